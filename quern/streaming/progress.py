"""Streaming twins of the progress operators: a running count and a stall detector."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.session import shared_path


def running_count(stream: DataFrame, by: str) -> DataFrame:
    """Finished items per class so far."""
    return stream.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def stall_detector(stream: DataFrame, worker: str, ts: str, minutes: int = 60, report_open: bool = False) -> DataFrame:
    """(worker, silent_from, silent_to): gaps of more than so many minutes in the order of arrival.

    The state of a worker is its last time; times within a batch are sorted first. With ``report_open``
    a worker from which nothing has arrived for so many minutes of the clock is reported with a null ``silent_to``,
    once until it comes back; such a stream never ends by itself, as it waits for the clock.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times = sorted(t for f in frames for t in f[ts].astype("int64") // 1000)
        last = state.get[0] if state.exists else None
        if state.hasTimedOut:
            yield pd.DataFrame({worker: [key[0]], "silent_from": [pd.Timestamp(last, unit="us")], "silent_to": pd.Series([pd.NaT], dtype="datetime64[ns]")})
            return
        found = []
        for t in times:
            if last is not None and t - last > minutes * 60_000_000:
                found.append((key[0], pd.Timestamp(last, unit="us"), pd.Timestamp(t, unit="us")))
            last = t if last is None else max(last, t)
        state.update((last,))
        if report_open:
            state.setTimeoutDuration(minutes * 60_000)
        yield pd.DataFrame(found, columns=[worker, "silent_from", "silent_to"])

    kind = stream.schema[worker].dataType.simpleString()
    exact = stream.select(worker, F.col(ts).cast("timestamp").alias(ts))
    return exact.groupBy(worker).applyInPandasWithState(run, f"{worker} {kind}, silent_from timestamp, silent_to timestamp", "last long", "append", GroupStateTimeout.ProcessingTimeTimeout if report_open else GroupStateTimeout.NoTimeout)


def drain(result: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over what is there and return its result as a table.

    Each batch is written under its number, so a batch that runs again replaces itself.
    """
    spark = result.sparkSession
    out, marks = shared_path(spark, "stream"), shared_path(spark, "stream-marks")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    result.writeStream.outputMode(mode).option("checkpointLocation", marks).foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(result.schema).parquet(f"{out}/batch=*") if mode != "complete" else spark.read.option("basePath", out).parquet(out)
    if mode == "complete":
        rows = rows.join(F.broadcast(rows.agg(F.max("batch").alias("batch"))), "batch").drop("batch")
    return rows


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet file of a folder as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)

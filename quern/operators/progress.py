"""Progress, stalls, restarts and resumption over logs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.config import Progress
from quern.functions import numeric


def done_ids(lines: DataFrame, column: str = "line") -> DataFrame:
    """Distinct numeric ids of a log of finished items; other lines are ignored."""
    clean = F.regexp_replace(column, r"(?U)^\s+|\s+$", "")
    return lines.where(clean.rlike("^[0-9]+$")).select(clean.try_cast("long").alias("id")).where("id IS NOT NULL").distinct()


def todo(corpus: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    return corpus.join(done.select(key), key, "left_anti")


def poll(done: DataFrame, p: Progress = Progress()) -> DataFrame:
    """How many are done, the share in percent, and whether the target is reached."""
    return done.agg(F.count(F.lit(1)).alias("done")).select("done", numeric.percent_done(F.col("done"), p.target).alias("percent"), (F.col("done") >= p.target).alias("finished"))


def micros(rows: DataFrame, ts: str) -> Column:
    """Microseconds of a time of ``rows``: of one without a zone by its own calendar, whatever the session's zone."""
    if not isinstance(rows.schema[ts].dataType, T.TimestampNTZType):
        return F.unix_micros(F.col(ts).cast("timestamp"))
    c = F.col(ts)
    return ((F.unix_date(c.cast("date")).cast("long") * 24 + F.hour(c)) * 60 + F.minute(c)) * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def throughput(events: DataFrame, ts: str, target: int, by: list[str] | None = None) -> DataFrame:
    """Items per second between the first and the last, and hours until the target."""
    at = micros(events, ts)
    seconds = F.max(at) - F.min(at)
    out = events.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("done"), (seconds / 1e6).alias("seconds"))
    rate = F.when(F.col("seconds") > 0, F.col("done") / F.when(F.col("seconds") > 0, F.col("seconds")))
    return out.withColumn("rate", rate).withColumn("eta_hours", F.greatest(F.lit(target) - F.col("done"), F.lit(0)) / F.col("rate") / 3600)


def stalls(events: DataFrame, by: str, ts: str, minutes: int = Progress.stall_minutes) -> DataFrame:
    """(by, stalled_from, stalled_to): gaps of more than so many minutes between items of a worker."""
    before = F.lag(ts).over(Window.partitionBy(by).orderBy(ts))
    both = events.select(by, ts, before.alias("stalled_from"))
    gap = micros(both, ts) - micros(both, "stalled_from")
    return both.where(gap > minutes * 60_000_000).select(by, "stalled_from", F.col(ts).alias("stalled_to"))


def open_stalls(events: DataFrame, by: str, ts: str, now: DataFrame, minutes: int = Progress.stall_minutes) -> DataFrame:
    """(by, stalled_from): workers that have been silent for more than so many minutes at the time ``now``, a table of one time."""
    last = events.groupBy(by).agg(F.max(ts).alias("stalled_from"))
    column = now.columns[0]
    at = last.join(F.broadcast(now.select(micros(now, column).alias("_now")).limit(1)))
    return at.where(F.col("_now") - micros(last, "stalled_from") > minutes * 60_000_000).select(by, "stalled_from")


def restarts(ticks: DataFrame, by: str, ts: str, active: str, p: Progress = Progress()) -> DataFrame:
    """(by, ts, restart): restarts at every ``quiet_ticks``-th inactive tick in a row, at most ``most_restarts``.

    An active tick, or a restart, begins the count anew.
    """
    order = Window.partitionBy(by).orderBy(ts)
    island = F.sum(F.col(active).cast("int")).over(order)
    quiet = ticks.withColumn("_island", island).where(~F.col(active))
    nth = F.row_number().over(Window.partitionBy(by, "_island").orderBy(ts))
    fired = quiet.withColumn("_nth", nth).where(F.col("_nth") % p.quiet_ticks == 0)
    return fired.withColumn("restart", F.row_number().over(order)).where(F.col("restart") <= p.most_restarts).select(by, ts, "restart")


def with_retries(rows: DataFrame, call: Callable[[str], str], key: str, value: str, lanes: int, p: Progress = Progress(), wait: Callable[[float], None] | None = None) -> DataFrame:
    """(key, ok, attempts, result, error): call a service for every row, with growing waits between attempts.

    ``lanes`` is the number of concurrent callers. A failure is a row, not a failed task.
    """
    import time

    wait = wait or time.sleep

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, v in zip(batch[key], batch[value], strict=True):
                result = error = None
                for attempt in range(1, p.retries + 1):
                    try:
                        result, error = call(v), None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                        wait(2.0**attempt)
                out.append((k, error is None, attempt, result, error))
            yield pd.DataFrame(out, columns=[key, "ok", "attempts", "result", "error"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, value).repartition(lanes).mapInPandas(run, f"{key} {kind}, ok boolean, attempts int, result string, error string")

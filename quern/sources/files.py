"""Readers and writers of the stage files.

Pipe files quote minimally and double embedded quotes; tab and line files don't quote at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RAW_SCHEMA = "id long, sentence string, duration_s double, bytes long"
PAIR_SCHEMA = "clip_id string, sentence string"
CORPUS_SCHEMA = "id long, sentence string, phonemes string, category string, prosody string, n_accent int"
DROP_SCHEMA = "id long, filter string, error string, duration double, chars int, ratio double, peak double, rms double, count int, wer double, ref string, hyp string, ecapa double, wavlm double, axis string, value double, mu double, sd double"
_PIPE = {"sep": "|", "quote": '"', "escape": '"'}


def scan_text_docs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of whole text files; malformed bytes are dropped, not replaced."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    return files.select("path", F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit("")).alias("text"))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """(value, path, block, at): lines with their file, the offset of the file's block that a task reads, and their order in the task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """(id, line): trimmed non-blank lines, numbered from 0 by file and place in it.

    A large file is read block by block: lines are numbered within their block, and the counts of all
    blocks, one row for each, tell where a block's numbers begin.
    """
    line = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    kept = _placed(spark, path).select(line.alias("line"), "path", "block", "at").where("line <> ''")
    blocks = kept.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("path", "block", F.coalesce(before, F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("path", "block").orderBy("at")) - 1
    return kept.withColumn("own", own).join(starts, ["path", "block"]).select((F.col("start") + F.col("own")).cast("long").alias("id"), "line")


def scan_psv(spark: SparkSession, path: str, schema: str = RAW_SCHEMA, header: bool = True) -> DataFrame:
    return spark.read.options(**_PIPE).csv(path, schema=schema, header=header)


def sink_psv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.options(**_PIPE).csv(path, header=header)


def scan_tsv_kv(spark: SparkSession, path: str) -> DataFrame:
    """(key, value): lines split at the first tab, the last line of a key wins; others are ignored."""
    return last_wins(_placed(spark, path).select(F.struct("path", "block", "at").alias("at"), F.col("value").alias("line")))


def last_wins(lines: DataFrame) -> DataFrame:
    """Key and value of (at, line), split at the first tab; the greatest ``at`` of a key wins."""
    parts = F.split("line", "\t", 2)
    return lines.where(F.col("line").contains("\t")).groupBy(parts[0].alias("key")).agg(F.max_by(parts[1], "at").alias("value"))


def sink_tsv(df: DataFrame, path: str) -> None:
    """One line per row, values as they are."""
    df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])).write.text(path)


def sink_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.text(path)


def scan_jsonl(spark: SparkSession, path: str, schema: str = DROP_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_json_doc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def sink_jsonl(df: DataFrame, path: str) -> None:
    df.write.json(path)


def sink_manifest(values: dict[str, Column], counts: DataFrame, path: str) -> None:
    """One nested JSON object from a one-row table."""
    counts.select(F.to_json(F.struct(*[c.alias(n) for n, c in values.items()]))).coalesce(1).write.text(path)


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, modified): file names without their content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", F.col("modificationTime").alias("modified"))


def sink_vector(df: DataFrame, path: str) -> None:
    """A table of one vector per name."""
    df.coalesce(1).write.parquet(path)


def scan_vector(spark: SparkSession, path: str, column: str = "centroid") -> DataFrame:
    """The one vector that ``sink_vector`` wrote, as a one-row table to be joined to all rows."""
    return spark.read.parquet(path).select(F.col(column).cast("array<double>").alias(column)).limit(1)


def append_once(df: DataFrame, path: str) -> None:
    """Append rows to a progress table; ``read_once`` makes repeats harmless."""
    df.write.mode("append").parquet(path)


def read_once(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    return spark.read.parquet(path).dropDuplicates([key])


def markdown_report(title: str, tables: dict[str, DataFrame], most_rows: int = 200) -> str:
    """A report from small aggregates; longer tables are named with their length."""
    out = [f"# {title}"]
    for name, df in tables.items():
        rows = df.limit(most_rows + 1).collect()
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows[:most_rows]]
        if len(rows) > most_rows:
            out.append(f"\n({df.count()} rows)")
    return "\n".join(out) + "\n"

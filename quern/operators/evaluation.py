"""Splits, vector summaries and the comparison of competing checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.config import Evaluation
from quern.functions import numeric


def split_key(clip_id: Column, seed: int) -> Column:
    """A hash by which a clip keeps its place however many clips there are."""
    return F.md5(F.concat(F.lit(f"{seed}:"), clip_id.cast("string")).cast("binary"))


def train_eval_split(clips: DataFrame, e: Evaluation = Evaluation(), key: str = "clip_id") -> DataFrame:
    """``clips`` with ``split``: the ``eval_size`` least hashes are eval, the rest train.

    The cut is the hash of the last eval row, found by a top-k; the table itself isn't sorted.
    """
    hashed = clips.withColumn("_h", F.concat(split_key(F.col(key), e.seed), F.lit(":"), F.col(key).cast("string")))
    cut = hashed.select("_h").orderBy("_h").limit(e.eval_size).agg(F.max("_h").alias("_cut"))
    return hashed.join(F.broadcast(cut)).withColumn("split", F.when(F.col("_h") <= F.col("_cut"), "eval").otherwise("train")).drop("_h", "_cut")


def split_overlap(a: DataFrame, b: DataFrame, key: str = "clip_id") -> DataFrame:
    """How many eval clips of one split train the other."""
    ev, tr = a.where("split = 'eval'").select(key), b.where("split = 'train'").select(key)
    return ev.join(tr, key, "left_semi").agg(F.count(F.lit(1)).alias("leaked"))


def centroid(rows: DataFrame, vector: str, by: list[str]) -> DataFrame:
    """Element-wise means as (by, centroid): positions are averaged apart, so no group is gathered."""
    parts = rows.select(*by, F.posexplode(vector).alias("at", "x")).groupBy(*by, "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"])
    return parts.groupBy(*by).agg(listed.alias("centroid"))


def pair_similarity(takes: DataFrame, key: str, take: str, vector: str) -> DataFrame:
    """(key, similarity) of takes 1 and 2; keys with one of them only are left out."""
    one = takes.where(F.col(take) == 1).select(key, F.col(vector).alias("a"))
    two = takes.where(F.col(take) == 2).select(key, F.col(vector).alias("b"))
    return one.join(two, key).select(key, numeric.cosine(F.col("a"), F.col("b")).alias("similarity"))


def summary(rows: DataFrame, by: str = "checkpoint", e: Evaluation = Evaluation()) -> DataFrame:
    """Means and medians per checkpoint, the composite's mean and variance, and the rank score."""
    scored = rows.withColumn("composite", numeric.composite(F.col("ecapa"), F.col("wavlm"), F.col("wer"), e))
    median = lambda c: F.percentile(c, F.lit(0.5))
    out = scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_eval"),
        *[x for c in ("wer", "ecapa", "wavlm") for x in (F.avg(c).alias(f"{c}_mean"), median(c).alias(f"{c}_p50"))],
        F.avg("composite").alias("composite_mean"),
        F.var_pop("composite").alias("composite_var"),
    )
    mean = F.col("composite_mean")
    return out.withColumn("rank_score", mean - e.variance_weight * F.col("composite_var")).withColumn("ambiguous", (mean > e.band[0]) & (mean < e.band[1]))


def winner(summaries: DataFrame, order: str = "checkpoint") -> DataFrame:
    """The checkpoint with the greatest rank score; a missing score is the least, ties go to the first."""
    return summaries.orderBy(F.coalesce("rank_score", F.lit(-1e9)).desc(), order).limit(1)


def latest(files: DataFrame, n: int, by: tuple[str, ...] = ("modified", "path")) -> DataFrame:
    """The n latest, in ascending order; fewer if there are fewer."""
    return files.orderBy(*[F.desc(c) for c in by]).limit(n).orderBy(*by)


def first_n(rows: DataFrame, n: int, *order: str) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def sort_multi(rows: DataFrame, *keys: str) -> DataFrame:
    """All rows in the order of several keys, by ranges: a global order without one task that sorts all."""
    return rows.orderBy(*keys)


def step_of(path: Column) -> Column:
    """The training step in a checkpoint's name, as a number."""
    return F.regexp_extract(path, r"step=(\d+)\.ckpt$", 1).try_cast("int")


def milestone_reached(files: DataFrame, step: int) -> DataFrame:
    return files.agg(F.coalesce(F.bool_or(step_of(F.col("path")) >= step), F.lit(False)).alias("reached"))


def resume_from(files: DataFrame, base: str) -> DataFrame:
    """The latest checkpoint, or the base one."""
    return files.agg(F.coalesce(F.max_by("path", F.struct("modified", "path")), F.lit(base)).alias("resume_from"))


def deduped_union(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Both in order of origin; a key of the first table wins."""
    both = first.withColumn("origin", F.lit(1)).unionByName(second.withColumn("origin", F.lit(2)))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("origin"))
    return both.withColumn("_r", rank).where("_r = 1").drop("_r")

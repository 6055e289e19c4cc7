"""Curation: sentences, acceptance, order-stable deduplication, coverage and balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.config import Curation
from quern.functions import text


def sentences(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, pos, sentence): one row per sentence, numbered from 0 in its document."""
    return docs.select(key, F.posexplode(text.sentence_split(F.col(column))).alias("pos", "sentence"))


def normal_sentences(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``sentences``, normalised. That is done before they become rows, as filters on rows that
    are pushed below a projection would repeat it once per rule."""
    return docs.select(key, F.posexplode(text.normalize_all(text.sentence_split(F.col(column)))).alias("pos", "sentence"))


def accepted(rows: DataFrame, column: str = "sentence") -> DataFrame:
    """Of normalised sentences those that no rule rejects, with their number of words."""
    return rows.where(text.reject_reason(F.col(column)).isNull()).withColumn("n_words", text.word_count(F.col(column)))


def reject_histogram(rows: DataFrame, column: str = "sentence") -> DataFrame:
    """Normalised sentences by the first rule that rejects them."""
    reason = F.coalesce(text.reject_reason(F.col(column)), F.lit("accepted"))
    return rows.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def dedupe_first(rows: DataFrame, column: str = "sentence", order: tuple[str, ...] = ("doc_id", "pos")) -> DataFrame:
    """One row per lower-cased text: the first in the given order, as it was written.

    An aggregate, not a window: copies are merged before the shuffle, so a text that fills a third
    of the table costs one row per task.
    """
    rest = [c for c in rows.columns if c not in order]
    least = F.min(F.struct(*order, *rest)).alias("first")
    return rows.groupBy(F.lower(column).alias("_key")).agg(least).select(*[f"first.{c}" for c in rows.columns])


def labelled(rows: DataFrame, column: str = "sentence") -> DataFrame:
    """With length bucket and prosody class; rows without a bucket go."""
    return rows.withColumn("category", text.length_bucket(text.word_count(F.col(column)))).withColumn("prosody", text.prosody(F.col(column))).where("category IS NOT NULL")


def curated(docs: DataFrame) -> DataFrame:
    """Sentence split, normalisation, acceptance, deduplication and labels."""
    return labelled(dedupe_first(accepted(normal_sentences(docs))))


def corpus_funnel(docs: DataFrame) -> DataFrame:
    return curated(docs).groupBy("category", "prosody").agg(F.count(F.lit(1)).alias("n"))


def funnel_counts(docs: DataFrame, c: Curation = Curation()) -> DataFrame:
    """Rows after each step, from one pass: copies are counted before the shuffle.

    A selection takes as many of the candidates as it is asked for, or all.
    """
    rows = normal_sentences(docs).select("sentence", text.reject_reason(F.col("sentence")).isNull().alias("ok"))
    key = F.when(F.col("ok"), F.lower("sentence"))
    keyed = rows.groupBy("ok", key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    labelled_ = text.length_bucket(text.word_count(F.col("key"))).isNotNull()
    whole = keyed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("1_raw"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("2_accepted"),
        F.count_if("ok").alias("3_unique"),
        F.count_if(F.col("ok") & labelled_).alias("4_candidates"),
    ).withColumn("5_selected", F.least("4_candidates", F.lit(c.target_size).cast("long")))
    return whole.select(F.inline(F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).alias("n")) for c in whole.columns])))


def phonemised(rows: DataFrame, column: str = "sentence") -> DataFrame:
    """With phoneme tokens from the stand-in phonemiser, their bigrams and the accent count."""
    with_tokens = rows.withColumn("tokens", text.phoneme_tokens(text.letter_phonemes(F.col(column))))
    return with_tokens.withColumn("bigrams", text.bigrams(F.col("tokens"))).withColumn("n_accent", text.accent_markers(F.col("tokens")))


def bigram_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("bigrams").alias("bigram")).groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


def coverage_summary(counts: DataFrame, c: Curation = Curation()) -> DataFrame:
    """Distinct and total bigrams, and how many lie below either floor."""
    return counts.agg(
        F.count(F.lit(1)).alias("distinct_bigrams"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_bigrams"),
        F.count_if(F.col("n") < c.bigram_floor).alias("below_floor"),
        F.count_if(F.col("n") < c.bigram_floor_rare).alias("below_rare_floor"),
    )


def marker_counts(rows: DataFrame, markers: list[str] = text.ACCENT_MARKERS) -> DataFrame:
    """For each marker the number of tokens that contain it, zeros included: one pass, no join."""
    tokens = rows.select(F.explode("tokens").alias("token"))
    sums = tokens.agg(*[F.count_if(F.col("token").contains(m)).alias(f"m{i}") for i, m in enumerate(markers)])
    entry = F.array(*[F.struct(F.lit(m).alias("marker"), F.col(f"m{i}").alias("n")) for i, m in enumerate(markers)])
    return sums.select(F.inline(entry))


def shares(rows: DataFrame, column: str, targets: dict[str, float]) -> DataFrame:
    """Count, share and target of each class; classes of the targets without rows are kept."""
    counts = rows.groupBy(F.col(column).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    wanted = rows.sparkSession.createDataFrame(list(targets.items()), "class string, target double")
    both = wanted.join(counts, "class", "left").select("class", F.coalesce("n", F.lit(0)).alias("n"), "target")
    whole = counts.agg(F.greatest(F.coalesce(F.sum("n"), F.lit(0)), F.lit(1)).alias("whole"))
    return both.join(F.broadcast(whole)).select("class", "n", (F.col("n") / F.col("whole")).alias("share"), "target")


def stratified_topk(rows: DataFrame, size: int, c: Curation = Curation()) -> DataFrame:
    """A deterministic selection: a quota per category and prosody class, filled by a static score.

    The quota is the product of the targets times the size, rounded up. The score is twice the
    number of accent markers plus the number of bigrams; ties go to the earlier sentence. This is
    not the greedy selection.
    """
    quota = F.lit(0)
    for cat, a in c.length_target.items():
        for pro, b in c.prosody_target.items():
            quota = F.when((F.col("category") == cat) & (F.col("prosody") == pro), -int(-round(a * b * size, 6) // 1)).otherwise(quota)
    score = c.accent_weight * F.col("n_accent") + F.size("bigrams")
    rank = F.row_number().over(Window.partitionBy("category", "prosody").orderBy(F.desc("score"), "doc_id", "pos"))
    return rows.withColumn("score", score).withColumn("rank", rank).where(F.col("rank") <= size).where(F.col("rank") <= quota)


def merge_cache(wanted: DataFrame, cache: DataFrame, compute: Column, key: str = "sentence", value: str = "phonemes") -> tuple[DataFrame, DataFrame]:
    """(rows with their cached or computed value, the cache with what was missing).

    An empty cached value counts as missing.
    """
    known = cache.groupBy(key).agg(F.max(value).alias("cached"))
    looked = wanted.join(known, key, "left").withColumn("hit", F.coalesce(F.col("cached") != "", F.lit(False)))
    filled = looked.withColumn(value, F.when(F.col("hit"), F.col("cached")).otherwise(compute)).drop("cached")
    added = filled.where("NOT hit").groupBy(key).agg(F.max(value).alias(value))
    return filled, cache.where(F.col(value) != "").select(key, value).unionByName(added)

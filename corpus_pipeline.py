"""A training-text pipeline over ``documents``: each stage works on what its predecessor kept.

Language identification, quality rules, near-duplicate removal, removal of passages that repeat
across documents, and packing. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import jaccard_join, langid, packing, passage_dedup, quality_rules
from quern.session import prepare, remove, shared_path, spread, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be determined stay.

    Null and empty texts, and those without a letter, have none and go; a null ``lang`` or id is as good as any.
    Repeated rows are judged alike. All columns are returned as they came, an empty table as an empty one.
    """
    prepare(spark)
    return langid.keep_identified(docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and the compression bands stay.

    Null and empty texts have no words and go. Repeated rows are judged alike, texts of any length whole; only the text counts.
    """
    prepare(spark)
    return quality_rules.keep_passing(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, by five-word shingles at 0.8, the document with the least id stays.

    Of rows that repeat id and text one stays. Rows with a null id, and texts without a word, are in no class and stay.
    """
    prepare(spark)
    return jaccard_join.keep_first(docs, n=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more that an earlier document holds are cut; documents of which nothing is left go.

    Earlier means of smaller id; rows with a null id, null and empty texts stay as they are. ``n_chars`` is set anew where a text is cut.
    """
    prepare(spark)
    return passage_dedup.clean(docs, min_words=50)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence, and their ids.

    Null and empty texts are one token, the end mark. Repeated rows, and rows with a null id, are packed each for itself.
    """
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("ngram_jaccard_join", join_near_duplicates),
    ("passage_dedup", drop_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: Profiles, compression, chaining and packing can't be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written as Parquet and reread; what the next has read is deleted."""
    docs, before = spread(table(prepare(spark), sf_dir, "documents")), None
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs

"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams (one to three letters, a
blank at word ends). A document gets the language whose profile is nearest by out-of-place
distance: for each of the document's most frequent n-grams the difference of its ranks in the two
lists, or the profile's length where the language's list lacks it.

Results in odd cases: a null text, an empty one or one without a letter gets ``und`` and score 0;
with no labelled rows everything is ``und``; equal distances go to the alphabetically first
language; rows whose label is null teach nothing; repeated rows each count and each get a row.
Input columns other than those named are kept by ``predict`` unless they clash with an output
name, in which case the output replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.aside import set_aside

PROFILE_SIZE = 400
#: Upper bound, in expectation, of labelled rows per language that a profile is learned from.
TRAIN_ROWS_PER_LANGUAGE = 4000
UNDETERMINED = "und"
#: Characters whose n-grams are counted at once.
_PIECE = 1 << 20
_SHIFT = 21  # bits of a code point; three of them fill one 64-bit key


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the letter n-grams of a text; both empty if it has no letter.

    Counted piece by piece, so that a very long text takes little more memory than itself.
    """
    keys = counts = np.empty(0, np.int64)
    tail, inside = np.array([32], np.int64), False  # what n-grams of the next piece may begin with; whether a letter came last
    lowered = (text or "").lower()
    for at in range(0, len(lowered), _PIECE):
        code = np.frombuffer(lowered[at : at + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[code]
        # every run of other characters becomes one blank, and the text ends with blanks
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= inside
        inside = letter[-1]
        c = np.where(letter, code, 32)[keep].astype(np.int64)
        if at + _PIECE >= len(lowered):
            c = np.append(c, 32)
        c = np.concatenate((tail, c))
        new = len(c) - len(tail)
        one, pair, triple = c[len(tail) :], c[-new - 1 :], c[-new - 2 :]
        one = one[one != 32]
        two = (pair[:-1] << _SHIFT | pair[1:])[(pair[:-1] != 32) | (pair[1:] != 32)]
        three = (triple[:-2] << 2 * _SHIFT | triple[1:-1] << _SHIFT | triple[2:])[triple[1:-1] != 32]
        tail = c[-2:]
        found = np.unique(np.concatenate((one, two, three)), return_counts=True)
        if not len(keys):
            keys, counts = found
        elif len(found[0]):
            keys, place = np.unique(np.concatenate((keys, found[0])), return_inverse=True)
            counts = np.bincount(place, np.concatenate((counts, found[1]))).astype(np.int64)
    return keys, counts


def top_ngrams(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The keys of the most frequent n-grams, ties to the smaller key."""
    return keys[np.lexsort((keys, -counts))[:size]]


class Profiles:
    """Profiles of a few languages, as a lookup from n-gram to its rank in each."""

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size, self.names = size, sorted(ranked)
        self.keys = np.array(sorted({k for ks in ranked.values() for k in ks}), np.int64)
        self.ranks = np.full((len(self.keys) + 1, len(self.names)), -1, np.int64)  # the last row: unknown n-grams
        for j, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.keys, np.array(ranked[name], np.int64)), j] = np.arange(len(ranked[name]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 minus its distance over the largest possible one."""
        keys, counts = ngram_counts(text)
        if not len(keys) or not self.names:
            return UNDETERMINED, 0.0
        own = top_ngrams(keys, counts, self.size)
        at = np.searchsorted(self.keys, own)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != own)] = len(self.keys)
        rank = self.ranks[at]
        apart = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.names[best], float(1 - apart[best] / (self.size * len(own)))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", size: int = PROFILE_SIZE, rows_per_language: int = TRAIN_ROWS_PER_LANGUAGE) -> Profiles:
    """Profiles of all labels, from a bounded hash sample of the rows of each label.

    The sample holds about ``rows_per_language`` rows of a label (all of them if there are fewer),
    picked by a hash of the key, so it doesn't depend on partitioning. Counts are summed in each
    task before they are shuffled; only the profiles come to the driver.
    """
    known = labelled.where(F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    share = {r["lang"]: min(1.0, rows_per_language / r["n"]) for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return Profiles({}, size)
    limit = F.create_map(*[F.lit(x) for name, part in share.items() for x in (name, int(part * 2**32))])
    sample = known.where(F.crc32(F.concat(F.lit("profile:"), F.col("key").cast("string")).cast("binary")) < limit[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, dict[int, int]] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                mine = total.setdefault(lang, {})
                for k, n in zip(*(x.tolist() for x in ngram_counts(text)), strict=True):
                    mine[k] = mine.get(k, 0) + n
        for lang, mine in total.items():
            if mine:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(mine)), pa.array(list(mine), pa.int64()), pa.array(list(mine.values()), pa.int64())], names=["lang", "gram", "n"])

    counts = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked: dict[str, list[int]] = {name: [] for name in share}
    for r in counts.withColumn("rank", rank).where(F.col("rank") <= size).orderBy("lang", "rank").collect():
        ranked[r["lang"]].append(r["gram"])
    return Profiles({k: v for k, v in ranked.items() if v}, size)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; one row per input row."""
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score")]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.nearest(t) for t in batch.column(text).to_pylist()]
            names = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=[*names, "lang_pred", "score"])

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(assign, schema)


def held_out(key: str = "doc_id") -> Column:
    """True for the rows that no profile may learn from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows that aren't held out and predict every row."""
    profiles = learn(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return predict(docs.select("doc_id", "text"), profiles).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.25) -> DataFrame:
    """The rows whose language is determined with at least ``min_score``; columns as they were."""
    profiles = learn(docs.where(~F.coalesce(held_out(), F.lit(False))))
    moved, back = set_aside(docs, ("lang_pred", "score"))
    return back(predict(moved, profiles).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)))

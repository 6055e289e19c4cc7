"""Stupid-backoff language-model scores, computed relationally.

Counts of all one-, two- and three-word sequences of the whole table are summed in tables that are
partitioned by hash, joined back to each bucket's n-grams, and the log scores of a document's
words are summed; once with all counts, and once with the document's own occurrences taken off all
counts that score it, so that a document isn't judged by itself; copies elsewhere still count. (With
all counts each sequence of the table is seen, so only the first two words of a document back off.)

N-grams are hashes of 48 bits, and beyond 256 buckets of one bit more for each doubling, so the share that collides stays below one in a million.

A word after its two predecessors scores count(three words) / count(first two); where that
sequence is unseen, ``alpha`` times count(two words) / count(first); else ``alpha`` squared times
count(word) / all words; an unseen word ``alpha`` cubed / all words. The first two words of a
document start from the longest sequence that they can end, with as many factors ``alpha`` fewer.

Words are lower-cased in A-Z and separated by blanks and 0x09 to 0x0D. Results in odd cases: null
and empty text have no words, a log score of 0 and a null mean; repeated rows are documents of
their own and each gets a row; an empty table gives no rows. Columns other than the key and the
text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quern.llm import count_exchange as exchange
from quern.llm import wordhash

ORDER = 3
ALPHA = 0.4
#: Texts of a bucket; scoring holds about sixty bytes per byte of them.
BUCKET_BYTES = 4_000_000
#: The key under which the number of all words is counted.
TOTAL = np.uint64(0)


def sequence_keys(words: np.ndarray, owners: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each order, the key of the sequence that ends at each word; 0 where the document is too short."""
    found = []
    for n in range(1, ORDER + 1):
        key = np.zeros(len(words), np.uint64)
        h, _ = wordhash.ngram_hashes(words, owners, n)
        last = len(words) - n + 1
        inside = np.flatnonzero(owners[: max(0, last)] == owners[n - 1 :]) + n - 1 if last > 0 else np.empty(0, np.int64)
        key[inside] = np.maximum(wordhash.keys(h, bits), np.uint64(1))
        found.append(key)
    return found


def _asked(bits: int) -> Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]:
    def run(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        words, owners = wordhash.word_hashes(exchange.texts_of(table))
        every = np.concatenate(sequence_keys(words, owners, bits))
        found, counts = exchange.summed(every[every != TOTAL])
        return np.concatenate(([TOTAL], found)), np.concatenate(([len(words)], counts))

    return run


def _logs(counts: np.ndarray, total: np.ndarray, top: np.ndarray, alpha: float) -> np.ndarray:
    """The log score of each word from the counts of the sequences, by order, that end at it."""
    with np.errstate(divide="ignore", invalid="ignore"):
        log = top * np.log(alpha) - np.log(np.maximum(total, 1))
        log = np.where(counts[0] > 0, np.log(counts[0] / np.maximum(total, 1)) + (top - 1) * np.log(alpha), log)
        for n in range(2, ORDER + 1):
            before = np.concatenate(([0], counts[n - 2][:-1]))  # the sequence without its last word ends one word earlier
            log = np.where((counts[n - 1] > 0) & (before > 0), np.log(counts[n - 1] / np.maximum(before, 1)) + (top - n) * np.log(alpha), log)
    return log


def _scores(table: pa.Table, answers: pa.Table, alpha: float, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each document of a bucket, and its log scores with and without its own occurrences."""
    texts = exchange.texts_of(table)
    words, owners = wordhash.word_hashes(texts)
    n_words = np.bincount(owners, minlength=len(texts))
    if not len(words):
        return n_words, np.zeros(len(texts)), np.zeros(len(texts))
    every = np.concatenate(sequence_keys(words, owners, bits))
    of = np.tile(owners, ORDER)
    # one sort finds each key's place among the bucket's keys, and its count in its document: sequences of
    # different lengths have different keys, and those of one length come by document
    order = np.argsort(every, kind="stable")
    k, d = every[order], of[order]
    new_key = np.concatenate(([True], k[1:] != k[:-1]))
    new_pair = new_key | np.concatenate(([True], d[1:] != d[:-1]))
    place = np.cumsum(new_key) - 1 + (k[0] != TOTAL)  # the bucket's keys start with the total
    pair = np.cumsum(new_pair) - 1
    corpus = exchange.received(answers, int(place[-1]) + 1)[0]
    own = np.diff(np.concatenate((np.flatnonzero(new_pair), [len(k)])))[pair]
    top = np.minimum(ORDER, np.arange(len(words)) - np.concatenate(([0], np.cumsum(n_words)))[owners] + 1)
    found = []
    for less, rest in ((0, corpus[0]), (own, corpus[0] - n_words[owners])):
        seen = np.empty(len(every), np.int64)
        seen[order] = corpus[place] - less
        seen[every == TOTAL] = 0
        log = _logs(seen.reshape(ORDER, len(words)), rest, top, alpha)
        found.append(np.bincount(owners, weights=log, minlength=len(texts)))
    return n_words, *found


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", alpha: float = ALPHA) -> DataFrame:
    """(key, n_words, log_score, mean_log_score, full_log_score) of every document under counts of all documents.

    ``log_score`` and its mean per word leave the document's own occurrences out; ``full_log_score`` doesn't.
    """
    buckets, n = exchange.dealt(docs, key, text, BUCKET_BYTES)
    bits = wordhash.key_bits(n)
    answers = exchange.exchange(buckets, n, _asked(bits), bits)
    kind = docs.schema[key].dataType
    fields = [("key", kind), ("n_words", T.LongType()), ("log_score", T.DoubleType()), ("mean_log_score", T.DoubleType()), ("full_log_score", T.DoubleType())]

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        n_words, full, log = _scores(table, answers, alpha, bits)
        mean = pa.array(log / np.maximum(n_words, 1), mask=n_words == 0)
        return pa.table({"key": table.column("key"), "n_words": pa.array(n_words.astype(np.int64)), "log_score": pa.array(log), "mean_log_score": mean, "full_log_score": pa.array(full)})

    return buckets.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(run, T.StructType([T.StructField(*f) for f in fields])).withColumnRenamed("key", key)

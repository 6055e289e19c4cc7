"""Global counts, or first holders, of hashed n-grams, for documents that are dealt to buckets.

A bucket asks for the counts of its distinct keys: it sends each block of the key space the
sorted keys that it has there with their counts in the bucket. A block adds these up and answers
with the sums, in the order in which the keys were asked. In place of counts any few numbers per key
can travel that blocks merge; so do the first holders of keys. So n-grams are counted within a bucket
before anything is shuffled, and keys travel as compressed differences. An n-gram that a
third of all documents hold is one key per bucket.

There are as many blocks in the end as buckets, but a bucket asks no more than ``FAN`` of them: beyond
that, the requests of ``FAN`` buckets for one part of the key space are added up and asked on, part by
part. So each table that travels carries about 1/``FAN`` of a bucket's keys at any size of the input,
and the number of tables is in proportion to the buckets, times the logarithm of their number.

Rows go to buckets by a hash of id and text: only rows that repeat both are sure to meet in one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 5_000_000
FAN_BITS = 8
FAN = 1 << FAN_BITS


def dealt(docs: DataFrame, key: str, text: str, bucket_bytes: int = BUCKET_BYTES, carry: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """(bucket, key, text, and the columns to carry) with as many buckets as the texts need to be of about that size; and their number."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(n)).cast("int")
    return docs.select(bucket.alias("bucket"), F.col(key).alias("key"), F.col(text).alias("text"), *carry), n


def packed(values: np.ndarray) -> bytes:
    """Compressed bytes of an unsigned array, planes of equal significance together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def summed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    values = np.sort(values)
    if not len(values):
        return values, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.diff(np.concatenate((first, [len(values)])))


def hops(n_buckets: int, fan_bits: int = FAN_BITS) -> list[int]:
    """Bits of the key that each hop of the requests resolves."""
    bits = max(0, n_buckets - 1).bit_length()
    return [fan_bits] * (bits // fan_bits) + [bits % fan_bits] * (bits % fan_bits > 0) or [0]


def _deltas(keys: np.ndarray) -> bytes:
    return packed(np.concatenate((keys[:1], np.diff(keys))))


def undone(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)


def _split(keys: np.ndarray, values: np.ndarray, block: int, done: int, bits: int, key_bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Requests for the parts of a block (of ``done`` leading bits) that the next ``bits`` make: their numbers, keys and values."""
    parts = (keys >> np.uint64(key_bits - done - bits)).astype(np.int64) if done + bits else np.zeros(len(keys), np.int64)
    edges = np.searchsorted(parts, (block << bits) + np.arange((1 << bits) + 1))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[i], edges[i + 1])
        yield (block << bits) + i, _deltas(keys[part]), packed(values[:, part].ravel())


Merge = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def add(values: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the values of each key: the merge for counts."""
    return np.add.reduceat(values[:, np.argsort(place, kind="stable")], starts, axis=1)


def first_holder(values: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The merge for (document, 2 * place + whether several documents hold the key, bucket): the least document's."""
    order = np.lexsort((values[0], place))
    doc, flagged, bucket = values[:, order]
    ends = np.concatenate((starts[1:], [len(doc)])) - 1
    several = np.bitwise_or.reduceat(flagged & 1, starts) | (doc[ends] != doc[starts])
    return np.stack((doc[starts], (flagged[starts] & ~1) | several, bucket[starts]))


def _merged(table: pa.Table, merge: Merge) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The keys of each request, all distinct ones sorted, their merged values, and the place of every asked key among them."""
    asked = [undone(x) for x in table.column("asked").to_pylist()]
    every = np.concatenate(asked)
    order = np.argsort(every)
    ranked = every[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    place = np.empty(len(every), np.int64)
    place[order] = np.cumsum(new) - 1
    held = np.concatenate([unpacked(x, np.int64).reshape(-1, len(a)) for x, a in zip(table.column("held").to_pylist(), asked, strict=True)], axis=1)
    return asked, ranked[new], merge(held, place, np.flatnonzero(new)), place


def _replies(table: pa.Table, asked: list[np.ndarray], values: np.ndarray) -> pa.Table:
    ends = np.cumsum([len(a) for a in asked])
    return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "values": pa.array([packed(values[:, e - len(a) : e].ravel()) for a, e in zip(asked, ends, strict=True)], pa.binary())})


REQUEST, _REPLY = "bucket int, block int, asked binary, held binary", "bucket int, block int, values binary"


def _requests(bucket: int, rows: list[tuple[int, bytes, bytes]]) -> pa.Table:
    return pa.table({"bucket": pa.array([bucket] * len(rows), pa.int32()), "block": pa.array([r[0] for r in rows], pa.int32()), "asked": pa.array([r[1] for r in rows], pa.binary()), "held": pa.array([r[2] for r in rows], pa.binary())})


def _resolved(requests: DataFrame, done: int, left: list[int], merge: Merge, fan_bits: int, key_bits: int) -> DataFrame:
    """Replies (bucket, block, values) to requests for blocks of ``done`` bits; ``left`` are the hops still to go."""
    if not left:

        def answer(table: pa.Table) -> pa.Table:
            asked, _, values, place = _merged(table, merge)
            return _replies(table, asked, values[:, place])

        return requests.groupBy("block").applyInArrow(answer, _REPLY)

    def ask_on(table: pa.Table) -> pa.Table:
        _, keys, values, _ = _merged(table, merge)
        return _requests(table.column("many")[0].as_py(), list(_split(keys, values, table.column("block")[0].as_py(), done, left[0], key_bits)))

    def hand_back(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _replies(table.select(["bucket", "block"]), [], np.empty((1, 0), np.int64))
        asked, keys, _, place = _merged(table, merge)
        return _replies(table, asked, received(replies, len(keys))[:, place])

    gathered = requests.withColumn("many", F.shiftright("bucket", fan_bits))
    replies = _resolved(gathered.groupBy("many", "block").applyInArrow(ask_on, REQUEST), done + left[0], left[1:], merge, fan_bits, key_bits)
    above = replies.select(F.col("bucket").alias("many"), F.shiftright("block", left[0]).alias("above"), "block", "values")
    return gathered.groupBy("many", "block").cogroup(above.groupBy("many", "above")).applyInArrow(hand_back, _REPLY)


def asking(n_buckets: int, extract: Callable[..., tuple[np.ndarray, np.ndarray]], key_bits: int = 64, fan_bits: int = FAN_BITS) -> Callable[..., pa.Table]:
    """From a bucket's table, or tables, to its requests.

    extract: from the tables to sorted distinct keys, of ``key_bits`` bits, and their values (rows of numbers, or one).
    """
    first = hops(n_buckets, fan_bits)[0]

    def ask(table: pa.Table, *more: pa.Table) -> pa.Table:
        keys, values = extract(table, *more)
        bucket = table.column("bucket")[0].as_py() if table.num_rows else None
        return _requests(bucket, list(_split(keys, np.atleast_2d(values).astype(np.int64), 0, 0, first, key_bits)))

    return ask


def answered(requests: DataFrame, n_buckets: int, merge: Merge, key_bits: int = 64, fan_bits: int = FAN_BITS) -> DataFrame:
    """(bucket, block, values): for every bucket the merged values of the keys that it asked for."""
    first, *left = hops(n_buckets, fan_bits)
    return _resolved(requests, first, left, merge, fan_bits, key_bits)


def exchange(buckets: DataFrame, n_buckets: int, extract: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], key_bits: int = 64, fan_bits: int = FAN_BITS, merge: Merge = add) -> DataFrame:
    """``answered``, for what ``extract`` returns for each bucket."""
    ask = asking(n_buckets, extract, key_bits, fan_bits)
    return answered(buckets.groupBy("bucket").applyInArrow(lambda table: ask(table), REQUEST), n_buckets, merge, key_bits, fan_bits)


def received(answers: pa.Table, n_keys: int) -> np.ndarray:
    """The merged values of a bucket's keys, in the keys' order; one row per number that travels."""
    rows = sorted(zip(answers.column("block").to_pylist(), answers.column("values").to_pylist(), strict=True))
    found = [unpacked(x, np.int64) for _, x in rows]
    width = max(1, sum(len(x) for x in found) // max(1, n_keys))
    return np.concatenate([x.reshape(width, -1) for x in found], axis=1) if found else np.empty((width, 0), np.int64)


def texts_of(table: pa.Table) -> list[bytes | None]:
    return [None if t is None else t.encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]


def slices(table: pa.Table, rows: int = 20_000) -> Iterator[pa.Table]:
    """Parts of a bucket with few enough rows that a row's number takes 16 bits."""
    for k in range(0, table.num_rows, rows):
        yield table.slice(k, rows)

"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes: a bounded sample of the vectors is centred and rotated to its principal axes; several
orthogonal rotations are then learned that bring the rotated vectors close to the corners of the
cube (iterative quantisation), and the signs of all rotations together are the code. It is split into
substrings of 16 bits.

Index: for each substring a table of postings, the rows in the order of the substring's value and the
place where each of the 65,536 values begins. A query looks up all values within ``reach`` bits of its own
in every substring. By the pigeonhole principle that retrieves every code within a Hamming radius of
``substrings * (reach + 1) - 1`` bits, and besides those farther ones that agree with the query in one
substring. All that is retrieved, and nothing else, is ranked by its float distance. The number of
rotations, and only where those don't suffice the reach, are the least with which the wanted share of
the sample's true neighbours is retrieved; among more rows neighbours are nearer, so that is on the
safe side. Where a block of rows holds fewer than k of the retrieved, the reach grows for that
query until it gives k, so none comes short.

Rows are dealt to blocks of bounded size once; a task builds the index of a block and streams the stated
queries past it. So the rows are shuffled once, the queries once per block, and no product of both.
Each block gives at most k rows per query.

Results in odd cases: vectors that are null, empty, zero, of another length than the sample's, or
with a null or non-finite component take no part, as query or as candidate; equal distances go to
the smaller id; rows with the query's own id are no candidates; repeated rows are found
repeatedly, and are one query. Vectors of one id that differ are queries of their own, ranked together.
Fewer than k candidates are all returned. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The fit sees at most about so many rows, picked by a hash of the id.
SAMPLE_ROWS = 4096
MOST_ROTATIONS = 64
REACH = 2
TARGET_RECALL = 0.94
BITS = 16
#: Rows of a block, at most about; and bytes of their vectors.
BLOCK_ROWS = 65_536
BLOCK_BYTES = 64_000_000
#: Blocks aren't made smaller than this to keep all cores busy.
LEAST_ROWS = 4096
_BITS_SET = np.array([bin(i).count("1") for i in range(1 << BITS)], np.uint8)


def ball(reach: int) -> np.ndarray:
    """All differences of at most so many bits."""
    return np.array([sum(1 << b for b in c) for n in range(reach + 1) for c in combinations(range(BITS), n)], np.int64)


@dataclass
class Coder:
    mean: np.ndarray
    planes: np.ndarray  # dimensions x bits
    reach: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Substrings of the codes, one row per vector."""
        return np.packbits((x - self.mean) @ self.planes > 0, axis=1).view(">u2").astype(np.uint16)


def fit(sample: np.ndarray, k: int, target: float = TARGET_RECALL, most_rotations: int = MOST_ROTATIONS, seed: int = 7) -> Coder:
    """Learn rotations from a sample of vectors, as many as retrieve the wanted share of its neighbours."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1]
    v = centred @ axes
    asked = rng.permutation(len(sample))[:256]
    apart = ((sample[asked] ** 2).sum(axis=1)[:, None] + (sample**2).sum(axis=1) - 2 * sample[asked] @ sample.T)
    apart[np.arange(len(asked)), asked] = np.inf
    near = np.argsort(apart, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    d = v.shape[1]
    least = np.full(near.shape, BITS, np.uint8)  # fewest bits by which a substring of each pair differs
    planes: list[np.ndarray] = []
    per_step = -(-BITS // d)  # rotations that make a substring at least
    shares = np.zeros(BITS + 1)
    while len(planes) < most_rotations:
        made = []
        for _ in range(per_step):
            r = np.linalg.qr(rng.normal(size=(d, d)))[0]
            for _ in range(8):
                left, _, right = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
                r = (left @ right).T
            made.append(axes @ r)
        step = np.concatenate(made, axis=1)
        planes.append(step[:, : step.shape[1] // BITS * BITS])
        code = Coder(mean, planes[-1], 0).codes(sample)
        for j in range(code.shape[1]):
            least = np.minimum(least, _BITS_SET[code[near, j] ^ code[asked, j][:, None]])
        shares = np.array([(least <= r).mean() if least.size else 1.0 for r in range(BITS + 1)])
        if shares[REACH] >= target:
            break
    return Coder(mean, np.concatenate(planes, axis=1), int(np.flatnonzero((shares >= target) & (np.arange(BITS + 1) >= REACH))[0]))


class Index:
    """Postings of a block of rows by substring and value."""

    def __init__(self, coder: Coder, ids: np.ndarray, x: np.ndarray):
        self.coder, self.ids, self.x = coder, ids, x
        codes = coder.codes(x)
        n, m = codes.shape
        self.rows = np.empty((m, n), np.int32)
        self.starts = np.zeros((m, (1 << BITS) + 1), np.int32)
        for j in range(m):
            self.rows[j] = np.argsort(codes[:, j], kind="stable")
            np.cumsum(np.bincount(codes[:, j], minlength=1 << BITS), out=self.starts[j, 1:])
        self._balls: dict[int, np.ndarray] = {}

    def retrieve(self, code: np.ndarray, reach: int) -> np.ndarray:
        """The rows of which a substring is within reach of the query's; in order."""
        if reach not in self._balls:
            self._balls[reach] = ball(reach)
        m, n = self.rows.shape
        values = code.astype(np.int64)[:, None] ^ self._balls[reach]
        at = np.arange(m)[:, None]
        low = self.starts[at, values].astype(np.int64) + at * n
        size = (self.starts[at, values + 1] + at * n - low).ravel()
        full = np.flatnonzero(size)
        low, size = low.ravel()[full], size[full]
        where = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        hit = np.zeros(n, bool)
        hit[self.rows.reshape(-1)[where]] = True
        return np.flatnonzero(hit)

    def nearest(self, q: int, vector: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and distances of the k nearest rows that are retrieved, and how many were ranked."""
        others = len(self.ids) - int((self.ids == q).sum())
        for reach in range(self.coder.reach, BITS + 1):
            # from five bits on a substring's ball is larger than most blocks
            at = self.retrieve(code, reach) if reach < 5 else np.arange(len(self.ids))
            at = at[self.ids[at] != q]
            if len(at) >= min(k, others):
                break
        score = np.sqrt(((self.x[at].astype(np.float64) - vector) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[at], score))[:k]
        return self.ids[at][best], score[best], len(at)


def _usable(key: str, vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(key).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _sample(usable: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """About so many vectors, and how many there are."""
    total = usable.count()
    if not total:
        return np.empty((0, 0)), 0
    share = min(1.0, size / total)
    found = usable.where(F.crc32(F.concat(F.lit("sample:"), F.col("key").cast("string")).cast("binary")) < int(share * 2**32)).limit(2 * size).collect()
    lengths = [len(r["v"]) for r in found]
    usual = max(set(lengths), key=lambda n: (lengths.count(n), n), default=0)
    return np.array([r["v"] for r in found if len(r["v"]) == usual], np.float64), total


def _meet(coder: Coder, k: int):
    """Over rows sorted by block, and in each first its rows and then queries: the nearest rows of each query."""
    d = len(coder.mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, xs, index = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, asks, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                if blocks[a] != block:
                    block, ids, xs, index = blocks[a], [], [], None
                if not asks[a]:
                    ids.append(keys[a:b])
                    xs.append(x[a:b])
                elif ids:
                    if index is None:
                        index = Index(coder, np.concatenate(ids), np.concatenate(xs))
                        ids, xs = [index.ids], []
                    queries = x[a:b].astype(np.float64)
                    found = [index.nearest(q, v, c, k) for q, v, c in zip(keys[a:b], queries, coder.codes(queries), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys[a:b], [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], names=["query_id", "vec_id", "score"])

    return run


def search(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS, target: float = TARGET_RECALL) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score (the distance)."""
    spark = rows.sparkSession
    usable = rows.where(_usable(key, vector)).select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v"), is_query.alias("asks"))
    sample, total = _sample(usable.select("key", "v"), sample_rows)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    coder = fit(sample, k, target)
    d, lanes = sample.shape[1], int(spark.conf.get("spark.sql.shuffle.partitions"))
    # all blocks hold about as many rows; a small table's are smaller, so that all cores have some
    n_blocks = max(-(-total // max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * d)))), min(lanes, -(-total // LEAST_ROWS)))
    usable = usable.where(F.size("v") == d)
    dealt = usable.select(F.pmod(F.xxhash64("key", "v"), F.lit(n_blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "key", "v")
    queries = usable.where("asks").select("key", "v").distinct()
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(True).alias("asks"), "key", "v")
    stream = dealt.unionByName(asked).repartition(n_blocks, "block").sortWithinPartitions("block", "asks")
    found = stream.mapInArrow(_meet(coder, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

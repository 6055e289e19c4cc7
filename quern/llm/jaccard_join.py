"""Jaccard similarity join of documents over their word n-grams.

The links are the large entries of a product: of the sparse matrix of documents by n-grams with
its transpose, whose entries are overlap counts. It is computed in blocks, and entries that cannot
reach the threshold are discarded early by bounds that follow from the documents' sizes:

1. Count in how many documents each n-gram occurs (``count_exchange``). N-grams of one document
   add nothing to any overlap. A document with fewer shared n-grams than the threshold's part of
   its size links with nothing, which leaves few documents but copies.
2. In the order rarest n-gram first, two documents that link must share one of the first
   ``size - threshold * size + 1`` n-grams of both, and lie in the same or neighbouring bands of sizes.
   Each band with the one above it is a cell; documents of a cell that share one of those n-grams are
   candidates, and their connected components are families, outside which no entry can count. A family
   never leaves its cell, so chains of documents of ever other sizes don't grow together.
3. Each family is a sub-matrix. Its product is accumulated in blocks of a bounded number of
   n-grams: first over the leading n-grams, where entries that are zero, or whose documents differ
   too much in size for any overlap to reach the threshold, are dropped; then over all. Two documents
   of the upper band are left to their own cell. Of the links found, each block gives
   only as many as connect its documents alike, so a family of thousands of near copies gives
   thousands of rows, not millions.
4. Documents with equal sets are one document in steps 2 and 3; all of them belong to its class.

Classes are connected components of links. Nothing is capped: a large family is more blocks.

Results in odd cases: null or empty text, and text without words, has no n-grams and links with
nothing; a text with fewer words than n has its whole sequence as its only n-gram. A null id links
with nothing and has a null class. Rows that repeat an id are one document's texts: each gets a
row, and their classes are one. An empty table gives no rows. Columns other than the key and text are ignored.
Words are compared with A-Z lowered; n-grams by 64-bit hashes, which is the one way in which it could err.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import count_exchange as exchange
from quern.llm import wordhash
from quern.llm.aside import names_after, set_aside
from quern.llm.components import components
from quern.session import materialize, release

#: Bytes of the n-grams of a family in one block of its product, about.
BLOCK_BYTES = 2_000_000


def _doc_keys(table: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, key) of a bucket, sorted: row numbers and keys."""
    rows, found, at = [], [], 0
    for part in exchange.slices(table):
        words, owners = wordhash.word_hashes(exchange.texts_of(part))
        h, of = wordhash.shingles(words, owners, n)
        order = np.argsort(h)
        order = order[np.argsort(of[order].astype(np.uint16), kind="stable")]  # a slice's rows fit in 16 bits
        h, of = h[order], of[order]
        if len(h):
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])))
            h, of = h[new], of[new]
        rows.append(of + at)
        found.append(h)
        at += part.num_rows
    return np.concatenate(rows), np.concatenate(found)


def least_overlap(size: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The fewest n-grams that a document of that size shares with any that it links with."""
    return -(-size * percent // 100)


SIGNATURE = [("size", T.LongType()), ("fingerprint", T.BinaryType()), ("leading", T.ArrayType(T.LongType())), ("shared", T.BinaryType())]


def signatures(docs: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """(key, size, fingerprint, leading, shared); the last three are null for documents that can't link."""
    buckets, n_buckets = exchange.dealt(docs, key, text)
    answers = exchange.exchange(buckets, n_buckets, lambda table: exchange.summed(_doc_keys(table, n)[1]))
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType)] + [T.StructField(a, b) for a, b in SIGNATURE])

    def sign(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows, keys = _doc_keys(table, n)
        distinct = exchange.summed(keys)[0]
        df = exchange.received(replies, len(distinct))[0][np.searchsorted(distinct, keys)]
        size = np.bincount(rows, minlength=table.num_rows)
        possible = np.bincount(rows[df > 1], minlength=table.num_rows) >= np.maximum(least_overlap(size, percent), 1)
        edges = np.searchsorted(rows, np.arange(table.num_rows + 1))
        prints: list[bytes | None] = [None] * table.num_rows
        leading: list[list[int] | None] = [None] * table.num_rows
        shared: list[bytes | None] = [None] * table.num_rows
        for i in np.flatnonzero(possible).tolist():
            part = slice(edges[i], edges[i + 1])
            k, often = keys[part], df[part]
            first = np.lexsort((k, often))[: size[i] - least_overlap(int(size[i]), percent) + 1]
            prints[i] = hashlib.sha1(k.tobytes()).digest()[:16]
            leading[i] = k[first][often[first] > 1].astype(np.int64).tolist()
            shared[i] = k[often > 1].tobytes()
        return pa.table({"key": table.column("key"), "size": pa.array(size), "fingerprint": pa.array(prints, pa.binary()), "leading": pa.array(leading, pa.list_(pa.int64())), "shared": pa.array(shared, pa.binary())})

    return buckets.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(sign, schema)


def _product(keys: list[np.ndarray], sizes: np.ndarray, low: np.ndarray, leading: list[np.ndarray], left: range, right: range, percent: int) -> list[tuple[int, int]]:
    """Links between two blocks of documents: entries of the block's product that reach the threshold.

    low: which documents are of the cell's lower band; pairs without one of those are left out.
    """

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate([rows[j] for j in right])
        of = np.repeat(np.arange(len(right)), [len(rows[j]) for j in right])
        order = np.argsort(flat, kind="stable")
        return flat[order], of[order]

    whole, first = matrix(keys), matrix(leading)
    right_sizes, right_low = sizes[right.start : right.stop], low[right.start : right.stop]

    def row(wanted: np.ndarray, columns: np.ndarray, of: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(columns, wanted, "left"), np.searchsorted(columns, wanted, "right")
        n = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.bincount(of[at], minlength=len(right_sizes))

    links = []
    for i in left:
        both = sizes[i] + right_sizes
        alive = (right_low | low[i]) & (100 * np.minimum(sizes[i], right_sizes) >= percent * np.maximum(sizes[i], right_sizes))
        if left == right:
            alive[: i - right.start + 1] = False
        if alive.any():
            alive &= row(leading[i], *first) > 0
        if alive.any():
            overlap = row(keys[i], *whole)
            linked = alive & (100 * overlap >= percent * (both - overlap))
            links += [(i, right.start + int(j)) for j in np.flatnonzero(linked)]
    return links


def _forest(n: int, links: list[tuple[int, int]]) -> list[int]:
    """For each of n nodes the first node of its component."""
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def _bands(size: Column, percent: int) -> Column:
    """A number per document: of two that can link it is equal or differs by one."""
    return F.floor(F.log(size.cast("double")) / (math.log(100 / percent) * (1 + 1e-9))).cast("int") if percent < 100 else size.cast("int")


def _candidates(unique: DataFrame, percent: int) -> DataFrame:
    """(u, v): documents of a cell that share a leading n-gram, as pairs with the first that holds it."""
    band = _bands(F.col("size"), percent)
    postings = unique.select("key", F.explode(F.array(band, band - 1)).alias("cell"), "leading").select("key", "cell", F.explode("leading").alias("gram"))
    hubs = postings.groupBy("gram", "cell").agg(F.min("key").alias("hub"), F.max("key").alias("last")).where("hub < last").select("gram", "cell", "hub")
    return postings.join(hubs, ["gram", "cell"]).select(F.struct("cell", "key").alias("u"), F.struct("cell", F.col("hub").alias("key")).alias("v")).distinct()


def links(unique: DataFrame, families: DataFrame, percent: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(u, v, n): pairs that connect what links connect, among documents with different sets; and, with
    v null, parts of the number n of documents that u links with, each set counting its copies.

    families: components of ``_candidates``.
    """
    families = families.select("node.cell", "node.key", F.col("component").alias("family"))
    sized = unique.select("key", F.octet_length("shared").alias("bytes"), _bands(F.col("size"), percent).alias("band"))
    blocks = families.join(sized, "key").groupBy("family").agg(F.ceil(F.sum("bytes") / block_bytes).cast("int").alias("blocks"), F.bool_or(F.col("band") == F.col("cell")).alias("needed"))
    # a family of upper documents alone is one in its own cell too
    places = families.join(blocks.where("needed").drop("needed"), "family")  # ids only, before the sets are moved
    members = unique.join(places, "key").withColumn("low", _bands(F.col("size"), percent) == F.col("cell"))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # one column names the block: rows that lie together by family alone don't satisfy it, so a family's blocks spread over tasks
    block = F.struct("family", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).alias("block")
    dealt = members.withColumn("own", own).withColumn("other", other).select(block, "own", "key", "size", "low", "copies", "leading", "shared")

    def multiply(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        a, b = block["a"], block["b"]
        table = table.sort_by([("own", "ascending"), ("key", "ascending")])
        own, ids = table.column("own").to_numpy(), table.column("key").to_pylist()
        sizes, copies, low = (table.column(c).to_numpy() for c in ("size", "copies", "low"))
        keys = [np.frombuffer(x, np.uint64) for x in table.column("shared").to_pylist()]
        leading = [np.array(x, np.int64).astype(np.uint64) for x in table.column("leading").to_pylist()]
        cut = int(np.searchsorted(own, b)) if a < b else len(ids)
        left = range(cut)
        right = range(cut, len(ids)) if a < b else left
        found = _product(keys, sizes, low, leading, left, right, percent) if len(left) and len(right) else []
        first = _forest(len(ids), found)
        u = [ids[i] for i, f in enumerate(first) if f != i]
        v = [ids[f] for i, f in enumerate(first) if f != i]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        degree = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(ids)) + np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(ids))
        counted = np.flatnonzero(degree)
        kind = table.column("key").type
        return pa.table({"u": pa.array(u + [ids[i] for i in counted], kind), "v": pa.array(v + [None] * len(counted), kind), "n": pa.array([0] * len(u) + degree[counted].astype(np.int64).tolist(), pa.int64())})

    kind = unique.schema["key"].dataType.simpleString()
    return dealt.groupBy("block").applyInArrow(multiply, f"u {kind}, v {kind}, n long")


def classes(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, n_links) for every row of ``docs``.

    component_id is the least key of the row's class, n_links the number of other rows that it links with.
    """
    signed = materialize(signatures(docs, key, text, n, percent), "signatures")
    able = signed.where(F.col("fingerprint").isNotNull() & F.col("key").isNotNull())
    first = F.min(F.struct("key", "size", "leading", "shared")).alias("one")
    unique = materialize(able.groupBy("fingerprint").agg(first, F.count(F.lit(1)).alias("copies")).select("fingerprint", "one.*", "copies"), "unique-sets")
    families = components(_candidates(unique, percent))
    found = materialize(links(unique, families, percent), "links")
    release(families)
    # an id that comes with several texts connects them
    own = able.select("key", "fingerprint")
    several = own.groupBy("key").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b")).where("a <> b").select("key")
    bridges = own.join(several, "key", "left_semi").join(unique.select("fingerprint", F.col("key").alias("v")), "fingerprint").select(F.col("key").alias("u"), "v")
    linked = components(found.where("v IS NOT NULL").select("u", "v").unionByName(bridges))
    degrees = found.where("v IS NULL").groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("degree"))
    of_set = unique.select("fingerprint", "key", "copies").join(linked.withColumnRenamed("node", "key"), "key", "left").join(degrees, "key", "left")
    of_set = of_set.select("fingerprint", F.coalesce("component", "key").alias("component_id"), (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"))
    grouped = able.select("key", "size", "fingerprint").join(of_set, "fingerprint").drop("fingerprint")
    alone = signed.where(F.col("fingerprint").isNull() | F.col("key").isNull()).select("key", "size", F.col("key").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    out = materialize(alone.unionByName(grouped).select(F.col("key").alias(key), F.col("size").alias("n_shingles"), "component_id", "n_links"), "classes")
    for used in (signed, unique, found, linked):
        release(used)
    return out


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class of ``docs``: that with the least key.

    Of rows that repeat both key and text one stays. Different texts of the least key are parts of one document
    and stay, as do all rows with a null key, which are in no class.
    """
    names = ("_key", "_nth")
    moved, back = set_aside(docs, names)
    at, body = (names_after(docs, names)[c] for c in (key, text))
    found = classes(docs, n, percent, key, text)
    gone = found.where(F.col("component_id") < F.col(key)).select(F.col(key).alias("_key")).distinct()
    # one exchange by key serves the join and the look at repeated rows, at any size; rows without a key need neither
    kept = moved.where(F.col(at).isNotNull()).join(gone.hint("merge"), F.col(at) == F.col("_key"), "left_anti")
    nth = F.row_number().over(Window.partitionBy(at, body).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in moved.columns if c != body])))
    return back(kept.withColumn("_nth", nth).where("_nth = 1").drop("_nth").unionByName(moved.where(F.col(at).isNull())))

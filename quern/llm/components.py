"""Connected components of a graph given as a table of edges, by alternating star operations.

Each round hangs all neighbours of a node on the smallest of them: first the larger ones (large
star), then the smaller ones (small star). The rounds end when no edge changes; every node then
hangs on the smallest of its component. Edges stay in tables throughout; each round is written to
the shared folder, and the one before it deleted. A node with very many edges is aggregated before the shuffle, and the join that
hangs its neighbours is one whose skewed partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import materialize, release

_MOST_ROUNDS = 100


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is its smallest node. Null ends are ignored.

    The result is a table that the caller may ``release``; all others are deleted here.
    """
    edges = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull())
    given = edges = materialize(_distinct(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
    nodes = given.select(F.col("u").alias("node")).union(given.select(F.col("v").alias("node"))).distinct()
    before = None
    for _ in range(_MOST_ROUNDS):
        # large star: the larger neighbours of a node hang on the smallest node around it
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _distinct(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialize(large, "edges")
        # small star: the smaller neighbours of a node, and it, hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        last, edges = edges, materialize(_distinct(small), "edges")
        release(large)
        if last is not given:
            release(last)
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    out = materialize(nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("m")), "node", "left").select("node", F.coalesce("m", "node").alias("component")), "components")
    release(edges)
    if edges is not given:
        release(given)
    return out

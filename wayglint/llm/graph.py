"""Connected components by alternating stars, wholly in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Edges up to which one task takes them all, in about 70 MB; beyond it rounds of stars do. The number is fixed, so that
#: task stays as small whatever the table; it spares the many jobs of the rounds, which cost the driver memory.
SMALL_EDGES = 200_000


def _downward(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each node's smaller neighbours, and the node, to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union of the ends of all edges, the lesser root above."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            a, z = root(u), root(v)
            up[max(a, z)] = min(a, z)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "component"])


def connected_components(edges: DataFrame, small: int = SMALL_EDGES) -> DataFrame:
    """``edges(u, v)`` of longs to ``(node, component)``, a component being named by its least node.

    Nodes are those of the edges. Repeated edges, loops and an empty table are fine; null ends are dropped.
    Up to ``small`` different edges are joined in one task on an executor. Beyond that each round of stars shuffles
    the edges only, of which there are never more than at the start, and is written to the shared folder; a star of
    any degree is pre-aggregated before its shuffle. Both ways give the same rows.
    """
    now = materialize(_downward(edges.dropna()), "edges")
    if now.count() <= small:
        return now.select("u", "v").coalesce(1).mapInArrow(_in_one_task, "node long, component long")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = materialize(_small_star(_large_star(now)), "edges", instead_of=now)
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

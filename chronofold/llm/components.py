"""Connected components of a graph given as edges, by local union and alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.session import forget, store


def _contract(batches):
    """A partition's edges as stars, one edge for each node it holds but the roots (a node's root is its smallest)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def out():
        got = [(x, r) for x in parent if (r := find(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:
            yield out()
    yield out()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (bigint). node, label of each node of an edge but its component's smallest; label is the smallest.

    Each round is two aggregations and joins by node; a round ends with a written table. Rounds grow with the
    logarithm of the longest path; nothing is gathered."""
    stars = store(edges.where("u <> v").mapInArrow(_contract, "u bigint, v bigint"), "stars")
    while True:  # every edge is (larger, smaller)
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        before, stars = stars, store(small, "stars")
        forget(before)
        chained = stars.join(stars.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        forked = stars.groupBy("u").count().where("count > 1")
        if chained.isEmpty() and forked.isEmpty():
            labels = stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
            labels.stored_at = stars.stored_at
            return labels

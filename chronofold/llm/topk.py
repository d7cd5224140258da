"""Exact top-k search by inner product, with a KD-tree per shard.

Candidates are dealt to shards by a hash of their id, SHARD_ROWS in each on average, and queries to blocks; a unit is
one shard and one block, so a task holds a bounded number of both whatever the input holds. A shard's tree splits at
the median of its widest component down to LEAF rows, with tight boxes. A query's score in a box is at most the sum of
the larger of q*low and q*high over the components. A traversal goes down the levels, dropping boxes that cannot reach
the query's k-th score, and then visits leaves best bound first until none can. A first pass over shard 0 gives every
query a k-th score that the other shards' traversals start from.

Components become floor(scale * x). Defined results: vectors that are null, or hold a null or non-finite component,
take no part; only vectors of equal length meet; rows with the query's id are its own and no candidates; a query id
that is repeated is searched once, with its smallest vector; ties go to the smaller id; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.session import bounded_batches, store

SHARD_ROWS, BLOCK_QUERIES, LEAF = 8192, 2048, 64
#: Leaves that each query visits between two looks at its k-th score.
STRIDE = 2


class KDTree:
    """Nodes in levels; low, high: boxes; leaves hold order[begin:end]."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.low, self.high, self.children, self.range = [], [], [], []
        todo = [(0, len(x), self._node(x, 0, len(x)))] if len(x) else []
        while todo:
            begin, end, node = todo.pop()
            extent = self.high[node] - self.low[node]
            j = int(extent.argmax()) if extent.size else 0
            if end - begin <= LEAF or not extent.size or extent[j] == 0:
                continue
            half = begin + (end - begin) // 2
            part = self.order[begin:end]
            self.order[begin:end] = part[np.argpartition(x[part, j], half - begin)]
            left, right = self._node(x, begin, half), self._node(x, half, end)
            self.children[node] = (left, right)
            todo += [(begin, half, left), (half, end, right)]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _node(self, x: np.ndarray, begin: int, end: int) -> int:
        part = x[self.order[begin:end]]
        self.low.append(part.min(0))
        self.high.append(part.max(0))
        self.children.append(None)
        self.range.append((begin, end))
        return len(self.low) - 1


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, score) of up to k best rows of each query that score least or more; x and q hold whole numbers."""
    tree = KDTree(x)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    pairs_q, pairs_leaf, pairs_bound = [], [], []
    level = [(0, np.arange(len(q)))] if len(x) else []
    while level:  # down the tree, with the queries that may find something below
        below = []
        for node, who in level:
            bound = plus[who] @ tree.high[node] + minus[who] @ tree.low[node]
            ok = bound >= least[who]
            who, bound = who[ok], bound[ok]
            if not who.size:
                continue
            if tree.children[node] is None:
                pairs_q.append(who)
                pairs_leaf.append(np.full(who.size, node))
                pairs_bound.append(bound)
            else:
                below += [(child, who) for child in tree.children[node]]
        level = below
    if not pairs_q:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, q.dtype)
    pq, pl, pb = np.concatenate(pairs_q), np.concatenate(pairs_leaf), np.concatenate(pairs_bound)
    order = np.lexsort((pl, -pb, pq))
    pq, pl, pb = pq[order], pl[order], pb[order]
    first = np.searchsorted(pq, np.arange(len(q) + 1))
    lowest = np.iinfo(np.int64).min // 2
    top_s, top_i = np.full((len(q), k), lowest, np.int64), np.full((len(q), k), np.iinfo(np.int64).max)
    kth, at = np.maximum(least, lowest).astype(np.float64), first[:-1].copy()
    alive = np.flatnonzero(at < first[1:])
    while alive.size:
        take = []
        for step in range(STRIDE):
            spot = at[alive] + step
            ok = spot < first[alive + 1]
            take.append(spot[ok])
        take = np.concatenate(take)
        take = take[pb[take] >= kth[pq[take]]]
        for leaf in np.unique(pl[take]):
            who = pq[take[pl[take] == leaf]]
            begin, end = tree.range[leaf]
            rows = tree.order[begin:end]
            s = (q[who] @ x[rows].T).astype(np.int64)
            s[query_ids[who][:, None] == ids[rows][None, :]] = lowest
            ok = s.max(1) >= kth[who]
            who, s = who[ok], s[ok]
            if who.size:
                s = np.concatenate([top_s[who], s], 1)
                i = np.concatenate([top_i[who], np.broadcast_to(ids[rows], (who.size, rows.size))], 1)
                best = np.lexsort((i, -s), axis=-1)[:, :k]
                top_s[who], top_i[who] = np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)
                kth[who] = np.maximum(kth[who], top_s[who, k - 1])
        at[alive] += STRIDE
        alive = alive[at[alive] < first[alive + 1]]
        alive = alive[pb[at[alive]] >= kth[alive]]
    found = np.nonzero(top_s > lowest)
    return found[0], top_i[found], top_s[found]


def _matrix(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten().to_numpy(zero_copy_only=False) if len(flat) else np.empty(0)
    return np.floor(scale * flat.astype(np.float64)).reshape(len(column), -1)


def _unit(k: int, scale: float):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        names, kinds = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.int64()]
        empty = pa.table([pa.array([], t) for t in kinds], names)
        if not len(candidates) or not len(queries):
            return empty
        x, q = _matrix(candidates["vec"], scale), _matrix(queries["vec"], scale)
        most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(x.shape[1], 1)
        if most >= 2**53:
            if most >= 2**63:
                raise ValueError("scores do not fit a long")
            x, q = x.astype(np.int64), q.astype(np.int64)
        ids, query_ids = candidates["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        least = queries["least"].to_pandas().to_numpy(np.float64, na_value=-np.inf)
        at, found, score = search(ids, x, query_ids, q, k, least)
        return pa.table([pa.array(query_ids[at], pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.int64())], names)

    return run


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows. is_query: a condition on id_col; ids are whole numbers."""
    bounded_batches(vectors.sparkSession)
    v = F.col(vector_col)
    good = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull()).where(good).select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("vec"), is_query.alias("asks"))
    sizes = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = max(1, -(-sizes[0] // SHARD_ROWS)), max(1, -(-sizes[1] // BLOCK_QUERIES))
    shard = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id", F.lit(5)), F.lit(blocks)).cast("int")
    queries = rows.where("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vec").alias("vec"))
    queries = queries.withColumn("block", block).withColumn("length", F.size("vec"))
    dealt = rows.select("vec_id", "vec", shard.alias("shard"), F.size("vec").alias("length")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    unit, keys = _unit(k, scale), ["shard", "block", "length"]
    schema = "query_id bigint, vec_id bigint, score bigint"

    def meet(candidates: DataFrame, asked: DataFrame) -> DataFrame:
        return candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(unit, schema)

    found = meet(dealt.where("shard = 0"), queries.withColumn("shard", F.lit(0)).withColumn("least", F.lit(None).cast("bigint")))
    if shards > 1:
        found = store(found, "topk")
        bounds = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
        asked = queries.join(bounds, "query_id", "left").withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
        found = found.unionByName(meet(dealt.where("shard > 0"), asked))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Nearest neighbours by cosine from a vantage-point tree per shard.

Vectors fall into shards of about ``SHARD_ROWS`` by a hash of their id. Vectors
that are equal are one point of the tree, with the smallest ids that can ever
be asked for. On unit vectors the distance sqrt(2 - 2 cos) is a metric: each
node keeps a vantage point and parts the rest at the median distance to it; a
query that is d away from the vantage point skips a side whose points it can
only be further from than its worst neighbour so far, by the triangle
inequality. ``factor`` scales that worst distance: 1 gives exact search, less
prunes more and may miss neighbours. Queries go down the tree together, block by
block, nearer side first. A second walk then collects all points that are no
farther than the k-th, so that any number of ties is there to choose from.

Every query is sent to every shard, in blocks of ``QUERY_BLOCK`` (the stated
query set against all rows); a task holds one shard and one block, and builds
its tree once. Each shard returns its best k of a query, and a window picks the
k best of those.

Scores are recomputed in double precision from the original vectors; scores that
agree to ``DECIMALS`` places are ties, as those of multiples of one vector must
be whatever their last bits.

Defined results: vectors that are null, zero, or hold a null or a non-finite
component take no part, nor do rows without an id. Vectors are compared with
those of their own length alone. A query meets every row but those of its own
id; a row that is repeated in full counts once. Ties go to the smaller id. An
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.llm.common import partitions_for, written

SHARD_ROWS = 4096
# Queries of a task, and of one walk down its tree
QUERY_BLOCK = 65_536
QUERY_SLICE = 512
LEAF = 128
SLACK = 1e-7  # distances that differ by less count as equal when pruning
TIE = 1e-12  # what rounding may change in a squared distance
DECIMALS = 12  # scores that agree so far are ties
SLAB = 50_000  # scores computed at a time


class VPTree:
    """A tree over the rows of ``unit`` (float64 unit vectors)."""

    def __init__(self, unit: np.ndarray, leaf: int = LEAF, seed: int = 5):
        self.unit, self.leaf = unit, leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(unit)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        pick = self.rng.integers(len(rows))
        vantage, rest = rows[pick], np.delete(rows, pick)
        d = distances(self.unit[rest], self.unit[[vantage]])[:, 0]
        mid = np.median(d)
        near = d <= mid
        if near.all():  # all at one distance: half of them, in any order
            near = np.arange(len(rest)) < len(rest) // 2
        return (vantage, d[near].max(), d[~near].min(),
                self._build(rest[near]), self._build(rest[~near]))

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0):
        """(distances, rows), both [queries, k], nearest first; rows of -1 at
        infinite distance where there are fewer points."""
        best = np.full((len(queries), k), np.inf)
        which = np.full((len(queries), k), -1)
        self.compared = 0

        def offer(q: np.ndarray, rows: np.ndarray, d: np.ndarray):
            self.compared += d.size
            if d.shape[1] > k:
                top = np.argpartition(d, k - 1, axis=1)[:, :k]
                d, cand = np.take_along_axis(d, top, 1), rows[top]
            else:
                cand = np.broadcast_to(rows, d.shape)
            d = np.concatenate([best[q], d], axis=1)
            cand = np.concatenate([which[q], cand], axis=1)
            order = np.argsort(d, axis=1, kind="stable")[:, :k]
            best[q] = np.take_along_axis(d, order, 1)
            which[q] = np.take_along_axis(cand, order, 1)

        self._descend(queries, offer, lambda q: factor * best[q, -1] + SLACK)
        return best, which

    def within(self, queries: np.ndarray, limit: np.ndarray, factor: float = 1.0):
        """(queries, rows): the points up to ``limit`` of each query away, in
        the order of the queries."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def offer(q: np.ndarray, rows: np.ndarray, d: np.ndarray):
            i, j = np.nonzero(d <= limit[q, None])
            found.append((q[i], rows[j]))

        self._descend(queries, offer, lambda q: factor * limit[q] + SLACK)
        q, rows = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((rows, q))
        return q[order], rows[order]

    def _descend(self, queries: np.ndarray, offer, reach) -> None:
        """All queries down the tree, nearer sides first; ``offer`` takes the
        points met, ``reach`` says how far a query still looks."""
        def visit(node, q: np.ndarray):
            if not len(q):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    offer(q, node, distances(queries[q], self.unit[node]))
                return
            vantage, most, least, near, far = node
            d = distances(queries[q], self.unit[[vantage]])
            offer(q, np.array([vantage]), d)
            d = d[:, 0]
            inside = d - most <= least - d
            visit(near, q[inside])
            visit(far, q[~inside])
            worst = reach(q)
            visit(far, q[inside & (least - d <= worst)])
            visit(near, q[~inside & (d - most <= worst)])

        visit(self.root, np.arange(len(queries)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def _vectors(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _search_shard(k: int, factor: float):
    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if points.num_rows and queries.num_rows:
            dim = points.column("dim")[0].as_py()
            ids = points.column("vec_id").to_numpy()
            v = _vectors(points.column("vec"), dim)
            q_ids = queries.column("vec_id").to_numpy()
            q = _vectors(queries.column("vec"), dim)
            # one point for equal vectors, with its smallest ids: one more than
            # k, since the query's own may be among them
            order = np.lexsort((ids, *v.T[::-1]))
            ids, v = ids[order], v[order]
            new = np.append(True, (v[1:] != v[:-1]).any(axis=1))
            again = np.append(False, (ids[1:] == ids[:-1])) & ~new
            ids, v, new = ids[~again], v[~again], new[~again]
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(ids))
            point = v[start]
            norm = np.linalg.norm(point, axis=1)
            q_norm = np.linalg.norm(q, axis=1)
            tree = VPTree(point / norm[:, None])
            for a in range(0, len(q), QUERY_SLICE):
                part, part_ids = q[a:a + QUERY_SLICE], q_ids[a:a + QUERY_SLICE]
                unit = part / q_norm[a:a + QUERY_SLICE, None]
                # the query's own vector may be one of k + 1
                far = tree.search(unit, k + 1, factor)[0][:, -1]
                # all that may tie with the last of them, in rounding too
                limit = np.where(np.isfinite(far), np.sqrt(far ** 2 + TIE), np.inf)
                who, rows = tree.within(unit, limit, factor)
                # of equal vectors only the first ids can be asked for
                times = np.minimum(end[rows] - start[rows], k + 1)
                who, rows = np.repeat(who, times), np.repeat(rows, times)
                place = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
                cand = ids[start[rows] + place]
                other = cand != part_ids[who]
                who, rows, cand = who[other], rows[other], cand[other]
                score = np.concatenate([
                    (point[rows[i:i + SLAB]] * part[who[i:i + SLAB]]).sum(axis=1)
                    / (norm[rows[i:i + SLAB]] * q_norm[a + who[i:i + SLAB]])
                    for i in range(0, len(rows), SLAB)] or [np.zeros(0)])
                order = np.lexsort((cand, -np.round(score, DECIMALS), who))
                who, cand, score = who[order], cand[order], score[order]
                top = np.arange(len(who)) - np.searchsorted(who, who) < k
                out["query_id"].append(part_ids[who[top]])
                out["vec_id"].append(cand[top])
                out["score"].append(score[top])
        return pa.table({
            "query_id": pa.array(np.concatenate(out["query_id"] or [[]]), pa.int64()),
            "vec_id": pa.array(np.concatenate(out["vec_id"] or [[]]), pa.int64()),
            "score": pa.array(np.concatenate(out["score"] or [[]]), pa.float64())})
    return search


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec, dim) of the rows that take part."""
    d = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    return d.filter(F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False))) \
        .withColumn("dim", F.size("vec"))


def nearest(points: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest points of every query,
    both given as (vec_id, vec, dim)."""
    shards = partitions_for(points.count(), shard_rows)
    # one vector for each query id
    queries = written(queries.groupBy("vec_id").agg(F.min("vec").alias("vec"))
                      .withColumn("dim", F.size("vec")), "queries")
    blocks = partitions_for(queries.count(), QUERY_BLOCK)

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    key = ["shard", "block", "dim"]
    p = points.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")) \
        .withColumn("block", each(blocks))
    q = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", each(shards))
    found = p.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(
        _search_shard(k, factor), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.round("score", DECIMALS).desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

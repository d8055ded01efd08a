"""Connected components of a link table by union-find and star operations.

Every round first unites the links of each partition by union-find (a
partition's links become one star per local group), then does one large-star
and one small-star step: links are re-hung from a node to the smallest node
known near it. Each step keeps what is connected connected; rounds end when
every node hangs from a root. A node with very many links is met as a pre-aggregated
minimum and in a join that adaptive execution can split. Links are written
after each round, so lineage stays short and a lost executor costs little.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import written


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a partition as links from each node to its root, the
    smallest node of its local group."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i:i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], ["a", "b"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (hung.unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct())


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every node hangs from one root and no root hangs from a node."""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("hangs")) \
        .unionByName(links.select(F.col("b").alias("x"), F.lit(0).alias("hangs")))
    odd = ends.groupBy("x").agg(F.sum("hangs").alias("up"), F.count(F.lit(1)).alias("n")) \
        .filter("up > 1 OR (up = 1 AND n > 1)")
    return odd.isEmpty()


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of the links (a long, b long); the
    component is its smallest node. Nodes without a link are not listed."""
    links = links.select("a", "b").filter("a <> b")
    for _ in range(most_rounds):
        local = links.mapInArrow(_unite, "a long, b long")
        links = written(_small_star(_large_star(local)), "links")
        if _is_star_forest(links):
            break
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    # a star per component: every node but the smallest hangs from it
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(roots.select("node", F.col("node").alias("component")))

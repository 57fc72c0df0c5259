"""Connected components of an undirected graph, as DataFrame rounds.

Each round alternates a large-star and a small-star step (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014), which ends after O(log n) rounds on chains as well as on stars, unlike plain label spreading.
A node with very many neighbours never becomes one group in one task: both steps need only the least neighbour of a
node, an aggregate with map-side combine, which is then joined back to the node's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut, drop_scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v."""
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst", max_rounds: int = 40) -> DataFrame:
    """Rows ``(node, component)`` for every node that has an edge; the component is its least node.

    Null ends, self-loops, repeated and reversed edges are allowed: edges with a null end are dropped, a node that only
    has a self-loop is its own component. An empty table gives an empty table. Other columns are ignored. Raises
    RuntimeError if ``max_rounds`` (far above the logarithm of any graph's size) do not suffice.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = cut(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        after = cut(_star(_star(now, True), False), "edges")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_scratch(now)
        now = after
        if seen == mark or seen[0] == 0:
            break
        mark = seen
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    return nodes.join(now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )

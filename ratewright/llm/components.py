"""Connected components by alternating large-star and small-star steps.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: Connected Components in MapReduce and Beyond (SoCC 2014).
Neighbourhoods are only ever reduced to their minimum (a partial aggregate) and joined back, so a hub's
neighbours never meet in one task.  Hubs with more than one in SHARE of the rows are few (fewer than SHARE), so
their minima are broadcast; all others are joined by an exchange.  In a graph of at most SMALL rows no hub is too large for a
task: a round is then three exchanges by node and windows over them, of a partition per PART rows, so that a small graph isn't
dealt over as many files as the texts are.  Results are the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.lineage import cut

SHARE = 1000  # bounds the rows of a broadcast
SMALL = 2_000_000  # rows of 16 bytes
PART = 20_000  # rows of 16 bytes in a partition of a small graph


def _with_least(rows: DataFrame, low: DataFrame, total: int) -> DataFrame:
    """`rows` (u, v) with m, the least neighbour of u, from `low` (u, m, n): n counts u's rows, of `total` at most."""
    hub = F.col("n") > total // SHARE
    hubs = F.broadcast(low.where(hub).select("u", "m"))
    rest = rows.join(hubs.select("u"), "u", "left_anti").join(low.where(~hub).select("u", "m"), "u")
    return rows.join(hubs, "u").unionByName(rest)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _with_least(both.where("v > u"), low, 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    rest = _with_least(edges, low, total).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _small_graph_round(edges: DataFrame, total: int) -> DataFrame:
    """The two stars of a graph of at most SMALL rows, by windows over its nodes' neighbours."""
    parts, node = max(1, -(-total // PART)), Window.partitionBy("u")
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition(parts, "u")
    least = both.withColumn("m", F.least("u", F.min("v").over(node)))
    large = least.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).repartition(parts, "u")
    starred = large.distinct().withColumn("m", F.min("v").over(node))
    ends = F.when(F.col("v") != F.col("m"), F.array("u", "v")).otherwise(F.array("u"))
    return starred.select(F.explode(ends).alias("u"), F.col("m").alias("v")).repartition(parts, "u").distinct()


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `links`: root is the smallest node that it reaches.

    Self-links, nulls and repeated links are ignored (a node with only those is not returned); an empty table gives an empty result.
    Each round is checkpointed; rounds grow with the logarithm of the graph.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, before = cut(edges), None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        # a large star has at most as many rows as it was given, so one total bounds the round's hubs
        before, edges = state, cut(_small_graph_round(edges, state[0]) if state[0] <= SMALL else _small_star(_large_star(edges, state[0]), state[0]))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

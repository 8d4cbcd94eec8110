"""Connected components as alternating large-star / small-star joins.

Every round is two shuffled aggregates and one join on (node, neighbour) rows;
the number of rows never grows, no neighbourhood is gathered in one task (the
minimum is pre-aggregated before the shuffle, and AQE may split the join on a
node with very many neighbours), and nothing but one count and one checksum
per round reaches the driver.  Kiveris et al., "Connected Components in
MapReduce and Beyond" (2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("c"), F.least("low", "u").alias("low"))
    # neighbours above the centre are hung on the centre's lowest neighbour
    up = edges.select(F.col("v").alias("c"), F.col("u").alias("w"))
    return up.join(low, "c").select(F.col("w").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    hung = edges.join(low.withColumnRenamed("u", "c"), F.col("u") == F.col("c")).where("v <> low").select(
        F.col("v").alias("u"), F.col("low").alias("v"))
    return hung.union(low.select("u", F.col("low").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node on an edge; root is the smallest node of its
    component.

    ``edges`` has two columns of one ordered type, in any order and direction;
    repeated edges, loops and rows with a NULL end are allowed (loops and NULL
    ends link nothing).  An empty table gives an empty result.
    """
    a, b = edges.columns
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = materialize(e, "cc")
    seen = _signature(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        e = materialize(_small_star(_large_star(e)), "cc")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))

"""Ranks over huge or skewed groups without a single-task window.

``Window.orderBy(x)`` with no partition (e.g. a global PERCENT_RANK) and
``Window.partitionBy(g)`` with a hot ``g`` both put one group in one task.
Both operators here range-partition the rows instead, rank locally inside
each range partition, and add per-partition offsets:

1. ``repartitionByRange`` on (group, order) → balanced, sorted ranges;
2. the partition id is written down and the frame checkpointed (reliable
   storage under ``spark.checkpoint.dir``), so ids survive executor loss;
3. local running counts per (partition, group) by a window whose partitions
   are bounded by the range partition size;
4. offsets = running sum of per-(partition, group) counts; that table has at
   most (#partitions + #groups) rows and each group spans ≤ #partitions rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import checkpoint_root


def _parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def percent_rank_global(df: DataFrame, col: str, out: str = "percent_rank",
                        num_partitions: int | None = None) -> DataFrame:
    """``PERCENT_RANK() OVER (ORDER BY col ASC NULLS FIRST)`` for every row.

    Works on the distinct values with their counts: rank − 1 = number of rows
    with a smaller value (NULL is the smallest), n = total rows; 1-row input
    gives 0.0.  Returns ``df`` with ``out`` added."""
    checkpoint_root(df.sparkSession)
    key = F.col(col).asc_nulls_first()
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    ranged = (counts.repartitionByRange(_parts(df, num_partitions), key)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint())
    before = Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_lb", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    # One row per range partition: bounded by the partition count.
    totals = ranged.groupBy("_pid").agg(F.sum("_c").alias("_t"))
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.withColumn("_off", F.coalesce(F.sum("_t").over(prior), F.lit(0)))
               .withColumn("_n", F.sum("_t").over(Window.partitionBy())))
    ranks = local.join(F.broadcast(offsets), "_pid").select(
        F.col(col).alias("_v"),
        F.when(F.col("_n") <= 1, F.lit(0.0))
        .otherwise((F.col("_off") + F.col("_lb")).cast("double") / (F.col("_n") - 1).cast("double"))
        .alias(out))
    return df.join(ranks, df[col].eqNullSafe(ranks["_v"])).drop("_v")


def row_number_in_groups(df: DataFrame, group_cols: list[str], order_cols: list[Column],
                         out: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` that stays
    balanced when one group holds a large share of the rows.  ``order_cols``
    must make the order total (end with a unique key)."""
    checkpoint_root(df.sparkSession)
    keys = [F.col(g).asc_nulls_first() for g in group_cols] + list(order_cols)
    ranged = (df.repartitionByRange(_parts(df, num_partitions), *keys)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint())
    local_w = Window.partitionBy("_pid", *group_cols).orderBy(*order_cols)
    local = ranged.withColumn("_ln", F.row_number().over(local_w))
    counts = ranged.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_c"))
    prior = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_c").over(prior), F.lit(0))).drop("_c")
    o = offsets.select(*[F.col(c).alias(f"_g_{c}") for c in ["_pid", *group_cols]], "_off")
    cond = reduce(lambda a, b: a & b,
                  [local[c].eqNullSafe(o[f"_g_{c}"]) for c in ["_pid", *group_cols]])
    joined = local.join(o, cond)
    return (joined.withColumn(out, F.col("_off") + F.col("_ln"))
            .drop("_pid", "_ln", "_off", *[f"_g_{c}" for c in ["_pid", *group_cols]]))


def row_number_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column], out: str = "rank") -> DataFrame:
    """Rows numbered within groups of bounded size (one window per group)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order_cols)))


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column], k: int,
                    out: str = "rank") -> DataFrame:
    """Rows ranked 1..k per group.  The filter sits directly on the window so
    Spark plans a partial WindowGroupLimit before the shuffle."""
    return row_number_per_group(df, group_cols, order_cols, out).filter(F.col(out) <= k)

"""Keyed writes for state tables kept as plain parquet (no MERGE available).

Set-based joins on the key, no per-row loop.  Keys compare NULL-safe (a NULL
key component is a value like any other), and a key occurs at most once in a
result whatever the input holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """NULL-safe equality of the key columns of two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def one_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None, strict: bool = False) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (default: by the other
    columns in their order), so the choice never depends on row order.  With
    ``strict`` a key that occurs twice fails the job instead."""
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in (order_by or []) if c not in keys]
    ranked = order + [c for c in rest if c not in order]
    n = F.count(F.lit(1))
    if not ranked:
        one = df.groupBy(*keys).agg(n.alias("_n"))
    else:
        one = df.groupBy(*keys).agg(n.alias("_n"), F.max(F.struct(*ranked)).alias("_r"))
    if strict:
        one = one.withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(
            F.concat(F.lit("key occurs more than once: "), F.to_json(F.struct(*keys))))).otherwise(F.col("_n")))
        one = one.where("_n is not null")
    return one.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def keyed_upsert(target: DataFrame, updates: DataFrame, keys: list[str],
                 update_cols: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
    """``INSERT … ON CONFLICT (keys) DO UPDATE SET update_cols``.

    New keys are inserted whole; for existing keys only ``update_cols`` take
    the new value and every other column keeps the stored one; keys absent
    from ``updates`` are kept.  A key that occurs twice in ``updates`` fails the
    job, as in SQL, unless ``order_by`` says which of its rows is the last."""
    cols = target.columns
    update_cols = [c for c in (update_cols if update_cols is not None else cols) if c not in keys]
    fresh = one_per_key(updates.select(*cols), keys, order_by, strict=order_by is None)
    t = target.withColumn("_in", F.lit(True)).alias("t")
    u = fresh.withColumn("_in", F.lit(True)).alias("u")
    has_t, has_u = F.col("t._in").isNotNull(), F.col("u._in").isNotNull()

    def value(c: str) -> Column:
        new_first = c in update_cols and c not in keys
        first, other, has = ("u", "t", has_u) if new_first else ("t", "u", has_t)
        return F.when(has, F.col(f"{first}.{c}")).otherwise(F.col(f"{other}.{c}")).alias(c)

    return t.join(u, same_key("t", "u", keys), "full_outer").select(*map(value, cols))


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT … ON CONFLICT (keys) DO NOTHING``: append only new keys, each
    once (of several new rows with one key the smallest choice is stable, see
    ``one_per_key``)."""
    fresh = one_per_key(new.select(*target.columns), keys)
    return target.unionByName(fresh.alias("n").join(target.select(*keys).alias("t"), same_key("n", "t", keys), "left_anti"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that changed between two snapshots of a keyed table.

    Full outer join on the key; emits ``change`` = insert / update / delete with
    the new values (old values for deletes).  Values compare NULL-safe column by
    column; unchanged rows are dropped.  Keys must be unique in each snapshot."""
    value_cols = [c for c in new.columns if c not in keys]
    o = old.select(*keys, *value_cols).withColumn("_in", F.lit(True)).alias("o")
    n = new.select(*keys, *value_cols).withColumn("_in", F.lit(True)).alias("n")
    gone, came = F.col("n._in").isNull(), F.col("o._in").isNull()
    differs = reduce(lambda a, b: a | b, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in value_cols], F.lit(False))
    change = F.when(came, "insert").when(gone, "delete").when(differs, "update")

    def pick(c: str) -> Column:
        return F.when(gone, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)

    return (o.join(n, same_key("o", "n", keys), "full_outer")
            .select(*map(pick, keys), change.alias("change"), *map(pick, value_cols))
            .filter(F.col("change").isNotNull()))


def state_violations(df: DataFrame, table: str, keys: list[str],
                     not_null: list[str] = ()) -> DataFrame:
    """Audit a state table against its declared constraints.

    One row per constraint: (table_name, constraint_name, violations).
    One pass: per key, the row count and NULL counts (partial-aggregated
    map-side, so a hot key costs one row per map task), then one global sum:
    duplicates = Σ (rows per key − 1), NULL keys, NULLs per NOT NULL column."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_c"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(not_null)])
    totals = per_key.agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("_dup"),
        F.coalesce(F.sum(F.when(null_key, F.col("_c"))), F.lit(0)).cast("long").alias("_pk_null"),
        *[F.coalesce(F.sum(f"_nn{i}"), F.lit(0)).cast("long").alias(f"_nn{i}") for i in range(len(not_null))])
    names = ([f"primary key ({', '.join(keys)}) unique", f"primary key ({', '.join(keys)}) not null"]
             + [f"{c} not null" for c in not_null])
    cols = ["_dup", "_pk_null"] + [f"_nn{i}" for i in range(len(not_null))]
    stack = ", ".join(f"'{n}', {c}" for n, c in zip(names, cols))
    return totals.selectExpr(f"stack({len(names)}, {stack}) AS (constraint_name, violations)").select(
        F.lit(table).alias("table_name"), "constraint_name", F.col("violations").cast("long"))


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str],
                  change_col: str = "change") -> DataFrame:
    """Apply a change feed (``snapshot_diff`` output) to a keyed table, the
    way an index sync consumes it: deletes remove the key, inserts and
    updates replace the whole row.  One anti-join plus a union."""
    cols = target.columns
    upserts = changes.filter(F.col(change_col) != "delete").select(*cols)
    kept = target.alias("t").join(changes.select(*keys).alias("c"), same_key("t", "c", keys), "left_anti")
    return kept.unionByName(upserts)

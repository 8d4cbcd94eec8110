"""What the chains shuffle and write: no more than once by a key, and compressed."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.test_refresh import files, rows
from tillroll.operators.partitioned import PartitionedTable
from tillroll.plans import medallion, state
from tillroll.plans.refresh import _Touched
from tillroll.session import work_dir
from tillroll.sources import csv as csvio
from tillroll.sources.arrivals import ARRIVAL, KEYS, current, land, read_arrivals, read_bronze, split_lines
from tillroll.sources.schemas import SOURCES


def test_partial_rows_of_sessions_travel_once(spark):
    t = lambda minute: datetime(2024, 1, 5, 10, minute)                                        # noqa: E731
    part = lambda s, c, p, cust, score, adds, removes, m, e: (                                 # noqa: E731
        s, c, p, cust, score, adds, removes, t(m), ((t(m), e), f"d{e}"))
    partials = spark.createDataFrame([
        part("a", "X", 1, 7, 3, 2, 0, 1, 10), part("a", "X", 2, 7, 3, 0, 1, 2, 11), part("a", "Y", 2, 8, 5, 0, 0, 3, 12),
        part("a", None, None, 7, 4, 0, 0, 4, 13), part("a", "X", 1, None, 1, 0, 0, 0, 9), part("a", None, 3, 7, 4, 0, 0, 4, 14),
        part("b", "Y", None, None, 2, 0, 3, 5, 1), part(None, "X", 1, 1, 99, 9, 0, 5, 2)],
        "session_id string, category string, product_id long, customer_id long, score long, adds long, removes long, started timestamp_ntz, "
        "last struct<k: struct<event_timestamp: timestamp_ntz, event_id: long>, device: string>")
    got = state.sessions_from_partials(partials)
    assert {tuple(r) for r in got.collect()} == {
        ("a", 8, None, 8.0, 3, 1, "d14", t(0), t(4)), ("b", None, "Y", 2.0, 0, 0, "d1", t(5), t(5))}
    plan = state.sessions_from_partials(partials)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_touched_combinations_are_not_shuffled(spark):
    touched = _Touched(spark, work_dir(spark, "t-touched"))
    facts = spark.createDataFrame([("2024-01", 1), ("2024-01", 1), (None, None), ("2024-02", 1)], "m string, c long")
    assert rows(touched.add("facts", facts)) == rows(facts)                                     # repeated keys stay
    assert rows(touched.add("keys", facts.select("c"))) == [(1,), (None,)]


def test_compressed_deliveries_land_in_order(spark):
    base = work_dir(spark, "t-gzip")
    schema, name = SOURCES["products"], "products"
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in ("product_id", "product_name")]
    lines = spark.createDataFrame([(i % 50, f"n, \"{i}\"") for i in range(200)], "product_id long, product_name string")
    products = lines.coalesce(1).select("*", *blank).select(*schema.names)
    csvio.write_csv(products, f"{base}/raw", compression="gzip")
    land(read_arrivals(spark, f"{base}/raw", schema), f"{base}/bronze", f"{base}/ckpt")
    bronze = read_bronze(spark, f"{base}/bronze", schema)
    assert {f.rsplit(".", 2)[1] for f in (r[0] for r in bronze.select(f"{ARRIVAL}.file").distinct().collect())} == {"csv"}
    good, rejected = split_lines(bronze, KEYS[name])
    assert bronze.count() == 200 and rejected.count() == 0
    assert {(r.product_id, r.product_name) for r in current(good, KEYS[name]).collect()} == {(i % 50, f"n, \"{i}\"") for i in range(150, 200)}


def test_tables_of_the_chains_are_written_with_zstd(spark):
    base = work_dir(spark, "t-zstd")
    df = spark.createDataFrame([(1, "2024-01"), (2, None)], "x int, m string")
    table = PartitionedTable(spark, f"{base}/table", "m", "string")
    table.replace(df, ["2024-01", None])
    medallion.write_table(df, f"{base}/version")
    written = [*files(f"{base}/table"), *files(f"{base}/version")]
    assert written and all(f.endswith(".zstd.parquet") for f in written)
    assert rows(table.read()) == rows(spark.read.parquet(f"{base}/version")) == [("2024-01", 1), (None, 2)]

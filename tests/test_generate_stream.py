"""Generator determinism and streaming incrementality."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.plans import generate, silver, state
from tillroll.session import work_dir
from tillroll.sources import csv as csvio
from tillroll.sources.adapters import Retail
from tillroll.sources.schemas import CLICKSTREAM, CUSTOMERS
from tillroll.streaming import jobs


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_generator_is_partitioning_independent(spark):
    a = generate.generate_customers(spark.range(0, 300, numPartitions=1))
    b = generate.generate_customers(spark.range(0, 300, numPartitions=7))
    assert _rows(a) == _rows(b)
    p1 = generate.generate_products(spark.range(498, numPartitions=2))
    p2 = generate.generate_products(spark.range(498, numPartitions=5))
    assert _rows(p1) == _rows(p2)


def test_generator_shapes(spark):
    prods = generate.generate_products(spark.range(498))
    assert prods.select("category").distinct().count() == 6
    assert prods.groupBy("category").count().agg(F.min("count")).first()[0] == 83
    custs = generate.generate_customers(spark.range(2000))
    tiers = {r.loyalty_tier: r["count"] for r in custs.groupBy("loyalty_tier").count().collect()}
    assert tiers["Bronze"] > tiers["Silver"] > tiers["Gold"] > tiers["Platinum"]
    n_cats = custs.select(F.size(F.from_json("preferred_categories", "array<string>")).alias("n"))
    assert {r.n for r in n_cats.distinct().collect()} <= {1, 2, 3}
    purch = generate.generate_purchases(spark.range(1000), custs, prods)
    assert purch.count() == 1000
    assert purch.filter(F.col("total_amount") != F.round(F.col("unit_price") * F.col("quantity"), 2)).count() == 0
    clicks = generate.generate_clickstream(spark.range(2000), custs, prods)
    assert clicks.count() == 2000
    assert clicks.filter((F.col("event_type") == "search") & F.col("product_id").isNotNull()).count() == 0


def test_csv_roundtrip_keeps_json_and_zeros(spark):
    base = work_dir(spark, "t-csv")
    c = Retail(spark, SF_SMALL).customers
    csvio.write_csv(c, base)
    back = csvio.read_csv(spark, base, CUSTOMERS)
    assert _rows(back) == _rows(c)


def test_stream_ingest_is_incremental(spark):
    base = work_dir(spark, "t-stream")
    c = Retail(spark, SF_SMALL).clickstream
    land, out, ck = f"{base}/landing", f"{base}/table", f"{base}/_ckpt"
    csvio.write_csv(c.filter(F.col("event_id") < 500), land, mode="append")
    assert jobs.bronze(spark, land, CLICKSTREAM, out, ck).count() == 500
    assert jobs.bronze(spark, land, CLICKSTREAM, out, ck).count() == 500   # re-run adds nothing
    csvio.write_csv(c.filter(F.col("event_id") >= 500), land, mode="append")
    got = jobs.bronze(spark, land, CLICKSTREAM, out, ck)
    assert got.count() == c.count()
    assert got.select("event_id").distinct().count() == c.count()


def test_csv_corrupt_lines_are_kept(spark):
    base = work_dir(spark, "t-corrupt")
    c = Retail(spark, SF_SMALL).customers.limit(3)
    csvio.write_csv(c, f"{base}/good")
    bad = spark.createDataFrame([("not-a-number", "x")], "a string, b string")
    bad.write.mode("overwrite").option("header", "true").csv(f"{base}/bad")
    good = csvio.read_csv(spark, f"{base}/good", CUSTOMERS, keep_corrupt=True).cache()
    assert good.filter(F.col(csvio.CORRUPT_COLUMN).isNotNull()).count() == 0
    junk = csvio.read_csv(spark, f"{base}/bad", CUSTOMERS, keep_corrupt=True).cache()
    row = junk.first()
    assert row.customer_id is None and row[csvio.CORRUPT_COLUMN] is not None


def test_keyed_state(spark):
    from tillroll.streaming.sinks import KeyedState
    root = work_dir(spark, "t-sink") + "/state"

    def merge(rows):
        return rows.groupBy("k").agg(F.sum("n").cast("long").alias("n"))

    st = KeyedState(spark, root, ["k"], merge, buckets=4, keep=2)
    frame = lambda *r: spark.createDataFrame(list(r), "k long, n long")
    assert st.latest() is None and st.apply(frame().limit(0), 0) is None
    assert st.apply(frame((1, 1), (2, 2), (None, 7), (1, 5)), 1) == 1
    first = dict(map(tuple, st.read().collect()))
    assert first == {1: 6, 2: 2, None: 7}
    assert st.apply(frame((2, 10)), 2) == 2
    assert st.apply(frame((2, 10)), 2) == 2                    # the same batch delivered again
    assert dict(map(tuple, st.read().collect())) == {1: 6, 2: 12, None: 7}
    assert st.apply(frame().limit(0), 3) == 2 and st.versions() == [1, 2]
    two = st.manifest(2)
    assert sum(v == 2 for v in two.values()) == 1              # only the touched bucket is new
    for v in (4, 5, 6):
        st.apply(frame((1, 1)), v)
    assert st.versions() == [5, 6]
    assert dict(map(tuple, st.read().collect())) == {1: 9, 2: 12, None: 7}
    assert dict(map(tuple, st.read(5).collect())) == {1: 8, 2: 12, None: 7}


def test_streams_take_late_files_and_empty_runs(spark):
    base = work_dir(spark, "t-late")
    r = Retail(spark, SF_SMALL)
    land = f"{base}/landing"
    jobs_of = {"recent": jobs.recent_interest, "days": jobs.category_interest, "sessions": jobs.active_sessions}
    versions = {}
    for late in (False, True):
        part = r.clickstream.where(F.col("event_timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz"))
        csvio.write_csv(r.clickstream.exceptAll(part) if late else part, land, mode="append")
        for name, job in jobs_of.items():
            versions[name] = job(spark, land, r.products, f"{base}/{name}", f"{base}/_ck_{name}")
    for name, job in jobs_of.items():
        assert job(spark, land, r.products, f"{base}/{name}", f"{base}/_ck_{name}") == versions[name]
    assert jobs.day_state(spark, f"{base}/days").read().agg(F.sum("events")).first()[0] == r.clickstream.count()
    whole = silver.clickstream_enriched(r.clickstream, r.products)
    assert _rows(jobs.session_state(spark, f"{base}/sessions")) == _rows(state.active_sessions(whole))


def test_medallion_registers_named_tables(spark):
    from tillroll.plans import medallion
    base = work_dir(spark, "t-medallion")
    r = Retail(spark, SF_SMALL)
    landing = {}
    for name in ("products", "customers", "purchases", "clickstream"):
        landing[name] = f"{base}/raw/{name}"
        csvio.write_csv(getattr(r, name), landing[name])
    medallion.run_medallion(spark, landing, f"{base}/lake", register_prefix="tm_")
    assert spark.table("tm_silver_clickstream_enriched").count() == r.clickstream.count()
    assert spark.table("tm_gold_customer_segments").count() == r.customers.count()
    info = {row.col_name: row.data_type for row in spark.sql("DESCRIBE TABLE EXTENDED tm_gold_category_interest").collect()}
    assert info["Comment"].startswith("Recency-weighted") and "quality=gold" in info["Table Properties"]


def test_second_run_keeps_state_and_bad_lines_stay_out(spark):
    from datetime import timedelta
    from tillroll.config import AS_OF
    from tillroll.plans import medallion
    base = work_dir(spark, "t-two-runs")
    r = Retail(spark, SF_SMALL)
    landing = {name: f"{base}/raw/{name}" for name in ("products", "customers", "purchases", "clickstream")}
    for name, path in landing.items():
        csvio.write_csv(getattr(r, name), path)
    bad = spark.createDataFrame([("not-a-number", "x")], "a string, b string")
    bad.write.mode("append").option("header", "true").csv(landing["customers"])
    first = medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF - timedelta(days=20), register_prefix="two_")
    offers1 = {x.offer_id: x.created_at for x in spark.read.parquet(first["personalized_offers"]).collect()}
    assert spark.table("two_quarantine_customers").count() == 1
    c360 = spark.read.parquet(first["customer_360"])
    assert "_corrupt_record" not in c360.columns and c360.where("customer_id is null").count() == 0
    assert spark.read.parquet(first["loyalty_status"]).where("customer_id is null").count() == 0
    second = medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF, register_prefix="two_")
    offers2 = {x.offer_id: x.created_at for x in spark.read.parquet(second["personalized_offers"]).collect()}
    assert offers1.items() <= offers2.items() and len(offers2) > len(offers1)
    assert spark.table("two_personalized_offers").count() == len(offers2)
    assert spark.read.parquet(first["personalized_offers"]).count() == len(offers1)      # the old version is whole
    assert spark.read.parquet(second["product_changes"]).count() == 0
    names = {k: medallion.table_name(k, "two_") for k in second}
    medallion.drop_tables(spark, names)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("two_")]


def test_generator_leaves_no_id_out_when_ids_have_gaps(spark):
    prods = generate.generate_products(spark.range(0, 400, 7))
    custs = generate.generate_customers(spark.range(0, 300, 11))
    purch = generate.generate_purchases(spark.range(500), custs, prods)
    clicks = generate.generate_clickstream(spark.range(1000), custs, prods)
    assert purch.count() == 500 and clicks.count() == 1000
    recent = clicks.where(F.col("event_timestamp") > F.lit("2024-01-29 12:00:00").cast("timestamp_ntz"))
    assert recent.select("customer_id").distinct().count() >= 6


def test_generated_data_runs_through_the_whole_chain(spark):
    from tillroll.plans import medallion
    from tillroll.sources.schemas import SOURCES
    prods = generate.generate_products(spark.range(60))
    custs = generate.generate_customers(spark.range(50))
    frames = {"products": prods, "customers": custs,
              "purchases": generate.generate_purchases(spark.range(300), custs, prods),
              "clickstream": generate.generate_clickstream(spark.range(400), custs, prods)}
    for name, df in frames.items():
        assert df.columns == SOURCES[name].fieldNames()
    base = work_dir(spark, "t-gen-chain")
    landing = {}
    for name, df in frames.items():
        landing[name] = f"{base}/raw/{name}"
        csvio.write_csv(df, landing[name])
    paths = medallion.run_medallion(spark, landing, f"{base}/lake")
    seg = spark.read.parquet(paths["customer_segments"])
    assert seg.count() == 50
    assert seg.filter(F.col("total_orders").isNotNull()).count() > 0
    assert spark.read.parquet(paths["quarantine_clickstream"]).count() == 0
    assert spark.read.parquet(paths["personalized_offers"]).count() > 0

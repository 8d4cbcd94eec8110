"""Keys that arrive again, and the incremental chain against a full recompute."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.config import AS_OF
from tillroll.operators.partitioned import KeyedTable, PartitionedTable, buckets_for
from tillroll.plans import generate, gold, medallion, refresh, search, silver, state
from tillroll.session import work_dir
from tillroll.sources import csv as csvio
from tillroll.sources.adapters import Retail
from tillroll.sources import arrivals
from tillroll.sources.arrivals import KEYS
from tillroll.sources.schemas import SOURCES


def rows(df, drop=()):
    cols = sorted(c for c in df.columns if c not in ("bucket", *drop))
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path.removeprefix("file:"))
            for f in names if f.endswith(".parquet")}


# ---- keyed writes --------------------------------------------------------------------

def test_five_keys_rewrite_at_most_five_buckets(spark):
    path = work_dir(spark, "t-buckets")
    n = buckets_for(1000, 25)
    table = KeyedTable(spark, path, "k", n)
    everything = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    everything = everything.union(spark.createDataFrame([(None, "old")], "k long, v string"))
    table.replace_keys(everything.select("k"), everything)
    before = files(path)
    keys = spark.createDataFrame([(3,), (500,), (999,), (None,), (5000,)], "k long")
    written = table.replace_keys(keys, keys.where("k is null or k <> 500").withColumn("v", F.lit("new")))
    after = files(path)
    changed = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert 1 <= len(changed) <= 5 and written.partitions == len(changed) <= 5 < n
    assert written.rows <= sum(1 for _ in table.read(table.buckets_of(keys)).collect())
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == table.read().count() == 1001 and 500 not in got
    assert {k for k, v in got.items() if v == "new"} == {3, 999, None, 5000}
    table.replace_keys(keys, keys.where("k is null or k <> 500").withColumn("v", F.lit("new")))
    assert {r.k: r.v for r in KeyedTable(spark, path, "k", n).read().collect()} == got      # the same write again


def test_a_partition_that_loses_its_rows_goes(spark):
    path = work_dir(spark, "t-partitions")
    table = PartitionedTable(spark, path, "m", "string")
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-02"), (3, None)], "x int, m string")
    table.replace(df, ["2024-01", "2024-02", None])
    assert rows(table.read()) == [("2024-01", 1), ("2024-02", 2), (None, 3)]
    table.replace(table.read(["2024-02", None]).where("x = 0").union(spark.createDataFrame([(9, "2024-03")], "x int, m string")),
                  ["2024-02", None, "2024-03"])
    assert rows(table.read()) == [("2024-01", 1), ("2024-03", 9)]
    plan = table.read(["2024-03"])._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and table.read(["2024-03"]).count() == 1


# ---- second arrivals -----------------------------------------------------------------

def test_known_customers_and_products_arrive_again(spark):
    base = work_dir(spark, "t-again")
    r = Retail(spark, SF_SMALL)
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    for name, path in landing.items():
        csvio.write_csv(getattr(r, name), path)
    medallion.run_medallion(spark, landing, f"{base}/lake")
    ids = [x[0] for x in r.customers.select("customer_id").orderBy("customer_id").limit(5).collect()]
    parts = [x[0] for x in r.clickstream.where("product_id is not null").select("product_id").distinct().limit(5).collect()]
    csvio.write_csv(r.customers.where(F.col("customer_id").isin(ids)).withColumn("city", F.lit("Early")), landing["customers"], "append")
    csvio.write_csv(r.customers.where(F.col("customer_id").isin(ids)).withColumn("city", F.lit("Later")), landing["customers"], "append")
    csvio.write_csv(r.products.where(F.col("product_id").isin(parts)).withColumn("price", F.lit(1.25)), landing["products"], "append")
    csvio.write_csv(r.customers.limit(2).withColumn("customer_id", F.lit(None).cast("long")), landing["customers"], "append")
    results = [medallion.run_medallion(spark, landing, f"{base}/lake") for _ in range(2)]      # the third run lands nothing
    for paths in results:
        c360, clicks = spark.read.parquet(paths["customer_360"]), spark.read.parquet(paths["clickstream_enriched"])
        assert (c360.count(), clicks.count(), spark.read.parquet(paths["purchase_enriched"]).count()) == (150, 1000, 6000)
        assert {x.customer_id for x in c360.where("city = 'Later'").collect()} == set(ids) and c360.where("city = 'Early'").count() == 0
        assert {x[0] for x in clicks.where(F.col("product_id").isin(parts)).select("price").distinct().collect()} == {1.25}
        assert spark.read.parquet(paths["loyalty_status"]).count() == 150
    assert rows(spark.read.parquet(results[0]["customer_segments"])) == rows(spark.read.parquet(results[1]["customer_segments"]))
    reasons = [x.reason for x in spark.read.parquet(results[0]["quarantine_customers"]).collect()]
    assert reasons == ["customer_id is NULL"] * 2
    assert {x.product_id for x in spark.read.parquet(results[0]["product_changes"]).collect()} == set(parts)


# ---- incremental chain ------------------------------------------------------------------

def deliver(spark, landing, frames):
    for name, part in frames.items():
        if part:
            csvio.write_csv(spark.createDataFrame(part, SOURCES[name]), landing[name], "append")


def recompute(spark, now, as_of):
    """Every table from the current rows, by the functions of the full chain."""
    f = {name: spark.createDataFrame(list(part.values()), SOURCES[name]) for name, part in now.items()}
    clicks = silver.clickstream_enriched(f["clickstream"], f["products"])
    c360 = silver.customer_360(f["customers"], f["purchases"], f["clickstream"], as_of)
    segments = gold.customer_segments(c360, as_of)
    return {"clickstream_enriched": clicks, "purchase_enriched": silver.purchase_enriched(f["purchases"], f["products"]),
            "customer_360": c360, "category_interest": gold.category_interest(clicks, as_of), "customer_segments": segments,
            "active_sessions": state.active_sessions(clicks), "products_searchable": search.products_searchable(f["products"]),
            "loyalty_status": state.loyalty_status(segments, as_of)}, f


def compare(spark, result, now, as_of):
    want, frames = recompute(spark, now, as_of)
    for name, df in want.items():
        got = spark.read.schema(df.schema).parquet(result.paths[name])
        drop = ("updated_at",) if name == "loyalty_status" else ()     # untouched customers keep their time
        assert rows(got, drop) == rows(df, drop), name
    fresh = state.personalized_offers(want["category_interest"], frames["products"], as_of)
    offers = {r.offer_id for r in spark.read.parquet(result.paths["personalized_offers"]).collect()}
    assert {r.offer_id for r in fresh.collect()} <= offers and len(offers) == spark.read.parquet(result.paths["personalized_offers"]).count()


def key_of(name, row):
    return tuple(row[k] for k in KEYS[name])


@pytest.mark.parametrize("seed", [1])
def test_refresh_equals_a_full_recompute(spark, seed):
    rng = random.Random(seed)
    prods = generate.generate_products(spark.range(40))
    custs = generate.generate_customers(spark.range(40))
    source = {"products": prods, "customers": custs, "purchases": generate.generate_purchases(spark.range(150), custs, prods),
              "clickstream": generate.generate_clickstream(spark.range(200), custs, prods)}
    pool = {name: [r.asDict() for r in df.select(*SOURCES[name].names).collect()] for name, df in source.items()}
    base = work_dir(spark, "t-refresh")
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    now = {name: {} for name in SOURCES}
    for path in landing.values():
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    as_of = AS_OF
    for step in range(4):
        delivery = {}
        for name, left in pool.items():
            take = left[:len(left) if step == 2 else rng.randrange(len(left) // 2, len(left))] if step < 3 else []
            del left[:len(take)]
            known = list(now[name].values())
            again = [dict(r) for r in rng.sample(known, min(len(known), rng.choice((0, 1, 3))))]
            for r in again:
                if name == "products":
                    r.update(product_name=r["product_name"] + "*", category=rng.choice(known)["category"])
                elif name == "customers":
                    r.update(loyalty_tier=rng.choice(("Gold", "Silver", None)), loyalty_points=rng.randrange(9000))
                elif name == "purchases":
                    r.update(total_amount=round(rng.uniform(1, 900), 2), customer_id=rng.randrange(40),
                             purchase_date=r["purchase_date"] - timedelta(days=rng.choice((0, 40))))
                else:
                    r.update(event_type="add_to_cart", session_id=rng.choice(known)["session_id"],
                             event_timestamp=rng.choice((r["event_timestamp"] - timedelta(days=2), datetime(2024, 1, 2, 3), None)))
            delivery[name] = take + again
            now[name] |= {key_of(name, r): r for r in delivery[name]}
        deliver(spark, landing, delivery)
        as_of = AS_OF + timedelta(days=1) if step == 3 else AS_OF
        result = refresh.refresh(spark, landing, f"{base}/lake", as_of, rows_per_bucket=4)
        compare(spark, result, now, as_of)
    again = refresh.refresh(spark, landing, f"{base}/lake", as_of, rows_per_bucket=4)           # nothing landed
    assert all(w.rows == 0 and w.partitions == 0 for w in again.written.values())
    compare(spark, again, now, as_of)


def test_a_refresh_touches_only_what_changed_and_survives_a_failure(spark, monkeypatch):
    base = work_dir(spark, "t-touch")
    r = Retail(spark, SF_SMALL)
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    now = {}
    for name, path in landing.items():
        csvio.write_csv(getattr(r, name), path)
        now[name] = {key_of(name, x): x for x in (y.asDict() for y in getattr(r, name).select(*SOURCES[name].names).collect())}
    first = refresh.refresh(spark, landing, f"{base}/lake", rows_per_bucket=5)
    assert first.written["customer_360"] == (30, 150) and first.written["current_purchases"].rows == 6000
    stored = {name: files(p) for name, p in first.paths.items()}

    moved = [dict(x) for x in list(now["clickstream"].values())[:2]]
    for x in moved:
        x.update(customer_id=x["customer_id"] + 1, event_type="search")
    people = [dict(x, city="Elsewhere") for x in list(now["customers"].values())[:3]]
    deliver(spark, landing, {"clickstream": moved, "customers": people})
    now["clickstream"] |= {key_of("clickstream", x): x for x in moved}
    now["customers"] |= {key_of("customers", x): x for x in people}

    # the run fails after the events are corrected, before anything that depends on them
    def fail(*_):
        raise RuntimeError("executor lost")
    with monkeypatch.context() as m:
        m.setattr(refresh.silver, "clickstream_enriched", fail)
        with pytest.raises(RuntimeError):
            refresh.refresh(spark, landing, f"{base}/lake", rows_per_bucket=5)
    second = refresh.refresh(spark, landing, f"{base}/lake", rows_per_bucket=5)
    compare(spark, second, now, AS_OF)
    for name in ("customer_360", "customer_segments", "loyalty_status", "category_interest"):
        assert 1 <= second.written[name].partitions <= 7 and second.written[name].rows <= 7 * 15, name
    for name in ("current_purchases", "purchase_enriched", "purchase_partials", "current_products", "products_searchable"):
        assert second.written[name].rows == 0 and files(second.paths[name]) == stored[name], name
    assert second.written["clickstream_enriched"].partitions <= 2
    assert len(files(second.paths["clickstream_enriched"]).keys() - stored["clickstream_enriched"].keys()) <= 4


def test_a_refresh_of_many_changes_leaves_the_other_rows_where_they_are(spark, monkeypatch):
    for module in (arrivals, medallion):
        monkeypatch.setattr(module, "FEW", 8)
    prods, custs = generate.generate_products(spark.range(40)), generate.generate_customers(spark.range(40))
    source = {"products": prods, "customers": custs, "purchases": generate.generate_purchases(spark.range(400), custs, prods),
              "clickstream": generate.generate_clickstream(spark.range(300), custs, prods)}
    pool = {name: [r.asDict() for r in df.select(*SOURCES[name].names).collect()] for name, df in source.items()}
    base = work_dir(spark, "t-many")
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    now = {name: {key_of(name, r): r for r in some} for name, some in pool.items()}
    deliver(spark, landing, pool | {"clickstream": [*pool["clickstream"], *pool["clickstream"][:20]]})
    refresh.refresh(spark, landing, f"{base}/lake", AS_OF)
    again = {"purchases": [dict(r, total_amount=3.5, purchase_date=r["purchase_date"] - timedelta(days=31)) for r in pool["purchases"][::16]],
             "clickstream": [dict(r, event_type="add_to_cart", event_timestamp=None) for r in pool["clickstream"][::20]],
             "products": [dict(r, product_name="new") for r in pool["products"][:9]]}
    for name, some in again.items():
        now[name] |= {key_of(name, r): r for r in some}
    deliver(spark, landing, again)
    moved = {"purchase_enriched": [], "clickstream_enriched": []}
    with monkeypatch.context() as m:
        for name, counts in moved.items():
            whole = getattr(silver, name)
            m.setattr(silver, name, lambda df, p, whole=whole, counts=counts: counts.append(df.count()) or whole(df, p))
        second = refresh.refresh(spark, landing, f"{base}/lake", AS_OF)
    assert 25 <= moved["purchase_enriched"][0] < 250 and 15 <= moved["clickstream_enriched"][0] < 220, moved
    compare(spark, second, now, AS_OF)


def test_partial_aggregates_are_shuffled_once(spark):
    r = Retail(spark, SF_SMALL)
    for name, partials in (("purchases", refresh.purchase_partials), ("clickstream", refresh.click_partials)):
        plan = partials(refresh.with_period(name, getattr(r, name).localCheckpoint()))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan

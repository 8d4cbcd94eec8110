"""What a later run of the chain does not move again, against a run over everything."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_refresh import deliver, files, rows
from tillroll.config import AS_OF, PREV_WEEK
from tillroll.operators.upsert import one_per_key
from tillroll.plans import generate, medallion, search, silver
from tillroll.session import work_dir
from tillroll.sources import adapters, arrivals
from tillroll.sources.adapters import Retail
from tillroll.sources.arrivals import ARRIVAL, ARRIVAL_TYPE, KEYS, current, latest, repeated_numbers
from tillroll.sources.schemas import SOURCES

COMPARED = ("current_products", "clickstream_enriched", "purchase_enriched", "purchase_totals", "customer_360",
            "category_interest", "customer_segments", "products_searchable")


def landed(spark, some):
    place = F.struct("at", "file", "block", "line").cast(ARRIVAL_TYPE)
    return spark.createDataFrame([(k, m, "2024-01-02", "f", 0, i, f"v{i}") for i, (k, m) in enumerate(some)],
                                 "k long, m double, at string, file string, block long, line long, v string").select(
        "k", "m", place.alias(ARRIVAL), "v")


def test_only_rows_of_repeated_keys_travel(spark, monkeypatch):
    lines = landed(spark, [(1, None), (1, 0.0), (1, -0.0), (2, 5.0), (None, 5.0), (3, None), (1, None), (4, float("nan")), (4, float("nan"))])
    path = work_dir(spark, "t-numbers")
    numbers = repeated_numbers(lines, ["k", "m"], path)
    assert numbers.count() == 3
    assert repr(rows(latest(lines, ["k", "m"], numbers).drop(ARRIVAL))) == repr(rows(current(lines, ["k", "m"]).drop(ARRIVAL)))   # NaN
    moved = current(arrivals.with_numbers(lines, ["k", "m"], numbers), ["k", "m"])
    assert arrivals.with_numbers(lines, ["k", "m"], numbers).count() == 6 and moved.count() == 3
    more = lines.unionByName(landed(spark, [(2, 5.0), (9, 1.0), (8, 1.0), (8, 1.0)]))
    fresh = landed(spark, [(2, 5.0), (9, 1.0), (8, 1.0), (8, 1.0)])
    again = repeated_numbers(more, ["k", "m"], f"{path}/2", fresh, numbers)
    assert rows(again) == rows(repeated_numbers(more, ["k", "m"], f"{path}/3")) and again.count() == 5
    monkeypatch.setattr(arrivals, "FEW", 2)
    assert repeated_numbers(more, ["k", "m"], f"{path}/4", fresh, numbers) is None               # then all rows go the long way
    assert repr(rows(latest(lines, ["k", "m"], None))) == repr(rows(current(lines, ["k", "m"])))


@pytest.mark.parametrize("few", [1_000_000, 3])
def test_carried_rows_equal_a_run_over_everything(spark, monkeypatch, few):
    """``few``: with 3 some steps carry rows over and others do the whole work."""
    for module in (arrivals, medallion):
        monkeypatch.setattr(module, "FEW", few)
    rng = random.Random(few)
    prods, custs = generate.generate_products(spark.range(40)), generate.generate_customers(spark.range(40))
    source = {"products": prods, "customers": custs, "purchases": generate.generate_purchases(spark.range(150), custs, prods),
              "clickstream": generate.generate_clickstream(spark.range(200), custs, prods)}
    pool = {name: [r.asDict() for r in df.select(*SOURCES[name].names).collect()] for name, df in source.items()}
    base = work_dir(spark, "t-carry")
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    later = {name: some[len(some) - 5:] for name, some in pool.items()}                           # also products that were bought before
    deliver(spark, landing, {name: some[:-5] for name, some in pool.items()})
    medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF - timedelta(days=1))

    enriched = []
    whole = silver.purchase_enriched
    monkeypatch.setattr(silver, "purchase_enriched", lambda p, products: enriched.append(p.count()) or whole(p, products))
    known = {name: rng.sample(some[:-5], 2) for name, some in pool.items()}
    again = {"products": [dict(r, product_name=r["product_name"] + "*", price=1.5) for r in known["products"]],
             "customers": [dict(r, loyalty_tier="Gold") for r in known["customers"]],
             "purchases": [dict(r, customer_id=(r["customer_id"] + 1) % 40, total_amount=7.25) for r in known["purchases"]],
             "clickstream": [dict(r, event_type="add_to_cart", event_timestamp=t, product_id=None)
                             for r, t in zip(known["clickstream"], (None, datetime(2024, 1, 2, 3)))]}
    twice = dict(later["purchases"][0], total_amount=9.5)
    keyless = dict(later["purchases"][1], transaction_id=None)
    no_one = dict(later["purchases"][2], transaction_id="T-nobody", customer_id=None, product_id=None)
    deliver(spark, landing, {**later, "purchases": [*later["purchases"], keyless, no_one]})
    deliver(spark, landing, again | {"purchases": [*again["purchases"], twice]})
    second = medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF)

    before = set(files(landing["purchases"]) | {os.path.join(landing["purchases"].removeprefix("file:"), f): 0
                                                for f in os.listdir(landing["purchases"].removeprefix("file:"))})
    deliver(spark, landing, {"purchases": [dict(known["purchases"][0], total_amount=-1.0)]})
    for f in os.listdir(landing["purchases"].removeprefix("file:")):                             # a file from before all others
        f = os.path.join(landing["purchases"].removeprefix("file:"), f)
        if f not in before and f.endswith(".csv"):
            os.utime(f, (1_000_000_000, 1_000_000_000))
    third = medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF)
    fourth = medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF)                       # nothing landed
    if few > 3:
        assert enriched[0] < 75 and enriched[1] <= 5 and enriched[2] <= 5, enriched
    full = medallion.run_medallion(spark, landing, f"{base}/fresh", AS_OF)
    for paths in (third, fourth):
        for name in COMPARED:
            got, want = spark.read.parquet(paths[name]), spark.read.parquet(full[name])
            assert got.schema.simpleString() == want.schema.simpleString() and rows(got) == rows(want), name
    assert rows(spark.read.parquet(second["purchase_enriched"])) == rows(spark.read.parquet(full["purchase_enriched"]))
    totals = silver.purchase_agg(spark.read.parquet(full["purchase_enriched"]))
    assert rows(spark.read.parquet(third["purchase_totals"])) == rows(totals)


def test_later_purchases_by_their_orders(spark, monkeypatch):
    r = Retail(spark, SF_SMALL)
    for day in (PREV_WEEK, AS_OF - timedelta(days=400)):
        want = rows(r.purchases.where(F.col("purchase_date") > F.lit(day.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")))
        few = r.purchases_after(day)
        assert rows(few) == want
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = r.purchases_after(day)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning(l_orderkey" not in plan and "BroadcastHashJoin" in plan
            monkeypatch.setattr(adapters, "FEW", -1)
            plan = r.purchases_after(day)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning(l_orderkey" in plan and rows(r.purchases_after(day)) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            monkeypatch.undo()
    assert want


def test_the_feed_is_built_once(spark):
    products = Retail(spark, SF_SMALL).products
    base, kept = work_dir(spark, "t-feed"), []

    def keep(feed):
        kept.append(feed)
        feed.write.parquet(f"{base}/{len(kept)}")
        return spark.read.parquet(f"{base}/{len(kept)}")

    first, _ = search.searchable_version(None, products, keep)
    assert rows(first) == rows(one_per_key(search.products_searchable(products), ["product_id"]))
    changed = products.withColumn("price", F.when(F.col("product_id") == 7, 1.0).otherwise(F.col("price")))
    second, feed = search.searchable_version(first, changed, keep)
    assert rows(second) == rows(search.products_searchable(changed)) and [x.change for x in feed.collect()] == ["update"]
    assert len(kept) == 2 and f"{base}/1" in first.inputFiles()[0]


@pytest.mark.parametrize("few", [4, 16])
def test_more_numbers_than_few_still_leave_rows_alone(spark, monkeypatch, few):
    """A map of bits stands for the numbers: rows that have one are all found, most others stay where they are."""
    for module in (arrivals, medallion):
        monkeypatch.setattr(module, "FEW", few)
    path = work_dir(spark, "t-bits")
    lines = landed(spark, [*[(k, float(k % 3)) for k in [*range(400), *range(20)]], (None, None), (None, None)])
    sent = repeated_numbers(lines, ["k", "m"], path, send=arrivals.sent_numbers)
    assert "_row" in sent.columns and 1 <= sent.count() <= few
    found, others = (arrivals.with_numbers(lines, ["k", "m"], sent, how) for how in ("left_semi", "left_anti"))
    assert found.count() + others.count() == 422 and 40 <= found.count() < 200
    assert {r.k for r in found.collect()} >= {*range(20)} and not {r.k for r in found.collect()} & {r.k for r in others.collect()}
    assert rows(latest(lines, ["k", "m"], sent).drop(ARRIVAL)) == rows(current(lines, ["k", "m"]).drop(ARRIVAL))
    more = lines.unionByName(landed(spark, [(k, float(k % 3)) for k in range(390, 420)]))
    fresh = landed(spark, [(k, float(k % 3)) for k in range(390, 420)])
    known = spark.read.schema("_number long").parquet(path)
    repeated_numbers(more, ["k", "m"], f"{path}/2", fresh, known, send=arrivals.sent_numbers)
    repeated_numbers(more, ["k", "m"], f"{path}/3", send=arrivals.sent_numbers)
    assert rows(spark.read.parquet(f"{path}/2")) == rows(spark.read.parquet(f"{path}/3"))


def test_a_delivery_of_many_changes_does_not_move_all_rows(spark, monkeypatch):
    for module in (arrivals, medallion):
        monkeypatch.setattr(module, "FEW", 8)
    prods, custs = generate.generate_products(spark.range(60)), generate.generate_customers(spark.range(60))
    bought = generate.generate_purchases(spark.range(600), custs, prods)
    frames = {"products": prods, "customers": custs, "purchases": bought, "clickstream": generate.generate_clickstream(spark.range(300), custs, prods)}
    pool = {name: [r.asDict() for r in df.select(*SOURCES[name].names).collect()] for name, df in frames.items()}
    base = work_dir(spark, "t-many")
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    deliver(spark, landing, pool)
    medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF)
    enriched, summed = [], []
    whole, agg = silver.purchase_enriched, silver.purchase_agg
    monkeypatch.setattr(silver, "purchase_enriched", lambda p, products: enriched.append(p.count()) or whole(p, products))
    monkeypatch.setattr(silver, "purchase_agg", lambda p: summed.append(p.count()) or agg(p))
    deliver(spark, landing, {"purchases": [dict(r, total_amount=3.5) for r in pool["purchases"][:30]],
                             "products": [dict(r, product_name="new") for r in pool["products"][:10]]})
    second = medallion.run_medallion(spark, landing, f"{base}/lake", AS_OF)
    assert 30 <= enriched[0] < 300 and 30 <= summed[0] < 550, (enriched, summed)
    full = medallion.run_medallion(spark, landing, f"{base}/fresh", AS_OF)
    for name in COMPARED:
        assert rows(spark.read.parquet(second[name])) == rows(spark.read.parquet(full[name])), name


def test_purchases_of_some_customers_by_their_orders(spark, monkeypatch):
    r = Retail(spark, SF_SMALL)
    want = rows(r.purchases.where("customer_id % 13 = 5"))
    assert want and rows(r.purchases_of(lambda c: c % 13 == 5)) == want
    for module in (arrivals, adapters):
        monkeypatch.setattr(module, "FEW", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some = r.purchases_of(lambda c: c % 13 == 5)
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert rows(some) == want and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

"""Streams with Spark's own state against the batch results."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tests.conftest import SF_SMALL
from tillroll.functions.weights import recent_interest_weight
from tillroll.plans import silver, state
from tillroll.session import work_dir
from tillroll.sources import csv as csvio
from tillroll.sources.adapters import Retail
from tillroll.streaming import stateful


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()))


def cut(clicks, begin, end):
    at = F.col("event_timestamp")
    return clicks.where((at >= F.lit(begin).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))


def batch_windows(clicks, products):
    """Window ends at 12:00: an event counts in the two that follow it."""
    first = F.date_trunc("day", F.col("event_timestamp") - F.expr("interval 12 hours")).cast("timestamp_ntz") + F.expr("interval 36 hours")
    ends = F.explode(F.array(first, first + F.expr("interval 1 day")))
    return (silver.clickstream_enriched(clicks, products).withColumn("window_end", ends).groupBy("window_end", "customer_id", "category")
            .agg(F.sum(recent_interest_weight("event_type")).cast("long").alias("recent_interest_score"), F.count("*").alias("events")))


def test_windows_equal_batch_and_expire(spark):
    base = work_dir(spark, "t-windows")
    r = Retail(spark, SF_SMALL)
    edges = ["2000-01-01", "2024-01-10", "2024-01-20", "2024-01-26", "2030-01-01"]
    sizes, late = [], 0
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        csvio.write_csv(cut(r.clickstream, a, b), f"{base}/land", mode="append")
        done = stateful.interest_windows(spark, f"{base}/land", r.products, f"{base}/w", f"{base}/ck")
        late += sum(x.late for x in done)
        sizes.append((max(x.state for x in done), done[-1].state))
    got = stateful.window_table(spark, f"{base}/w").read().drop("window_key")
    assert rows(got) == rows(batch_windows(r.clickstream, r.products)) and late == 0
    assert all(end < peak for peak, end in sizes)                   # windows behind the watermark leave the state
    assert sizes[-1][1] < got.count() / 4
    # behind the watermark: counted, and nothing changes
    csvio.write_csv(cut(r.clickstream, "2024-01-05", "2024-01-08"), f"{base}/land", mode="append")
    done = stateful.interest_windows(spark, f"{base}/land", r.products, f"{base}/w", f"{base}/ck")
    assert sum(x.late for x in done) > 0
    assert rows(stateful.window_table(spark, f"{base}/w").read().drop("window_key")) == rows(got)
    # at once, and replayed
    csvio.write_csv(r.clickstream, f"{base}/land1")
    stateful.interest_windows(spark, f"{base}/land1", r.products, f"{base}/w1", f"{base}/ck1")
    table = stateful.window_table(spark, f"{base}/w1")
    assert rows(table.read().drop("window_key")) == rows(got)
    stateful.upsert_sink(table, stateful.WINDOW_KEYS)(table.read().where("window_end >= '2024-01-20'"), 99)
    assert rows(table.read().drop("window_key")) == rows(got)


def test_sessions_equal_batch(spark):
    base = work_dir(spark, "t-sessions")
    r = Retail(spark, SF_SMALL)
    whole = rows(state.active_sessions(silver.clickstream_enriched(r.clickstream, r.products)))
    for a, b in (("2000-01-01", "2024-01-15"), ("2024-01-15", "2030-01-01")):
        csvio.write_csv(cut(r.clickstream, a, b), f"{base}/land", mode="append")
        stateful.live_sessions(spark, f"{base}/land", r.products, f"{base}/s", f"{base}/ck", idle=timedelta(days=400))
    got = stateful.session_table(spark, f"{base}/s").read()
    assert rows(got.drop("opened", "opened_day", "closed")) == whole
    assert got.where("closed").count() == 0


def test_idle_sessions_close(spark):
    base = work_dir(spark, "t-idle")
    r = Retail(spark, SF_SMALL)
    product = r.products.first().product_id
    columns = r.clickstream.columns
    kinds = StructType([StructField(f.name, f.dataType) for f in r.clickstream.schema])

    def land(*events):
        made = [{"event_id": k, "customer_id": 7, "session_id": s, "event_type": kind, "event_timestamp": at, "product_id": product,
                 "device_type": "web"} for k, s, kind, at in events]
        csvio.write_csv(spark.createDataFrame([tuple(m.get(c) for c in columns) for m in made], kinds), f"{base}/land", mode="append")
        return stateful.live_sessions(spark, f"{base}/land", r.products, f"{base}/s", f"{base}/ck", lateness="10 minutes")

    def table():
        return {(x.session_id, x.opened.hour): (x.closed, x.cart_items, x.last_activity.hour)
                for x in stateful.session_table(spark, f"{base}/s").read().collect()}

    t = lambda hour, minute=0: datetime(2024, 1, 5, hour, minute)
    land((1, "a", "add_to_cart", t(8)), (2, "b", "view", t(8, 30)))
    assert table() == {("a", 8): (False, 1, 8), ("b", 8): (False, 0, 8)}
    land((3, "b", "add_to_cart", t(8, 50)))                            # the watermark passes 8:30: a closes, b lives on
    assert table() == {("a", 8): (True, 1, 8), ("b", 8): (False, 1, 8)}
    done = land((4, "a", "view", t(12)), (5, "b", "view", t(8, 10)))   # a comes back: a session of its own; b's row is late
    assert sum(x.late for x in done) == 1
    assert table() == {("a", 8): (True, 1, 8), ("a", 12): (False, 0, 12), ("b", 8): (True, 1, 8)}
    assert done[-1].state < 8


def test_sessions_share_states_but_close_apart(spark, monkeypatch):
    """Many sessions in one bucket: few states, every session with its own end."""
    monkeypatch.setattr(stateful, "SESSION_BUCKETS", 2)
    base = work_dir(spark, "t-buckets")
    r = Retail(spark, SF_SMALL)
    edges = ["2000-01-01", "2024-01-10", "2024-01-20", "2030-01-01"]
    states = []
    for a, b in zip(edges, edges[1:]):
        csvio.write_csv(cut(r.clickstream, a, b), f"{base}/land", mode="append")
        done = stateful.live_sessions(spark, f"{base}/land", r.products, f"{base}/s", f"{base}/ck", idle=timedelta(days=2))
        states += [x.state for x in done]
    got = stateful.session_table(spark, f"{base}/s").read()
    sessions = rows(state.active_sessions(silver.clickstream_enriched(r.clickstream, r.products)))
    assert max(states) == 2 and len(sessions) > 100
    assert rows(got.drop("opened", "opened_day", "closed")) == sessions
    last = r.clickstream.agg(F.max("event_timestamp")).first()[0]
    for x in got.collect():                                            # lateness and idle time, two days each
        assert x.closed == (x.last_activity + timedelta(days=4) < last)

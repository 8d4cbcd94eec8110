"""Event-time streams whose state is Spark's own (RocksDB state store).

* ``interest_windows``: sliding windows of recent interest behind a watermark;
* ``live_sessions``: open sessions, kept in hash buckets, each closed when it has
  been idle.

State of what the watermark has passed is dropped, so it follows the events of
the last days and not the whole history.  Every batch brings whole current rows
(not increments) that replace those of the same key in a parquet table
partitioned by time: only open windows or days are read and written, a batch
that is delivered twice leaves the same table, and a restart goes on from the
checkpoint.  Rows behind the watermark change nothing; they are counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillroll.config import AS_OF
from tillroll.functions.weights import event_weight, recent_interest_weight
from tillroll.operators.partitioned import PartitionedTable, only, values_of
from tillroll.plans import silver
from tillroll.sources.csv import read_csv_stream
from tillroll.sources.schemas import CLICKSTREAM

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Batch(NamedTuple):
    """``late``: rows (of partial aggregates, for windows) behind the watermark;
    ``state``: rows kept after the batch."""
    batch: int
    watermark: str | None
    late: int
    state: int


@contextmanager
def _rocksdb(spark: SparkSession):
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def upsert_sink(table: PartitionedTable, keys: list[str]):
    """foreachBatch function: the batch's rows replace those of the same key.
    The partition column is a part of the key or follows from it."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            touched = values_of(batch, table.by)                    # open windows or days
            if touched:
                rows = batch
                if table.exists():
                    rows = only(table.read(touched), batch.select(*keys), "left_anti").unionByName(batch)
                table.replace(rows, touched)
        finally:
            batch.unpersist()
    return run


def run_batches(rows: DataFrame, sink, checkpoint: str) -> list[Batch]:
    """Everything that has landed, into the sink; what each batch did."""
    with _rocksdb(rows.sparkSession):
        query = (rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                 .foreachBatch(sink).trigger(availableNow=True).start())
        query.awaitTermination()
    return [Batch(p["batchId"], p["eventTime"].get("watermark"), sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
                  sum(s["numRowsTotal"] for s in p["stateOperators"])) for p in query.recentProgress]


def _clicks(spark: SparkSession, landing: str, products: DataFrame, lateness: str) -> DataFrame:
    return (silver.clickstream_enriched(read_csv_stream(spark, landing, CLICKSTREAM), products)
            .where(F.col("event_timestamp").isNotNull())
            .withColumn("at", F.col("event_timestamp").cast("timestamp")).withWatermark("at", lateness))


# ---- windows ----------------------------------------------------------------------

WINDOW_KEYS = ["window_end", "customer_id", "category"]


def window_table(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, "window_key", "string")


def interest_windows(spark: SparkSession, landing: str, products: DataFrame, out: str, checkpoint: str,
                     as_of: datetime = AS_OF, hours: int = 48, slide: timedelta = timedelta(days=1),
                     lateness: str = "2 days") -> list[Batch]:
    """Interest score per window, customer and category in ``hours`` long windows,
    one per ``slide``, of which one ends at ``as_of``.

    Equals the batch aggregate as long as rows come at most ``lateness`` behind
    the latest event of earlier batches; a window that the watermark has passed
    is final.  Events without a time count nowhere."""
    from tillroll.streaming.jobs import _window_start_offset
    win = F.window("at", f"{hours} hours", f"{int(slide.total_seconds())} seconds", _window_start_offset(spark, as_of, slide))
    rows = (_clicks(spark, landing, products, lateness).groupBy(win.alias("w"), "customer_id", "category")
            .agg(F.sum(recent_interest_weight("event_type")).cast("long").alias("recent_interest_score"),
                 F.count("*").alias("events"))
            .select(F.col("w.end").cast("timestamp_ntz").alias("window_end"), "customer_id", "category",
                    "recent_interest_score", "events"))
    rows = rows.withColumn("window_key", F.date_format("window_end", "yyyyMMdd'T'HHmmss"))
    return run_batches(rows, upsert_sink(window_table(spark, out), WINDOW_KEYS), checkpoint)


# ---- sessions ---------------------------------------------------------------------

def _text(x) -> str | None:
    return None if x is None or x != x else x


SESSION_BUCKETS = 1024     # states; every one holds the open sessions of its hash bucket
SESSION_IN = ("session_id", "micros", "event", "customer", "kind", "category", "product", "device", "weight")
SESSION_STATE = "sessions string"      # JSON: session id → the fields that ``session_update`` keeps


def session_update(idle_ms: int, numeric_ids: bool):
    """Function of the new rows and the open sessions of one bucket, for
    ``applyInPandasWithState``.  A call costs milliseconds whatever it is given, so
    sessions share one.  Each session has its own time to close, ``idle_ms`` after its
    last event; the bucket's timeout is the earliest of them."""
    order = int if numeric_ids else str

    def row(session: str, h: dict, closed: bool) -> tuple:
        return (session, h["customer"], h["opened"], h["category"], float(max(score for _, score in h["scores"])), len(h["products"]),
                max(0, h["adds"] - h["removes"]), h["device"], h["started"], h["last"], closed)

    def update(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sessions = json.loads(state.get[0]) if state.exists else {}
        stored, touched = set(sessions), {}
        for part in () if state.hasTimedOut else parts:
            for session, at, event, customer, kind, category, product, device, weight in zip(*[part[c].tolist() for c in SESSION_IN]):
                customer, category, product = _text(customer), _text(category), _text(product)
                h = sessions.get(session)
                if h is None:
                    h = sessions[session] = {"customer": customer, "opened": at, "started": at, "last": at, "event": event, "category": category,
                                             "device": _text(device), "adds": 0, "removes": 0, "scores": [], "products": []}
                if session not in touched:
                    touched[session] = dict(map(tuple, h["scores"])), set(h["products"])
                scores, products = touched[session]
                if session not in stored:
                    h["opened"] = min(h["opened"], at)
                h["started"] = min(h["started"], at)
                if customer is not None and (h["customer"] is None or order(customer) > order(h["customer"])):
                    h["customer"] = customer
                if (at, order(event)) >= (h["last"], order(h["event"])):
                    h |= {"last": at, "event": event, "category": category, "device": _text(device)}
                h["adds"] += kind == "add_to_cart"
                h["removes"] += kind == "remove_from_cart"
                scores[category] = scores.get(category, 0) + weight
                if product is not None:
                    products.add(product)
        for session, (scores, products) in touched.items():
            sessions[session] |= {"scores": list(scores.items()), "products": sorted(products)}
        ends = {session: h["last"] // 1000 + idle_ms for session, h in sessions.items()}
        over = {session for session, end in ends.items() if end < state.getCurrentWatermarkMs()}
        rows = [row(session, sessions[session], session in over) for session in {**touched, **dict.fromkeys(over)}]
        for session in over:
            del sessions[session], ends[session]
        if sessions:
            state.update((json.dumps(sessions),))
            state.setTimeoutTimestamp(min(ends.values()))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=SESSION_FIELDS)

    return update


SESSION_OUT = ("session_id string, customer string, opened long, current_category string, top_interest_score double, "
               "products_viewed int, cart_items int, device_type string, started long, last long, closed boolean")


SESSION_FIELDS = [field.split()[0] for field in SESSION_OUT.split(", ")]


def session_table(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, "opened_day", "date")


def live_sessions(spark: SparkSession, landing: str, products: DataFrame, out: str, checkpoint: str,
                  idle: timedelta = timedelta(minutes=30), lateness: str = "2 days") -> list[Batch]:
    """Session rows like those of ``plans.state.active_sessions``, with ``closed``:
    a session closes when the watermark has passed its last event by ``idle``;
    events of the same id after that open a new one (its own row, by ``opened``).
    Events without a time or a session id count nowhere."""
    clicks = _clicks(spark, landing, products, lateness).where(F.col("session_id").isNotNull())
    ids = clicks.schema["customer_id"].dataType
    text = lambda c: F.col(c).cast("string")
    events = clicks.select(
        text("session_id").alias("session_id"), text("customer_id").alias("customer"), "category", text("product_id").alias("product"),
        F.col("event_type").alias("kind"), F.col("device_type").alias("device"), F.coalesce(text("event_id"), F.lit("-1")).alias("event"),
        F.unix_micros("at").alias("micros"), F.coalesce(event_weight("event_type"), F.lit(0)).cast("long").alias("weight"), "at")
    update = session_update(int(idle.total_seconds() * 1000), isinstance(ids, T.NumericType))
    events = events.withColumn("bucket", F.pmod(F.xxhash64("session_id"), F.lit(SESSION_BUCKETS)).cast("int"))
    rows = events.groupBy("bucket").applyInPandasWithState(update, SESSION_OUT, SESSION_STATE, "update", GroupStateTimeout.EventTimeTimeout)
    wall = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    rows = rows.select("session_id", F.col("customer").cast(ids).alias("customer_id"), "current_category", "top_interest_score",
                       "products_viewed", "cart_items", "device_type", wall("started").alias("started_at"),
                       wall("last").alias("last_activity"), wall("opened").alias("opened"), "closed",
                       F.to_date(wall("opened")).alias("opened_day"))
    keys = ["session_id", "opened", "opened_day"]
    sink = upsert_sink(session_table(spark, out), keys)

    return run_batches(rows, sink, checkpoint)

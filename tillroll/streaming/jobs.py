"""Streaming jobs over the raw CSV landing zone.

All run with ``trigger(availableNow=True)``: process what has landed, commit,
stop — the same code runs continuously with a processing-time trigger."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.config import AS_OF
from tillroll.functions.weights import recency_of_day, recent_interest_weight
from tillroll.plans import gold, silver, state
from tillroll.sources.csv import ingest, read_csv_stream
from tillroll.sources.schemas import CLICKSTREAM
from tillroll.streaming.sinks import KeyedState, merge_sink


def bronze(spark: SparkSession, landing: str, schema, out: str, checkpoint: str,
           keep_corrupt: bool = True) -> DataFrame:
    """Ingest every new CSV file of ``landing`` once into the parquet table
    ``out``; returns the table.  Malformed lines are kept verbatim in
    ``_corrupt_record`` (NULL for good lines), never silently lost."""
    ingest(read_csv_stream(spark, landing, schema, keep_corrupt=keep_corrupt), out, checkpoint)
    return spark.read.parquet(out)


def enrich(spark: SparkSession, landing: str, products: DataFrame, out: str, checkpoint: str,
           partition_by: list[str] = ("event_date",)) -> DataFrame:
    """Stream–static left join of new click events with the product table,
    appended to a silver table partitioned by event_date (partition pruning
    for time-bounded readers).  Late events are accepted."""
    clicks = read_csv_stream(spark, landing, CLICKSTREAM)
    ingest(silver.clickstream_enriched(clicks, products), out, checkpoint, list(partition_by))
    return spark.read.parquet(out)


def _window_start_offset(spark: SparkSession, as_of: datetime, slide: timedelta) -> str:
    """Window start offset that makes one window end exactly at ``as_of``.
    Windows are aligned on epoch instants, and wall-clock ``as_of`` maps to an
    instant through the session time zone."""
    from zoneinfo import ZoneInfo
    tz = ZoneInfo(spark.conf.get("spark.sql.session.timeZone", "UTC"))
    epoch = int(as_of.replace(tzinfo=tz).timestamp())
    return f"{epoch % int(slide.total_seconds())} seconds"


def run_merge(spark: SparkSession, landing: str, products: DataFrame, state: KeyedState, partials, checkpoint: str) -> int | None:
    """Merge all newly landed clicks into a keyed state; returns the current
    version (the same one as before if nothing had landed, None if nothing ever
    has)."""
    clicks = read_csv_stream(spark, landing, CLICKSTREAM)
    query = (silver.clickstream_enriched(clicks, products).writeStream
             .option("checkpointLocation", checkpoint).foreachBatch(merge_sink(state, partials))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return state.latest()


# ---- rolling recent interest ------------------------------------------------------

RECENT_KEYS = ["window_start", "window_end", "customer_id", "category"]


def recent_state(spark: SparkSession, root: str) -> KeyedState:
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*RECENT_KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in ("recent_interest_score", "events_48h")])
    return KeyedState(spark, root, ["customer_id"], merge)


def recent_interest(spark: SparkSession, landing: str, products: DataFrame, root: str,
                    checkpoint: str, as_of: datetime = AS_OF, hours: int = 48,
                    slide: timedelta = timedelta(days=1)) -> int | None:
    """Sliding ``hours``-long windows (one per ``slide``, aligned so one window
    ends at ``as_of``) of the analyst interest score per customer × category.

    Each batch is aggregated per window and merged into the state by key, so an
    event counts whenever it arrives.  Returns the current version."""
    offset = _window_start_offset(spark, as_of, slide)

    def partials(batch: DataFrame) -> DataFrame:
        win = F.window(F.col("event_timestamp").cast("timestamp"), f"{hours} hours", f"{int(slide.total_seconds())} seconds", offset)
        return (batch.groupBy(win.alias("window"), "customer_id", "category")
                .agg(F.sum(recent_interest_weight("event_type")).cast("long").alias("recent_interest_score"),
                     F.count("*").alias("events_48h"))
                .select(*[F.col(f"window.{e}").cast("timestamp_ntz").alias(f"window_{e}") for e in ("start", "end")],
                        "customer_id", "category", "recent_interest_score", "events_48h"))
    return run_merge(spark, landing, products, recent_state(spark, root), partials, checkpoint)


def interest_at(spark: SparkSession, root: str, version: int | None = None, as_of: datetime = AS_OF) -> DataFrame:
    """The window ending at ``as_of`` from a state version (default: latest)."""
    return (recent_state(spark, root).read(version)
            .filter(F.col("window_end") == F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
            .select("customer_id", "category", "recent_interest_score", "events_48h"))


# ---- category interest by day ------------------------------------------------------

DAY_KEYS = ["event_day", "customer_id", "category", "product_id"]


def day_state(spark: SparkSession, root: str) -> KeyedState:
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*DAY_KEYS).agg(
            *[F.sum(c).cast("long").alias(c) for c in ("weight", "events")], F.max("last_interaction").alias("last_interaction"))
    return KeyedState(spark, root, ["customer_id"], merge)


def category_interest(spark: SparkSession, landing: str, products: DataFrame, root: str, checkpoint: str) -> int | None:
    """Streaming form of the gold category interest.

    The recency multiplier depends only on an event's calendar day relative to
    ``as_of``, so the state holds a row per (day, customer, category, product):
    weight sum, event count, last time.  ``interest_from_days`` applies the
    multipliers at read time for any ``as_of``.  Returns the current version."""
    def partials(batch: DataFrame) -> DataFrame:
        return batch.withColumn("event_day", F.to_date("event_timestamp")).groupBy(*DAY_KEYS).agg(
            F.sum("event_weight").cast("long").alias("weight"), F.count("*").alias("events"),
            F.max("event_timestamp").alias("last_interaction"))
    return run_merge(spark, landing, products, day_state(spark, root), partials, checkpoint)


def interest_from_days(days: DataFrame, as_of: datetime = AS_OF) -> DataFrame:
    """Gold category interest from the per-day state, ranked per customer."""
    points = F.col("weight") * recency_of_day(F.col("event_day"), as_of)
    return gold.interest_ranked(days.groupBy("customer_id", "category").agg(
        F.sum(points).alias("interest_score"), F.sum("events").alias("event_count"),
        F.max("last_interaction").alias("last_interaction"), F.count_distinct("product_id").alias("unique_products_viewed")))


# ---- sessions ------------------------------------------------------------------------

def sessions_state(spark: SparkSession, root: str) -> KeyedState:
    return KeyedState(spark, root, ["session_id"], state.merge_session_partials)


def active_sessions(spark: SparkSession, landing: str, products: DataFrame, root: str, checkpoint: str) -> int | None:
    """Live session state as mergeable rows per (session, category, product);
    returns the current version.  No event history is read again."""
    return run_merge(spark, landing, products, sessions_state(spark, root), state.session_partials, checkpoint)


def session_state(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Session rows from a state version (default: latest)."""
    return state.sessions_from_partials(sessions_state(spark, root).read(version))

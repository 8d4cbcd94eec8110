"""Serving state tables: loyalty status, personalized offers, sessions.

Built set-based from the gold tables (no driver round trip, no row loop)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillroll.config import OFFER_VALID_DAYS, UNKNOWN_OFFER_CATEGORY
from tillroll.functions.rules import (
    offer_code, offer_discount, offer_type, tier_or_default, tier_progress, tier_threshold,
)
from tillroll.functions.time import ts_lit
from tillroll.functions.weights import event_weight
from tillroll.operators.rank import row_number_in_groups

#: Parts that a category's customers are dealt over when they meet its product count.
SPREAD = 64

LOYALTY_UPDATE_COLUMNS = [
    "loyalty_tier", "points_balance", "lifetime_value", "total_orders", "next_tier_threshold",
    "tier_progress_pct", "segment", "churn_risk_level", "last_purchase_date",
    "preferred_categories", "updated_at",
]


def loyalty_status(segments: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per customer: tier (default Bronze), points, next threshold,
    progress %, segment, churn level, last purchase date, update time."""
    tier = tier_or_default("loyalty_tier")
    points = F.coalesce(F.col("loyalty_points"), F.lit(0)).cast("int")
    return (segments
            .withColumn("_tier", tier)
            .withColumn("_thr", tier_threshold("_tier"))
            .select(
                "customer_id", "first_name", "last_name",
                F.col("_tier").alias("loyalty_tier"),
                points.alias("points_balance"),
                F.coalesce(F.col("lifetime_value"), F.lit(0.0)).alias("lifetime_value"),
                F.coalesce(F.col("total_orders"), F.lit(0)).cast("int").alias("total_orders"),
                F.col("_thr").cast("int").alias("next_tier_threshold"),
                tier_progress(points, "_thr").alias("tier_progress_pct"),
                "segment", "churn_risk_level",
                F.to_date("last_purchase_date").alias("last_purchase_date"),
                "preferred_categories",
                ts_lit(as_of).alias("updated_at"),
            ))


def product_slots(products: DataFrame) -> DataFrame:
    """Products numbered 0..n−1 within their category (by product_id), plus
    the category size.  Categories are few and large, so the numbering uses
    the range-partitioned operator instead of a per-category window."""
    numbered = row_number_in_groups(
        products.select("product_id", "product_name", "category"), ["category"],
        [F.col("product_id").asc()], out="_rn")
    return numbered.withColumn("slot", F.col("_rn") - 1).drop("_rn")


def personalized_offers(interest: DataFrame, products: DataFrame,
                        as_of: datetime | None = None, max_rank: int = 3,
                        slots: DataFrame | None = None) -> DataFrame:
    """One offer per top-``max_rank`` category of each customer.

    Product choice is deterministic: slot = (customer_id·31 + rank) mod the
    category's product count, joined on (category, slot) — an equi-join, no
    sampling.  Unknown category becomes 'General' and finds no product."""
    top = interest.filter(F.col("interest_rank") <= max_rank).select(
        "customer_id", F.coalesce(F.col("category"), F.lit(UNKNOWN_OFFER_CATEGORY)).alias("category"),
        F.coalesce(F.col("interest_score"), F.lit(0.0)).alias("relevance_score"),
        F.coalesce(F.col("interest_rank"), F.lit(1)).alias("interest_rank"))
    # Few categories carry all rows: the counts (a row per category) are dealt
    # once to each of SPREAD parts, so a category's customers meet them there.
    counts = (products.groupBy("category").agg(F.count("*").alias("_n"))
              .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))))
    slots = slots if slots is not None else product_slots(products)  # reusable across runs
    key_type = top.schema["customer_id"].dataType
    if isinstance(key_type, NumericType):
        ckey = F.col("customer_id").cast("long")
    else:  # string ids: a stable non-negative number per id
        ckey = F.pmod(F.xxhash64("customer_id"), F.lit(1 << 31))
    top = top.withColumn("_part", F.pmod(F.xxhash64("customer_id"), F.lit(SPREAD)).cast("int"))
    want = (top.join(counts, ["category", "_part"])
            .withColumn("slot", F.pmod(ckey * 31 + F.col("interest_rank"), F.col("_n"))))
    j = want.join(slots, ["category", "slot"])
    now = ts_lit(as_of)
    discount = offer_discount("relevance_score")
    return j.select(
        F.sha2(F.concat_ws("|", F.col("customer_id").cast("string"), F.col("category"),
                           F.col("product_id").cast("string")), 256).alias("offer_id"),
        "customer_id",
        offer_code("category", discount).alias("offer_code"),
        "product_id", "product_name", "category", "relevance_score",
        offer_type("interest_rank").alias("offer_type"),
        discount.cast("double").alias("discount_pct"),
        (now + F.expr(f"INTERVAL {OFFER_VALID_DAYS} DAYS")).alias("expires_at"),
        F.lit("active").alias("status"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


SESSION_KEYS = ["session_id", "category", "product_id"]


def session_partials(enriched: DataFrame) -> DataFrame:
    """Mergeable session state, one row per (session, category, product): weight
    sum, cart adds/removes, first time, latest (time, event_id, device).  No
    row grows with a session's events."""
    latest = F.struct("event_timestamp", "event_id")
    return enriched.groupBy(*SESSION_KEYS).agg(
        F.max("customer_id").alias("customer_id"),
        F.sum(event_weight("event_type")).cast("long").alias("score"),
        *[F.count_if(F.col("event_type") == kind).alias(name)
          for name, kind in (("adds", "add_to_cart"), ("removes", "remove_from_cart"))],
        F.min("event_timestamp").alias("started"),
        F.max(F.struct(latest.alias("k"), F.col("device_type").alias("device"))).alias("last"),
    )


def merge_session_partials(partials: DataFrame) -> DataFrame:
    """Combine several partial rows of the same (session, category, product)."""
    return partials.groupBy(*SESSION_KEYS).agg(
        F.max("customer_id").alias("customer_id"),
        *[F.sum(c).cast("long").alias(c) for c in ("score", "adds", "removes")],
        F.min("started").alias("started"), F.max("last").alias("last"))


def sessions_from_partials(partials: DataFrame) -> DataFrame:
    """Session rows: current category / device of the latest event (ties:
    event_id), top category score, distinct products, cart items =
    max(0, adds − removes), first and last activity.

    The partial rows travel once, by session: the weight of a category and the
    first row of a product are found among the rows that are there together."""
    first = F.row_number().over(Window.partitionBy("session_id", "product_id").orderBy("category")) == 1
    rows = partials.where(F.col("session_id").isNotNull()).repartition("session_id").select(
        "*", F.sum("score").over(Window.partitionBy("session_id", "category")).alias("_weight"),
        (first & F.col("product_id").isNotNull()).alias("_first"))
    per = rows.groupBy("session_id").agg(
        F.max("customer_id").alias("customer_id"), F.max("_weight").cast("double").alias("top_interest_score"),
        F.max(F.struct(F.col("last.k").alias("k"), F.col("last.device").alias("device"),
                       F.col("category").alias("category"))).alias("last"),
        F.count_if("_first").cast("int").alias("products_viewed"),
        F.greatest(F.lit(0), F.sum("adds") - F.sum("removes")).cast("int").alias("cart_items"),
        F.min("started").alias("started_at"))
    return per.select(
        "session_id", "customer_id", F.col("last.category").alias("current_category"), "top_interest_score",
        "products_viewed", "cart_items", F.col("last.device").alias("device_type"), "started_at",
        F.col("last.k.event_timestamp").alias("last_activity"))


def active_sessions(enriched: DataFrame) -> DataFrame:
    """Live session state per session_id: an aggregate per (session, category,
    product), then per session, both partial-aggregated before the shuffle."""
    return sessions_from_partials(session_partials(enriched))

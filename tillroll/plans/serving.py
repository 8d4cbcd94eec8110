"""Portal read paths over the state tables, as batch jobs.

Each accepts an optional key frame: the answer for every requested key is
computed in one job (a left-semi join), instead of one query per request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.time import iso
from tillroll.operators.rank import top_k_per_group


def _only(df: DataFrame, keys: DataFrame | None, key: str = "customer_id") -> DataFrame:
    return df if keys is None else df.join(keys.select(key), key, "left_semi")


def profile_lookup(status: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Full loyalty_status rows of the requested customers, dates as ISO text."""
    out = _only(status, keys)
    return (out.withColumn("last_purchase_date", F.date_format("last_purchase_date", "yyyy-MM-dd"))
            .withColumn("updated_at", iso("updated_at")))


def active_offers_topk(offers: DataFrame, keys: DataFrame | None = None, k: int = 10) -> DataFrame:
    """Top ``k`` active offers per customer by relevance (ties: offer_id)."""
    active = _only(offers.filter(F.col("status") == "active"), keys)
    ranked = top_k_per_group(active, ["customer_id"],
                             [F.desc("relevance_score"), F.asc("offer_id")], k, out="offer_rank")
    return ranked.select("customer_id", "offer_rank", "offer_id", "offer_code", "product_id",
                         "product_name", "category", "relevance_score", "offer_type",
                         "discount_pct", iso("expires_at").alias("expires_at"), "status")


def recent_sessions_topk(sessions: DataFrame, keys: DataFrame | None = None, k: int = 5) -> DataFrame:
    """The ``k`` latest sessions per customer (ties: session_id)."""
    ranked = top_k_per_group(_only(sessions, keys), ["customer_id"],
                             [F.desc("last_activity"), F.asc("session_id")], k, out="session_rank")
    return ranked.select("customer_id", "session_rank", "session_id", "current_category",
                         "top_interest_score", "products_viewed", "cart_items", "device_type",
                         iso("last_activity").alias("last_activity"))


SEARCH_COLUMNS = ["customer_id", "first_name", "last_name", "loyalty_tier", "points_balance",
                  "lifetime_value", "segment", "churn_risk_level"]


def customer_search(status: DataFrame, q: str = "", limit: int = 20) -> DataFrame:
    """Case-insensitive substring search on id / first / last name, best
    lifetime value first (NULL first, as the state store sorts), ``limit``
    rows.  ``%`` and ``_`` in ``q`` act as wildcards.  Spark plans the
    ORDER BY + LIMIT as a per-partition top-N, never a full sort."""
    df = status
    if q:
        pat = f"%{q}%"
        df = df.filter(F.col("customer_id").cast("string").ilike(pat)
                       | F.col("first_name").ilike(pat) | F.col("last_name").ilike(pat))
    return (df.select(*SEARCH_COLUMNS)
            .orderBy(F.desc_nulls_first("lifetime_value"), F.asc("customer_id"))
            .limit(int(limit)))


def dashboard_stats(status: DataFrame, offers: DataFrame) -> DataFrame:
    """One row: customer counts, average LTV (2 decimals), average points
    (rounded), and the number of active offers.

    Both tables feed ONE global aggregate over a tagged union (offer rows
    carry NULL customer fields, which AVG ignores), so there is no join;
    each partition pre-aggregates to one row before the final merge."""
    s = status.select(F.lit(True).alias("_cust"), "segment", "churn_risk_level",
                      F.col("lifetime_value").cast("decimal(18,4)").alias("_ltv"),
                      F.col("points_balance").alias("_pts"), F.lit(None).cast("string").alias("_offer"))
    o = offers.select(F.lit(False).alias("_cust"), F.lit(None).cast("string").alias("segment"),
                      F.lit(None).cast("string").alias("churn_risk_level"),
                      F.lit(None).cast("decimal(18,4)").alias("_ltv"), F.lit(None).cast("int").alias("_pts"),
                      F.col("status").alias("_offer"))
    return s.unionByName(o).agg(
        F.count_if(F.col("_cust")).alias("total_customers"),
        F.count_if(F.col("_cust") & (F.col("segment") == "High-Value Active")).alias("high_value_active"),
        F.count_if(F.col("_cust") & (F.col("churn_risk_level") == "High")).alias("high_churn_risk"),
        F.round(F.avg("_ltv"), 2).cast("decimal(10,2)").alias("avg_ltv"),
        F.round(F.avg("_pts")).cast("int").alias("avg_points"),
        F.count_if(F.col("_offer") == "active").alias("active_offers"),
    )

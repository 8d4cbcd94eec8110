"""Analyst questions over the silver/gold tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.config import FOCUS_CATEGORY
from tillroll.functions.weights import recent_interest_weight, within_days, within_hours
from tillroll.operators.rank import percent_rank_global


def recent_interest(enriched: DataFrame, as_of: datetime | None = None, hours: int = 48) -> DataFrame:
    """Rolling-window interest: Σ analyst weight (ELSE 0) and event count."""
    return (enriched.filter(within_hours("event_timestamp", hours, as_of))
            .groupBy("customer_id", "category")
            .agg(F.sum(recent_interest_weight("event_type")).cast("long").alias("recent_interest_score"),
                 F.count(F.lit(1)).alias("events_48h"))
            .orderBy(F.desc("recent_interest_score"), "customer_id", "category"))


def trending_categories(enriched: DataFrame, as_of: datetime | None = None, days: int = 7) -> DataFrame:
    return (enriched.filter(within_days("event_timestamp", days, as_of))
            .groupBy("category")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.countDistinct("customer_id").alias("unique_shoppers"),
                 F.sum(F.when(F.col("event_type") == "add_to_cart", 1).otherwise(0)).cast("long")
                 .alias("cart_adds"))
            .orderBy(F.desc("total_events"), "category"))


def high_churn_customers(segments: DataFrame) -> DataFrame:
    return (segments.filter(F.col("churn_risk_level") == "High")
            .select("customer_id", "first_name", "last_name", "loyalty_tier", "lifetime_value",
                    "segment", "churn_risk_score", "churn_risk_level", "days_since_last_purchase")
            .orderBy(F.desc_nulls_first("lifetime_value"), "customer_id"))


def ltv_by_customer(purchases: DataFrame) -> DataFrame:
    """LTV as historic spend: Σ total_amount per customer (exact decimal sum)."""
    return (purchases.groupBy("customer_id")
            .agg(F.sum(F.col("total_amount").cast("decimal(18,4)")).cast("double").alias("ltv")))


def top_decile_customers(c360: DataFrame, threshold: float = 0.90) -> DataFrame:
    """Customers whose lifetime_value percent rank is ≥ threshold (no
    single-task global window; see operators.rank)."""
    ranked = percent_rank_global(c360.select("customer_id", "lifetime_value"), "lifetime_value",
                                 out="ltv_pctile")
    return ranked.filter(F.col("ltv_pctile") >= threshold)


def top_lapsed_browsers(c360: DataFrame, enriched: DataFrame, as_of: datetime | None = None,
                        category: str = FOCUS_CATEGORY, hours: int = 48,
                        min_days: int = 30, threshold: float = 0.90) -> DataFrame:
    """Top-decile shoppers who have not bought for ≥ min_days but browsed
    ``category`` in the last ``hours``.  The DISTINCT + inner join of the
    SQL form is a left-semi join; the percent rank is computed once on the
    same frame (no self-join)."""
    recent = enriched.filter((F.col("category") == category)
                             & within_hours("event_timestamp", hours, as_of)).select("customer_id")
    top = top_decile_customers(c360, threshold).select("customer_id")
    return (c360.filter(F.col("days_since_last_purchase") >= min_days)
            .join(top, "customer_id", "left_semi")
            .join(recent, "customer_id", "left_semi")
            .select("customer_id", "first_name", "last_name", "loyalty_tier", "lifetime_value",
                    "days_since_last_purchase", "last_activity")
            .orderBy(F.desc_nulls_first("lifetime_value"), "customer_id"))

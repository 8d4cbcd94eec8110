"""Gold layer: category interest and customer segments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.config import SEGMENT_COLUMNS
from tillroll.functions.rules import churn_level, churn_score, segment
from tillroll.functions.weights import calendar_recency, event_weight
from tillroll.operators.rank import row_number_per_group


def interest_ranked(scored: DataFrame) -> DataFrame:
    """Adds interest_rank: highest score first, ties by category."""
    return row_number_per_group(scored, ["customer_id"], [F.desc("interest_score"), F.asc_nulls_first("category")],
                                out="interest_rank")


def category_interest(enriched: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Interest per (customer, category): the events' weights times the
    multiplier of their day, summed inside the aggregate, with counts, and a
    rank per customer.  The rank runs on the aggregate, never on raw events."""
    points: Column = event_weight("event_type") * calendar_recency("event_timestamp", as_of)
    measures = {
        "interest_score": F.sum(points),
        "event_count": F.count("*"),
        "last_interaction": F.max("event_timestamp"),
        "unique_products_viewed": F.countDistinct("product_id"),
    }
    per_category = enriched.groupBy("customer_id", "category").agg(*[m.alias(n) for n, m in measures.items()])
    return interest_ranked(per_category)


def with_segments(c360: DataFrame, as_of: datetime | None = None) -> DataFrame:
    scored = c360.withColumns({"segment": segment(as_of=as_of), "churn_risk_score": churn_score()})
    return scored.withColumn("churn_risk_level", churn_level())


def customer_segments(c360: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The segment table (flagship)."""
    return with_segments(c360, as_of).select(*SEGMENT_COLUMNS)

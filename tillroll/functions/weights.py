"""Event weights and recency multipliers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.config import (
    DEFAULT_EVENT_WEIGHT, DEFAULT_RECENCY, EVENT_WEIGHTS, RECENCY_STEPS, RECENT_INTEREST_WEIGHTS,
)
from tillroll.functions.time import date_lit, ts_lit


def weight_from_dict(col: str | Column, weights: dict, default) -> Column:
    """CASE built from a dict; NULL or unknown keys take ``default``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for key, value in weights.items():
        expr = F.when(c == key, F.lit(value)) if expr is None else expr.when(c == key, F.lit(value))
    return expr.otherwise(F.lit(default))


def event_weight(col: str | Column = "event_type") -> Column:
    """Pipeline weight: view 1 … checkout 6, remove −1, anything else 1."""
    return weight_from_dict(col, EVENT_WEIGHTS, DEFAULT_EVENT_WEIGHT)


def recent_interest_weight(col: str | Column = "event_type") -> Column:
    """Analyst-SQL weight: checkout, remove and unknown types score 0."""
    return weight_from_dict(col, RECENT_INTEREST_WEIGHTS, 0)


def recency_of_day(day: Column, as_of: datetime | None = None, steps=RECENCY_STEPS) -> Column:
    """Multiplier of a calendar day: the first step whose age it does not exceed."""
    age = F.datediff(date_lit(as_of), day)
    return F.coalesce(*[F.when(age <= days, F.lit(factor)) for days, factor in steps], F.lit(DEFAULT_RECENCY))


def calendar_recency(ts: str | Column = "event_timestamp", as_of: datetime | None = None) -> Column:
    """Recency multiplier of an event, by its age in calendar days: the cut-offs
    are midnights, not rolling hours (an event 62 hours old may still get the
    first multiplier)."""
    return recency_of_day(F.to_date(F.col(ts) if isinstance(ts, str) else ts), as_of)


def within_hours(ts: str | Column, hours: int, as_of: datetime | None = None) -> Column:
    """Rolling window predicate ``ts >= as_of - INTERVAL hours``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c >= ts_lit(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")


def within_days(ts: str | Column, days: int, as_of: datetime | None = None) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return c >= ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")

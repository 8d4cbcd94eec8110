"""Business rules as column expressions (segments, churn, loyalty, offers)."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.config import (
    CHURN_CAP,
    CHURN_STEPS,
    CHURN_TERMS,
    DEFAULT_CHURN_LEVEL,
    DEFAULT_SEGMENT,
    DEFAULT_TIER,
    DEFAULT_TIER_THRESHOLD,
    OFFER_MAX_DISCOUNT,
    OFFER_MIN_DISCOUNT,
    OFFER_TYPES,
    SEGMENT_RULES,
    TIER_THRESHOLDS,
)
from tillroll.functions.time import days_since


def _within(value: Column, bounds: tuple) -> Column:
    """``more than`` < value <= ``up to``; a missing bound is open."""
    low, high = bounds
    tests = ([value > low] if low is not None else []) + ([value <= high] if high is not None else [])
    return reduce(lambda a, b: a & b, tests)


def segment(tier="loyalty_tier", d_purchase="days_since_last_purchase",
            d_activity="days_since_last_activity", signup="signup_date",
            as_of: datetime | None = None, rules=SEGMENT_RULES) -> Column:
    """First matching rule of the segment table.  NULL comparisons never match,
    so a customer without purchases falls through to the later rules."""
    source = {"days_since_last_purchase": F.col(d_purchase), "days_since_last_activity": F.col(d_activity),
              "days_since_signup": days_since(signup, as_of)}

    def holds(alternative: dict) -> Column:
        tests = [F.col(tier).isin(*bounds) if name == "tiers" else _within(source[name], bounds)
                 for name, bounds in alternative.items()]
        return reduce(lambda a, b: a & b, tests)

    found = [F.when(reduce(lambda a, b: a | b, map(holds, alternatives)), F.lit(name)) for name, alternatives in rules]
    return F.coalesce(*found, F.lit(DEFAULT_SEGMENT))


def churn_score(d_purchase="days_since_last_purchase", d_activity="days_since_last_activity",
                orders="total_orders", terms=CHURN_TERMS) -> Column:
    """Weighted sum of the churn terms, capped above; no lower bound."""
    named = dict(zip((name for name, _, _ in CHURN_TERMS), (d_purchase, d_activity, orders)))
    parts = [F.coalesce(F.col(named[name]), F.lit(default)) * F.lit(weight) for name, default, weight in terms]
    return F.least(F.lit(CHURN_CAP), reduce(lambda a, b: a + b, parts))


def churn_level(score="churn_risk_score", steps=CHURN_STEPS) -> Column:
    """Level of the highest step that the score reaches."""
    return F.coalesce(*[F.when(F.col(score) >= least, F.lit(level)) for least, level in steps], F.lit(DEFAULT_CHURN_LEVEL))


def tier_from_balance(balance: str | Column) -> Column:
    """Tier of the test mapping: Platinum ≥ 8500, Gold ≥ 6000, Silver ≥ 3000."""
    b = F.col(balance) if isinstance(balance, str) else balance
    return (F.when(b >= 8500, "Platinum").when(b >= 6000, "Gold")
            .when(b >= 3000, "Silver").otherwise("Bronze"))


def tier_or_default(tier="loyalty_tier") -> Column:
    """NULL or empty tier → Bronze."""
    return F.coalesce(F.nullif(F.col(tier), F.lit("")), F.lit(DEFAULT_TIER))


def tier_threshold(tier: str | Column) -> Column:
    t = F.col(tier) if isinstance(tier, str) else tier
    expr = None
    for name, value in TIER_THRESHOLDS.items():
        expr = F.when(t == name, F.lit(value)) if expr is None else expr.when(t == name, F.lit(value))
    return expr.otherwise(F.lit(DEFAULT_TIER_THRESHOLD))


def tier_progress(points: str | Column, threshold: str | Column) -> Column:
    """min(100, points / threshold · 100) to one decimal, 0 if threshold ≤ 0.

    Rounded half-up on the exact ratio with integer arithmetic, so the
    result never depends on binary floating point."""
    p = F.col(points) if isinstance(points, str) else points
    t = F.col(threshold) if isinstance(threshold, str) else threshold
    p, t = p.cast("long"), t.cast("long")
    tenths = F.floor((p * 2000 + t) / (t * 2))  # exact: operands < 2^53
    return F.when(t <= 0, F.lit(0.0)).otherwise(F.least(F.lit(100.0), tenths.cast("double") / 10.0))


def offer_discount(score: str | Column) -> Column:
    """min(30, max(5, int(score / 5))); int() truncates toward zero."""
    s = F.col(score) if isinstance(score, str) else score
    return F.least(F.lit(OFFER_MAX_DISCOUNT),
                   F.greatest(F.lit(OFFER_MIN_DISCOUNT), (s / 5.0).cast("int")))


def offer_code(category: str | Column, discount: str | Column) -> Column:
    c = F.col(category) if isinstance(category, str) else category
    d = F.col(discount) if isinstance(discount, str) else discount
    return F.concat(F.lit("OFFER-"), F.upper(F.substring(c, 1, 3)), F.lit("-"),
                    d.cast("string"), F.lit("OFF"))


def offer_type(rank: str | Column) -> Column:
    r = F.col(rank) if isinstance(rank, str) else rank
    types = F.array(*[F.lit(t) for t in OFFER_TYPES])
    return F.element_at(types, (F.pmod(r, F.lit(len(OFFER_TYPES))) + 1).cast("int"))

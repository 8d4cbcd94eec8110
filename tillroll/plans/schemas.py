"""Declared state tables: keys, required columns, defaults, conflict rule.

One place for the writer (``with_defaults`` and the keyed writes of the whole
chain) and for the audit (``audit``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.config import DEFAULT_CHURN_LEVEL, DEFAULT_TIER
from tillroll.operators.upsert import state_violations
from tillroll.plans.state import LOYALTY_UPDATE_COLUMNS


@dataclass(frozen=True)
class StateTable:
    """``columns`` in order with their types; ``on_conflict``: update or nothing."""
    columns: dict[str, str]
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    on_conflict: str = "update"
    update: tuple[str, ...] | None = None


#: The key columns take the type of the source's ids (``id``).
STATE_TABLES = {
    "loyalty_status": StateTable(
        columns={"customer_id": "id", "first_name": "string", "last_name": "string", "loyalty_tier": "string",
                 "points_balance": "int", "lifetime_value": "double", "total_orders": "int", "next_tier_threshold": "int",
                 "tier_progress_pct": "double", "segment": "string", "churn_risk_level": "string",
                 "last_purchase_date": "date", "preferred_categories": "string", "updated_at": "timestamp_ntz"},
        key=("customer_id",), not_null=("loyalty_tier", "points_balance"),
        defaults={"loyalty_tier": DEFAULT_TIER, "points_balance": 0, "lifetime_value": 0.0, "total_orders": 0,
                  "next_tier_threshold": 5000, "tier_progress_pct": 0.0, "churn_risk_level": DEFAULT_CHURN_LEVEL},
        update=tuple(LOYALTY_UPDATE_COLUMNS)),
    "personalized_offers": StateTable(
        columns={"offer_id": "string", "customer_id": "id", "offer_code": "string", "product_id": "id",
                 "product_name": "string", "category": "string", "relevance_score": "double", "offer_type": "string",
                 "discount_pct": "double", "expires_at": "timestamp_ntz", "status": "string",
                 "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
        key=("offer_id",), not_null=("customer_id", "offer_code", "relevance_score", "offer_type", "status"),
        defaults={"relevance_score": 0.0, "offer_type": "recommendation", "status": "active"}, on_conflict="nothing"),
    "active_sessions": StateTable(
        columns={"session_id": "string", "customer_id": "id", "current_category": "string", "top_interest_score": "double",
                 "products_viewed": "int", "cart_items": "int", "device_type": "string", "started_at": "timestamp_ntz",
                 "last_activity": "timestamp_ntz"},
        key=("session_id",), not_null=("customer_id",),
        defaults={"top_interest_score": 0.0, "products_viewed": 0, "cart_items": 0}),
}


def with_defaults(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the table's declared columns and types; a missing column or a
    NULL takes the declared default."""
    spec = STATE_TABLES[table]

    def column(name: str, kind: str):
        value = F.col(name) if name in rows.columns else F.lit(None)
        if name in spec.defaults:
            value = F.coalesce(value, F.lit(spec.defaults[name]))
        return (value if kind == "id" else value.cast(kind)).alias(name)

    return rows.select(*[column(n, k) for n, k in spec.columns.items()])


def audit(rows: DataFrame, table: str) -> DataFrame:
    """Violations of the declared constraints, one row each."""
    spec = STATE_TABLES[table]
    return state_violations(rows, table, list(spec.key), list(spec.not_null))

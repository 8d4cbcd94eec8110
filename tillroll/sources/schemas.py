"""Explicit schemas of the four raw CSV sources (no inference: inference
splits JSON-array fields and drops leading zeros of zip codes)."""

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


def source_schemas(id_type=LongType()) -> dict[str, StructType]:
    """Schemas of the four sources; ``id_type`` is the type of the entity ids
    (LONG for the test tables, STRING for files with ids such as
    ``PRD-1001`` / ``CUST-00001`` / uuid event ids)."""
    products = _s(("product_id", id_type), ("product_name", StringType()), ("category", StringType()),
                  ("subcategory", StringType()), ("brand", StringType()), ("color", StringType()),
                  ("size", StringType()), ("material", StringType()), ("price", DoubleType()),
                  ("rating", DoubleType()), ("review_count", IntegerType()), ("tags", StringType()),
                  ("description", StringType()), ("in_stock", BooleanType()))
    customers = _s(("customer_id", id_type), ("first_name", StringType()), ("last_name", StringType()),
                   ("email", StringType()), ("phone", StringType()), ("city", StringType()),
                   ("state", StringType()), ("zip_code", StringType()), ("date_of_birth", DateType()),
                   ("signup_date", DateType()), ("loyalty_tier", StringType()), ("loyalty_points", IntegerType()),
                   ("lifetime_value", DoubleType()), ("preferred_categories", StringType()),
                   ("credit_card_last4", StringType()), ("credit_card_masked", StringType()))
    purchases = _s(("transaction_id", StringType()), ("customer_id", id_type), ("product_id", id_type),
                   ("category", StringType()), ("brand", StringType()), ("quantity", IntegerType()),
                   ("unit_price", DoubleType()), ("total_amount", DoubleType()),
                   ("purchase_date", TimestampNTZType()), ("payment_method", StringType()),
                   ("store_type", StringType()))
    clickstream = _s(("event_id", id_type), ("session_id", StringType()), ("customer_id", id_type),
                     ("event_type", StringType()), ("event_timestamp", TimestampNTZType()),
                     ("product_id", id_type), ("category", StringType()), ("brand", StringType()),
                     ("page_url", StringType()), ("search_term", StringType()), ("device_type", StringType()),
                     ("referrer", StringType()), ("duration_seconds", IntegerType()))
    return {"products": products, "customers": customers, "purchases": purchases, "clickstream": clickstream}


SOURCES = source_schemas(LongType())
STRING_ID_SOURCES = source_schemas(StringType())
PRODUCTS, CUSTOMERS = SOURCES["products"], SOURCES["customers"]
PURCHASES, CLICKSTREAM = SOURCES["purchases"], SOURCES["clickstream"]

"""Map the given test tables onto the retail model (see FIXTURES.md §2).

Each adapter is a lazy projection/join over the parquet tables; filters are
written on the stored columns so they reach the parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.config import (
    DEVICE_TYPES,
    ORDER_DATE_SHIFT_DAYS,
    ORDER_STATUS,
    PAYMENT_METHODS,
    REFERRERS,
    SEARCH_TERMS,
    STORE_TYPES,
    TEST_CATEGORIES,
)
from tillroll.functions.rules import tier_from_balance
from tillroll.functions.time import ts_lit
from tillroll.functions.text import json_array, mask_card, product_url, search_url
from tillroll.session import work_dir
from tillroll.sources.arrivals import FEW, key_number, number_bits, with_numbers
from tillroll.sources.tables import Tables


def _pick(values: list, index) -> F.Column:
    """values[index] for a non-negative integral index column."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def products(t: Tables) -> DataFrame:
    p = t.part
    name = F.col("p_name")
    sub = F.split_part(name, F.lit(" "), F.lit(2))
    first = F.split_part(name, F.lit(" "), F.lit(1))
    return p.select(
        F.col("p_partkey").alias("product_id"),
        name.alias("product_name"),
        F.col("p_type").alias("category"),
        sub.alias("subcategory"),
        F.col("p_brand").alias("brand"),
        first.alias("color"),
        F.col("p_size").cast("string").alias("size"),
        first.alias("material"),
        F.col("p_retailprice").alias("price"),
        ((F.col("p_partkey") % 21 + 30).cast("double") / 10.0).alias("rating"),
        ((F.col("p_partkey") * 7) % 496 + 5).cast("int").alias("review_count"),
        json_array(F.lower(F.col("p_type")), F.lower(sub)).alias("tags"),
        F.concat(name, F.lit(" by "), F.col("p_brand")).alias("description"),
        (F.col("p_partkey") % 4 != 0).alias("in_stock"),
    )


def customers(t: Tables) -> DataFrame:
    c, n = t.customer, t.nation
    key = F.col("c_custkey")
    first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    last = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    last4 = F.lpad(((key * 7919) % 10000).cast("string"), 4, "0")
    # nation has 25 rows by definition; Spark broadcasts it by size.
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        key.alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
        F.col("n_name").alias("city"),
        F.upper(F.substring(F.col("n_name"), 1, 2)).alias("state"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.date_sub(F.lit("1990-01-01").cast("date"), ((key * 53) % 18000).cast("int")).alias("date_of_birth"),
        F.date_sub(F.lit("2024-01-31").cast("date"), (((key * 37) % 1066) + 30).cast("int")).alias("signup_date"),
        tier_from_balance("c_acctbal").alias("loyalty_tier"),
        (((key * 1571) % 24901) + 100).cast("int").alias("loyalty_points"),
        F.col("c_acctbal").alias("lifetime_value"),
        json_array(_pick(TEST_CATEGORIES, key)).alias("preferred_categories"),
        last4.alias("credit_card_last4"),
        mask_card(last4).alias("credit_card_masked"),
    )


def purchases(t: Tables, as_of: datetime | None = None, after: datetime | None = None,
              customers: Callable[[Column], Column] | None = None) -> DataFrame:
    """Every line item; ``as_of`` hides later orders, ``after`` all others (bounds
    on o_orderdate itself, so they are pushed into the orders scan), ``customers``
    those of customers for which it is not true.  If ``after`` or ``customers``
    leaves at most ``FEW`` orders, they go to the lines; of more, their numbers
    do, and lines that have no such order stay where they are."""
    shift = timedelta(days=ORDER_DATE_SHIFT_DAYS)
    o = t.orders
    if as_of is not None:
        o = o.filter(F.col("o_orderdate") <= ts_lit(as_of - shift))
    if after is not None:
        o = o.filter(F.col("o_orderdate") > ts_lit(after - shift))
    if customers is not None:
        o = o.filter(customers(F.col("o_custkey")))
    li, p = t.lineitem, t.part
    if after is not None or customers is not None:
        if o.count() <= FEW:
            o = F.broadcast(o)
        else:
            wanted = number_bits(o.select(key_number(["o_orderkey"]).alias("_number")), work_dir(t.spark, "orders"))
            li = with_numbers(li, ["l_orderkey"], wanted)
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey, "left"))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {ORDER_DATE_SHIFT_DAYS} DAYS")).alias("purchase_date"),
        _pick(PAYMENT_METHODS, F.col("l_orderkey")).alias("payment_method"),
        _pick(STORE_TYPES, F.col("l_linenumber")).alias("store_type"),
    )


def _click_event_type() -> F.Column:
    et, even = F.col("event_type"), (F.col("event_id") % 2 == 0)
    return (
        F.when(et == "view", F.when(even, "page_view").otherwise("product_view"))
        .when(et == "click", F.when(even, "search").otherwise("add_to_cart"))
        .when(et == "purchase", "checkout_start")
        .when(et == "signup", "add_to_wishlist")
        .when(et == "error", F.when(even, "remove_from_cart").otherwise("error"))
        .otherwise(et)
    )


def clickstream(t: Tables, as_of: datetime | None = None) -> DataFrame:
    """Every event; its product is drawn from the whole key range of part."""
    p = t.part.select("p_partkey", "p_type", "p_brand")
    first = t.part.select(F.min("p_partkey")).scalar()
    span = t.part.select(F.max("p_partkey") - F.min("p_partkey") + 1).scalar()
    e = t.events if as_of is None else t.events.filter(F.col("ts") <= ts_lit(as_of))
    e = e.withColumn("event_type", _click_event_type())
    e = e.withColumn("_pk", first + F.col("event_id") % span)
    j = e.join(p, F.col("_pk") == F.col("p_partkey"), "left")
    is_search = F.col("event_type") == "search"
    term = _pick(SEARCH_TERMS, F.col("event_id"))
    product_id = F.when(is_search, F.lit(None).cast("long")).otherwise(F.col("_pk"))
    return j.select(
        F.col("event_id"),
        F.concat(F.lit("SES-"), F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type"),
        F.col("ts").alias("event_timestamp"),
        product_id.alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(is_search, search_url(term)).otherwise(product_url("p_type", "_pk")).alias("page_url"),
        F.when(is_search, term).alias("search_term"),
        _pick(DEVICE_TYPES, F.col("user_id")).alias("device_type"),
        _pick(REFERRERS, F.col("event_id")).alias("referrer"),
        F.when(F.col("event_type").isin("page_view", "product_view"),
               (F.col("event_id") % 298 + 3).cast("int")).otherwise(F.lit(0)).alias("duration_seconds"),
    )


def order_status(code: F.Column) -> F.Column:
    """Dashboard label of a stored status code."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in ORDER_STATUS.items() for x in kv]), code)


def sales_orders(t: Tables, dims: tuple[str, ...] = ("category", "region"), status: str | None = None) -> DataFrame:
    """The sales fact: one row per line item with status, revenue, quantity,
    order date and the dimensions asked for.

    Only the tables of those dimensions are joined.  ``status`` keeps one label
    and filters on the stored code, so the orders scan is pruned."""
    o = t.orders
    if status is not None:
        o = o.filter(F.col("o_orderstatus").isin(*[c for c, label in ORDER_STATUS.items() if label == status]))
    # Inner joins: a line without its order, customer or part is no sale.  The
    # order-level dimensions come first, so lineitem-sized rows move only by
    # orderkey and partkey; nation and region are small and broadcast by size.
    if "region" in dims:
        place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", F.col("r_name").alias("region"))
        buyers = t.customer.join(place, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "region")
        o = o.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    if "category" in dims:
        lines = lines.join(t.part.select("p_partkey", F.col("p_type").alias("category")), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        *dims,
        order_status(F.col("o_orderstatus")).alias("status"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("revenue"),
        F.col("l_quantity").alias("quantity"),
        F.col("o_orderdate").alias("order_date"),
    )


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "embedding", "label")


def conversations(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", "role", "text")


_BUILT: dict[tuple, DataFrame] = {}


class Retail:
    """The retail model over one scale-factor directory.

    Each adapter frame is built once per (session, directory, as_of) and then
    reused (DataFrames are immutable), which saves the driver from analysing
    the same joins again for every query that needs them."""

    def __init__(self, spark, sf_dir: str, as_of: datetime | None = None):
        """``as_of`` hides purchases and events after that time (a snapshot)."""
        self.spark = spark
        self.t = Tables(spark, sf_dir)
        self.as_of = as_of

    def _get(self, name: str, build, timed: bool) -> DataFrame:
        key = (id(self.spark), self.t.sf_dir.rstrip("/"), name, self.as_of if timed else None)
        df = _BUILT.get(key)
        if df is None or df.sparkSession is not self.spark:
            df = build()
            _BUILT[key] = df
        return df

    @property
    def products(self):
        return self._get("products", lambda: products(self.t), False)

    @property
    def customers(self):
        return self._get("customers", lambda: customers(self.t), False)

    @property
    def purchases(self):
        return self._get("purchases", lambda: purchases(self.t, self.as_of), True)

    def purchases_after(self, after: datetime) -> DataFrame:
        return purchases(self.t, self.as_of, after)

    def purchases_of(self, customers: Callable[[Column], Column]) -> DataFrame:
        """Purchases of the customers for which the condition on their id is true."""
        return purchases(self.t, self.as_of, customers=customers)

    @property
    def clickstream(self):
        return self._get("clickstream", lambda: clickstream(self.t, self.as_of), True)

    @property
    def sales_orders(self):
        return self._get("sales_orders", lambda: sales_orders(self.t), False)

    def sales(self, dims: tuple[str, ...] = (), status: str | None = None):
        """The sales fact with only the given dimensions (and one status)."""
        return self._get(f"sales {dims} {status}", lambda: sales_orders(self.t, dims, status), False)

    @property
    def vectors(self):
        return self._get("vectors", lambda: vectors(self.t), False)

    @property
    def conversations(self):
        return self._get("conversations", lambda: conversations(self.t), False)

"""Synthetic retail data as Spark jobs (no driver-side loops).

Every value is a pure function of (seed, row id, column tag): 40 bits of the md5
of their text, so output is identical for any partitioning, re-run or engine.
All draws are integer arithmetic on those bits.  Row ids come from a key frame
(``spark.range(n)`` or keys of an existing table), so generation scales with
the cluster.  Purchases and clicks pick customers and products by a drawn
position in their numbered frames (ids may have gaps) with an equi-join.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.config import (
    AS_OF, DEVICE_TYPES, LOYALTY_TIERS, PAYMENT_METHODS, REFERRERS, SEARCH_TERMS, STORE_TYPES,
)
from tillroll.functions.text import mask_card, slug
from tillroll.functions.time import date_lit, ts_lit
from tillroll.operators.rank import row_number_in_groups

# ---------------------------------------------------------------------------
# FIXED values of the generator
# ---------------------------------------------------------------------------
CATEGORIES = {
    "Denim": ["Slim Jeans", "Bootcut Jeans", "Skinny Jeans", "Relaxed Jeans", "Denim Jacket", "Denim Shorts", "Denim Skirt", "Wide Leg Jeans"],
    "Tops": ["T-Shirt", "Blouse", "Polo Shirt", "Tank Top", "Henley", "Crop Top", "Button-Down Shirt", "Sweater"],
    "Shoes": ["Sneakers", "Boots", "Sandals", "Loafers", "Running Shoes", "Heels", "Flats", "Slip-Ons"],
    "Accessories": ["Watch", "Sunglasses", "Belt", "Handbag", "Scarf", "Hat", "Wallet", "Bracelet"],
    "Outerwear": ["Winter Jacket", "Trench Coat", "Blazer", "Parka", "Windbreaker", "Vest", "Peacoat", "Rain Jacket"],
    "Activewear": ["Leggings", "Sports Bra", "Running Shorts", "Yoga Pants", "Track Jacket", "Compression Shirt", "Gym Tank", "Sweatpants"],
}
BRANDS = ["UrbanEdge", "NorthTrail", "LuxeVibe", "ActivePulse", "ClassicThread", "StreetCraft", "EcoWear", "PrimeFit"]
COLORS = ["Black", "White", "Navy", "Gray", "Red", "Blue", "Green", "Beige", "Brown", "Pink", "Olive", "Burgundy"]
SIZES = ["XS", "S", "M", "L", "XL", "XXL"]
MATERIALS = ["Cotton", "Polyester", "Denim", "Leather", "Nylon", "Wool", "Linen", "Silk"]
PRICE_RANGES = {
    "Denim": (39.99, 149.99), "Tops": (19.99, 89.99), "Shoes": (49.99, 199.99),
    "Accessories": (14.99, 129.99), "Outerwear": (59.99, 299.99), "Activewear": (24.99, 99.99),
}
DESCRIPTION = "Premium {material} {item} by {brand}. Available in {color}. Perfect for any occasion."
TIER_WEIGHTS = [0.40, 0.30, 0.20, 0.10]
LTV_RANGES = {"Bronze": (50, 500), "Silver": (300, 1500), "Gold": (1000, 5000), "Platinum": (3000, 15000)}
QUANTITY_WEIGHTS = {1: 0.7, 2: 0.2, 3: 0.1}
GEN_EVENT_WEIGHTS = {
    "page_view": 0.45, "product_view": 0.25, "search": 0.10, "add_to_cart": 0.10,
    "add_to_wishlist": 0.05, "remove_from_cart": 0.03, "checkout_start": 0.02,
}
RECENT_SHARE = 0.3             # of the events
RECENT_CUSTOMER_SHARE = 0.2    # of the customers, who make those events
IN_STOCK_SHARE = 0.75
RECENT_HOURS = 48
CLICK_DAYS = 30
PURCHASE_DAYS = 365
SIGNUP_DAYS = (30, 3 * 365)
AGE_DAYS = (18 * 365, 70 * 365)
POINTS_RANGE = (100, 25000)

BITS = 40
SCALE = 1 << BITS


def draw(seed: int, ident: Column, tag: str) -> Column:
    """40 pseudorandom bits as a long."""
    text = F.concat_ws("|", F.lit(str(seed)), ident.cast("string"), F.lit(tag))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def below(bits: Column, n) -> Column:
    """A draw from 0..n-1 (n up to 2^23): the product stays inside a long."""
    return F.shiftright(bits * n, BITS)


def position(bits: Column, n: Column) -> Column:
    """A draw from 0..n-1 for n of any size."""
    return bits % n


def part_of(share: float) -> int:
    """Draws below this number have the probability ``share``."""
    return round(share * SCALE)


def _choice(values: list, bits: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), below(bits, len(values)).cast("int"))


def thresholds(weights: list[float]) -> list[int]:
    total, out = 0.0, []
    for w in weights[:-1]:
        total += w
        out.append(part_of(total))
    return out


def _weighted(values: list, weights: list, bits: Column) -> Column:
    """Choice by cumulative weight: the number of thresholds at or below the draw."""
    passed = [(bits >= t).cast("int") for t in thresholds(weights)]
    index = passed[0]
    for p in passed[1:]:
        index = index + p
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def _between(lo: int, hi: int, bits: Column) -> Column:
    return (F.lit(lo) + below(bits, hi - lo + 1)).cast("int")


def _cents(lo: Column, hi: Column, bits: Column) -> Column:
    """An amount of whole cents in lo..hi (both in cents)."""
    return (lo + below(bits, hi - lo + 1)).cast("double") / 100.0


def _uuid(seed: int, ident: Column, tag: str) -> Column:
    h = F.sha2(F.concat_ws("|", F.lit(str(seed)), ident.cast("string"), F.lit(tag)), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def _by_name(name: Column, table: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), name)


def cents(value: float) -> int:
    return round(value * 100)


def generate_products(ids: DataFrame, seed: int = 42) -> DataFrame:
    """One product per id: category by id; item, brand, colour, material and
    size drawn; price in whole cents of the category's range; JSON tags."""
    i = F.col("id")

    def u(tag):
        return draw(seed, i, tag)

    names = list(CATEGORIES)
    category = F.get(F.array(*map(F.lit, names)), F.pmod(i, F.lit(len(names))).cast("int"))
    items = F.create_map(*[x for c in names for x in (F.lit(c), F.array(*map(F.lit, CATEGORIES[c])))])
    item = F.get(F.element_at(items, category), below(u("item"), 8).cast("int"))
    low, high = (_by_name(category, {c: cents(r[k]) for c, r in PRICE_RANGES.items()}) for k in (0, 1))
    brand, color, material = (_choice(v, u(t)) for v, t in ((BRANDS, "brand"), (COLORS, "color"), (MATERIALS, "material")))
    named = {"material": F.lower(material), "item": F.lower(item), "brand": brand, "color": F.lower(color)}
    text = []
    for piece in DESCRIPTION.split("{"):
        name, found, rest = piece.partition("}")
        text += [named[name], F.lit(rest)] if found else [F.lit(piece)]
    return ids.select(
        (i + 1001).alias("product_id"),
        F.concat_ws(" ", brand, color, item).alias("product_name"),
        category.alias("category"), item.alias("subcategory"), brand.alias("brand"), color.alias("color"),
        _choice(SIZES, u("size")).alias("size"), material.alias("material"),
        _cents(low, high, u("price")).alias("price"),
        (_between(30, 50, u("rating")).cast("double") / 10.0).alias("rating"),
        _between(5, 500, u("reviews")).alias("review_count"),
        F.to_json(F.array(F.lower(category), slug(item), F.lower(brand), F.lower(color))).alias("tags"),
        F.concat(*text).alias("description"),
        (u("stock") < part_of(IN_STOCK_SHARE)).alias("in_stock"),
    )


def generate_customers(ids: DataFrame, seed: int = 42, as_of: datetime = AS_OF) -> DataFrame:
    """Tier by weight, lifetime value in whole cents of the tier's range, one to
    three preferred categories in a drawn order, placeholder names."""
    i = F.col("id")

    def u(tag):
        return draw(seed, i, tag)

    tier = _weighted(LOYALTY_TIERS, TIER_WEIGHTS, u("tier"))
    low, high = (_by_name(tier, {t: r[k] * 100 for t, r in LTV_RANGES.items()}) for k in (0, 1))
    order = F.array_sort(F.array(*[F.concat(F.md5(F.concat_ws("|", F.lit(str(seed)), i.cast("string"), F.lit(c))), F.lit(c))
                                   for c in CATEGORIES]))
    liked = F.transform(F.slice(order, 1, _between(1, 3, u("ncat"))), lambda x: F.substr(x, F.lit(33)))
    first = F.concat(F.lit("First"), _between(1, 999, u("first")).cast("string"))
    last = F.concat(F.lit("Last"), _between(1, 4999, u("last")).cast("string"))

    def digits(n, tag):
        return F.lpad(_between(0, 10 ** n - 1, u(tag)).cast("string"), n, "0")

    return ids.select(
        (i + 1).alias("customer_id"), first.alias("first_name"), last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), digits(4, "phone")).alias("phone"),
        F.concat(F.lit("City"), _between(1, 500, u("city")).cast("string")).alias("city"),
        F.concat(F.lit("S"), _between(1, 50, u("state")).cast("string")).alias("state"),
        digits(5, "zip").alias("zip_code"),
        F.date_sub(date_lit(as_of), _between(*AGE_DAYS, u("dob"))).alias("date_of_birth"),
        F.date_sub(date_lit(as_of), _between(*SIGNUP_DAYS, u("signup"))).alias("signup_date"),
        tier.alias("loyalty_tier"),
        _between(*POINTS_RANGE, u("points")).alias("loyalty_points"),
        _cents(low, high, u("ltv")).alias("lifetime_value"),
        F.to_json(liked).alias("preferred_categories"),
        digits(4, "card").alias("credit_card_last4"), mask_card(digits(4, "card")).alias("credit_card_masked"),
    )


def numbered(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows numbered 0..n-1 by ``order`` (a total order), column ``_at``."""
    return row_number_in_groups(df, [], order, out="_nr").withColumn("_at", F.col("_nr") - 1).drop("_nr")


def size_of(df: DataFrame) -> Column:
    """Number of rows, as a value inside the plan."""
    return df.select(F.count("*")).scalar()


def _seconds_before(as_of: datetime, seconds: Column) -> Column:
    return ts_lit(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def generate_purchases(ids: DataFrame, customers: DataFrame, products: DataFrame,
                       seed: int = 42, as_of: datetime = AS_OF) -> DataFrame:
    """A drawn customer and product per purchase, quantity by weight, time over
    the last year.  Every id makes a purchase (if there is a customer and a
    product at all)."""
    i = F.col("id")

    def u(tag):
        return draw(seed, i, tag)

    who = numbered(customers.select("customer_id"), [F.col("customer_id").asc()]).withColumnRenamed("_at", "_c")
    what = numbered(products.select("product_id", "category", "brand", "price"),
                    [F.col("product_id").asc()]).withColumnRenamed("_at", "_p")
    drawn = ids.select("id", position(u("cust"), size_of(customers)).alias("_c"), position(u("prod"), size_of(products)).alias("_p"),
                       _weighted(list(QUANTITY_WEIGHTS), list(QUANTITY_WEIGHTS.values()), u("qty")).alias("quantity"))
    return drawn.join(who, "_c").join(what, "_p").select(
        _uuid(seed, i, "txn").alias("transaction_id"), "customer_id", "product_id", "category", "brand",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("price").alias("unit_price"),
        (F.round(F.col("price") * 100).cast("long") * F.col("quantity") / F.lit(100.0)).alias("total_amount"),
        _seconds_before(as_of, position(u("when"), F.lit(PURCHASE_DAYS * 86400))).alias("purchase_date"),
        _choice(PAYMENT_METHODS, u("pay")).alias("payment_method"),
        _choice(STORE_TYPES, u("store")).alias("store_type"),
    )


def generate_clickstream(ids: DataFrame, customers: DataFrame, products: DataFrame,
                         seed: int = 42, as_of: datetime = AS_OF) -> DataFrame:
    """Click events: a share of them by a share of the customers within the last
    48 h, the rest by all customers over 30 days; event types by weight;
    searches carry no product."""
    i = F.col("id")

    def u(tag):
        return draw(seed, i, tag)

    # customers in a drawn order: the recent ones are the first of them
    who = numbered(customers.select("customer_id", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("customer_id").cast("string"),
                                                                      F.lit("recent"))).alias("_h")),
                   [F.col("_h").asc(), F.col("customer_id").asc()]).select("customer_id", F.col("_at").alias("_c"))
    what = numbered(products.select("product_id", "category", "brand"), [F.col("product_id").asc()]).withColumnRenamed("_at", "_p")
    everyone = size_of(customers)
    few = F.ceil(everyone * int(RECENT_CUSTOMER_SHARE * 100) / 100).cast("long")
    recent = u("recent") < part_of(RECENT_SHARE)
    drawn = ids.select(
        "id", recent.alias("_recent"),
        F.when(recent, position(u("cust"), few)).otherwise(position(u("cust"), everyone)).alias("_c"),
        position(u("prod"), size_of(products)).alias("_p"),
        _weighted(list(GEN_EVENT_WEIGHTS), list(GEN_EVENT_WEIGHTS.values()), u("type")).alias("event_type"))
    ev = drawn.join(who, "_c").join(what.withColumnRenamed("product_id", "_pid"), "_p")
    span = F.when(F.col("_recent"), F.lit(RECENT_HOURS * 3600)).otherwise(F.lit(CLICK_DAYS * 86400))
    is_search = F.col("event_type") == "search"
    term = _choice(SEARCH_TERMS, u("term"))
    return ev.select(
        i.alias("event_id"),
        F.concat(F.lit("SES-"), F.substring(_uuid(seed, i, "session"), 1, 8)).alias("session_id"),
        "customer_id", "event_type",
        _seconds_before(as_of, position(u("when"), span)).alias("event_timestamp"),
        F.when(~is_search, F.col("_pid")).alias("product_id"),
        "category", "brand",
        F.when(is_search, F.concat(F.lit("/search?q="), F.replace(term, F.lit(" "), F.lit("+"))))
        .otherwise(F.concat(F.lit("/products/"), F.lower("category"), F.lit("/prd-"), F.col("_pid").cast("string")))
        .alias("page_url"),
        F.when(is_search, term).alias("search_term"),
        _choice(DEVICE_TYPES, u("device")).alias("device_type"),
        _choice(REFERRERS, u("ref")).alias("referrer"),
        F.when(F.col("event_type").isin("page_view", "product_view"), _between(3, 300, u("dur")))
        .otherwise(F.lit(0)).alias("duration_seconds"),
    )

"""Incremental form of the whole chain: a run reads and writes what its new files touch.

Tables are plain partitioned parquet folders written in place
(``operators.partitioned``):

* current rows of the sources: products and customers by hash bucket of their
  key, events by day, purchases by month;
* enriched events and purchases, by day and month;
* partial aggregates of both (a row per day or month, customer, session, category,
  product): everything per customer is merged from these, never from raw rows;
* per customer, session or product: customer record, interests, segments, loyalty
  status, offers, sessions, searchable products, by hash bucket.

A run finds the keys that its new lines touch (also the day, customer and session
that a corrected row leaves behind), writes these keys down, and then recomputes
the rows of just those keys.  Changed products are carried to the days and months
whose rows used them and to the offers of their categories.  Recency moves with
the calendar: if ``as_of`` is on another day than the last run's, the rows per
customer are merged from the partials for all customers.

Every step replaces partitions by values computed from the sources, so a run that
failed half way is simply run again; the keys it had written down are included.
Stored rows of a partition that no new key or product touches go back into it
without a shuffle, enriched ones only if no attempt of the run has failed.
The mark that says how far the sources are read is written last.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from tillroll.config import AS_OF, UNKNOWN_OFFER_CATEGORY
from tillroll.functions.time import days_since
from tillroll.functions.weights import event_weight, recency_of_day
from tillroll.operators.partitioned import BUCKET, KeyedTable, PartitionedTable, Written, buckets_for, only, same_rows, together, values_of
from tillroll.operators.upsert import insert_if_absent, keyed_upsert, snapshot_diff
from tillroll.plans import gold, search, silver, state
from tillroll.plans.schemas import STATE_TABLES, with_defaults
from tillroll.sources.arrivals import (
    ARRIVAL, KEYS, PARQUET, bronze_schema, current, key_number, land, path_exists, read_arrivals, read_bronze,
    repeated_numbers, sent_numbers, split_lines, with_numbers,
)
from tillroll.sources.schemas import SOURCES

ROWS_PER_BUCKET = 200_000      # customers, products or sessions of a bucket, about

#: Partition column of the facts, and its type.
PERIOD = {"purchases": ("purchase_month", "string"), "clickstream": ("event_date", "date")}
ENRICHED = {"purchases": "purchase_enriched", "clickstream": "clickstream_enriched"}
PARTS = 16                     # tasks that a period's partial aggregates are dealt over, at most
MAX_RANK = 3                   # interests of a customer that get an offer


# ---- partial aggregates ----------------------------------------------------------

def _placed(rows: DataFrame, period: str, *group: str) -> GroupedData:
    """Rows grouped by period and ``group``, dealt out once: a period's groups go to
    at most ``PARTS`` tasks, which also write them.  (Nearly every group has a
    single row, so partial results would not be fewer.)"""
    part = F.pmod(F.xxhash64(*group), F.lit(PARTS)).cast("int").alias("_part")
    return rows.select("*", part).repartition(period, "_part").groupBy(period, "_part", *group)


def purchase_partials(purchases: DataFrame) -> DataFrame:
    """Per (month, customer, category, product): orders, spend, last and first date."""
    return _placed(purchases, "purchase_month", "customer_id", "category", "product_id").agg(
        F.count("*").alias("orders"), F.sum(F.col("total_amount").cast("decimal(18,4)")).alias("spend"),
        F.max("purchase_date").alias("last"), F.min("purchase_date").alias("first")).drop("_part")


def merged_purchases(partials: DataFrame) -> DataFrame:
    """``silver.purchase_agg`` from partials."""
    return partials.groupBy("customer_id").agg(
        F.sum("orders").alias("total_orders"), F.sum("spend").cast("double").alias("total_spend"),
        F.max("last").alias("last_purchase_date"), F.min("first").alias("first_purchase_date"),
        F.countDistinct("category").alias("distinct_categories_purchased")).select(
        "customer_id", "total_orders", "total_spend", (F.col("total_spend") / F.col("total_orders")).alias("avg_order_value"),
        "last_purchase_date", "first_purchase_date", "distinct_categories_purchased")


def click_partials(clicks: DataFrame) -> DataFrame:
    """Per (day, customer, session, category, product): events, weight, counted
    actions, first time, latest (time, event_id, device)."""
    latest = F.struct("event_timestamp", "event_id")
    return _placed(clicks, "event_date", "customer_id", *state.SESSION_KEYS).agg(
        F.count("*").alias("events"), F.sum(event_weight("event_type")).cast("long").alias("score"),
        *[F.count_if(F.col("event_type") == kind).alias(name)
          for name, kind in (("adds", "add_to_cart"), ("removes", "remove_from_cart"), ("searches", "search"))],
        F.min("event_timestamp").alias("started"),
        F.max(F.struct(latest.alias("k"), F.col("device_type").alias("device"))).alias("last")).drop("_part")


def merged_clicks(partials: DataFrame) -> DataFrame:
    """``silver.click_agg`` from partials."""
    return partials.groupBy("customer_id").agg(
        F.sum("events").alias("total_events"), F.max("last.k.event_timestamp").alias("last_activity"),
        F.countDistinct("session_id").alias("total_sessions"),
        F.sum("adds").alias("total_cart_adds"), F.sum("searches").alias("total_searches"))


def merged_interest(partials: DataFrame, as_of: datetime) -> DataFrame:
    """``gold.category_interest`` from partials."""
    points = F.col("score") * recency_of_day(F.col("event_date"), as_of)
    return gold.interest_ranked(partials.groupBy("customer_id", "category").agg(
        F.sum(points).alias("interest_score"), F.sum("events").alias("event_count"),
        F.max("last.k.event_timestamp").alias("last_interaction"),
        F.countDistinct("product_id").alias("unique_products_viewed")))


# ---- the run ---------------------------------------------------------------------

class Refreshed(NamedTuple):
    """Paths of the tables, and what the run wrote of each."""
    paths: dict[str, str]
    written: dict[str, Written]


class _Marks:
    """How far the sources are read, bucket counts, reference day: a small frame per finished run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def last(self) -> dict[str, str]:
        if not path_exists(self.spark, self.root):
            return {}
        rows = self.spark.read.schema("name string, value string, run int").parquet(self.root)
        run = rows.agg(F.max("run")).first()[0]
        return {} if run is None else {"run": str(run)} | {r.name: r.value for r in rows.where(F.col("run") == run).collect()}

    def write(self, run: int, values: dict[str, str]) -> None:
        (self.spark.createDataFrame(sorted(values.items()), "name string, value string").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/run={run}"))


class _Touched:
    """Keys that a run touches.  They are added to a folder of the run before any
    table changes, so a second attempt still knows what the first one touched."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def add(self, kind: str, keys: DataFrame) -> DataFrame:
        """The keys may repeat: of several columns the distinct values are needed
        one by one, so their combinations are never shuffled."""
        path = f"{self.root}/{kind}"
        (keys if len(keys.columns) > 1 else keys.distinct()).write.mode("append").options(**PARQUET).parquet(path)
        return self.spark.read.schema(keys.schema).parquet(path)


def with_period(name: str, rows: DataFrame) -> DataFrame:
    value = F.date_format("purchase_date", "yyyy-MM") if name == "purchases" else F.to_date("event_timestamp")
    return rows.withColumn(PERIOD[name][0], value)


def _tables(spark: SparkSession, root: str, sizes: dict[str, int]) -> dict[str, PartitionedTable]:
    """All tables; the current rows' schemas are known before they are first written."""
    empty = {n: split_lines(spark.createDataFrame([], bronze_schema(SOURCES[n])), KEYS[n])[0] for n in SOURCES}
    tables: dict[str, PartitionedTable] = {}
    for name, key, size in (
            ("current_products", "product_id", "products"), ("products_searchable", "product_id", "products"),
            ("current_customers", "customer_id", "customers"), ("customer_360", "customer_id", "customers"),
            ("category_interest", "customer_id", "customers"), ("customer_segments", "customer_id", "customers"),
            ("loyalty_status", "customer_id", "customers"), ("personalized_offers", "customer_id", "customers"),
            ("active_sessions", "session_id", "sessions")):
        tables[name] = KeyedTable(spark, f"{root}/{name}", key, sizes[size])
    for name, prefix, partials in (("purchases", "purchase", purchase_partials), ("clickstream", "click", click_partials)):
        rows = with_period(name, empty[name])
        for table, schema in ((f"current_{name}", rows.schema), (ENRICHED[name], None), (f"{prefix}_partials", partials(rows).schema)):
            tables[table] = PartitionedTable(spark, f"{root}/{table}", *PERIOD[name], schema)
    for name in ("products", "customers"):
        tables[f"current_{name}"].schema = empty[name].schema
    return tables


def refresh(spark: SparkSession, landing: dict[str, str], out: str, as_of: datetime = AS_OF,
            rows_per_bucket: int = ROWS_PER_BUCKET) -> Refreshed:
    """Ingest what has landed and bring every table up to date."""
    marks = _Marks(spark, f"{out}/_refresh/marks")
    last = marks.last()
    run = int(last.get("run", 0)) + 1
    touched = _Touched(spark, f"{out}/_refresh/touched/run={run}")
    again = path_exists(spark, touched.root)          # an attempt failed: what tables hold may be half written
    written: dict[str, Written] = {}
    running = [land(read_arrivals(spark, landing[n], SOURCES[n]), f"{out}/bronze/{n}", f"{out}/_checkpoints/{n}", wait=False)
               for n in SOURCES]
    for q in running:
        q.awaitTermination()

    # what this run has to take in: one row per key of the new lines
    def taken(name: str) -> tuple[str, DataFrame]:
        fresh = read_bronze(spark, f"{out}/bronze/{name}", SOURCES[name]).where(F.col("batch") > int(last.get(f"batch {name}", -1)))
        good, rejected = split_lines(fresh, KEYS[name])
        path = f"{out}/_refresh/delta/{name}/run={run}"
        repeated = repeated_numbers(good, KEYS[name], f"{out}/_refresh/repeated/{name}/run={run}", send=sent_numbers)
        current(with_numbers(good, KEYS[name], repeated), KEYS[name]).write.mode("overwrite").options(**PARQUET).parquet(path)
        rejected.write.mode("overwrite").options(**PARQUET).parquet(f"{out}/quarantine/{name}/run={run}")
        reached = fresh.agg(F.max("batch")).first()[0]
        # the other lines are the last of their keys and stay in bronze
        rows = with_numbers(good, KEYS[name], repeated, "left_anti").unionByName(spark.read.schema(good.schema).parquet(path))
        return str(last.get(f"batch {name}", -1) if reached is None else reached), rows

    got = dict(zip(SOURCES, together(*[lambda n=n: taken(n) for n in SOURCES])))
    mark = {f"batch {n}": reached for n, (reached, _) in got.items()} | {"as_of": str(as_of.date())}
    delta = {n: with_period(n, rows) if n in PERIOD else rows for n, (_, rows) in got.items()}
    counted = {"products": delta["products"], "customers": delta["customers"], "sessions": delta["clickstream"].select("session_id").distinct()}
    sizes = {n: int(last[f"buckets {n}"]) if f"buckets {n}" in last else buckets_for(rows.count(), rows_per_bucket)
             for n, rows in counted.items()}
    mark |= {f"buckets {n}": str(size) for n, size in sizes.items()}
    tables = _tables(spark, f"{out}/tables", sizes)

    # numbers of the facts' new keys, and of the touched products: stored rows without them are not moved
    def numbers_of(kind: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        return sent_numbers(rows.select(key_number(keys).alias("_number")).distinct(), f"{out}/_refresh/numbers/{kind}/run={run}")

    sent = {n: numbers_of(n, delta[n], KEYS[n]) for n in PERIOD if tables[f"current_{n}"].exists()}

    # ---- the keys that are touched, written down before anything changes
    def touch_products() -> tuple[DataFrame, DataFrame]:
        products = touched.add("products", delta["products"].select("product_id"))
        offered = ["product_id", "product_name", "category"]
        old, new = tables["current_products"].rows_of(products).select(*offered), delta["products"].select(*offered)
        moved = old.exceptAll(new).unionByName(new.exceptAll(old))
        return products, touched.add("categories", moved.select(F.coalesce("category", F.lit(UNKNOWN_OFFER_CATEGORY)).alias("category")))

    def touch_facts(name: str) -> DataFrame:
        """New rows, and the rows that came before under the same keys (the
        stored key columns are read for this); by what they touch."""
        columns = [PERIOD[name][0], "customer_id", *(["session_id"] if name == "clickstream" else [])]
        found = delta[name].select(*columns)
        if tables[f"current_{name}"].exists():
            stored = tables[f"current_{name}"].read().select(*KEYS[name], *columns)
            # the new rows' keys do not repeat; a semi-join would be done first, over all stored rows
            earlier = with_numbers(stored, KEYS[name], sent[name]).alias("r").join(
                delta[name].select(*KEYS[name]).alias("k"), same_rows("r", "k", KEYS[name]))
            found = found.union(earlier.select(*[f"r.{c}" for c in columns]))
        return touched.add(name, found)

    (products, categories), *facts = together(touch_products, *[lambda n=n: touch_facts(n) for n in PERIOD])
    facts = dict(zip(PERIOD, facts))
    periods = {n: values_of(rows, PERIOD[n][0]) for n, rows in facts.items()}
    sessions = facts["clickstream"].select("session_id").distinct()
    customers = touched.add("customers", delta["customers"].select("customer_id").union(
        facts["purchases"].select("customer_id")).union(facts["clickstream"].select("customer_id")))

    # ---- current rows
    def update_rows(name: str) -> None:
        t, keys = tables[f"current_{name}"], delta[name].select(*KEYS[name])
        buckets = t.buckets_of(keys)
        rows = t.rows_of(keys, buckets).unionByName(delta[name])
        written[f"current_{name}"] = t.replace_keys(keys, current(rows, KEYS[name]), buckets)

    def update_facts(name: str) -> None:
        t, rows, kept = tables[f"current_{name}"], delta[name], None  # a row per key already
        if name in sent:
            stored = t.read(periods[name])
            rows = current(with_numbers(stored, KEYS[name], sent[name]).unionByName(rows), KEYS[name])
            kept = with_numbers(stored, KEYS[name], sent[name], "left_anti")
        written[f"current_{name}"] = t.replace(rows, periods[name], kept)

    together(*[lambda n=n: update_rows(n) for n in ("products", "customers")], *[lambda n=n: update_facts(n) for n in PERIOD])
    catalog = tables["current_products"].read().drop(ARRIVAL, BUCKET)
    changed = numbers_of("products", products, ["product_id"]) if sent else None

    # ---- partials, and enriched rows (also of the periods that used a changed product)
    def update_silver(name: str, prefix: str, partials, enrich) -> None:
        rows, t, column = tables[f"current_{name}"], tables[f"{prefix}_partials"], PERIOD[name][0]
        written[f"{prefix}_partials"] = t.replace(partials(rows.read(periods[name])), periods[name], placed=True)
        wanted = list({*periods[name], *values_of(only(t.read(), products), column)})
        stored, to_enrich, kept = tables[ENRICHED[name]], rows.read(wanted), None
        if name in sent and stored.exists() and not again:
            # rows with another key and product are enriched already
            kept = with_numbers(with_numbers(stored.read(wanted), KEYS[name], sent[name], "left_anti"), ["product_id"], changed, "left_anti")
            to_enrich = with_numbers(to_enrich, KEYS[name], sent[name]).unionByName(with_numbers(
                with_numbers(to_enrich, KEYS[name], sent[name], "left_anti"), ["product_id"], changed))
        written[ENRICHED[name]] = stored.replace(enrich(to_enrich.drop(ARRIVAL, column), catalog), wanted, kept)

    def update_search() -> None:
        """The touched products' rows, and their change feed."""
        t = tables["products_searchable"]
        fresh = search.products_searchable(only(catalog, products))
        t.schema = t.schema or fresh.schema
        snapshot_diff(t.rows_of(products), fresh, ["product_id"]).write.mode("overwrite").options(**PARQUET).parquet(f"{out}/product_changes/run={run}")
        written["products_searchable"] = t.replace_keys(products, fresh)

    together(lambda: update_silver("purchases", "purchase", purchase_partials, silver.purchase_enriched),
             lambda: update_silver("clickstream", "click", click_partials, silver.clickstream_enriched), update_search)

    # ---- per customer: all of them if the calendar has moved on
    bought, clicked = tables["purchase_partials"].read(), tables["click_partials"].read()
    if last.get("as_of") != mark["as_of"]:
        customers = touched.add("customers", tables["current_customers"].read().select("customer_id").union(
            bought.select("customer_id")).union(clicked.select("customer_id")))
    buckets = tables["customer_360"].buckets_of(customers)

    def stored(name: str, rows: DataFrame, keys: DataFrame, within: list[int] | None = None) -> None:
        """State rows of the keys, by the table's conflict rule."""
        spec, t = STATE_TABLES[name], tables[name]
        rows = with_defaults(rows, name)
        t.schema = t.schema or rows.schema
        old = t.rows_of(keys, within)
        rows = (insert_if_absent(old, rows, list(spec.key)) if spec.on_conflict == "nothing"
                else keyed_upsert(old, rows, list(spec.key), list(spec.update or rows.columns)))
        written[name] = t.replace_keys(keys, rows, within)

    def update_customers() -> None:
        wide = tables["current_customers"].rows_of(customers, buckets).drop(ARRIVAL)
        for merged in (merged_purchases(only(bought, customers)), merged_clicks(only(clicked, customers))):
            wide = wide.join(merged, "customer_id", "left")
        wide = wide.select("*", days_since("last_purchase_date", as_of).alias("days_since_last_purchase"),
                           days_since("last_activity", as_of).alias("days_since_last_activity"))
        written["customer_360"] = tables["customer_360"].replace_keys(customers, wide, buckets)
        segments = tables["customer_segments"]
        if not buckets:
            return
        found = gold.customer_segments(tables["customer_360"].rows_of(customers, buckets), as_of)
        written["customer_segments"] = segments.replace_keys(customers, found, buckets)
        stored("loyalty_status", state.loyalty_status(segments.rows_of(customers, buckets), as_of), customers, buckets)

    def update_interest() -> None:
        t = tables["category_interest"]
        rows = merged_interest(only(clicked, customers), as_of)
        written["category_interest"] = t.replace_keys(customers, rows, buckets)
        t.schema = t.schema or rows.schema
        top = t.read().where(F.col("interest_rank") <= MAX_RANK).drop(BUCKET)
        named = top.withColumn("category", F.coalesce("category", F.lit(UNKNOWN_OFFER_CATEGORY)))
        owners = customers.union(only(named, categories).select("customer_id")).distinct()
        stored("personalized_offers", state.personalized_offers(only(top, owners), catalog, as_of, MAX_RANK), owners)

    def update_sessions() -> None:
        """Sessions have no state of their own: a touched one is rebuilt, or goes with its last event."""
        t = tables["active_sessions"]
        rows = with_defaults(state.sessions_from_partials(only(clicked, sessions)), "active_sessions")
        written["active_sessions"] = t.replace_keys(sessions, rows)

    together(update_customers, update_interest, update_sessions)
    marks.write(run, mark)
    return Refreshed({name: t.path for name, t in tables.items() if t.exists()}, written)

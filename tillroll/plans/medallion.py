"""The whole chain as one job: raw CSV → bronze → silver → gold → state.

Bronze ingestion is incremental (stream checkpoints) and append-only; lines that
do not parse or have no key go to quarantine tables, never further.  A key that
arrives again counts once, with the values that arrived last.  Silver and gold
are computed from these current rows, state tables by keyed writes on their last
version.  Enriched rows of the last version whose key did not arrive again and
whose product did not change go into the next one as they are, and so do the
purchase totals of customers without such rows.  Every run
writes new versions of its tables and then one run record that names them;
names in the catalog are switched to the new location.  A run that fails half
way leaves the last record, and so all tables, as they were.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.config import AS_OF
from tillroll.operators.upsert import insert_if_absent, keyed_upsert
from tillroll.plans import gold, search, silver, state
from tillroll.plans.schemas import STATE_TABLES, with_defaults
from tillroll.sources.arrivals import (  # noqa: F401  (FEW: set here too by tests)
    ARRIVAL, FEW, KEYS, PARQUET, current, key_number, land, latest, path_exists, read_arrivals, read_bronze,
    repeated_numbers, sent_numbers, split_lines, with_numbers,
)
from tillroll.sources.schemas import SOURCES

# dataset → (quality layer, description) used when registering the tables
DATASETS = {
    "bronze_products": ("bronze", "Product catalog as landed, one row per CSV line"),
    "bronze_customers": ("bronze", "Customer profiles as landed, one row per CSV line"),
    "bronze_purchases": ("bronze", "Purchase history as landed, one row per CSV line"),
    "bronze_clickstream": ("bronze", "Click events as landed, one row per CSV line"),
    "quarantine_products": ("quarantine", "Product lines that did not parse or have no key"),
    "quarantine_customers": ("quarantine", "Customer lines that did not parse or have no key"),
    "quarantine_purchases": ("quarantine", "Purchase lines that did not parse or have no key"),
    "quarantine_clickstream": ("quarantine", "Click event lines that did not parse or have no key"),
    "current_products": ("silver", "One row per product, as it arrived last"),
    "clickstream_enriched": ("silver", "Click events with product details, event weight, date and hour"),
    "purchase_enriched": ("silver", "Purchases with product details and purchase month"),
    "purchase_totals": ("silver", "Purchase aggregates per customer"),
    "customer_360": ("silver", "One row per customer: profile, purchase and click aggregates, recency"),
    "category_interest": ("gold", "Recency-weighted interest per customer and category, ranked"),
    "customer_segments": ("gold", "Segment and churn risk per customer"),
    "products_searchable": ("gold", "Products with their search text, keyed by product_id"),
    "product_changes": ("gold", "Change feed of the searchable products since the last run"),
    "loyalty_status": ("state", "Loyalty tier, points, progress and segment per customer"),
    "personalized_offers": ("state", "Offers for the top interests of each customer"),
    "active_sessions": ("state", "Live state per browsing session"),
}

# datasets written partitioned (column list)
PARTITIONED = {"clickstream_enriched": ["event_date"]} | {f"bronze_{name}": ["batch"] for name in KEYS}


def table_name(dataset: str, prefix: str = "") -> str:
    layer = DATASETS[dataset][0]
    name = f"{layer}_{dataset}" if layer in ("silver", "gold") else dataset
    return f"{prefix}{name}"


def register_tables(spark: SparkSession, paths: dict[str, str], prefix: str = "") -> dict[str, str]:
    """Register every written dataset as an external parquet table with a
    comment and a quality property, so later jobs read it by name.  A table
    that exists is switched to the new location; it is never dropped."""
    names = {}
    for dataset, path in paths.items():
        quality, comment = DATASETS[dataset]
        name = table_name(dataset, prefix)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}' "
                  f"COMMENT '{comment}' TBLPROPERTIES ('quality' = '{quality}')")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        if dataset in PARTITIONED:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
        names[dataset] = name
    return names


def drop_tables(spark: SparkSession, names: dict[str, str]) -> None:
    """Remove table names (the files of external tables stay)."""
    for name in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_table(df: DataFrame, path: str, partition_by: list[str] = (), carried: DataFrame | None = None) -> None:
    """Write a table version.  Before a partitioned write the rows are
    rebalanced on the partition columns (AQE splits a hot date across tasks
    and merges small ones), avoiding both one-task dates and file floods.
    ``carried`` are rows of the last version: its files hold a partition's rows
    together already, so they are not moved."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if carried is not None:
        df = df.unionByName(carried)
    w = df.write.mode("overwrite").options(**PARQUET)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class Runs:
    """Run records under ``out``: which version of every table is current, and up
    to which batch of bronze lines the tables go."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.root = spark, f"{out}/_runs"

    def _all(self) -> DataFrame | None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(p):
            return None
        return self.spark.read.schema("dataset string, path string, batch long, run long").parquet(self.root)

    def last(self) -> tuple[int, dict[str, str], dict[str, int]]:
        """(number, dataset → path, dataset → last batch) of the last finished run; (0, {}, {}) if none."""
        records = self._all()
        if records is None:
            return 0, {}, {}
        number = records.agg(F.max("run")).first()[0] or 0
        tables = records.where(F.col("run") == number).collect()                                      # a row per table
        return number, {r.dataset: r.path for r in tables}, {r.dataset: r.batch for r in tables if r.batch is not None}

    def commit(self, number: int, paths: dict[str, str], batches: dict[str, int]) -> None:
        rows = self.spark.createDataFrame([(name, path, batches.get(name)) for name, path in sorted(paths.items())],
                                          "dataset string, path string, batch long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/run={number}")


class Carried(NamedTuple):
    """What the next version of an enriched table is made of: rows to enrich, and
    rows of the last version that go on as they are; ``moved`` are the lines whose
    key came for the first time, and all lines of keys that came more often."""
    rows: DataFrame
    kept: DataFrame | None = None
    moved: DataFrame | None = None


def carry_over(stored: DataFrame, lines: DataFrame, fresh: DataFrame, keys: list[str],
               repeated: DataFrame, repeated_exactly: DataFrame, changed: DataFrame) -> Carried:
    """Split the work on a table whose last version is ``stored``.  ``lines`` are all
    good lines, ``fresh`` those that the last version has not seen, ``repeated``
    the numbers that several lines have (``sent_numbers``), ``repeated_exactly``
    the same as they were found, ``changed`` the numbers of products that are not
    as they were (``sent_numbers``).  A stored row whose key has no other line is
    still the last of its key; a row or product that is taken for another only
    goes the long way."""
    alone, came = with_numbers(stored, keys, repeated, "left_anti"), with_numbers(fresh, keys, repeated, "left_anti")
    again = with_numbers(lines, keys, repeated)
    rows = came.unionByName(current(again, keys)).drop(ARRIVAL)
    rows = rows.unionByName(with_numbers(alone, ["product_id"], changed).select(*rows.columns))
    if "_number" not in repeated.columns:      # (a semi-join would be done first, over all lines)
        again = again.join(repeated_exactly.hint("merge"), key_number(keys) == F.col("_number")).drop("_number")
    return Carried(rows, with_numbers(alone, ["product_id"], changed, "left_anti"), fresh.unionByName(again))


def purchase_totals(stored: DataFrame | None, purchases: DataFrame, work: Carried, path: str) -> DataFrame:
    """``silver.purchase_agg`` of the purchases; customers without a line that has
    ``moved`` keep their last totals (a product's columns are not in them)."""
    customer = ["customer_id"]
    if stored is None or work.kept is None:
        return silver.purchase_agg(purchases)
    touched = sent_numbers(work.moved.select(key_number(customer).alias("_number")).distinct(), path)
    again = silver.purchase_agg(with_numbers(purchases, customer, touched))
    return with_numbers(stored, customer, touched, "left_anti").unionByName(again)


def run_medallion(spark: SparkSession, landing: dict[str, str], out: str,
                  as_of: datetime = AS_OF, register_prefix: str | None = None) -> dict[str, str]:
    """Run every stage; returns dataset name → path of its new version.  With
    ``register_prefix`` the tables are also registered in the catalog."""
    runs = Runs(spark, out)
    number, before, seen = runs.last()
    number += 1
    paths: dict[str, str] = {}
    # The four ingestion streams run concurrently (start all, then await all).
    running = []
    for name in SOURCES:
        paths[f"bronze_{name}"] = f"{out}/bronze/{name}"
        running.append(land(read_arrivals(spark, landing[name], SOURCES[name]), paths[f"bronze_{name}"],
                            f"{out}/_checkpoints/{name}", wait=False))
    for q in running:
        q.awaitTermination()

    def stage(name: str, df: DataFrame, carried: DataFrame | None = None) -> DataFrame:
        paths[name] = f"{out}/{DATASETS[name][0]}/{name}/run={number}"
        write_table(df, paths[name], PARTITIONED.get(name, ()), carried)
        return spark.read.parquet(paths[name])

    def stored(name: str) -> DataFrame | None:
        return spark.read.parquet(before[name]) if name in before else None

    def together(frames: dict[str, DataFrame], carried: dict[str, DataFrame | None] = {}) -> dict[str, DataFrame]:
        """Tables that do not need each other are written at the same time."""
        with ThreadPoolExecutor(len(frames)) as pool:
            return dict(zip(frames, pool.map(stage, frames, frames.values(), [carried.get(n) for n in frames])))

    bronze = {name: read_bronze(spark, paths[f"bronze_{name}"], SOURCES[name]) for name in SOURCES}
    lines, rejected = {}, {}
    for name in SOURCES:
        lines[name], rejected[f"quarantine_{name}"] = split_lines(bronze[name], KEYS[name])

    def fresh(name: str) -> DataFrame:
        """Good lines that the last run did not have."""
        return split_lines(bronze[name].where(F.col("batch") > seen[f"bronze_{name}"]), KEYS[name])[0]

    def looked_through(name: str) -> tuple[DataFrame | None, int | None]:
        """(numbers of the keys that arrived more than once, as they are sent; last batch)"""
        path, last, earlier = f"{out}/_repeated/{name}/run={number}", f"{out}/_repeated/{name}/run={number - 1}", ()
        if f"bronze_{name}" in seen and path_exists(spark, last):
            earlier = fresh(name), spark.read.schema("_number long").parquet(last)
        sent = repeated_numbers(lines[name], KEYS[name], path, *(earlier or (None, None)), send=sent_numbers)
        return sent, bronze[name].agg(F.max("batch")).first()[0]

    with ThreadPoolExecutor(len(SOURCES)) as pool:
        found = dict(zip(SOURCES, pool.map(looked_through, SOURCES)))
    good = {name: latest(lines[name], KEYS[name], found[name][0]).drop(ARRIVAL) for name in SOURCES}
    products = together({"current_products": good["products"], **rejected})["current_products"]

    searchable, changes = search.searchable_version(stored("products_searchable"), products,
                                                    lambda feed: stage("product_changes", feed))
    # the feed has every column that enriched rows take from a product
    changed = (sent_numbers(changes.select(key_number(["product_id"]).alias("_number")).distinct(), f"{out}/_changed/run={number}")
               if "products_searchable" in before else None)

    def to_enrich(table: str, name: str) -> Carried:
        if table not in before or f"bronze_{name}" not in seen or changed is None:
            return Carried(good[name])
        exactly = spark.read.schema("_number long").parquet(f"{out}/_repeated/{name}/run={number}")
        return carry_over(stored(table), lines[name], fresh(name), KEYS[name], found[name][0], exactly, changed)

    events, lines_bought = to_enrich("clickstream_enriched", "clickstream"), to_enrich("purchase_enriched", "purchases")
    silver_tables = together({
        "clickstream_enriched": silver.clickstream_enriched(events.rows, products),
        "purchase_enriched": silver.purchase_enriched(lines_bought.rows, products), "products_searchable": searchable},
        {"clickstream_enriched": events.kept, "purchase_enriched": lines_bought.kept})
    # the enriched rows hold every event and purchase once, with the columns that the aggregates read
    clicks, purchases = silver_tables["clickstream_enriched"], silver_tables["purchase_enriched"]
    totals = purchase_totals(stored("purchase_totals"), purchases, lines_bought, f"{out}/_touched/run={number}")
    gold_tables = together({"purchase_totals": totals, "category_interest": gold.category_interest(clicks, as_of)})
    gold_tables |= together({"customer_360": silver.customer_record(
        good["customers"], gold_tables["purchase_totals"], silver.click_agg(clicks), as_of)})
    segments = gold.customer_segments(gold_tables["customer_360"], as_of)

    # state tables: keyed writes on their last version, defaults filled in
    fresh = {"loyalty_status": state.loyalty_status(segments, as_of),
             "personalized_offers": state.personalized_offers(gold_tables["category_interest"], products, as_of),
             "active_sessions": state.active_sessions(clicks)}
    written = {"customer_segments": segments}
    for name, rows in fresh.items():
        spec, old = STATE_TABLES[name], stored(name)
        rows = with_defaults(rows, name)
        if old is not None and spec.on_conflict == "update":
            rows = keyed_upsert(old, rows, list(spec.key), list(spec.update or rows.columns))
        elif old is not None:
            rows = insert_if_absent(old, rows, list(spec.key))
        written[name] = rows
    together(written)
    runs.commit(number, paths, {f"bronze_{name}": last for name, (_, last) in found.items()})
    if register_prefix is not None:
        register_tables(spark, paths, register_prefix)
    return paths

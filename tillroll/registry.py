"""Registered queries: name → (spark, sf_dir) → DataFrame.

Every query reads the whole of the given tables it needs, through the retail
adapters; snapshot queries hide what lies after their reference time, and the
vector searches take every fiftieth vector as their query set.  The matching
DuckDB SQL lives in ``tillroll.oracle``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.config import AS_OF
from tillroll.functions.time import parse_ts
from tillroll.functions.weights import calendar_recency, event_weight
from tillroll.session import work_dir
from tillroll.plans import gold, reports, silver
from tillroll.sources.adapters import Retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- shared building blocks -------------------------------------------------

def enriched_clicks(r: Retail) -> DataFrame:
    return silver.clickstream_enriched(r.clickstream, r.products)


def c360(r: Retail) -> DataFrame:
    return silver.customer_360(r.customers, r.purchases, r.clickstream, AS_OF)


def segments(r: Retail) -> DataFrame:
    return gold.customer_segments(c360(r), AS_OF)


def interest(r: Retail) -> DataFrame:
    return gold.category_interest(enriched_clicks(r), AS_OF)


# ---- dashboard --------------------------------------------------------------

for _name, _fn in reports.DATASETS.items():
    QUERIES[_name] = (lambda f, need: lambda spark, d: f(Retail(spark, d).sales(*need)))(_fn, reports.NEEDS[_name])


@query("dashboard_widgets")
def q_dashboard_widgets(spark, d):
    return reports.dashboard_widgets(Retail(spark, d).sales_orders)


# ---- silver / gold ----------------------------------------------------------

@query("clickstream_enriched")
def q_clickstream_enriched(spark, d):
    return enriched_clicks(Retail(spark, d))


@query("purchase_enriched")
def q_purchase_enriched(spark, d):
    r = Retail(spark, d)
    return silver.purchase_enriched(r.purchases, r.products)


@query("purchase_agg")
def q_purchase_agg(spark, d):
    return silver.purchase_agg(Retail(spark, d).purchases)


@query("click_agg")
def q_click_agg(spark, d):
    return silver.click_agg(Retail(spark, d).clickstream)


@query("customer_360")
def q_customer_360(spark, d):
    return c360(Retail(spark, d))


@query("category_interest")
def q_category_interest(spark, d):
    return interest(Retail(spark, d))


@query("customer_segments")
def q_customer_segments(spark, d):
    return segments(Retail(spark, d))


@query("segment_counts")
def q_segment_counts(spark, d):
    return (segments(Retail(spark, d)).groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "segment"))


@query("churn_scores")
def q_churn_scores(spark, d):
    return segments(Retail(spark, d)).select("customer_id", "churn_risk_score", "churn_risk_level")


@query("event_weights")
def q_event_weights(spark, d):
    c = Retail(spark, d).clickstream
    return (c.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
            .withColumn("event_weight", event_weight("event_type"))
            .orderBy("event_type"))


@query("recency_weights")
def q_recency_weights(spark, d):
    c = Retail(spark, d).clickstream
    return c.select("event_id", "event_timestamp",
                    calendar_recency("event_timestamp", AS_OF).alias("recency_weight"))


@query("time_features")
def q_time_features(spark, d):
    """Parse the ISO text form of each event time (as a CSV would hold it)."""
    c = Retail(spark, d).clickstream
    text = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ts = parse_ts(text)
    return c.select("event_id", ts.alias("event_timestamp"),
                    F.to_date(ts).alias("event_date"), F.hour(ts).alias("event_hour"))


# ---- analyst SQL ------------------------------------------------------------

from tillroll.plans import analyst  # noqa: E402


@query("recent_interest")
def q_recent_interest(spark, d):
    return analyst.recent_interest(enriched_clicks(Retail(spark, d)), AS_OF)


@query("trending_categories")
def q_trending_categories(spark, d):
    return analyst.trending_categories(enriched_clicks(Retail(spark, d)), AS_OF)


@query("high_churn_customers")
def q_high_churn_customers(spark, d):
    return analyst.high_churn_customers(
        gold.with_segments(c360(Retail(spark, d)), AS_OF))


@query("ltv_by_customer")
def q_ltv_by_customer(spark, d):
    r = Retail(spark, d)
    return analyst.ltv_by_customer(silver.purchase_enriched(r.purchases, r.products))


@query("top_decile_customers")
def q_top_decile_customers(spark, d):
    return analyst.top_decile_customers(c360(Retail(spark, d)))


@query("top_lapsed_browsers")
def q_top_lapsed_browsers(spark, d):
    r = Retail(spark, d)
    return analyst.top_lapsed_browsers(c360(r), enriched_clicks(r), AS_OF)


# ---- state tables, keyed writes, serving ------------------------------------

from tillroll.config import PREV_DAY, PREV_WEEK, SEARCH_QUERY  # noqa: E402
from tillroll.operators import upsert as ups  # noqa: E402
from tillroll.plans import schemas, serving, state  # noqa: E402


def loyalty_at(spark, d, as_of) -> DataFrame:
    r = Retail(spark, d, as_of)
    c = silver.customer_360(r.customers, r.purchases, r.clickstream, as_of)
    return state.loyalty_status(gold.customer_segments(c, as_of), as_of)


def offers_at(spark, d, as_of, slots=None) -> DataFrame:
    r = Retail(spark, d, as_of)
    i = gold.category_interest(silver.clickstream_enriched(r.clickstream, r.products), as_of)
    return state.personalized_offers(i, r.products, as_of, slots=slots)


def offers_book(spark, d) -> DataFrame:
    """Offer table after two weekly runs (last week's, then today's); the
    catalog numbering is computed once and shared by both runs."""
    slots = state.product_slots(Retail(spark, d).products)
    return ups.insert_if_absent(offers_at(spark, d, PREV_WEEK, slots), offers_at(spark, d, AS_OF, slots),
                                ["offer_id"])


def sessions(spark, d) -> DataFrame:
    return state.active_sessions(enriched_clicks(Retail(spark, d)))


@query("loyalty_status")
def q_loyalty_status(spark, d):
    return loyalty_at(spark, d, AS_OF)


@query("personalized_offers")
def q_personalized_offers(spark, d):
    return offers_at(spark, d, AS_OF)


@query("active_sessions")
def q_active_sessions(spark, d):
    return sessions(spark, d)


@query("upsert_loyalty")
def q_upsert_loyalty(spark, d):
    return ups.keyed_upsert(loyalty_at(spark, d, PREV_WEEK), loyalty_at(spark, d, AS_OF),
                            ["customer_id"], state.LOYALTY_UPDATE_COLUMNS)


@query("insert_if_absent")
def q_insert_if_absent(spark, d):
    return offers_book(spark, d)


def _recent(spark, d, as_of):
    r = Retail(spark, d, as_of)
    return analyst.recent_interest(silver.clickstream_enriched(r.clickstream, r.products), as_of)


@query("snapshot_diff")
def q_snapshot_diff(spark, d):
    return ups.snapshot_diff(_recent(spark, d, PREV_DAY), _recent(spark, d, AS_OF),
                             ["customer_id", "category"])


@query("state_constraints")
def q_state_constraints(spark, d):
    r = Retail(spark, d)
    found = ups.state_violations(r.purchases, "purchases", ["transaction_id"],
                                 ["customer_id", "product_id", "purchase_date"])
    tables = {"loyalty_status": loyalty_at(spark, d, AS_OF), "personalized_offers": offers_book(spark, d),
              "active_sessions": sessions(spark, d)}
    for name, rows in tables.items():
        found = found.unionByName(schemas.audit(schemas.with_defaults(rows, name), name))
    return found


@query("top3_interests")
def q_top3_interests(spark, d):
    return interest(Retail(spark, d)).filter(F.col("interest_rank") <= 3)


@query("customer_context")
def q_customer_context(spark, d):
    from tillroll.plans.search import customer_context
    r = Retail(spark, d)
    return customer_context(c360(r), interest(r))


@query("profile_lookup")
def q_profile_lookup(spark, d):
    keys = Retail(spark, d).clickstream.select("customer_id")
    return serving.profile_lookup(loyalty_at(spark, d, AS_OF), keys)


@query("active_offers_topk")
def q_active_offers_topk(spark, d):
    return serving.active_offers_topk(offers_book(spark, d), k=10)


@query("recent_sessions_topk")
def q_recent_sessions_topk(spark, d):
    return serving.recent_sessions_topk(sessions(spark, d), k=5)


@query("customer_search")
def q_customer_search(spark, d):
    return serving.customer_search(loyalty_at(spark, d, AS_OF), SEARCH_QUERY, 20)


@query("top_customers")
def q_top_customers(spark, d):
    return serving.customer_search(loyalty_at(spark, d, AS_OF), "", 20)


@query("dashboard_stats")
def q_dashboard_stats(spark, d):
    return serving.dashboard_stats(loyalty_at(spark, d, AS_OF), offers_book(spark, d))


# ---- search, conversations, assistant --------------------------------------

from tillroll.config import ASSISTANT_RESULTS, SEARCH_RESULTS  # noqa: E402
from tillroll.operators import vector_index  # noqa: E402
from tillroll.plans import assistant, search  # noqa: E402


def searchable(spark, d) -> DataFrame:
    return search.products_searchable(Retail(spark, d).products)


def chat_queries(spark, d) -> DataFrame:
    m = assistant.last_user_message(Retail(spark, d).conversations)
    return m.select(F.col("conv_id").alias("query_id"), F.col("user_message").alias("text"))


def _older_products(spark, d) -> DataFrame:
    """The catalog before a price round: other prices on every seventh product,
    every eleventh not yet listed, and some that are listed no more."""
    p = Retail(spark, d).products
    key = F.col("product_id")
    price = F.when(key % 7 == 0, F.col("price") + 1).otherwise(F.col("price"))
    gone = p.where(key % 13 == 0).withColumn("product_id", -1 - key)
    return p.where(key % 11 != 0).withColumn("price", price).unionByName(gone)


def _synced(spark, d) -> tuple[str, str]:
    """(searchable table, change feed) written on top of an older version."""
    base = work_dir(spark, "searchable")
    first, _ = search.searchable_version(None, _older_products(spark, d))
    first.write.parquet(f"{base}/table/v=1")
    table, feed = search.searchable_version(spark.read.parquet(f"{base}/table/v=1"), Retail(spark, d).products)
    feed.write.parquet(f"{base}/feed/v=2")
    table.write.parquet(f"{base}/table/v=2")
    return f"{base}/table/v=2", f"{base}/feed/v=2"


@query("products_searchable")
def q_products_searchable(spark, d):
    """The searchable table as read back after a sync."""
    return spark.read.parquet(_synced(spark, d)[0])


@query("product_index_sync")
def q_product_index_sync(spark, d):
    """The change feed of that sync, keyed on product_id."""
    return spark.read.parquet(_synced(spark, d)[1])


@query("vector_topk")
def q_vector_topk(spark, d):
    v = Retail(spark, d).vectors
    return search.similar_vectors(v.where("vec_id % 50 = 0"), v, k=SEARCH_RESULTS)


@query("vector_topk_filtered")
def q_vector_topk_filtered(spark, d):
    v = Retail(spark, d).vectors
    return search.similar_vectors(v.where("vec_id % 50 = 0"), v, k=SEARCH_RESULTS, same=["label"])


@query("vector_index_topk")
def q_vector_index_topk(spark, d):
    """The same search from an index: approximate, so it has no SQL form."""
    v = Retail(spark, d).vectors
    return search.similar_vectors(v.where("vec_id % 50 = 0"), v, k=SEARCH_RESULTS, index=vector_index.build(v))


@query("text_topk")
def q_text_topk(spark, d):
    hits = search.product_text_search(chat_queries(spark, d), searchable(spark, d), SEARCH_RESULTS)
    return hits.select("query_id", "rank", "product_id", "score")


@query("last_user_message")
def q_last_user_message(spark, d):
    return assistant.last_user_message(Retail(spark, d).conversations)


@query("product_context")
def q_product_context(spark, d):
    q = chat_queries(spark, d)
    hits = search.product_text_search(q, searchable(spark, d), ASSISTANT_RESULTS)
    return assistant.product_context(hits, q)


@query("assistant_prompts")
def q_assistant_prompts(spark, d):
    return assistant.assistant_prompts(Retail(spark, d).conversations, searchable(spark, d))


# ---- scalar helpers over whole tables ---------------------------------------

from tillroll.functions.text import parse_json_array  # noqa: E402


@query("preferred_category_counts")
def q_preferred_category_counts(spark, d):
    c = Retail(spark, d).customers
    return (c.select(F.explode(parse_json_array("preferred_categories")).alias("category"))
            .groupBy("category").agg(F.count(F.lit(1)).alias("customers")))


@query("page_urls")
def q_page_urls(spark, d):
    return Retail(spark, d).clickstream.select("event_id", "event_type", "page_url", "search_term")


@query("mask_cards")
def q_mask_cards(spark, d):
    return Retail(spark, d).customers.select("customer_id", "credit_card_last4", "credit_card_masked")


# ---- CSV landing zone and streams -------------------------------------------

from tillroll.sources import csv as csvio  # noqa: E402
from tillroll.sources.schemas import SOURCES  # noqa: E402
from tillroll.streaming import jobs, stateful  # noqa: E402


def _bronze(name):
    def run(spark, d):
        base = work_dir(spark, f"bronze-{name}")
        src = getattr(Retail(spark, d), name)
        csvio.write_csv(src, f"{base}/landing")
        return jobs.bronze(spark, f"{base}/landing", SOURCES[name], f"{base}/table", f"{base}/_ckpt")
    return run


for _src in SOURCES:
    QUERIES[f"bronze_{_src}"] = _bronze(_src)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    """Customers (JSON arrays with quotes, zero-padded codes) → CSV → back."""
    base = work_dir(spark, "csv-roundtrip")
    csvio.write_csv(Retail(spark, d).customers, base)
    return csvio.read_csv(spark, base, SOURCES["customers"])


def _land_clicks_in_two_arrivals(spark, d, landing, newest_first=False):
    """Older events and the last week's as two sets of files; the second set
    must be picked up alone."""
    c = Retail(spark, d).clickstream
    cut = F.lit(PREV_WEEK.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    parts = [c.filter(F.col("event_timestamp") < cut), c.filter(F.col("event_timestamp") >= cut)]
    for part in reversed(parts) if newest_first else parts:
        yield lambda part=part: csvio.write_csv(part, landing, mode="append")


def _merged_stream(spark, d, name, job):
    """Run a merging job on two arrivals, the newer events first, and once more
    without new files; returns (state root, current version)."""
    base = work_dir(spark, name)
    products = Retail(spark, d).products
    args = (spark, f"{base}/landing", products, f"{base}/state", f"{base}/_ckpt")
    for land in _land_clicks_in_two_arrivals(spark, d, f"{base}/landing", newest_first=True):
        land()
        version = job(*args)
    if job(*args) != version:
        raise RuntimeError(f"{name}: a run without new files changed the version")
    return f"{base}/state", version


@query("stream_ingest")
def q_stream_ingest(spark, d):
    base = work_dir(spark, "stream-ingest")
    for land in _land_clicks_in_two_arrivals(spark, d, f"{base}/landing"):
        land()
        jobs.bronze(spark, f"{base}/landing", SOURCES["clickstream"], f"{base}/table", f"{base}/_ckpt")
    # a re-run with nothing new must add nothing
    return jobs.bronze(spark, f"{base}/landing", SOURCES["clickstream"], f"{base}/table", f"{base}/_ckpt")


@query("stream_enrich")
def q_stream_enrich(spark, d):
    base = work_dir(spark, "stream-enrich")
    products = Retail(spark, d).products
    out = None
    for land in _land_clicks_in_two_arrivals(spark, d, f"{base}/landing"):
        land()
        out = jobs.enrich(spark, f"{base}/landing", products, f"{base}/table", f"{base}/_ckpt")
    return out.select(*enriched_clicks(Retail(spark, d)).columns)


@query("stream_recent_interest")
def q_stream_recent_interest(spark, d):
    return jobs.interest_at(spark, *_merged_stream(spark, d, "stream-interest", jobs.recent_interest), AS_OF)


@query("stream_active_sessions")
def q_stream_active_sessions(spark, d):
    return jobs.session_state(spark, *_merged_stream(spark, d, "stream-sessions", jobs.active_sessions))


@query("stream_category_interest")
def q_stream_category_interest(spark, d):
    root, version = _merged_stream(spark, d, "stream-cat-interest", jobs.category_interest)
    return jobs.interest_from_days(jobs.day_state(spark, root).read(version), AS_OF)


def _live_stream(spark, d, name, job, table, **kw):
    """Two arrivals in the order of their events, and a run without new files."""
    base = work_dir(spark, name)
    args = (spark, f"{base}/landing", Retail(spark, d).products, f"{base}/table", f"{base}/_ckpt")
    for land in _land_clicks_in_two_arrivals(spark, d, f"{base}/landing"):
        land()
        if sum(b.late for b in job(*args, **kw)):
            raise RuntimeError(f"{name}: rows of an ordered arrival were late")
    job(*args, **kw)
    out = table(spark, f"{base}/table")
    return out.read().drop(out.by)


@query("stream_interest_windows")
def q_stream_interest_windows(spark, d):
    """All sliding windows, from Spark's own state behind a watermark."""
    return _live_stream(spark, d, "stream-windows", stateful.interest_windows, stateful.window_table)


@query("stream_live_sessions")
def q_stream_live_sessions(spark, d):
    """Sessions with a state and a timer each; the given ones last for weeks, so
    the idle time is longer than the whole table."""
    s = _live_stream(spark, d, "stream-live", stateful.live_sessions, stateful.session_table, idle=timedelta(days=400))
    return s.drop("opened")


# ---- whole chain and generator ----------------------------------------------

from tillroll.plans import generate, medallion, refresh  # noqa: E402


def _two_runs(spark, d) -> dict[str, str]:
    """The whole chain run twice, a week apart: the second run finds the later
    events and purchases landed and writes its state on the first run's.
    Returns the paths of the second run's tables."""
    base = work_dir(spark, "medallion")
    now, then = Retail(spark, d), Retail(spark, d, PREV_WEEK)
    after = F.lit(PREV_WEEK.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    first = {"products": now.products, "customers": now.customers, "purchases": then.purchases, "clickstream": then.clickstream}
    later = {"purchases": now.purchases_after(PREV_WEEK),
             "clickstream": now.clickstream.where(F.col("event_timestamp") > after)}
    prefix = "r" + base.rsplit("-", 1)[-1][:8] + "_"
    for frames, as_of in ((first, PREV_WEEK), (later, AS_OF)):
        for name, df in frames.items():
            csvio.write_csv(df, landing[name], mode="append", compression="gzip")
        paths = medallion.run_medallion(spark, landing, f"{base}/lake", as_of, register_prefix=prefix)
    names = {k: medallion.table_name(k, prefix) for k in paths}
    for dataset in ("customer_segments", "loyalty_status"):        # the names lead to the second run's versions
        if spark.table(names[dataset]).inputFiles()[0].count("run=2") != 1:
            raise RuntimeError(f"{names[dataset]} was not switched")
    medallion.drop_tables(spark, names)
    return paths


for _key, _dataset in (("medallion_run", "customer_segments"), ("medallion_loyalty", "loyalty_status"),
                       ("medallion_offers", "personalized_offers"), ("medallion_sessions", "active_sessions")):
    QUERIES[_key] = (lambda name: lambda spark, d: spark.read.parquet(_two_runs(spark, d)[name]))(_dataset)


def _first_and_changed(spark, d) -> tuple[dict, dict, dict]:
    """Deliveries of two runs: everything up to a week ago, then the later rows,
    and after them changed rows of known keys: customers, products, events and
    purchases that arrive a second time."""
    now, then = Retail(spark, d), Retail(spark, d, PREV_WEEK)
    after = F.lit(PREV_WEEK.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    first = {"products": now.products, "customers": now.customers, "purchases": then.purchases, "clickstream": then.clickstream}
    later = {"purchases": now.purchases_after(PREV_WEEK),
             "clickstream": now.clickstream.where(F.col("event_timestamp") > after)}
    changed = {
        "customers": now.customers.where("customer_id % 7 = 3").withColumns(
            {"loyalty_tier": F.lit("Platinum"), "loyalty_points": F.col("loyalty_points") + 500, "city": F.lit("MOVED")}),
        "products": now.products.where("product_id % 5 = 2").withColumns(
            {"product_name": F.concat("product_name", F.lit(" II")), "price": F.col("price") + 10}),
        "purchases": now.purchases_of(lambda customer: customer % 13 == 5).withColumn("total_amount", F.col("total_amount") + 1),
        "clickstream": now.clickstream.where("event_id % 11 = 4").withColumns(
            {"event_type": F.lit("add_to_wishlist"), "duration_seconds": F.lit(1)})}
    return first, later, changed


def _changed_chain(spark, d, run):
    """Both deliveries through a chain; the result of the second run."""
    base = work_dir(spark, "changes")
    landing = {name: f"{base}/raw/{name}" for name in SOURCES}
    first, later, changed = _first_and_changed(spark, d)
    for deliveries in ((first,), (later, changed)):
        for frames in deliveries:
            for name, df in frames.items():
                csvio.write_csv(df, landing[name], mode="append", compression="gzip")
        result = run(spark, landing, f"{base}/lake", AS_OF)
    return result


for _key, _dataset in (("medallion_changes", "customer_segments"), ("medallion_changed_clicks", "clickstream_enriched")):
    QUERIES[_key] = (lambda name: lambda spark, d: spark.read.parquet(_changed_chain(spark, d, medallion.run_medallion)[name]))(_dataset)


def _refreshed(spark, d, name: str):
    paths = _changed_chain(spark, d, refresh.refresh).paths
    return spark.read.parquet(paths[name]).drop("bucket")


for _key, _dataset in (("refresh_segments", "customer_segments"), ("refresh_interest", "category_interest"),
                       ("refresh_clicks", "clickstream_enriched"), ("refresh_sessions", "active_sessions")):
    QUERIES[_key] = (lambda name: lambda spark, d: _refreshed(spark, d, name))(_dataset)


def _gen_products(spark, d):
    return generate.generate_products(Retail(spark, d).t.part.select(F.col("p_partkey").alias("id")))


def _gen_customers(spark, d):
    return generate.generate_customers(Retail(spark, d).t.customer.select(F.col("c_custkey").alias("id")))


@query("gen_products")
def q_gen_products(spark, d):
    return _gen_products(spark, d)


@query("gen_customers")
def q_gen_customers(spark, d):
    return _gen_customers(spark, d)


@query("gen_purchases")
def q_gen_purchases(spark, d):
    ids = Retail(spark, d).t.orders.select(F.col("o_orderkey").alias("id"))
    return generate.generate_purchases(ids, _gen_customers(spark, d), _gen_products(spark, d))


@query("gen_clickstream")
def q_gen_clickstream(spark, d):
    ids = Retail(spark, d).t.events.select(F.col("event_id").alias("id"))
    return generate.generate_clickstream(ids, _gen_customers(spark, d), _gen_products(spark, d))


@query("index_sync")
def q_index_sync(spark, d):
    """Yesterday's table + the change feed to today = today's table."""
    old, new = _recent(spark, d, PREV_DAY), _recent(spark, d, AS_OF)
    keys = ["customer_id", "category"]
    return ups.apply_changes(old, ups.snapshot_diff(old, new, keys), keys)

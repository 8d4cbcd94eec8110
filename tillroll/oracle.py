"""DuckDB reference SQL for every registered query (the correctness oracle).

The views below re-state the test-table mapping of FIXTURES.md in SQL; each
query is ``WITH <views> <query>``.  Spark-vs-DuckDB traps handled here:
double→int casts use ``trunc`` first, NULL ordering is spelled out, money
sums go through DECIMAL, and double literals are cast explicitly.
"""

from __future__ import annotations


from tillroll.config import (
    AS_OF, CHURN_CAP, CHURN_STEPS, CHURN_TERMS, DEFAULT_CHURN_LEVEL, DEFAULT_EVENT_WEIGHT, DEFAULT_RECENCY,
    DEFAULT_SEGMENT, DEVICE_TYPES, EVENT_WEIGHTS, ORDER_DATE_SHIFT_DAYS, PAYMENT_METHODS, RECENCY_STEPS,
    RECENT_INTEREST_WEIGHTS, REFERRERS, SEARCH_TERMS, SEGMENT_RULES, STORE_TYPES, TEST_CATEGORIES,
)

ASOF_TS = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
ASOF_D = f"DATE '{AS_OF:%Y-%m-%d}'"


def _lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick(values, idx) -> str:
    return f"{_lst(values)}[({idx}) % {len(values)} + 1]"


def case_of(column: str, values: dict, default) -> str:
    """CASE over a dict of values."""
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


def _segment_sql(d: str) -> str:
    """The segment rules as one CASE."""
    days = {"days_since_signup": f"date_diff('day', signup_date, {d})"}

    def test(name, bounds):
        if name == "tiers":
            return f"list_contains({_lst(bounds)}, loyalty_tier)"
        value, (low, high) = days.get(name, name), bounds
        return " AND ".join(([f"{value} > {low}"] if low is not None else []) + ([f"{value} <= {high}"] if high is not None else []))

    rules = [f"WHEN {' OR '.join('(' + ' AND '.join(test(n, b) for n, b in alt.items()) + ')' for alt in alts)} THEN '{name}'"
             for name, alts in SEGMENT_RULES]
    return f"CASE {' '.join(rules)} ELSE '{DEFAULT_SEGMENT}' END"


def _churn_sql() -> str:
    terms = [f"CAST(COALESCE({c}, {d}) AS DOUBLE) * CAST({w} AS DOUBLE)" for c, d, w in CHURN_TERMS]
    return f"LEAST(CAST({CHURN_CAP} AS DOUBLE), {' + '.join(terms)})"


def _level_sql() -> str:
    return ("CASE " + " ".join(f"WHEN churn_risk_score >= {x} THEN '{n}'" for x, n in CHURN_STEPS)
            + f" ELSE '{DEFAULT_CHURN_LEVEL}' END")


def recency_sql(ts: str, now: str) -> str:
    age = f"date_diff('day', CAST({ts} AS DATE), CAST({now} AS DATE))"
    return ("CAST(CASE " + " ".join(f"WHEN {age} <= {d} THEN {f}" for d, f in RECENCY_STEPS)
            + f" ELSE {DEFAULT_RECENCY} END AS DOUBLE)")


EVENT_WEIGHT_SQL = case_of("event_type", EVENT_WEIGHTS, DEFAULT_EVENT_WEIGHT)
RECENT_WEIGHT_SQL = case_of("event_type", RECENT_INTEREST_WEIGHTS, 0)


def views(as_of=AS_OF, s: str = "") -> str:
    """The retail views as CTEs, seen at ``as_of`` (purchases and events after
    it are invisible); ``s`` suffixes every view name for a second snapshot."""
    ts = f"TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}'"
    d = f"DATE '{as_of:%Y-%m-%d}'"
    return f"""
products{s} AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         split_part(p_name, ' ', 2) AS subcategory, p_brand AS brand,
         split_part(p_name, ' ', 1) AS color, CAST(p_size AS VARCHAR) AS size,
         split_part(p_name, ' ', 1) AS material, p_retailprice AS price,
         CAST(p_partkey % 21 + 30 AS DOUBLE) / CAST(10 AS DOUBLE) AS rating,
         CAST((p_partkey * 7) % 496 + 5 AS INTEGER) AS review_count,
         '["' || lower(p_type) || '","' || lower(split_part(p_name, ' ', 2)) || '"]' AS tags,
         p_name || ' by ' || p_brand AS description,
         p_partkey % 4 <> 0 AS in_stock
  FROM part),
customers{s} AS (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@example.com' AS email,
         '+1-555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
         n_name AS city, upper(substring(n_name, 1, 2)) AS state,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
         CAST(DATE '1990-01-01' - CAST((c_custkey * 53) % 18000 AS INTEGER) AS DATE) AS date_of_birth,
         CAST(DATE '2024-01-31' - CAST((c_custkey * 37) % 1066 + 30 AS INTEGER) AS DATE) AS signup_date,
         CASE WHEN c_acctbal >= 8500 THEN 'Platinum' WHEN c_acctbal >= 6000 THEN 'Gold'
              WHEN c_acctbal >= 3000 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier,
         CAST((c_custkey * 1571) % 24901 + 100 AS INTEGER) AS loyalty_points,
         c_acctbal AS lifetime_value,
         '["' || {_pick(TEST_CATEGORIES, 'c_custkey')} || '"]' AS preferred_categories,
         lpad(CAST((c_custkey * 7919) % 10000 AS VARCHAR), 4, '0') AS credit_card_last4,
         '****-****-****-' || lpad(CAST((c_custkey * 7919) % 10000 AS VARCHAR), 4, '0') AS credit_card_masked
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
purchases{s} AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         o_custkey AS customer_id, l_partkey AS product_id, p_type AS category, p_brand AS brand,
         CAST(trunc(l_quantity) AS INTEGER) AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_amount,
         o_orderdate + INTERVAL {ORDER_DATE_SHIFT_DAYS} DAY AS purchase_date,
         {_pick(PAYMENT_METHODS, 'l_orderkey')} AS payment_method,
         {_pick(STORE_TYPES, 'l_linenumber')} AS store_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate + INTERVAL {ORDER_DATE_SHIFT_DAYS} DAY <= {ts}),
click_raw{s} AS (
  SELECT e.event_id, e.ts, e.user_id,
         CASE e.event_type
           WHEN 'view' THEN CASE WHEN e.event_id % 2 = 0 THEN 'page_view' ELSE 'product_view' END
           WHEN 'click' THEN CASE WHEN e.event_id % 2 = 0 THEN 'search' ELSE 'add_to_cart' END
           WHEN 'purchase' THEN 'checkout_start'
           WHEN 'signup' THEN 'add_to_wishlist'
           WHEN 'error' THEN CASE WHEN e.event_id % 2 = 0 THEN 'remove_from_cart' ELSE 'error' END
           ELSE e.event_type END AS event_type,
         e.pk, p.p_type, p.p_brand
  FROM (SELECT ev.*, k.lo + ev.event_id % k.span AS pk
        FROM events ev, (SELECT MIN(p_partkey) AS lo, MAX(p_partkey) - MIN(p_partkey) + 1 AS span FROM part) k) e
       LEFT JOIN part p ON e.pk = p.p_partkey
  WHERE e.ts <= {ts}),
clickstream{s} AS (
  SELECT event_id,
         'SES-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         user_id AS customer_id, event_type, ts AS event_timestamp,
         CASE WHEN event_type = 'search' THEN NULL ELSE pk END AS product_id,
         p_type AS category, p_brand AS brand,
         CASE WHEN event_type = 'search'
              THEN '/search?q=' || replace({_pick(SEARCH_TERMS, 'event_id')}, ' ', '+')
              ELSE '/products/' || lower(p_type) || '/' || CAST(pk AS VARCHAR) END AS page_url,
         CASE WHEN event_type = 'search' THEN {_pick(SEARCH_TERMS, 'event_id')} END AS search_term,
         {_pick(DEVICE_TYPES, 'user_id')} AS device_type,
         {_pick(REFERRERS, 'event_id')} AS referrer,
         CASE WHEN event_type IN ('page_view', 'product_view') THEN CAST(event_id % 298 + 3 AS INTEGER)
              ELSE 0 END AS duration_seconds
  FROM click_raw{s}),
sales_orders{s} AS (
  SELECT p_type AS category, r_name AS region,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Cancelled' END AS status,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS revenue,
         l_quantity AS quantity, o_orderdate AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey),
clickstream_enriched{s} AS (
  SELECT c.*, p.product_name, p.subcategory, p.price, p.material,
         {EVENT_WEIGHT_SQL} AS event_weight,
         CAST(c.event_timestamp AS DATE) AS event_date,
         CAST(hour(c.event_timestamp) AS INTEGER) AS event_hour
  FROM clickstream{s} c LEFT JOIN products{s} p ON c.product_id = p.product_id),
purchase_enriched{s} AS (
  SELECT pu.*, p.product_name, p.subcategory, p.material, strftime(pu.purchase_date, '%Y-%m') AS purchase_month
  FROM purchases{s} pu LEFT JOIN products{s} p ON pu.product_id = p.product_id),
purchase_agg{s} AS (
  SELECT customer_id, COUNT(*) AS total_orders,
         CAST(SUM(CAST(total_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_spend,
         CAST(SUM(CAST(total_amount AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) AS avg_order_value,
         MAX(purchase_date) AS last_purchase_date, MIN(purchase_date) AS first_purchase_date,
         COUNT(DISTINCT category) AS distinct_categories_purchased
  FROM purchases{s} GROUP BY customer_id),
click_agg{s} AS (
  SELECT customer_id, COUNT(*) AS total_events, MAX(event_timestamp) AS last_activity,
         COUNT(DISTINCT session_id) AS total_sessions,
         CAST(SUM(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS total_cart_adds,
         CAST(SUM(CASE WHEN event_type = 'search' THEN 1 ELSE 0 END) AS BIGINT) AS total_searches
  FROM clickstream{s} GROUP BY customer_id),
customer_360{s} AS (
  SELECT c.*, pa.total_orders, pa.total_spend, pa.avg_order_value, pa.last_purchase_date,
         pa.first_purchase_date, pa.distinct_categories_purchased,
         ca.total_events, ca.last_activity, ca.total_sessions, ca.total_cart_adds, ca.total_searches,
         CAST(date_diff('day', CAST(pa.last_purchase_date AS DATE), {d}) AS INTEGER) AS days_since_last_purchase,
         CAST(date_diff('day', CAST(ca.last_activity AS DATE), {d}) AS INTEGER) AS days_since_last_activity
  FROM customers{s} c LEFT JOIN purchase_agg{s} pa USING (customer_id) LEFT JOIN click_agg{s} ca USING (customer_id)),
customer_segments_all{s} AS (
  SELECT *,
         {_segment_sql(d)} AS segment, {_churn_sql()} AS churn_risk_score
  FROM customer_360{s}),
customer_segments{s} AS (
  SELECT customer_id, first_name, last_name, email, loyalty_tier, loyalty_points, lifetime_value,
         total_orders, total_spend, avg_order_value, last_purchase_date, days_since_last_purchase,
         total_events, last_activity, days_since_last_activity, segment, churn_risk_score,
         {_level_sql()} AS churn_risk_level,
         preferred_categories
  FROM customer_segments_all{s}),
category_interest{s} AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY interest_score DESC, category ASC NULLS FIRST) AS INTEGER)
           AS interest_rank
  FROM (
    SELECT customer_id, category,
           SUM(CAST(event_weight AS DOUBLE) * {recency_sql('event_timestamp', ts)}) AS interest_score,
           COUNT(*) AS event_count, MAX(event_timestamp) AS last_interaction,
           COUNT(DISTINCT product_id) AS unique_products_viewed
    FROM clickstream_enriched{s} GROUP BY customer_id, category) x)
"""


VIEWS = views()

# Query bodies (appended after ``WITH <views>``).
BODIES: dict[str, str] = {}


def sql(name: str) -> str:
    body = BODIES[name]
    if callable(body):
        body = body()
    return "WITH " + VIEWS.strip() + "\n" + body


def all_sql() -> dict[str, str]:
    return {k: sql(k) for k in BODIES}


def register(name: str, body: str) -> None:
    BODIES[name] = body

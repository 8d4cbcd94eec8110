"""DuckDB bodies of the registered queries (see ``tillroll.oracle``)."""

from tillroll.config import FOCUS_CATEGORY
from tillroll.oracle import (
    ASOF_TS, BODIES, EVENT_WEIGHT_SQL, RECENT_WEIGHT_SQL, recency_sql, register,
)

_REV = "CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_revenue"

register("revenue_by_category", f"""
SELECT category, {_REV}, COUNT(*) AS order_count FROM sales_orders
GROUP BY category ORDER BY total_revenue DESC, category""")
register("revenue_by_region", f"""
SELECT region, {_REV}, COUNT(*) AS order_count FROM sales_orders
GROUP BY region ORDER BY total_revenue DESC, region""")
register("monthly_trend", f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {_REV}, COUNT(*) AS order_count
FROM sales_orders WHERE status = 'Completed' GROUP BY 1 ORDER BY month""")
register("order_status_summary", f"""
SELECT status, COUNT(*) AS order_count, {_REV} FROM sales_orders
GROUP BY status ORDER BY order_count DESC, status""")
register("kpi_totals", f"""
SELECT COUNT(*) AS total_orders, {_REV},
       CAST(ROUND(SUM(revenue) / COUNT(revenue), 2) AS DOUBLE) AS avg_order_value,
       SUM(quantity) AS total_units
FROM sales_orders WHERE status = 'Completed'""")
register("dashboard_widgets", f"""
, kpi AS (SELECT COUNT(*) AS total_orders, {_REV},
                 CAST(ROUND(SUM(revenue) / COUNT(revenue), 2) AS DOUBLE) AS avg_order_value
          FROM sales_orders WHERE status = 'Completed'),
  cat AS (SELECT category, {_REV} FROM sales_orders GROUP BY category),
  reg AS (SELECT region, {_REV} FROM sales_orders GROUP BY region),
  mon AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {_REV}
          FROM sales_orders WHERE status = 'Completed' GROUP BY 1),
  sts AS (SELECT status, COUNT(*) AS order_count, {_REV} FROM sales_orders GROUP BY status)
SELECT 'total_revenue_counter' AS widget, CAST(NULL AS VARCHAR) AS label, 'total_revenue' AS measure, total_revenue AS value FROM kpi
UNION ALL SELECT 'total_orders_counter', NULL, 'total_orders', CAST(total_orders AS DOUBLE) FROM kpi
UNION ALL SELECT 'avg_order_value_counter', NULL, 'avg_order_value', avg_order_value FROM kpi
UNION ALL SELECT 'revenue_by_category_bar', category, 'total_revenue', total_revenue FROM cat
UNION ALL SELECT 'revenue_by_region_pie', region, 'total_revenue', total_revenue FROM reg
UNION ALL SELECT 'monthly_trend_line', CAST(month AS VARCHAR), 'total_revenue', total_revenue FROM mon
UNION ALL SELECT 'order_status_table', status, 'order_count', CAST(order_count AS DOUBLE) FROM sts
UNION ALL SELECT 'order_status_table', status, 'total_revenue', total_revenue FROM sts""")

register("clickstream_enriched", "SELECT * FROM clickstream_enriched")
register("purchase_enriched", "SELECT * FROM purchase_enriched")
register("purchase_agg", "SELECT * FROM purchase_agg")
register("click_agg", "SELECT * FROM click_agg")
register("customer_360", "SELECT * FROM customer_360")
register("category_interest", "SELECT * FROM category_interest")
register("customer_segments", "SELECT * FROM customer_segments")
register("segment_counts", """
SELECT segment, COUNT(*) AS customers FROM customer_segments GROUP BY segment
ORDER BY customers DESC, segment""")
register("churn_scores", "SELECT customer_id, churn_risk_score, churn_risk_level FROM customer_segments")
register("event_weights", f"""
SELECT event_type, COUNT(*) AS events, {EVENT_WEIGHT_SQL} AS event_weight
FROM clickstream GROUP BY event_type ORDER BY event_type""")
register("recency_weights", f"""
SELECT event_id, event_timestamp, {recency_sql('event_timestamp', ASOF_TS)} AS recency_weight
FROM clickstream""")
register("time_features", """
SELECT event_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
       CAST(hour(event_timestamp) AS INTEGER) AS event_hour
FROM clickstream""")

def recent_scores(events: str, until: str, more: str = "") -> str:
    """Analyst interest of the 48 hours before ``until``."""
    return f"""
SELECT customer_id, category, CAST(SUM({RECENT_WEIGHT_SQL}) AS BIGINT) AS recent_interest_score, COUNT(*) AS events_48h
FROM {events} WHERE date_diff('microsecond', event_timestamp, {until}) <= 172800000000 {more}
GROUP BY ALL"""


register("recent_interest", recent_scores("clickstream_enriched", ASOF_TS))
register("trending_categories", f"""
, week AS (SELECT * FROM clickstream_enriched
           WHERE date_diff('microsecond', event_timestamp, {ASOF_TS}) <= 7 * 86400000000)
SELECT category, COUNT(*) AS total_events, COUNT(DISTINCT customer_id) AS unique_shoppers,
       COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds
FROM week GROUP BY category""")
register("high_churn_customers", """
SELECT customer_id, first_name, last_name, loyalty_tier, lifetime_value, segment,
       churn_risk_score, churn_risk_level, days_since_last_purchase
FROM customer_segments WHERE churn_risk_level NOT IN ('Medium', 'Low')""")
register("ltv_by_customer", """
SELECT customer_id, CAST(SUM(CAST(total_amount AS DECIMAL(18,4))) AS DOUBLE) AS ltv
FROM purchase_enriched GROUP BY customer_id""")
# rank - 1 = customers with a smaller value (NULL is the smallest)
_DECILE = """
, sized AS (SELECT COUNT(*) AS total FROM customer_360),
by_value AS (
  SELECT lifetime_value, SUM(n) OVER (ORDER BY lifetime_value ASC NULLS FIRST ROWS UNBOUNDED PRECEDING) - n AS smaller
  FROM (SELECT lifetime_value, COUNT(*) AS n FROM customer_360 GROUP BY lifetime_value)),
decile AS (
  SELECT c.customer_id, c.lifetime_value,
         CASE WHEN total <= 1 THEN CAST(0 AS DOUBLE) ELSE CAST(smaller AS DOUBLE) / CAST(total - 1 AS DOUBLE) END AS ltv_pctile
  FROM customer_360 c JOIN by_value v ON c.lifetime_value IS NOT DISTINCT FROM v.lifetime_value, sized)"""
register("top_decile_customers", _DECILE + "\nSELECT * FROM decile WHERE ltv_pctile >= 0.90")
register("top_lapsed_browsers", _DECILE + f"""
SELECT customer_id, first_name, last_name, loyalty_tier, lifetime_value, days_since_last_purchase, last_activity
FROM customer_360 c
WHERE days_since_last_purchase >= 30
  AND EXISTS (SELECT 1 FROM decile d WHERE d.customer_id = c.customer_id AND d.ltv_pctile >= 0.90)
  AND EXISTS (SELECT 1 FROM clickstream_enriched e
              WHERE e.customer_id = c.customer_id AND e.category = '{FOCUS_CATEGORY}'
                AND date_diff('microsecond', e.event_timestamp, {ASOF_TS}) <= 172800000000)""")

# ---- state tables -----------------------------------------------------------

from tillroll.config import (  # noqa: E402
    AS_OF, DEFAULT_TIER_THRESHOLD, OFFER_TYPES, PREV_DAY, PREV_WEEK, SEARCH_QUERY, TIER_THRESHOLDS,
)
from tillroll.oracle import _lst, case_of, views  # noqa: E402


def _ts(t):
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def loyalty_cte(s="", as_of=AS_OF):
    return f"""
loyalty_status{s} AS (
  SELECT customer_id, first_name, last_name, tier AS loyalty_tier, points AS points_balance,
         COALESCE(lifetime_value, CAST(0 AS DOUBLE)) AS lifetime_value,
         CAST(COALESCE(total_orders, 0) AS INTEGER) AS total_orders,
         CAST(thr AS INTEGER) AS next_tier_threshold,
         CASE WHEN thr <= 0 THEN CAST(0 AS DOUBLE)
              ELSE LEAST(CAST(100 AS DOUBLE), CAST(floor((CAST(points AS BIGINT) * 2000 + thr) / (thr * 2)) AS DOUBLE) / 10.0) END
           AS tier_progress_pct,
         segment, churn_risk_level, CAST(last_purchase_date AS DATE) AS last_purchase_date,
         preferred_categories, {_ts(as_of)} AS updated_at
  FROM (SELECT *, {case_of('tier', TIER_THRESHOLDS, DEFAULT_TIER_THRESHOLD)} AS thr
        FROM (SELECT *, COALESCE(NULLIF(loyalty_tier, ''), 'Bronze') AS tier,
                     CAST(COALESCE(loyalty_points, 0) AS INTEGER) AS points
              FROM customer_segments{s})))"""


def offers_cte(s="", as_of=AS_OF):
    return f"""
offer_top{s} AS (
  SELECT customer_id, COALESCE(category, 'General') AS category,
         COALESCE(interest_score, CAST(0 AS DOUBLE)) AS relevance_score,
         COALESCE(interest_rank, 1) AS interest_rank,
         LEAST(30, GREATEST(5, CAST(trunc(COALESCE(interest_score, 0) / 5.0) AS INTEGER))) AS disc
  FROM category_interest{s} WHERE interest_rank <= 3),
offer_cnt{s} AS (SELECT category, COUNT(*) AS n FROM products{s} GROUP BY category),
offer_slots{s} AS (
  SELECT product_id, product_name, category,
         row_number() OVER (PARTITION BY category ORDER BY product_id) - 1 AS slot
  FROM products{s}),
offers{s} AS (
  SELECT sha256(CAST(t.customer_id AS VARCHAR) || '|' || t.category || '|' || CAST(sl.product_id AS VARCHAR)) AS offer_id,
         t.customer_id,
         'OFFER-' || upper(substring(t.category, 1, 3)) || '-' || CAST(t.disc AS VARCHAR) || 'OFF' AS offer_code,
         sl.product_id, sl.product_name, t.category, t.relevance_score,
         {_lst(OFFER_TYPES)}[t.interest_rank % 4 + 1] AS offer_type,
         CAST(t.disc AS DOUBLE) AS discount_pct,
         {_ts(as_of)} + INTERVAL 7 DAY AS expires_at, 'active' AS status,
         {_ts(as_of)} AS created_at, {_ts(as_of)} AS updated_at
  FROM offer_top{s} t JOIN offer_cnt{s} c ON t.category = c.category
       JOIN offer_slots{s} sl ON sl.category = t.category
                             AND sl.slot = (t.customer_id * 31 + t.interest_rank) % c.n)"""


SESSIONS_CTE = """
sess_cat AS (
  SELECT session_id, category, SUM(event_weight) AS score
  FROM clickstream_enriched GROUP BY session_id, category),
sess_last AS (
  SELECT session_id, category AS current_category, device_type,
         row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp DESC, event_id DESC) AS rn
  FROM clickstream_enriched),
sessions AS (
  SELECT a.session_id, a.customer_id, l.current_category, s.top_interest_score,
         a.products_viewed, a.cart_items, l.device_type, a.started_at, a.last_activity
  FROM (SELECT session_id, MAX(customer_id) AS customer_id,
               CAST(COUNT(DISTINCT product_id) AS INTEGER) AS products_viewed,
               CAST(GREATEST(0, COUNT(*) FILTER (WHERE event_type = 'add_to_cart')
                               - COUNT(*) FILTER (WHERE event_type = 'remove_from_cart')) AS INTEGER) AS cart_items,
               MIN(event_timestamp) AS started_at, MAX(event_timestamp) AS last_activity
        FROM clickstream_enriched GROUP BY session_id) a
  JOIN (SELECT session_id, CAST(MAX(score) AS DOUBLE) AS top_interest_score FROM sess_cat GROUP BY session_id) s
    USING (session_id)
  JOIN sess_last l ON l.session_id = a.session_id AND l.rn = 1)"""

_LOY_COLS = ["loyalty_tier", "points_balance", "lifetime_value", "total_orders", "next_tier_threshold",
             "tier_progress_pct", "segment", "churn_risk_level", "last_purchase_date",
             "preferred_categories", "updated_at"]

register("loyalty_status", "," + loyalty_cte() + "\nSELECT * FROM loyalty_status")
register("personalized_offers", "," + offers_cte() + "\nSELECT * FROM offers")
register("active_sessions", "," + SESSIONS_CTE + "\nSELECT * FROM sessions")
register("upsert_loyalty", "," + views(PREV_WEEK, "_prev") + "," + loyalty_cte("_prev", PREV_WEEK) + ","
         + loyalty_cte() + """
SELECT COALESCE(u.customer_id, t.customer_id) AS customer_id,
       CASE WHEN t.customer_id IS NOT NULL THEN t.first_name ELSE u.first_name END AS first_name,
       CASE WHEN t.customer_id IS NOT NULL THEN t.last_name ELSE u.last_name END AS last_name,
""" + ",\n".join(f"       CASE WHEN u.customer_id IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}" for c in _LOY_COLS) + """
FROM loyalty_status_prev t FULL OUTER JOIN loyalty_status u ON t.customer_id = u.customer_id""")

_BOOK = "," + views(PREV_WEEK, "_prev") + "," + offers_cte("_prev", PREV_WEEK) + "," + offers_cte() + """,
offers_book AS (
  SELECT * FROM offers_prev
  UNION ALL
  SELECT * FROM offers o WHERE NOT EXISTS (SELECT 1 FROM offers_prev p WHERE p.offer_id = o.offer_id))"""
register("insert_if_absent", _BOOK + "\nSELECT * FROM offers_book")


def _ri(s, as_of):
    return f"ri{s} AS (" + recent_scores(f"clickstream_enriched{s}", _ts(as_of)) + ")"


register("snapshot_diff", "," + views(PREV_DAY, "_prev") + "," + _ri("_prev", PREV_DAY) + "," + _ri("", AS_OF) + """
SELECT * FROM (
  SELECT COALESCE(n.customer_id, o.customer_id) AS customer_id, COALESCE(n.category, o.category) AS category,
         CASE WHEN o.customer_id IS NULL THEN 'insert' WHEN n.customer_id IS NULL THEN 'delete'
              WHEN o.recent_interest_score IS DISTINCT FROM n.recent_interest_score
                OR o.events_48h IS DISTINCT FROM n.events_48h THEN 'update' END AS change,
         CASE WHEN n.customer_id IS NULL THEN o.recent_interest_score ELSE n.recent_interest_score END AS recent_interest_score,
         CASE WHEN n.customer_id IS NULL THEN o.events_48h ELSE n.events_48h END AS events_48h
  FROM ri_prev o FULL OUTER JOIN ri n
    ON o.customer_id = n.customer_id AND o.category IS NOT DISTINCT FROM n.category)
WHERE change IS NOT NULL""")


def _violations(table, src, keys, not_null):
    k = ", ".join(keys)
    parts = [f"""SELECT '{table}' AS table_name, 'primary key ({k}) unique' AS constraint_name,
       CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS violations
FROM (SELECT {k}, COUNT(*) AS c FROM {src} GROUP BY {k})""",
             f"""SELECT '{table}', 'primary key ({k}) not null',
       COUNT(*) FILTER (WHERE {' OR '.join(f'{x} IS NULL' for x in keys)}) FROM {src}"""]
    for c in not_null:
        parts.append(f"SELECT '{table}', '{c} not null', COUNT(*) FILTER (WHERE {c} IS NULL) FROM {src}")
    return "\nUNION ALL\n".join(parts)


register("state_constraints", "," + loyalty_cte() + _BOOK + "," + SESSIONS_CTE + "\n"
         + _violations("purchases", "purchases", ["transaction_id"], ["customer_id", "product_id", "purchase_date"])
         + "\nUNION ALL\n"
         + _violations("loyalty_status", "loyalty_status", ["customer_id"], ["loyalty_tier", "points_balance"])
         + "\nUNION ALL\n"
         + _violations("personalized_offers", "offers_book", ["offer_id"],
                       ["customer_id", "offer_code", "relevance_score", "offer_type", "status"])
         + "\nUNION ALL\n"
         + _violations("active_sessions", "sessions", ["session_id"], ["customer_id"]))
register("top3_interests", "SELECT * FROM category_interest WHERE interest_rank <= 3")
register("customer_context", """
SELECT c.customer_id, c.preferred_categories, c.loyalty_tier, ci.category, ci.interest_score
FROM customer_360 c LEFT JOIN category_interest ci
  ON c.customer_id = ci.customer_id AND ci.interest_rank <= 3""")
register("profile_lookup", "," + loyalty_cte() + """
SELECT * REPLACE (strftime(last_purchase_date, '%Y-%m-%d') AS last_purchase_date,
                  strftime(updated_at, '%Y-%m-%dT%H:%M:%S') AS updated_at)
FROM loyalty_status WHERE customer_id IN (SELECT customer_id FROM clickstream)""")
register("active_offers_topk", _BOOK + """
SELECT customer_id, offer_rank, offer_id, offer_code, product_id, product_name, category, relevance_score,
       offer_type, discount_pct, strftime(expires_at, '%Y-%m-%dT%H:%M:%S') AS expires_at, status
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY relevance_score DESC, offer_id) AS INTEGER)
                AS offer_rank FROM offers_book WHERE status = 'active')
WHERE offer_rank <= 10""")
register("recent_sessions_topk", "," + SESSIONS_CTE + """
SELECT customer_id, session_rank, session_id, current_category, top_interest_score, products_viewed,
       cart_items, device_type, strftime(last_activity, '%Y-%m-%dT%H:%M:%S') AS last_activity
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY last_activity DESC, session_id) AS INTEGER)
                AS session_rank FROM sessions)
WHERE session_rank <= 5""")
_SEARCH_COLS = ("customer_id, first_name, last_name, loyalty_tier, points_balance, lifetime_value, "
                "segment, churn_risk_level")
register("customer_search", "," + loyalty_cte() + f"""
SELECT {_SEARCH_COLS} FROM loyalty_status
WHERE CAST(customer_id AS VARCHAR) ILIKE '%{SEARCH_QUERY}%' OR first_name ILIKE '%{SEARCH_QUERY}%'
   OR last_name ILIKE '%{SEARCH_QUERY}%'
ORDER BY lifetime_value DESC NULLS FIRST, customer_id LIMIT 20""")
register("top_customers", "," + loyalty_cte() + f"""
SELECT {_SEARCH_COLS} FROM loyalty_status ORDER BY lifetime_value DESC NULLS FIRST, customer_id LIMIT 20""")
register("dashboard_stats", "," + loyalty_cte() + _BOOK + """
SELECT COUNT(*) AS total_customers,
       COUNT(*) FILTER (WHERE segment = 'High-Value Active') AS high_value_active,
       COUNT(*) FILTER (WHERE churn_risk_level = 'High') AS high_churn_risk,
       CAST(ROUND(SUM(CAST(lifetime_value AS DECIMAL(18,4))) / COUNT(lifetime_value), 2) AS DECIMAL(10,2)) AS avg_ltv,
       CAST(ROUND(AVG(points_balance)) AS INTEGER) AS avg_points,
       (SELECT COUNT(*) FROM offers_book WHERE status = 'active') AS active_offers
FROM loyalty_status""")

# ---- search, conversations, assistant ----------------------------------------

from tillroll.config import ASSISTANT_PROMPT, ASSISTANT_RESULTS, NO_PRODUCTS_TEXT, SEARCH_RESULTS  # noqa: E402

SEARCHABLE_CTE = """
searchable AS (
  SELECT product_id, product_name, category, subcategory, brand, color, material, price, rating,
         description, tags,
         product_name || '. ' || category || ' - ' || subcategory || '. ' || 'Made of ' || material
           || '. ' || description AS search_text
  FROM products)"""

register("products_searchable", "," + SEARCHABLE_CTE + "\nSELECT * FROM searchable")
_TEXT_COLS = "product_name, category, subcategory, brand, color, material, price, rating, description, tags, search_text"
register("product_index_sync", "," + SEARCHABLE_CTE + f"""
SELECT product_id, CASE WHEN product_id % 11 = 0 THEN 'insert' ELSE 'update' END AS change, {_TEXT_COLS}
FROM searchable WHERE product_id % 11 = 0 OR product_id % 7 = 0
UNION ALL
SELECT -1 - product_id, 'delete', {_TEXT_COLS} FROM searchable WHERE product_id % 13 = 0""")


def _vec_sql(k, same_label):
    cond = "AND q.label = d.label" if same_label else ""
    return f"""
SELECT query_id, rank, vec_id, label, score FROM (
  SELECT q.vec_id AS query_id, d.vec_id, d.label,
         ROUND(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 6) AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY
              ROUND(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 6) DESC,
              d.vec_id) AS INTEGER) AS rank
  FROM embeddings q JOIN embeddings d ON q.vec_id % 50 = 0 {cond})
WHERE rank <= {k}"""


register("vector_topk", _vec_sql(SEARCH_RESULTS, False))
register("vector_topk_filtered", _vec_sql(SEARCH_RESULTS, True))

LAST_MSG_CTE = """
last_msg AS (
  SELECT conv_id, COALESCE(max_by(text, turn) FILTER (WHERE role = 'user'), '') AS user_message
  FROM conversations GROUP BY conv_id)"""


def _hits_cte(k):
    return f"""
qtext AS (SELECT conv_id AS query_id, user_message AS text FROM last_msg),
dtok AS (SELECT product_id AS did, unnest(regexp_split_to_array(lower(search_text), '[^\\p{{L}}\\p{{N}}]+')) AS token
         FROM searchable WHERE search_text IS NOT NULL),
dtf AS (SELECT did, token, COUNT(*) AS tf FROM dtok WHERE token <> '' GROUP BY did, token),
ndocs AS (SELECT COUNT(*) AS n FROM searchable WHERE search_text IS NOT NULL),
idf AS (SELECT token, ln(CAST(n + 1 AS DOUBLE) / CAST(COUNT(*) + 1 AS DOUBLE)) + 1.0 AS idf
        FROM dtf, ndocs GROUP BY token, n),
dw AS (SELECT did, token, tf * idf AS w FROM dtf JOIN idf USING (token)),
dn AS (SELECT did, sqrt(SUM(w * w)) AS norm FROM dw GROUP BY did),
qtok AS (SELECT query_id AS qid, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM qtext),
qtf AS (SELECT qid, token, COUNT(*) AS tf FROM qtok WHERE token <> '' GROUP BY qid, token),
qw AS (SELECT qid, token, tf * idf AS w FROM qtf JOIN idf USING (token)),
qn AS (SELECT qid, sqrt(SUM(w * w)) AS norm FROM qw GROUP BY qid),
pair AS (SELECT qid, did, ROUND(SUM(q.w * d.w) / (MAX(qn.norm) * MAX(dn.norm)), 6) AS score
         FROM qw q JOIN dw d USING (token) JOIN qn USING (qid) JOIN dn USING (did) GROUP BY qid, did),
hits AS (
  SELECT * FROM (
    SELECT qid AS query_id, did AS product_id, score,
           CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, did) AS INTEGER) AS rank
    FROM pair WHERE score > 0)
  WHERE rank <= {k})"""


register("text_topk", "," + SEARCHABLE_CTE + "," + LAST_MSG_CTE + "," + _hits_cte(SEARCH_RESULTS)
         + "\nSELECT query_id, rank, product_id, score FROM hits")
register("last_user_message", "," + LAST_MSG_CTE + "\nSELECT * FROM last_msg")

_NO = NO_PRODUCTS_TEXT.replace("'", "''")
CONTEXT_CTE = f"""
ctx AS (
  SELECT q.query_id,
         COALESCE(string_agg('- ' || s.product_name || ' (' || s.subcategory || ') by ' || s.brand || ' in '
                             || s.color || ' ' || s.material || ' - $'
                             || printf('%.2f', CAST(s.price AS DECIMAL(20,2))) || ', Rating: '
                             || CAST(s.rating AS VARCHAR) || '/5', chr(10) ORDER BY h.rank), '{_NO}')
           AS product_context
  FROM qtext q LEFT JOIN hits h ON q.query_id = h.query_id
       LEFT JOIN searchable s ON s.product_id = h.product_id
  GROUP BY q.query_id)"""

register("product_context", "," + SEARCHABLE_CTE + "," + LAST_MSG_CTE + "," + _hits_cte(ASSISTANT_RESULTS)
         + "," + CONTEXT_CTE + "\nSELECT query_id, product_context FROM ctx")

_HEAD, _TAIL = (p.replace("'", "''") for p in ASSISTANT_PROMPT.split("{product_context}"))
register("assistant_prompts", "," + SEARCHABLE_CTE + "," + LAST_MSG_CTE + "," + _hits_cte(ASSISTANT_RESULTS)
         + "," + CONTEXT_CTE + f"""
SELECT m.conv_id, m.user_message, c.product_context,
       '{_HEAD}' || c.product_context || '{_TAIL}' AS system_prompt
FROM last_msg m JOIN ctx c ON c.query_id = m.conv_id""")

register("preferred_category_counts", """
SELECT category, COUNT(*) AS customers
FROM (SELECT unnest(CAST(json(preferred_categories) AS VARCHAR[])) AS category FROM customers)
GROUP BY category""")
register("page_urls", "SELECT event_id, event_type, page_url, search_term FROM clickstream")
register("mask_cards", "SELECT customer_id, credit_card_last4, credit_card_masked FROM customers")

# ---- CSV and streams ----------------------------------------------------------

for _t in ("products", "customers", "purchases", "clickstream"):
    register(f"bronze_{_t}", f"SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM {_t}")
register("csv_roundtrip", "SELECT * FROM customers")
register("stream_ingest", "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM clickstream")
register("stream_enrich", "SELECT * FROM clickstream_enriched")
register("stream_recent_interest", recent_scores("clickstream_enriched", ASOF_TS, f"AND event_timestamp < {ASOF_TS}"))
register("stream_active_sessions", "," + SESSIONS_CTE + "\nSELECT * FROM sessions")
register("stream_interest_windows", f"""
, ends AS (SELECT *, date_trunc('day', event_timestamp - INTERVAL 12 HOUR) + INTERVAL 36 HOUR AS first_end FROM clickstream_enriched)
, windows AS (SELECT *, unnest([first_end, first_end + INTERVAL 1 DAY]) AS window_end FROM ends)
SELECT window_end, customer_id, category, CAST(SUM({RECENT_WEIGHT_SQL}) AS BIGINT) AS recent_interest_score, COUNT(*) AS events
FROM windows GROUP BY window_end, customer_id, category""")
register("stream_live_sessions", "," + SESSIONS_CTE + "\nSELECT *, FALSE AS closed FROM sessions")
register("medallion_run", "SELECT * FROM customer_segments")
for _key, _same in (("medallion_loyalty", "upsert_loyalty"), ("medallion_offers", "insert_if_absent"),
                    ("medallion_sessions", "active_sessions")):
    register(_key, BODIES[_same])


def changed_views(s: str = "_chg") -> str:
    """The retail views after the second delivery: changed rows take their last values."""
    text = views(AS_OF, s)
    for name, following, values in (
            ("products", "customers", "CASE WHEN {0} THEN product_name || ' II' ELSE product_name END AS product_name, "
                                      "CASE WHEN {0} THEN price + 10 ELSE price END AS price".format("product_id % 5 = 2")),
            ("customers", "purchases", "CASE WHEN {0} THEN 'Platinum' ELSE loyalty_tier END AS loyalty_tier, "
                                       "CAST(CASE WHEN {0} THEN loyalty_points + 500 ELSE loyalty_points END AS INTEGER) AS loyalty_points, "
                                       "CASE WHEN {0} THEN 'MOVED' ELSE city END AS city".format("customer_id % 7 = 3")),
            ("purchases", "click_raw", "CASE WHEN customer_id % 13 = 5 THEN total_amount + 1 ELSE total_amount END AS total_amount"),
            ("clickstream", "sales_orders", "CASE WHEN {0} THEN 'add_to_wishlist' ELSE event_type END AS event_type, "
                                            "CAST(CASE WHEN {0} THEN 1 ELSE duration_seconds END AS INTEGER) AS duration_seconds"
                                            .format("event_id % 11 = 4"))):
        text = text.replace(f"\n{name}{s} AS (", f"\n{name}_was AS (", 1)
        text = text.replace(f"\n{following}{s} AS (", f"\n{name}{s} AS (SELECT * REPLACE ({values}) FROM {name}_was),\n{following}{s} AS (", 1)
    return text


for _key, _result in (("medallion_changes", "customer_segments_chg"), ("refresh_segments", "customer_segments_chg"),
                      ("medallion_changed_clicks", "clickstream_enriched_chg"), ("refresh_clicks", "clickstream_enriched_chg"),
                      ("refresh_interest", "category_interest_chg")):
    register(_key, "," + changed_views() + f"\nSELECT * FROM {_result}")
register("refresh_sessions", "," + changed_views() + ","
         + SESSIONS_CTE.replace("clickstream_enriched", "clickstream_enriched_chg") + "\nSELECT * FROM sessions")
register("index_sync", recent_scores("clickstream_enriched", ASOF_TS))
register("stream_category_interest", "SELECT * FROM category_interest")

# ---- generator ------------------------------------------------------------------

from tillroll.config import DEVICE_TYPES, LOYALTY_TIERS, PAYMENT_METHODS, REFERRERS, SEARCH_TERMS, STORE_TYPES  # noqa: E402
from tillroll.plans import generate as gen  # noqa: E402

SEED = 42


def _u(tag: str, ident: str = "id") -> str:
    return f"CAST('0x' || md5('{SEED}|' || CAST({ident} AS VARCHAR) || '|{tag}')[1:10] AS BIGINT)"


def _below(tag: str, n) -> str:
    return f"(({_u(tag)} * {n}) >> {gen.BITS})"


def _pick(values: list, tag: str) -> str:
    return f"{_lst(values)}[{_below(tag, len(values))} + 1]"


def _weigh(values: list, weights: list, tag: str) -> str:
    items = _lst(values) if isinstance(values[0], str) else str(list(values))
    return f"{items}[1 + " + " + ".join(f"CAST({_u(tag)} >= {t} AS INTEGER)" for t in gen.thresholds(weights)) + "]"


def _range(lo: int, hi: int, tag: str) -> str:
    return f"CAST({lo} + {_below(tag, hi - lo + 1)} AS INTEGER)"


def _digits(n: int, tag: str) -> str:
    return f"lpad(CAST({_range(0, 10 ** n - 1, tag)} AS VARCHAR), {n}, '0')"


def _guid(tag: str) -> str:
    h = f"sha256('{SEED}|' || CAST(id AS VARCHAR) || '|{tag}')"
    return " || '-' || ".join(f"{h}[{a}:{b}]" for a, b in ((1, 8), (9, 12), (13, 16), (17, 20), (21, 32)))


def _map(table: dict, key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + " END"


_CATS = list(gen.CATEGORIES)
_ITEMS = "CASE category " + " ".join(f"WHEN '{c}' THEN {_lst(x)}" for c, x in gen.CATEGORIES.items()) + " END"
_DESC = "'" + gen.DESCRIPTION.format(material="' || lower(material) || '", item="' || lower(item) || '",
                                     brand="' || brand || '", color="' || lower(color) || '") + "'"
GEN_PRODUCTS = f"""
gp0 AS (SELECT p_partkey AS id, {_lst(_CATS)}[p_partkey % {len(_CATS)} + 1] AS category FROM part),
gp1 AS (SELECT id, category, {_ITEMS}[{_below('item', 8)} + 1] AS item, {_pick(gen.BRANDS, 'brand')} AS brand,
               {_pick(gen.COLORS, 'color')} AS color, {_pick(gen.MATERIALS, 'material')} AS material,
               {_map({c: gen.cents(r[0]) for c, r in gen.PRICE_RANGES.items()}, 'category')} AS lo,
               {_map({c: gen.cents(r[1]) for c, r in gen.PRICE_RANGES.items()}, 'category')} AS hi FROM gp0),
gen_products AS (
  SELECT id + 1001 AS product_id, brand || ' ' || color || ' ' || item AS product_name, category, item AS subcategory,
         brand, color, {_pick(gen.SIZES, 'size')} AS size, material,
         CAST(lo + {_below('price', '(hi - lo + 1)')} AS DOUBLE) / CAST(100 AS DOUBLE) AS price,
         CAST({_range(30, 50, 'rating')} AS DOUBLE) / CAST(10 AS DOUBLE) AS rating, {_range(5, 500, 'reviews')} AS review_count,
         '["' || lower(category) || '","' || replace(lower(item), ' ', '_') || '","' || lower(brand) || '","'
           || lower(color) || '"]' AS tags,
         {_DESC} AS description, {_u('stock')} < {gen.part_of(gen.IN_STOCK_SHARE)} AS in_stock
  FROM gp1)"""
_LIKED = "[" + ", ".join(f"md5('{SEED}|' || CAST(id AS VARCHAR) || '|{c}') || '{c}'" for c in _CATS) + "]"
GEN_CUSTOMERS = f"""
gc0 AS (SELECT c_custkey AS id, {_weigh(LOYALTY_TIERS, gen.TIER_WEIGHTS, 'tier').replace('CAST(id', 'CAST(c_custkey')} AS tier
        FROM customer),
gc1 AS (SELECT *, 'First' || CAST({_range(1, 999, 'first')} AS VARCHAR) AS f, 'Last' || CAST({_range(1, 4999, 'last')} AS VARCHAR) AS l,
               {_map({t: r[0] * 100 for t, r in gen.LTV_RANGES.items()}, 'tier')} AS lo,
               {_map({t: r[1] * 100 for t, r in gen.LTV_RANGES.items()}, 'tier')} AS hi,
               list_sort({_LIKED})[1:{_range(1, 3, 'ncat')}] AS liked FROM gc0),
gen_customers AS (
  SELECT id + 1 AS customer_id, f AS first_name, l AS last_name, lower(f) || '.' || lower(l) || '@example.com' AS email,
         '+1-555-' || {_digits(4, 'phone')} AS phone, 'City' || CAST({_range(1, 500, 'city')} AS VARCHAR) AS city,
         'S' || CAST({_range(1, 50, 'state')} AS VARCHAR) AS state, {_digits(5, 'zip')} AS zip_code,
         CAST(CAST({ASOF_TS} AS DATE) - {_range(*gen.AGE_DAYS, 'dob')} AS DATE) AS date_of_birth,
         CAST(CAST({ASOF_TS} AS DATE) - {_range(*gen.SIGNUP_DAYS, 'signup')} AS DATE) AS signup_date,
         tier AS loyalty_tier, {_range(*gen.POINTS_RANGE, 'points')} AS loyalty_points,
         CAST(lo + {_below('ltv', '(hi - lo + 1)')} AS DOUBLE) / CAST(100 AS DOUBLE) AS lifetime_value,
         '["' || array_to_string([x[33:] for x in liked], '","') || '"]' AS preferred_categories,
         {_digits(4, 'card')} AS credit_card_last4, '****-****-****-' || {_digits(4, 'card')} AS credit_card_masked
  FROM gc1)"""
register("gen_products", "," + GEN_PRODUCTS + "\nSELECT * FROM gen_products")
register("gen_customers", "," + GEN_CUSTOMERS + "\nSELECT * FROM gen_customers")
_WHAT = """
what AS (SELECT *, row_number() OVER (ORDER BY product_id) - 1 AS pos FROM gen_products),
sizes AS (SELECT (SELECT COUNT(*) FROM gen_customers) AS nc, (SELECT COUNT(*) FROM gen_products) AS np)"""
register("gen_purchases", "," + GEN_PRODUCTS + "," + GEN_CUSTOMERS + "," + _WHAT + f""",
who AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS pos FROM gen_customers),
drawn AS (SELECT o_orderkey AS id FROM orders),
placed AS (SELECT id, {_u('cust')} % nc AS c, {_u('prod')} % np AS p,
                  {_weigh(list(gen.QUANTITY_WEIGHTS), list(gen.QUANTITY_WEIGHTS.values()), 'qty')} AS qty FROM drawn, sizes)
SELECT {_guid('txn')} AS transaction_id, customer_id, product_id, category, brand, CAST(qty AS INTEGER) AS quantity,
       price AS unit_price, CAST(CAST(round(price * 100) AS BIGINT) * qty AS DOUBLE) / CAST(100 AS DOUBLE) AS total_amount,
       {ASOF_TS} - to_seconds({_u('when')} % {gen.PURCHASE_DAYS * 86400}) AS purchase_date,
       {_pick(PAYMENT_METHODS, 'pay')} AS payment_method, {_pick(STORE_TYPES, 'store')} AS store_type
FROM placed JOIN who ON who.pos = c JOIN what ON what.pos = p""")
register("gen_clickstream", "," + GEN_PRODUCTS + "," + GEN_CUSTOMERS + "," + _WHAT + f""",
who AS (SELECT customer_id, row_number() OVER (ORDER BY h, customer_id) - 1 AS pos
        FROM (SELECT customer_id, md5('{SEED}|' || CAST(customer_id AS VARCHAR) || '|recent') AS h FROM gen_customers)),
drawn AS (SELECT event_id AS id FROM events),
flagged AS (SELECT id, {_u('recent')} < {gen.part_of(gen.RECENT_SHARE)} AS recent FROM drawn),
placed AS (SELECT id, recent, np, {_u('cust')} % (CASE WHEN recent
                    THEN (nc * {int(gen.RECENT_CUSTOMER_SHARE * 100)} + 99) // 100 ELSE nc END) AS c,
                  {_u('prod')} % np AS p,
                  {_weigh(list(gen.GEN_EVENT_WEIGHTS), list(gen.GEN_EVENT_WEIGHTS.values()), 'type')} AS event_type,
                  {_pick(SEARCH_TERMS, 'term')} AS term FROM flagged, sizes)
SELECT id AS event_id, 'SES-' || ({_guid('session')})[1:8] AS session_id, customer_id, event_type,
       {ASOF_TS} - to_seconds({_u('when')} % (CASE WHEN recent THEN {gen.RECENT_HOURS * 3600} ELSE {gen.CLICK_DAYS * 86400} END))
         AS event_timestamp,
       CASE WHEN event_type <> 'search' THEN product_id END AS product_id, category, brand,
       CASE WHEN event_type = 'search' THEN '/search?q=' || replace(term, ' ', '+')
            ELSE '/products/' || lower(category) || '/prd-' || CAST(product_id AS VARCHAR) END AS page_url,
       CASE WHEN event_type = 'search' THEN term END AS search_term,
       {_pick(DEVICE_TYPES, 'device')} AS device_type, {_pick(REFERRERS, 'ref')} AS referrer,
       CASE WHEN event_type IN ('page_view', 'product_view') THEN {_range(3, 300, 'dur')} ELSE 0 END AS duration_seconds
FROM placed JOIN who ON who.pos = c JOIN what ON what.pos = p""")

"""Hand-made boundary frames for the business rules."""

from datetime import date, datetime

from tillroll.config import AS_OF
from tillroll.functions import rules, weights
from tillroll.plans import gold, state


def test_segment_order_and_nulls(spark):
    rows = [
        # id, tier, d_purchase, d_activity, signup
        (1, "Gold", 30, 1, date(2020, 1, 1)),       # HV active (<= 30)
        (2, "Platinum", 31, 1, date(2020, 1, 1)),   # HV at-risk
        (3, "Gold", None, 40, date(2020, 1, 1)),    # NULL purchase: falls through → Dormant (activity)
        (4, "Bronze", 61, 1, date(2020, 1, 1)),     # Dormant by purchase
        (5, "Bronze", None, None, date(2024, 1, 1)),  # New (signup 30 d)
        (6, "Silver", 45, 5, date(2020, 1, 1)),     # At-Risk
        (7, "Silver", 60, 5, date(2020, 1, 1)),     # At-Risk (<= 60)
        (8, "Bronze", None, None, date(2020, 1, 1)),  # never purchased, old → Active
        (9, "Silver", 10, None, date(2020, 1, 1)),  # Active
        (10, None, 61, None, date(2020, 1, 1)),     # NULL tier, >60 → Dormant (NULL OR TRUE)
    ]
    df = spark.createDataFrame(rows, "id int, loyalty_tier string, days_since_last_purchase int, "
                                     "days_since_last_activity int, signup_date date")
    got = dict(df.select("id", rules.segment(as_of=AS_OF).alias("s")).collect())
    assert got == {1: "High-Value Active", 2: "High-Value At-Risk", 3: "Dormant", 4: "Dormant", 5: "New",
                   6: "At-Risk", 7: "At-Risk", 8: "Active", 9: "Active", 10: "Dormant"}


def test_churn_score_and_levels(spark):
    rows = [(1, None, None, None), (2, 10, 10, 50), (3, 30, 20, 0), (4, 39, 1, 0), (5, 70, 0, 0), (6, 200, 200, 0)]
    df = spark.createDataFrame(rows, "id int, days_since_last_purchase int, days_since_last_activity int, total_orders long")
    out = {r.id: (r.s, r.l) for r in df.select(
        "id", rules.churn_score().alias("s")).withColumn("l", rules.churn_level("s")).collect()}
    assert out[1] == (100.0, "High")          # 90 + 15 − 0 = 105 → capped 100
    assert out[2] == (-85.0, "Low")           # negative: no lower bound
    assert out[3] == (40.0, "Medium")         # boundary 40
    assert out[4] == (39.5, "Low")
    assert out[5] == (70.0, "High")
    assert out[6] == (100.0, "High")


def test_event_weights_default_and_null(spark):
    df = spark.createDataFrame([("page_view",), ("checkout_start",), ("remove_from_cart",), ("error",), (None,)],
                               "event_type string")
    got = [r[0] for r in df.select(weights.event_weight()).collect()]
    assert got == [1, 6, -1, 1, 1]
    got2 = [r[0] for r in df.select(weights.recent_interest_weight()).collect()]
    assert got2 == [1, 0, 0, 0, 0]


def test_calendar_recency_vs_rolling(spark):
    # as_of 2024-01-31 12:00: calendar cut-off is 2024-01-29 00:00 (62 h back)
    rows = [(datetime(2024, 1, 29, 0, 0, 0),), (datetime(2024, 1, 28, 23, 59, 59),),
            (datetime(2024, 1, 24, 0, 0, 0),), (datetime(2024, 1, 23, 23, 0, 0),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r[0] for r in df.select(weights.calendar_recency("t", AS_OF)).collect()]
    assert got == [3.0, 2.0, 2.0, 1.0]
    rolling = [r[0] for r in df.select(weights.within_hours("t", 48, AS_OF)).collect()]
    assert rolling == [False, False, False, False]


def test_tier_progress_half_up_and_cap(spark):
    rows = [(1575, 50000), (25, 50000), (24, 50000), (6000, 5000), (0, 0), (7, 15000)]
    df = spark.createDataFrame(rows, "p int, t int")
    got = [r[0] for r in df.select(rules.tier_progress("p", "t")).collect()]
    assert got == [3.2, 0.1, 0.0, 100.0, 0.0, 0.0]


def test_offer_discount_code_type(spark):
    df = spark.createDataFrame([(3.0, "Denim", 1), (200.0, "Tops", 2), (27.0, "Shoes", 3), (-40.0, "ab", 4)],
                               "s double, c string, r int")
    rows = df.select(rules.offer_discount("s").alias("d"), rules.offer_code("c", rules.offer_discount("s")).alias("code"),
                     rules.offer_type("r").alias("t")).collect()
    assert [r.d for r in rows] == [5, 30, 5, 5]
    assert [r.code for r in rows] == ["OFFER-DEN-5OFF", "OFFER-TOP-30OFF", "OFFER-SHO-5OFF", "OFFER-AB-5OFF"]
    assert [r.t for r in rows] == ["loyalty_reward", "recommendation", "bundle_deal", "flash_sale"]


def test_unknown_category_gets_no_offer(spark):
    interest = spark.createDataFrame(
        [(1, None, 10.0, 1), (1, "A", 50.0, 2), (2, "A", 12.0, 1)],
        "customer_id long, category string, interest_score double, interest_rank int")
    products = spark.createDataFrame([(10, "p10", "A"), (11, "p11", "A"), (12, "p12", "B")],
                                     "product_id long, product_name string, category string")
    offers = state.personalized_offers(interest, products, AS_OF).collect()
    assert sorted((o.customer_id, o.category) for o in offers) == [(1, "A"), (2, "A")]
    o = {o.customer_id: o for o in offers}
    # slot = (customer·31 + rank) mod 2 → customer 1 rank 2: 33 mod 2 = 1 → p11
    assert o[1].product_id == 11 and o[1].discount_pct == 10.0
    # customer 2 rank 1: 63 mod 2 = 1 → p11
    assert o[2].product_id == 11


def test_loyalty_defaults(spark):
    seg = spark.createDataFrame(
        [(1, "a", "b", None, None, None, None, None, "Active", "Low", "[]")],
        "customer_id long, first_name string, last_name string, loyalty_tier string, loyalty_points int, "
        "lifetime_value double, total_orders long, last_purchase_date timestamp_ntz, segment string, "
        "churn_risk_level string, preferred_categories string")
    r = state.loyalty_status(seg, AS_OF).first()
    assert (r.loyalty_tier, r.points_balance, r.lifetime_value, r.total_orders, r.next_tier_threshold,
            r.tier_progress_pct, r.last_purchase_date) == ("Bronze", 0, 0.0, 0, 5000, 0.0, None)


def test_category_interest_ties_by_category(spark):
    rows = [(1, "B", "page_view", datetime(2024, 1, 1), 5), (1, "A", "page_view", datetime(2024, 1, 1), 6)]
    df = spark.createDataFrame(rows, "customer_id long, category string, event_type string, "
                                     "event_timestamp timestamp_ntz, product_id long")
    out = {r.category: r.interest_rank for r in gold.category_interest(df, AS_OF).collect()}
    assert out == {"A": 1, "B": 2}



def test_negative_interest_scores(spark):
    rows = [(1, "A", "remove_from_cart", datetime(2024, 1, 30), 5),
            (1, "A", "remove_from_cart", datetime(2024, 1, 10), 6),
            (1, "B", "page_view", datetime(2024, 1, 10), 7)]
    df = spark.createDataFrame(rows, "customer_id long, category string, event_type string, "
                                     "event_timestamp timestamp_ntz, product_id long")
    out = {r.category: (r.interest_score, r.interest_rank) for r in gold.category_interest(df, AS_OF).collect()}
    assert out == {"A": (-4.0, 2), "B": (1.0, 1)}   # −1·3 + −1·1


def test_conversation_without_user_message_and_no_match(spark):
    from tillroll.config import NO_PRODUCTS_TEXT
    from tillroll.plans import assistant
    conv = spark.createDataFrame(
        [(1, 0, "system", "hi"), (1, 1, "assistant", "hello"),
         (2, 0, "user", "red shoe"), (2, 1, "assistant", "ok"), (2, 2, "user", "blue hat please"),
         (3, 0, "user", "zzz qqq")],
        "conv_id long, turn long, role string, text string")
    msgs = {r.conv_id: r.user_message for r in assistant.last_user_message(conv).collect()}
    assert msgs == {1: "", 2: "blue hat please", 3: "zzz qqq"}
    products = spark.createDataFrame(
        [(10, "blue hat", "Hats", "hat", "Acme", "blue", "wool", 9.995, 4.5, "blue hat by Acme", "[]")],
        "product_id long, product_name string, category string, subcategory string, brand string, color string, "
        "material string, price double, rating double, description string, tags string")
    from tillroll.plans.search import products_searchable
    out = {r.conv_id: r for r in assistant.assistant_prompts(conv, products_searchable(products)).collect()}
    assert out[1].product_context == NO_PRODUCTS_TEXT
    assert out[3].product_context == NO_PRODUCTS_TEXT
    assert out[2].product_context == "- blue hat (hat) by Acme in blue wool - $10.00, Rating: 4.5/5"
    assert NO_PRODUCTS_TEXT in out[1].system_prompt and "shopping assistant" in out[1].system_prompt


def test_offers_with_string_customer_ids(spark):
    interest = spark.createDataFrame([("CUST-00001", "A", 50.0, 1), ("CUST-00002", "A", 12.0, 2)],
                                     "customer_id string, category string, interest_score double, interest_rank int")
    products = spark.createDataFrame([(10, "p10", "A"), (11, "p11", "A"), (12, "p12", "A")],
                                     "product_id long, product_name string, category string")
    offers = state.personalized_offers(interest, products, AS_OF).collect()
    assert sorted(o.customer_id for o in offers) == ["CUST-00001", "CUST-00002"]
    assert all(o.product_id in (10, 11, 12) for o in offers)

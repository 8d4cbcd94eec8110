"""Files in the original application's CSV layout (string ids, Python csv
quoting, isoformat timestamps, empty fields) run through the pipeline."""

import csv
import json
import os

from tillroll.config import AS_OF
from tillroll.plans import gold, silver
from tillroll.session import work_dir
from tillroll.sources import csv as csvio
from tillroll.sources.schemas import STRING_ID_SOURCES


def _write(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.csv", "w", newline="") as f:
        w = csv.DictWriter(f, fieldnames=list(rows[0].keys()))
        w.writeheader()
        w.writerows(rows)


def test_original_csv_layout_end_to_end(spark):
    base = work_dir(spark, "t-compat")
    products = [
        {"product_id": "PRD-1001", "product_name": "UrbanEdge Black Slim Jeans", "category": "Denim",
         "subcategory": "Slim Jeans", "brand": "UrbanEdge", "color": "Black", "size": "M", "material": "Denim",
         "price": 59.99, "rating": 4.5, "review_count": 12,
         "tags": json.dumps(["denim", "slim_jeans", "urbanedge", "black"]),
         "description": "Premium denim slim jeans by UrbanEdge. Available in black. Perfect for any occasion.",
         "in_stock": True},
        {"product_id": "PRD-1002", "product_name": "EcoWear Red Sneakers", "category": "Shoes",
         "subcategory": "Sneakers", "brand": "EcoWear", "color": "Red", "size": "L", "material": "Nylon",
         "price": 89.5, "rating": 3.9, "review_count": 7, "tags": json.dumps(["shoes", "sneakers"]),
         "description": "Premium nylon sneakers by EcoWear.", "in_stock": False},
    ]
    customers = [
        {"customer_id": "CUST-00001", "first_name": "Ann", "last_name": "Lee", "email": "a@x.org",
         "phone": "555", "city": "Town", "state": "CA", "zip_code": "01234", "date_of_birth": "1990-05-01",
         "signup_date": "2021-02-03", "loyalty_tier": "Gold", "loyalty_points": 1200, "lifetime_value": 2500.5,
         "preferred_categories": json.dumps(["Denim", "Shoes"]), "credit_card_last4": "0042",
         "credit_card_masked": "****-****-****-0042"},
        {"customer_id": "CUST-00002", "first_name": "Bo", "last_name": "Kim", "email": "b@x.org",
         "phone": "556", "city": "City", "state": "NY", "zip_code": "10001", "date_of_birth": "1985-01-01",
         "signup_date": "2024-01-10", "loyalty_tier": "Bronze", "loyalty_points": 100, "lifetime_value": 80.0,
         "preferred_categories": json.dumps(["Tops"]), "credit_card_last4": "1111",
         "credit_card_masked": "****-****-****-1111"},
    ]
    purchases = [
        {"transaction_id": "6f1c-aa", "customer_id": "CUST-00001", "product_id": "PRD-1001", "category": "Denim",
         "brand": "UrbanEdge", "quantity": 2, "unit_price": 59.99, "total_amount": 119.98,
         "purchase_date": "2024-01-20T10:11:12.345678", "payment_method": "paypal", "store_type": "online"},
    ]
    clicks = [
        {"event_id": "e-1", "session_id": "SES-abc", "customer_id": "CUST-00001", "event_type": "product_view",
         "event_timestamp": "2024-01-30T09:00:00", "product_id": "PRD-1002", "category": "Shoes",
         "brand": "EcoWear", "page_url": "/products/shoes/prd-1002", "search_term": "", "device_type": "mobile",
         "referrer": "google", "duration_seconds": 30},
        {"event_id": "e-2", "session_id": "SES-abc", "customer_id": "CUST-00001", "event_type": "search",
         "event_timestamp": "2024-01-30T09:01:00.500000", "product_id": "", "category": "Denim",
         "brand": "UrbanEdge", "page_url": "/search?q=slim+fit+jeans", "search_term": "slim fit jeans",
         "device_type": "mobile", "referrer": "google", "duration_seconds": 0},
    ]
    for name, rows in (("products", products), ("customers", customers), ("purchases", purchases),
                       ("clickstream", clicks)):
        _write(f"{base}/{name}", rows)
    read = {n: csvio.read_csv(spark, f"{base}/{n}", STRING_ID_SOURCES[n]) for n in STRING_ID_SOURCES}

    p = read["products"].collect()
    assert p[0].tags == '["denim", "slim_jeans", "urbanedge", "black"]' and p[0].in_stock is True
    c = {r.customer_id: r for r in read["customers"].collect()}
    assert c["CUST-00001"].zip_code == "01234" and c["CUST-00001"].preferred_categories == '["Denim", "Shoes"]'
    ev = {r.event_id: r for r in read["clickstream"].collect()}
    assert ev["e-2"].product_id is None and ev["e-1"].event_timestamp is not None
    assert ev["e-2"].event_timestamp is not None

    enriched = silver.clickstream_enriched(read["clickstream"], read["products"])
    e = {r.event_id: r for r in enriched.collect()}
    assert e["e-1"].product_name == "EcoWear Red Sneakers" and e["e-2"].product_name is None
    c360 = silver.customer_360(read["customers"], read["purchases"], read["clickstream"], AS_OF)
    seg = {r.customer_id: r for r in gold.customer_segments(c360, AS_OF).collect()}
    assert seg["CUST-00001"].segment == "High-Value Active" and seg["CUST-00001"].total_orders == 1
    assert seg["CUST-00002"].segment == "New" and seg["CUST-00002"].churn_risk_score == 100.0
    interest = {(r.customer_id, r.category): r for r in gold.category_interest(enriched, AS_OF).collect()}
    assert interest[("CUST-00001", "Denim")].interest_score == 9.0     # search 3 × recency 3
    assert interest[("CUST-00001", "Shoes")].interest_score == 6.0     # product view 2 × 3

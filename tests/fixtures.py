"""A made-up shop's raw files, small enough to work every expected result out by hand."""

from __future__ import annotations

import json
import os

PRODUCTS = [
    ("lime", "라임 소다", "음료"),
    ("plum", "자두 케이크", "제과"),
    ("rye", "호밀빵", "제과"),
    ("salt", "Sea salt", "식재료"),
    ("tea", "Green tea", "음료"),
]

# order_id, product_id, quantity, unit_price, ordered_at; amounts 900, 620, 450, 1140, 1240, 1800, 510, 380, 3100.
ORDERS = [
    (1, "tea", 2, 450, "2025-03-03T08:15:00+09:00"),
    (2, "rye", 1, 620, "2025-03-03T08:40:00+09:00"),
    (3, "tea", 1, 450, "2025-03-03T12:05:00+09:00"),
    (4, "plum", 3, 380, "2025-03-03T12:30:00+09:00"),
    (5, "rye", 2, 620, "2025-03-04T08:20:00+09:00"),
    (6, "tea", 4, 450, "2025-03-04T19:45:00+09:00"),
    (7, "lime", 1, 510, "2025-03-06T12:10:00+09:00"),
    (8, "plum", 1, 380, "2025-03-06T19:05:00+09:00"),
    (9, "rye", 5, 620, "2025-03-06T19:50:00+09:00"),
]
TOTAL = 10140

# product -> (orders, revenue, quantity)
BY_PRODUCT = {"lime": (1, 510, 1), "plum": (2, 1520, 4), "rye": (3, 4960, 8), "tea": (3, 3150, 7)}
BY_DAY = [("2025-03-03", 4, 3110), ("2025-03-04", 2, 3040), ("2025-03-06", 3, 3990)]
BY_CATEGORY = {"음료": (4, 3660), "제과": (5, 6480)}
# hour, orders, revenue, share of 10140 in percent
BY_HOUR = [(8, 3, 2760, 27.22), (12, 3, 2100, 20.71), (19, 3, 5280, 52.07)]
PAGE_VIEWS = {"2025-03-03": 4, "2025-03-04": 2, "2025-03-07": 3}


def access_log_text() -> str:
    lines = [f"{day}T09:0{k}:00+09:00 GET /menu/ 200 {10 + k}" for day, n in PAGE_VIEWS.items() for k in range(n)]
    return "\n".join(lines) + "\n"


def write_raw(data_dir: str) -> str:
    raw = os.path.join(data_dir, "raw")
    os.makedirs(raw, exist_ok=True)
    with open(os.path.join(raw, "orders.csv"), "w", encoding="utf-8") as f:
        f.write("order_id,product_id,quantity,unit_price,ordered_at\n")
        f.writelines(",".join(map(str, row)) + "\n" for row in ORDERS)
    with open(os.path.join(raw, "products.jsonl"), "w", encoding="utf-8") as f:
        for row in PRODUCTS:
            f.write(json.dumps(dict(zip(("product_id", "name", "category"), row)), ensure_ascii=False) + "\n")
    with open(os.path.join(raw, "access.log"), "w", encoding="utf-8") as f:
        f.write(access_log_text())
    return data_dir


def orders_frame(spark, rows=None):
    """Refined orders of the shop, or of the given raw rows."""
    from salesmart import schemas
    from salesmart.functions.refine import refine_orders

    return refine_orders(spark.createDataFrame(ORDERS if rows is None else rows, schemas.RAW_ORDER))


def products_frame(spark):
    return spark.createDataFrame(PRODUCTS, "product_id string, name string, category string")

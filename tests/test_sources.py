"""Raw-zone readers, exports round trip, refresh, order items."""

import os
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.functions.refine import refine_orders
from salesmart.operators import exports
from salesmart.sources import files
from tests.fixtures import orders_frame, write_raw


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_is_permissive_and_binds_by_position(spark, scratch):
    write(
        f"{scratch}/o.csv",
        "id,prod,qty,price,at\n"
        "1,A,x,100,2026-09-07T10:00:00+09:00\n"
        "2,B\n"
        "3,C,2,50,2026-09-07T11:00:00+09:00,extra\n",
    )
    rows = {r.order_id: r for r in files.read_orders_csv(spark, f"{scratch}/o.csv").collect()}
    assert rows[1].quantity is None and rows[1].unit_price == 100
    assert rows[2].product_id == "B" and rows[2].quantity is None and rows[2].ordered_at is None
    assert rows[3].quantity == 2 and rows[3].ordered_at == "2026-09-07T11:00:00+09:00"


def test_export_then_read_back_gives_the_same_orders(spark, scratch):
    orders = orders_frame(spark)
    exports.write_csv(exports.orders_snapshot(orders), f"{scratch}/orders.csv")
    back = refine_orders(files.read_orders_csv(spark, f"{scratch}/orders.csv"))
    cols = ["order_id", "product_id", "quantity", "unit_price", "amount", "ordered_at", "order_date"]
    assert sorted(back.select(cols).collect()) == sorted(orders.select(cols).collect())


def test_order_items_with_decimal_money(spark, scratch):
    write(
        f"{scratch}/items.csv",
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2025-02-01 07:30:00,41.20,3.05\n"
        "o1,2,p2,s1,2025-02-01 07:30:00,12345678.99,0.10\n",
    )
    items = files.read_order_items(spark, f"{scratch}/items.csv")
    assert items.schema["price"].dataType.simpleString() == "decimal(10,2)"
    rows = items.orderBy("order_id", "order_item_id").collect()
    assert rows[0].price == Decimal("41.20") and rows[1].freight_value == Decimal("0.10")
    assert items.agg(F.sum("price")).first()[0] == Decimal("12345720.19")


def test_products_and_log_readers(spark, scratch):
    data_dir = write_raw(scratch)
    products = files.read_products_jsonl(spark, f"{data_dir}/raw/products.jsonl")
    assert products.columns == ["product_id", "name", "category"] and products.count() == 5
    assert files.read_access_log(spark, f"{data_dir}/raw/access.log").count() == 9


def test_ordered_export_writes_rows_in_id_order(spark, scratch):
    orders = orders_frame(spark).repartition(4)
    exports.write_csv(exports.orders_snapshot(orders), f"{scratch}/o.csv", order_by="order_id")
    parts = sorted(f for f in os.listdir(f"{scratch}/o.csv") if f.startswith("part-"))
    ids = []
    for p in parts:
        with open(f"{scratch}/o.csv/{p}", encoding="utf-8") as f:
            ids += [int(line.split(",")[0]) for line in f.read().splitlines()[1:]]
    assert ids == list(range(1, 10))


def test_access_log_copy_is_unchanged(spark, scratch):
    data_dir = write_raw(scratch)
    src = files.read_access_log(spark, f"{data_dir}/raw/access.log")
    exports.copy_text(src, f"{scratch}/copy")
    back = files.read_access_log(spark, f"{scratch}/copy")
    assert src.exceptAll(back).count() == 0 and back.exceptAll(src).count() == 0

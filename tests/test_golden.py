"""The whole batch against the made-up shop's hand-worked document."""

import pytest

from salesmart.plans import batch, dashboard, refresh
from tests import fixtures as shop
from tests.fixtures import orders_frame, products_frame, write_raw

ROW = "product_id string, product_name string, order_count long, revenue long, sold_quantity long, average_order_amount double, category string, order_date string, visit_date string, page_views long"


def section(spark, data_dir, name):
    return dashboard.read_section(spark, f"{data_dir}/document", name, ROW)


def test_batch_document(spark, scratch):
    data_dir = write_raw(scratch)
    head = batch.run(spark, data_dir, generated_at="2025-03-08T00:00:00+09:00")
    assert head["order_count"] == 9
    assert [r["order_id"] for r in head["preview"]] == list(range(9, 0, -1))
    assert list(head["preview"][0]) == ["order_id", "product_id", "quantity", "amount"]
    hours = [(r["order_hour"], r["order_count"], r["revenue"], r["revenue_share_pct"]) for r in head["by_hour"]]
    assert hours == shop.BY_HOUR

    products = {r.product_id: r for r in section(spark, data_dir, "by_product").collect()}
    assert set(products) == {p[0] for p in shop.PRODUCTS}  # complete, whatever its size
    for pid, (orders, revenue, quantity) in shop.BY_PRODUCT.items():
        r = products[pid]
        assert (r.order_count, r.revenue, r.sold_quantity) == (orders, revenue, quantity)
        assert r.average_order_amount == pytest.approx(revenue / orders)
    assert (products["salt"].order_count, products["salt"].average_order_amount) == (0, None)
    assert [(r.order_date, r.order_count, r.revenue) for r in section(spark, data_dir, "by_day").collect()] == shop.BY_DAY
    assert [(r.visit_date, r.page_views) for r in section(spark, data_dir, "page_views").collect()] == list(shop.PAGE_VIEWS.items())
    assert {r.category: (r.order_count, r.revenue) for r in section(spark, data_dir, "by_category").collect()} == shop.BY_CATEGORY
    assert head["pipeline_seconds"] > 0
    assert head["rejected_orders"] == 0 and head["rejected_log_lines"] == 0
    assert dashboard.read_summary(spark, f"{data_dir}/document") == head


def test_section_lines_are_sorted_with_null_fields(spark, scratch):
    data_dir = write_raw(scratch)
    batch.run(spark, data_dir, generated_at="x")
    lines = [r.value for r in spark.read.text(f"{data_dir}/document/by_product").collect()]
    assert [line.split('"')[3] for line in lines] == sorted(p[0] for p in shop.PRODUCTS)
    assert '"average_order_amount":null' in lines[3] and '"product_id":"salt"' in lines[3]


def test_empty_document_has_no_hour_section():
    doc = dashboard.empty_document()
    assert doc["order_count"] == 0 and "by_hour" not in doc and "pipeline_seconds" not in doc


def test_day_partitioned_silver_gives_the_same_document(spark, scratch):
    data_dir = write_raw(scratch)
    head = batch.run(spark, data_dir, generated_at="x", partition_by=("order_date",))
    assert head["order_count"] == 9
    assert [(r.order_date, r.order_count, r.revenue) for r in section(spark, data_dir, "by_day").collect()] == shop.BY_DAY
    files = spark.read.parquet(batch.Zones(data_dir).silver).inputFiles()
    assert all("order_date=2025-03-" in f for f in files)


def test_tolerant_batch_reports_rejected_input(spark, scratch):
    data_dir = write_raw(scratch)
    with open(f"{data_dir}/raw/orders.csv", "a", encoding="utf-8") as f:
        f.write("10,tea,1,100,yesterday\n")
    with open(f"{data_dir}/raw/access.log", "a", encoding="utf-8") as f:
        f.write("not a log line\n")
    head = batch.run(spark, data_dir, generated_at="x")
    assert head["order_count"] == 10 and head["rejected_orders"] == 1 and head["rejected_log_lines"] == 1
    assert None in {r.order_date for r in section(spark, data_dir, "by_day").collect()}


def test_refresh_rebuilds_the_document(spark, scratch):
    orders, products = orders_frame(spark), products_frame(spark)
    log = spark.createDataFrame([(line,) for line in shop.access_log_text().splitlines()], "value string")
    first = refresh.refresh(spark, scratch, orders.filter("order_id <= 4"), products, log).first()
    assert (first.before_count, first.after_count) == (0, 4)
    again = refresh.refresh(spark, scratch, orders, products, log).first()
    assert (again.before_count, again.after_count) == (4, 9)
    sold = {r.product_id: (r.order_count, r.revenue, r.sold_quantity) for r in section(spark, scratch, "by_product").filter("order_count > 0").collect()}
    assert sold == shop.BY_PRODUCT
    exported = spark.read.json(f"{scratch}/raw/products.jsonl")
    assert [r.product_id for r in exported.collect()] == [p[0] for p in shop.PRODUCTS]

"""A refresh of changed days gives what a whole batch gives, and touches nothing else."""

import datetime as dt
import os

from pyspark.sql import functions as F

from salesmart.functions.logs import parse_requests
from salesmart.operators import marts
from salesmart.plans import batch, dashboard, incremental
from tests.fixtures import ORDERS, access_log_text, orders_frame, products_frame
from tests.test_plans import plan


def logs(spark):
    return spark.createDataFrame([(line,) for line in access_log_text().splitlines()], "value string")


def refresh(spark, data_dir, orders):
    return tuple(incremental.refresh(spark, data_dir, orders, products_frame(spark), logs(spark)).first())


def same_as_a_whole_batch(spark, data_dir, orders):
    want = batch.build_marts(orders, products_frame(spark), parse_requests(logs(spark)))
    for name, df in want.items():
        got = spark.read.parquet(f"{batch.Zones(data_dir).marts}/{name}")
        assert sorted(map(str, got.select(df.columns).collect())) == sorted(map(str, df.collect())), name
    head = dashboard.read_summary(spark, batch.Zones(data_dir).document)
    assert head["order_count"] == orders.count() and head["rows"]["by_product"] == 5
    assert [r["order_id"] for r in head["preview"]] == [r.order_id for r in marts.order_preview(orders).collect()]


def files_of(data_dir):
    state = incremental.Periods(data_dir)
    return {os.path.join(d, f) for top in (state.orders, state.totals, state.newest) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def test_refreshes_follow_changes_late_rows_and_vanished_orders(spark, scratch):
    orders = orders_frame(spark, [*ORDERS, (10, "tea", 1, 70, None)])
    steps = [
        (orders.filter("order_id <= 6"), (0, 6, 2, 0)),
        (orders.filter("order_id <= 6"), (6, 6, 0, 0)),  # nothing changed
        (orders, (6, 10, 2, 0)),  # a new day, and orders without a date
        (orders.filter("order_id <> 2"), (10, 9, 1, 0)),  # one order of a day has vanished
        (orders.withColumn("amount", F.when(F.col("order_id") == 5, 1).otherwise(F.col("amount"))), (9, 10, 2, 0)),
        (orders.filter("order_date IS NOT NULL AND order_date <> '2025-03-04'"), (10, 7, 0, 2)),
        (orders.filter("order_id < 0"), (7, 0, 0, 2)),
        (orders, (0, 10, 4, 0)),
    ]
    for now, want in steps:
        before = files_of(scratch)
        assert refresh(spark, scratch, now) == want
        same_as_a_whole_batch(spark, scratch, now)
        if want[2:] == (0, 0):
            assert files_of(scratch) == before
    assert {f.split("period=")[1].split("/")[0] for f in files_of(scratch)} == {"2025-03-03", "2025-03-04", "2025-03-06", "__HIVE_DEFAULT_PARTITION__"}


def test_unchanged_days_keep_their_files(spark, scratch):
    orders = orders_frame(spark)
    refresh(spark, scratch, orders)
    before = files_of(scratch)
    refresh(spark, scratch, orders.withColumn("quantity", F.when(F.col("order_id") == 5, 9).otherwise(F.col("quantity"))))
    changed = before ^ files_of(scratch)
    assert changed and all("period=2025-03-04" in f for f in changed)


def test_unchanged_days_are_not_scanned(spark, scratch):
    orders = orders_frame(spark)
    refresh(spark, scratch, orders)
    stored = spark.read.schema(incremental.with_period(orders).schema).parquet(incremental.Periods(scratch).orders)
    chosen = incremental.on_periods(stored, [dt.date(2025, 3, 4)])
    text = plan(incremental.period_totals(chosen))
    assert "PartitionFilters: [isnotnull(period" in text and "(period" in text and chosen.count() == 2
    assert all("2025-03-04" in f for f in chosen.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert incremental.on_periods(stored, []).count() == 0


def test_prints_do_not_depend_on_order_but_on_every_value(spark):
    orders = orders_frame(spark)
    prints = lambda df: sorted(map(tuple, incremental.fingerprints(incremental.with_period(df)).collect()))
    assert prints(orders) == prints(orders.orderBy(F.rand()).repartition(3))
    assert prints(orders) != prints(orders.withColumn("product_id", F.when(F.col("order_id") == 3, "rye").otherwise(F.col("product_id"))))
    assert prints(orders) != prints(orders.unionByName(orders.filter("order_id = 3")))


def test_months_as_periods(spark, scratch):
    orders = orders_frame(spark, [*ORDERS, (10, "tea", 1, 70, "2025-04-01T08:00:00+09:00")])
    args = (products_frame(spark), logs(spark), "month")
    assert tuple(incremental.refresh(spark, scratch, orders, *args).first()) == (0, 10, 2, 0)
    assert tuple(incremental.refresh(spark, scratch, orders.filter("order_id < 10"), *args).first()) == (10, 9, 0, 1)
    same_as_a_whole_batch(spark, scratch, orders.filter("order_id < 10"))

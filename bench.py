"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed to completion with the ``noop`` sink (no driver
transfer).  Also timed, to line up with the reference's only numbers: the
whole raw -> bronze -> silver -> marts batch on the order lines exported as
raw files; overwrite, append and a one-row update of an orders table; a join of
stored co-partitioned tables and a search by index (both written beforehand, not timed); ten
million generated orders rolled up per product; and the CSV read + group-by of
one million synthetic orders.  A step that fails ends the run with its error
and a non-zero exit code: no total is printed that leaves a step out.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.functions.refine import refine_orders  # noqa: E402
from salesmart.operators import layout, marts, search, tables  # noqa: E402
from salesmart.plans import batch  # noqa: E402
from salesmart.plans.queries import INDEXED_TERM, REGISTRY, UPDATE_SET, UPDATE_WHERE, order_index, order_parts, write_raw_zone  # noqa: E402
from salesmart.session import BENCHMARK_SCAN_CONF, build_session, scratch_path  # noqa: E402
from salesmart.sources import files, synth  # noqa: E402
from salesmart.sources import testdata as td  # noqa: E402

HEADLINE = [
    "q_sales_by_product",
    "q_sales_by_category",
    "q_sales_by_day",
    "q_sales_by_hour",
    "q_page_views",
    "q_order_preview",
    "q_dashboard_products",
    "q_total_sales",
    "q_order_count",
    "q_enriched_orders",
    "q_refined_orders",
    "q_product_totals_full",
    "q_benchmark_sales",
    "q_validate_orders",
    "q_order_search",
    "q_order_events",
    "q_dashboard_doc",
]


def timed(fn):
    """Seconds taken by ``fn``."""
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def run_noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    # build_session gives a local driver 8 GiB (tasks run in the driver JVM).
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "8g")
    spark = build_session(f"local[{cpus}]", app_name="salesmart-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": memory})
    scratch = scratch_path(spark, "bench")

    run_noop(REGISTRY["q_order_count"](spark, sf_dir))  # JVM / reader warm-up, not timed

    times = {}
    for name in HEADLINE:
        times[name] = timed(lambda: run_noop(REGISTRY[name](spark, sf_dir)))

    # Raw zone from the order lines (setup, not timed).
    write_raw_zone(spark, sf_dir, f"{scratch}/batch")
    times["batch_full"] = timed(lambda: batch.run(spark, f"{scratch}/batch", generated_at="bench"))

    # Orders table: overwrite with the orders before the split day, append the rest, update one order.
    table = f"{scratch}/orders"
    first, rest = order_parts(td.orders(spark, sf_dir))
    times["table_overwrite"] = timed(lambda: tables.overwrite(first, table))
    times["table_append"] = timed(lambda: tables.append(rest, table))
    times["table_update"] = timed(lambda: tables.update(spark, table, UPDATE_SET, UPDATE_WHERE))

    # Stored layouts (written beforehand, as in production): a join of co-partitioned tables, a search by index.
    stored = layout.store(td.order_lines(spark, sf_dir), td.products(spark, sf_dir), "product_id", f"{scratch}/layout")
    times["stored_join"] = timed(lambda: run_noop(layout.join(spark, stored)))
    index = order_index(spark, sf_dir)
    times["index_search"] = timed(lambda: run_noop(search.search(spark, index, INDEXED_TERM)))

    # Ten million generated orders (100 products, 8 slices) rolled up in parallel.
    def synthetic_group():
        rows = marts.product_totals(refine_orders(synth.orders(spark, 10_000_000, num_partitions=8))).collect()
        assert len(rows) == 100 and sum(r.revenue for r in rows) == 18_500_000_000

    times["synthetic_10m_group"] = timed(synthetic_group)

    # CSV read + group-by of one million synthetic orders with the benchmark scan profile.
    synth.write_raw(spark, 1_000_000, f"{scratch}/synth/raw", num_partitions=int(cpus))
    for k, v in BENCHMARK_SCAN_CONF.items():
        spark.conf.set(k, v)

    def csv_group():
        orders = refine_orders(files.read_orders_csv(spark, f"{scratch}/synth/raw/orders.csv"))
        rows = marts.product_totals(orders).select("product_id", "order_count", "revenue").collect()
        assert sum(r.revenue for r in rows) == 1_850_000_000

    times["csv_group_1m"] = timed(csv_group)

    # The same rows as a Parquet (bronze) scan: columnar, vectorized, pruned.
    files.read_orders_csv(spark, f"{scratch}/synth/raw/orders.csv").write.parquet(f"{scratch}/synth/bronze")

    def parquet_group():
        orders = refine_orders(files.read_bronze(spark, f"{scratch}/synth/bronze"))
        rows = marts.product_totals(orders).select("product_id", "order_count", "revenue").collect()
        assert sum(r.revenue for r in rows) == 1_850_000_000

    times["parquet_group_1m"] = timed(parquet_group)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

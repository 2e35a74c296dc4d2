"""L2 at the cost of what changed: totals per period, recomputed only for periods whose orders changed.

A period is a day, or a month where days hold few orders.  State below
``data_dir``::

    lake/periods/orders     refined orders, one folder per period
    marts/periods/totals    per period: totals of every product, day and hour
    marts/periods/newest    per period: its orders with the highest ids
    marts/periods/prints    per period: number of orders and a hash that their order does not change

A refresh reads the operational orders once to fingerprint their periods, and
compares that with the stored prints.  Only periods that differ are written,
summed and ranked again, each by replacing its folder; periods that have no
order any more lose theirs.  The marts are sums over the periods' totals, which
hold one row per period and product, day or hour.  Prints are written last, so
a refresh that was broken off does the same periods again.

The driver sees the list of changed periods, one date each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.functions.logs import parse_requests
from salesmart.operators import exports, marts, tables
from salesmart.operators.footers import folder_sizes
from salesmart.plans import batch, dashboard
from salesmart.session import materialize

PERIOD = "period"

#: Orders of the preview.
PREVIEW = 10

#: ``gid`` of the products', days' and hours' rows of a period.
OF_PRODUCTS, OF_DAYS, OF_HOURS = 3, 5, 6


class Periods:
    def __init__(self, data_dir: str):
        d = data_dir.rstrip("/")
        self.orders = f"{d}/lake/periods/orders"
        self.totals = f"{d}/marts/periods/totals"
        self.newest = f"{d}/marts/periods/newest"
        self.prints = f"{d}/marts/periods/prints"


def with_period(orders: DataFrame, grain: str = "day") -> DataFrame:
    """Orders with the first day of their period (NULL without a date)."""
    return orders.withColumn(PERIOD, F.trunc("order_date", grain) if grain != "day" else F.col("order_date"))


def fingerprints(orders: DataFrame) -> DataFrame:
    """(period, rows, print): ``print`` is the sum of the rows' hashes, which a change of order leaves alone."""
    row = F.xxhash64(*[c for x in sorted(orders.columns) for c in (F.col(x), F.col(x).isNull())])
    return orders.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("print"))


def changed_periods(now: DataFrame, before: DataFrame) -> DataFrame:
    """(period, vanished) of the periods whose print differs, is new or has gone."""
    old = before.select(F.col(PERIOD).alias("_day"), F.col("rows").alias("_rows"), F.col("print").alias("_print"), F.lit(True).alias("_old"))
    both = now.withColumn("_now", F.lit(True)).join(old, F.col(PERIOD).eqNullSafe(F.col("_day")), "full")
    same = F.col("_now").isNotNull() & F.col("_old").isNotNull() & (F.col("rows") == F.col("_rows")) & (F.col("print") == F.col("_print"))
    return both.filter(~same).select(F.when(F.col("_now").isNull(), F.col("_day")).otherwise(F.col(PERIOD)).alias(PERIOD), F.col("_now").isNull().alias("vanished"))


def on_periods(df: DataFrame, days: list[dt.date | None]) -> DataFrame:
    """Rows of the given periods (None: those without a date); on a table by period this lists their folders only."""
    known = [F.lit(d) for d in days if d is not None]
    cond: Column = F.col(PERIOD).isin(known) if known else F.lit(False)
    return df.filter(cond | F.col(PERIOD).isNull() if None in days else cond)


def period_totals(orders: DataFrame) -> DataFrame:
    """Per period: totals of every product, day and hour (``gid`` tells them apart), from one scan."""
    keys = ["product_id", "order_date", "order_hour"]
    facts = orders.select(PERIOD, "product_id", "order_date", F.hour("ordered_at").alias("order_hour"), "amount", "quantity")
    sets = facts.groupingSets([[PERIOD, k] for k in keys], PERIOD, *keys)
    return sets.agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("order_count"), F.sum("amount").alias("revenue"), F.sum("quantity").alias("sold_quantity"))


def period_newest(orders: DataFrame, n: int = PREVIEW) -> DataFrame:
    """Per period: the ``n`` orders with the highest ids."""
    place = F.row_number().over(Window.partitionBy(PERIOD).orderBy(F.col("order_id").desc_nulls_last()))
    return orders.select(PERIOD, "order_id", "product_id", "quantity", "amount", place.alias("_place")).filter(F.col("_place") <= n).drop("_place")


def all_totals(totals: DataFrame) -> DataFrame:
    """The periods' totals summed up in the shape of :func:`marts.fact_totals`."""
    sums = [F.sum(c).alias(c) for c in ("order_count", "revenue", "sold_quantity")]
    return totals.groupBy("gid", "product_id", "order_date", "order_hour").agg(*sums)


def refresh_periods(spark: SparkSession, data_dir: str, given: DataFrame, grain: str = "day") -> dict[str, int]:
    """Bring the periods' tables up to date with ``given`` (refined orders); orders before and after, periods changed and vanished."""
    state, orders = Periods(data_dir), with_period(given, grain)
    now = materialize(fingerprints(orders), "prints")
    before = spark.read.schema(now.schema).parquet(state.prints) if dashboard.exists(spark, state.prints) else spark.createDataFrame([], now.schema)
    count = lambda prints: prints.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    done = {"before_count": count(before), "after_count": count(now)}
    changes = changed_periods(now, before).collect()
    changed, vanished = [r[PERIOD] for r in changes if not r.vanished], [r[PERIOD] for r in changes if r.vanished]
    if changed:
        tables.load(on_periods(orders, changed), state.orders, PERIOD, lookup=("order_id",), sort_by=("order_id",))
        stored = on_periods(spark.read.schema(orders.schema).parquet(state.orders), changed)
        tables.load(period_totals(stored), state.totals, PERIOD)
        tables.load(period_newest(stored), state.newest, PERIOD)
    names = [None if d is None else d.isoformat() for d in vanished]
    for path in (state.orders, state.totals, state.newest):
        if names:
            tables.drop_partitions(spark, path, PERIOD, names)
    if changes:
        tables.overwrite(now, state.prints)
    return done | {"changed_periods": len(changed), "vanished_periods": len(vanished)}


def refresh(spark: SparkSession, data_dir: str, orders: DataFrame, products: DataFrame, log_lines: DataFrame, grain: str = "day") -> DataFrame:
    """L2: bring periods, marts and document up to date; one row (before_count, after_count, changed_periods, vanished_periods).

    ``orders`` are the refined operational orders, ``products`` their
    dimension, ``log_lines`` the access log's lines in ``value``.
    """
    state, zones = Periods(data_dir), batch.Zones(data_dir)
    done, dated = refresh_periods(spark, data_dir, orders, grain), with_period(orders, grain)

    def read(path: str, like: DataFrame) -> DataFrame:
        return spark.read.schema(like.schema).parquet(path) if dashboard.exists(spark, path) else spark.createDataFrame([], like.schema)

    totals = materialize(all_totals(read(state.totals, period_totals(dated))), "all-totals")
    sections = batch.build_marts(read(state.newest, period_newest(dated)), exports.products_snapshot(products), parse_requests(log_lines), totals)
    for name, df in sections.items():
        tables.overwrite(df, f"{zones.marts}/{name}")
    dashboard.write_sections(spark, zones.marts, zones.document)
    sizes = folder_sizes(spark, {name: f"{zones.marts}/{name}" for name in sections}).collect()
    head = {"order_count": done["after_count"], "rows": {r.section: r.rows for r in sizes}} | dashboard.bounded_sections(spark, zones.document)
    dashboard.write_summary(spark, head, zones.document)
    return spark.createDataFrame([tuple(done.values())], ", ".join(f"{k} long" for k in done))

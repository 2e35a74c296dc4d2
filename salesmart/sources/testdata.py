"""The driver's TPC-H-like parquet tables mapped onto the order model.

Mapping (money is kept in integer cents so sums are exact):

* order lines  <- ``lineitem``: order_id=l_orderkey, product_id=l_partkey,
  quantity=int(l_quantity), unit_price=cents(l_extendedprice) div quantity,
  ordered_at=l_shipdate.  ``(l_orderkey, l_linenumber)`` is not unique, so
  this table is never used where an order id must identify one row.
* products     <- ``part``: product_id=p_partkey, name=p_name, category=p_type,
  unit_price=cents(p_retailprice).
* orders       <- ``orders``: order_id=o_orderkey (unique), product_id=o_custkey,
  quantity=1, unit_price=cents(o_totalprice), ordered_at=o_orderdate.
  Its product side is ``customer`` (name=c_name, category=c_mktsegment).
* timed orders <- ``events``: order_id=event_id, product_id=user_id, quantity=1,
  unit_price=cents(value), ordered_at=ts (spans all 24 hours).
* access log   <- ``events`` rendered to log lines and parsed back.
* order requests <- ``events``: product_id=user_id, quantity text built from
  the ``props`` number; the menu for them is ``supplier``.

Timestamps in these files are TIMESTAMP_NTZ, so day and hour buckets do not
depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.logs import ISO_SECONDS, format_request_line
from salesmart.functions.refine import refine_orders


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        F.floor(cents("l_extendedprice") / quantity).cast("long").alias("unit_price"),
        F.col("l_shipdate").alias("ordered_at"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined order lines (amount, ordered_at, order_date)."""
    return refine_orders(raw_order_lines(spark, sf_dir))


def products(spark: SparkSession, sf_dir: str, with_price: bool = False) -> DataFrame:
    cols = [
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
    ]
    if with_price:
        cols.append(cents("p_retailprice").alias("unit_price"))
    return table(spark, sf_dir, "part").select(*cols)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("product_id"),
        F.lit(1).cast("int").alias("quantity"),
        cents("o_totalprice").alias("unit_price"),
        F.col("o_orderdate").alias("ordered_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined orders with a unique order_id."""
    return refine_orders(raw_orders(spark, sf_dir))


def sparse_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of which every tenth has no category, another tenth an empty one, and every seventh no name."""
    k = F.col("product_id")
    return products(spark, sf_dir).withColumns({
        "name": F.when(k % 7 == 0, F.lit("")).otherwise(F.col("name")),
        "category": F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 10 == 1, F.lit("")).otherwise(F.col("category")),
    })


def customers_as_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("product_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
    )


def timed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined orders whose instants cover every hour of the day."""
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("product_id"),
        F.lit(1).cast("int").alias("quantity"),
        cents("value").alias("unit_price"),
        F.col("ts").alias("ordered_at"),
    )
    return refine_orders(raw)


def partly_timed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed orders of which every ninth has no time."""
    no_time = F.col("order_id") % 9 == 0
    return timed_orders(spark, sf_dir).withColumn("ordered_at", F.when(~no_time, F.col("ordered_at")))


def damaged_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of which those with duration 3 lose their blanks, and those with duration 5 their time."""
    line = F.col("value")
    return access_log_lines(spark, sf_dir).select(
        F.when(line.endswith(" 3"), F.replace(line, F.lit(" "), F.lit(";")))
        .when(line.endswith(" 5"), F.regexp_replace(line, r"^\S+", "not-a-time"))
        .otherwise(line).alias("value"))


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render every event as one access-log line (column ``value``)."""
    ev = table(spark, sf_dir, "events")
    requests = ev.select(
        F.col("ts").alias("requested_at"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("POST"))
        .otherwise(F.lit("GET"))
        .alias("method"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/")).alias("path"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.col("user_id").alias("duration_ms"),
    )
    return requests.select(format_request_line().alias("value"))


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-intake requests with raw quantity text of every shape.

    The number in ``props`` is rendered per event type as plain digits,
    blank-padded, negative, too large for an int, or not a number.
    """
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1)
    text = (
        F.when(F.col("event_type") == "view", k)
        .when(F.col("event_type") == "click", F.concat(F.lit(" "), k, F.lit(" ")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("-"), k))
        .when(F.col("event_type") == "signup", F.concat(k, F.lit("00000000")))
        .otherwise(F.concat(F.lit("x"), k))
    )
    return ev.select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").cast("string").alias("product_id"),
        text.alias("quantity"),
    )


def menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a price for order intake (from ``supplier``)."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("product_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("category"),
        cents("s_acctbal").alias("unit_price"),
    )


def damaged_order_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines without a header: every 11th has no number for its quantity, every 13th no time."""
    k = F.col("order_id")
    quantity = F.when(k % 11 == 0, F.lit("two")).otherwise(F.col("quantity").cast("string"))
    time = F.when(k % 13 == 0, F.lit("soon")).otherwise(F.date_format("ordered_at", ISO_SECONDS))
    return raw_orders(spark, sf_dir).select(F.concat_ws(",", k.cast("string"), F.col("product_id").cast("string"), quantity, F.col("unit_price").cast("string"), time).alias("value"))


def damaged_product_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as JSON lines, every seventh cut off after its name."""
    line = F.format_string('{"product_id":"%d","name":"%s"', "product_id", "name")
    rest = F.format_string(',"category":"%s"}', "category")
    return customers_as_products(spark, sf_dir).select(F.when(F.col("product_id") % 7 == 0, line).otherwise(F.concat(line, rest)).alias("value"))

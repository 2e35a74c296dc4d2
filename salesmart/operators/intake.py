"""Order intake and order lookups, re-aimed from per-request web code to batches.

L4/J8 validation, L5 price snapshot, T2/J7 recent orders, A18 their totals,
T6 received order, P20 search, P19/T7 menu filter, A19 menu categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import labels
from salesmart.operators.joins import spread_join

# Rejection reasons, product check first.
UNKNOWN_PRODUCT = "unknown_product"
BAD_QUANTITY = "bad_quantity"
RECENT_LIMIT = 50


def validate_orders(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Check each request: the product must exist, then the quantity must be 1..2^31-1.

    ``requests`` has ``product_id`` and the raw ``quantity`` text; ``products``
    has ``product_id`` and ``unit_price`` (unique ids).  Adds
    ``quantity_value`` (int or NULL), ``unit_price``, ``accepted`` and ``reason``.
    """
    menu = products.select("product_id", "unit_price", F.lit(True).alias("_known"))
    qty = labels.parse_quantity("quantity")
    checked = spread_join(requests, menu, "product_id", "left").withColumn("quantity_value", qty)
    ok_qty = F.col("quantity_value").between(labels.MIN_QUANTITY, labels.MAX_QUANTITY)
    reason = (
        F.when(F.col("_known").isNull(), F.lit(UNKNOWN_PRODUCT))
        .when(F.coalesce(ok_qty, F.lit(False)), F.lit(None).cast("string"))
        .otherwise(F.lit(BAD_QUANTITY))
    )
    return (
        checked.withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
        .drop("_known")
    )


def price_snapshot(validated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Accepted requests become orders priced at the product's current unit price."""
    return (
        validated.filter(F.col("accepted"))
        .select(
            *keep,
            "product_id",
            F.col("quantity_value").alias("quantity"),
            "unit_price",
        )
        .withColumn("amount", F.col("quantity") * F.col("unit_price"))
    )


def recent_orders(orders: DataFrame, products: DataFrame, n: int = RECENT_LIMIT) -> DataFrame:
    """The ``n`` newest orders by id with their product, newest first.

    The top-k runs first (n rows per task), so the join, its result's order
    and ``position`` (1 for the newest shown) see at most ``n`` rows.
    """
    top = orders.orderBy(F.col("order_id").desc()).limit(n)
    dim = products.select("product_id", "name", "category")
    shown = top.join(dim, on="product_id", how="inner")
    newest = Window.orderBy(F.col("order_id").desc())
    return shown.withColumn("position", F.row_number().over(newest)).orderBy("position")


def recent_order_totals(recent: DataFrame) -> DataFrame:
    """Sum of quantity, sum of amount and number of rows of the recent list."""
    return recent.agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.sum("quantity").alias("quantity_total"),
        F.sum("amount").alias("amount_total"),
    )


def received_order(recent: DataFrame, received_id: str | Column | None) -> DataFrame:
    """The recent order whose id text equals ``received_id`` (text or a column); no row if absent."""
    wanted = received_id if isinstance(received_id, Column) else F.lit(received_id).cast("string")
    return recent.filter(F.col("order_id").cast("string") == wanted)


def search_orders(orders_with_names: DataFrame, term: str, name: str = "name") -> DataFrame:
    """P20: substring match of the normalised term on ``"<0000 id> <id> <name>"``."""
    t = labels.search_term(term)
    if not t:
        return orders_with_names
    return orders_with_names.filter(labels.search_text("order_id", name).contains(t))


def menu_by_category(products: DataFrame, category: str | None = None) -> DataFrame:
    """Products of one category by id (all when the selection is empty)."""
    if category:
        products = products.filter(F.col("category") == F.lit(category))
    return products.orderBy("product_id")


def menu_categories(products: DataFrame) -> DataFrame:
    """Distinct non-empty categories in the order of the first product that shows each."""
    return (
        products.filter(F.col("category").isNotNull() & (F.col("category") != ""))
        .groupBy("category")
        .agg(F.min("product_id").alias("first_product_id"))
        .orderBy("first_product_id", "category")
    )

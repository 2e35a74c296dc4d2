"""Raw order -> refined order (amount, instant, local date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def amount(quantity: str = "quantity", unit_price: str = "unit_price") -> Column:
    """quantity * unit_price; int * bigint is bigint and overflow raises under ANSI."""
    return F.col(quantity) * F.col(unit_price)


def parse_instant(column: Column, strict: bool = False) -> Column:
    """ISO-8601 text (with offset) -> timestamp in the session zone.

    ``strict`` fails the job on one malformed value, as the plain cast does
    under ANSI mode (and also when a session turns ANSI off); the default
    turns malformed text into NULL.
    """
    parsed = F.try_to_timestamp(column)
    if not strict:
        return parsed
    bad = column.isNotNull() & parsed.isNull()
    message = F.concat(F.lit("malformed timestamp: "), column)
    return F.when(bad, F.raise_error(message).cast("timestamp")).otherwise(parsed)


def refine_orders(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``amount``, type ``ordered_at`` and add ``order_date``.

    ``ordered_at`` may already be a timestamp (columnar sources); text is
    parsed.  ``order_date`` is the date of the instant in the session zone.
    """
    ordered_at = F.col("ordered_at")
    if isinstance(raw.schema["ordered_at"].dataType, StringType):
        ordered_at = parse_instant(ordered_at, strict)
    return (
        raw.withColumn("amount", amount())
        .withColumn("ordered_at", ordered_at)
        .withColumn("order_date", F.to_date("ordered_at"))
    )


def rejected_instants(raw: DataFrame) -> DataFrame:
    """Rows whose ``ordered_at`` text is present but cannot be parsed."""
    return raw.filter(F.col("ordered_at").isNotNull() & F.try_to_timestamp("ordered_at").isNull())

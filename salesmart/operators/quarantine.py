"""Quarantine: lines of the raw zone that could not be read, with their text, reason and file.

Each ``split_*`` takes what ``sources.files.scan_*`` has read and a table has
stored (Spark does not filter a raw CSV or JSON scan by the malformed line
alone; a log may come straight from its files), and returns the good rows and
the rejects (:data:`REJECT`).  A malformed CSV or JSON line is only a reject.  An order with
an unreadable instant and a log line that does not match stay in the flow with
NULL fields, as tolerant parsing has them, and are listed too, so nothing that
was lost or blanked goes unseen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.logs import LOG_PATTERN, log_group
from salesmart.sources.files import REJECTED

REJECT = ("source", "reason", "line", "file")

# Reasons.
MALFORMED, BAD_INSTANT, UNMATCHED, OUT_OF_RANGE = "malformed_row", "bad_instant", "unmatched_line", "number_out_of_range"


def _rejects(df: DataFrame, source: str, reason: Column, line: Column) -> DataFrame:
    return df.select(F.lit(source).alias("source"), reason.alias("reason"), line.alias("line"), "file").filter("reason IS NOT NULL")


def split_orders(scanned: DataFrame, drop_malformed: bool = True) -> tuple[DataFrame, DataFrame]:
    """Raw orders without malformed rows; rejects, of unreadable instants the instant's text.

    Without ``drop_malformed`` such rows stay among the orders too, with NULL for what could not be read.
    """
    bad_time = F.col("ordered_at").isNotNull() & F.try_to_timestamp("ordered_at").isNull()
    reason = F.when(F.col(REJECTED).isNotNull(), MALFORMED).when(bad_time, BAD_INSTANT)
    good = scanned.filter(F.col(REJECTED).isNull()) if drop_malformed else scanned
    return good.drop(REJECTED, "file"), _rejects(scanned, "orders", reason, F.coalesce(REJECTED, "ordered_at"))


def split_products(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products without malformed lines, and those lines."""
    reason = F.when(F.col(REJECTED).isNotNull(), MALFORMED)
    return scanned.filter(F.col(REJECTED).isNull()).drop(REJECTED, "file"), _rejects(scanned, "products", reason, F.col(REJECTED))


def split_log(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All log lines, and those whose typed fields are not all read."""
    line = F.col("value")
    small = log_group(4).try_cast("int").isNotNull() & log_group(5).try_cast("long").isNotNull()
    reason = (
        F.when(line.isNull(), F.lit(None).cast("string"))
        .when(~line.rlike(LOG_PATTERN), UNMATCHED)
        .when(F.try_to_timestamp(log_group(1)).isNull(), BAD_INSTANT)
        .when(~small, OUT_OF_RANGE)
    )
    return scanned.drop("file"), _rejects(scanned, "access_log", reason, line)


def counts(rejects: DataFrame) -> dict[tuple[str, str], int]:
    """Rejects by (source, reason): at most one number for each of the few reasons."""
    return {(r.source, r.reason): r.n for r in rejects.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n")).collect()}

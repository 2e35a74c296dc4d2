"""Access-log lines: parse (text -> typed request) and format (row -> text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The access-log line layout `<ISO ts> <method> <path> <status> <duration_ms>`.
LOG_PATTERN = r"^(\S+) (\S+) (\S+) (\d+) (\d+)$"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"
DAY_FORMAT = "yyyy-MM-dd"


def log_group(index: int, line: str = "value") -> Column:
    """Regex group ``index`` of the line; '' when the line does not match."""
    return F.regexp_extract(F.col(line), LOG_PATTERN, index)


def parse_requests(lines: DataFrame, strict: bool = False, line: str = "value") -> DataFrame:
    """One typed request per log line.

    Tolerant by default: an unmatched line gives NULL typed fields instead of
    failing the whole job (``strict=True`` keeps the ANSI cast errors).
    Catalyst prunes unused groups, so a count by day only evaluates group 1.
    """
    ts = F.try_to_timestamp(log_group(1, line))
    status = log_group(4, line).try_cast("int")
    duration = log_group(5, line).try_cast("long")
    if strict:
        # Fail on an unmatched line whatever the session's ANSI setting.
        unmatched = F.col(line).isNotNull() & ~F.col(line).rlike(LOG_PATTERN)
        message = F.concat(F.lit("unmatched log line: "), F.col(line))
        ts = F.when(unmatched | ts.isNull(), F.raise_error(message).cast("timestamp")).otherwise(ts)
        too_big = F.concat(F.lit("number out of range in log line: "), F.col(line))
        status = F.when(status.isNull(), F.raise_error(too_big).cast("int")).otherwise(status)
        duration = F.when(duration.isNull(), F.raise_error(too_big).cast("long")).otherwise(duration)
    return lines.select(
        ts.alias("requested_at"),
        log_group(2, line).alias("method"),
        log_group(3, line).alias("path"),
        status.alias("status"),
        duration.alias("duration_ms"),
    ).withColumn("visit_date", F.date_format("requested_at", DAY_FORMAT))


def format_request_line(
    requested_at: str = "requested_at",
    method: str = "method",
    path: str = "path",
    status: str = "status",
    duration_ms: str = "duration_ms",
) -> Column:
    """Inverse of :func:`parse_requests`: ``<ts with offset> <method> <path> <status> <ms>``."""
    return F.concat_ws(
        " ",
        F.date_format(F.col(requested_at), ISO_SECONDS),
        F.col(method),
        F.col(path),
        F.col(status).cast("string"),
        F.col(duration_ms).cast("string"),
    )

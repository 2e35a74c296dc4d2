"""Join helpers: size-checked broadcasts, joins that split hot keys, the key-uniqueness check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialize

#: Bytes of a hinted dimension (its rows as JSON text), at most.
MAX_BROADCAST_BYTES = 64 << 20


def _json_bytes(df: DataFrame) -> DataFrame:
    """One row: the bytes of the rows as JSON text, ``size``."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("size"))


def broadcast_bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` hinted for broadcast; the query fails when it is larger than ``max_bytes``.

    The size is a scalar subquery of the same query, one aggregated row, so no
    job runs while the query is built.  A caller whose dimension may outgrow
    the bound uses :func:`broadcast_join` or :func:`spread_join`.
    """
    size = _json_bytes(df)
    message = F.concat(F.lit(f"dimension is larger than the {max_bytes} bytes that may be broadcast: "), size.scalar().cast("string"))
    fits = F.when(size.scalar() > max_bytes, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return F.broadcast(df.filter(fits))


def broadcast_join(facts: DataFrame, dim: DataFrame, key: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Inner join with the dimension hinted for broadcast up to ``max_bytes``; a larger one is shuffled, with the same rows.

    One scan of the dimension measures it while the query is built.  ``facts``
    are aggregated by ``key`` before, so no key is hot.
    """
    fits = _json_bytes(dim).first()["size"] <= max_bytes
    return facts.join(F.broadcast(dim) if fits else dim.hint("merge"), key)


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """Keys with more rows than an even share of a shuffle partition: (``key``, ``_spread``).

    ``_spread`` is the number of even shares the key's rows fill.  There are
    fewer such keys than shuffle partitions, whatever the data: each holds more
    than that share of all rows.  One scan of the key column, one row per key
    and task shuffled, nothing collected; the counts are written once, so the
    total and the keys above it come from the same scan.
    """
    spark = facts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    counted = materialize(known, "key-counts")
    share = counted.agg((F.sum("_rows") / parts).alias("share")).scalar()
    return counted.filter(F.col("_rows") > share).select(key, F.ceil(F.col("_rows") / share).cast("int").alias("_spread"))


def spread_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join facts to a dimension on ``key`` without gathering a hot key in one task.

    Rows of a hot key are dealt over as many shuffle partitions as they fill
    (:func:`hot_keys`), and its dimension row is repeated for each; so is a
    NULL key of a left join.  The part of a row is a hash of it, so a task that
    runs again deals its rows as before.  The facts are scanned twice: once for
    their keys, once for the join.  No session setting is relied on, and no key
    is capped.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread join does not support {how!r}")
    hot = hot_keys(facts, key)
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lost = F.when(F.col(key).isNull(), F.lit(parts)) if how == "left" else F.lit(None).cast("int")
    spread: Column = F.coalesce(F.col("_spread"), lost, F.lit(1))
    dealt = facts.join(F.broadcast(hot), key, "left").withColumn("_part", F.pmod(F.xxhash64(*facts.columns), spread).cast("int")).drop("_spread")
    copies = dim.join(F.broadcast(hot), key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_spread", F.lit(1)) - 1))).drop("_spread")
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, *keys: str) -> None:
    """Fail when a key repeats (a repeated product id would fan out and inflate revenue).

    Collects at most five offending keys for the message.
    """
    dups = duplicate_keys(df, *keys).limit(5).collect()
    if dups:
        raise ValueError(f"duplicate key {keys}: " + ", ".join(str(tuple(r)) for r in dups))

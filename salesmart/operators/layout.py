"""Facts and a dimension stored for joins without a shuffle.

Both are bucketed by the join key into the same number of buckets and sorted
within, so a join of the stored tables is a merge of buckets: no exchange, no
sort, one scan of each side.  A bucket is read by one task, so keys that alone
exceed an even share of a bucket are found when the layout is written and kept
in a table of their own, in the tasks they come from; there are fewer of them
than buckets, and their dimension rows are broadcast.

A bucketed table needs a catalog entry; the files lie where the caller says.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.joins import hot_keys
from salesmart.operators.tables import overwrite


@dataclass(frozen=True)
class Stored:
    """Names of the bucketed tables, and paths of the hot keys' rows of either side."""

    facts: str
    dim: str
    hot_facts: str
    hot_dim: str
    key: str


def _bucketed(df: DataFrame, path: str, key: str, buckets: int) -> str:
    """Write ``df`` bucketed and sorted by ``key``; returns the table's name.

    Rows are dealt by bucket first, so each bucket is one file.
    """
    name = f"layout_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return name


def store(facts: DataFrame, dim: DataFrame, key: str, path: str, buckets: int | None = None) -> Stored:
    """Write both sides in co-partitioned buckets of ``key`` below ``path``.

    Rows of the facts without a key are kept beside the hot ones.  ``dim`` has
    one row per key.
    """
    spark = facts.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, key).select(key, F.lit(True).alias("_hot"))
    marked = facts.join(F.broadcast(hot), key, "left")
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    overwrite(marked.filter(apart).drop("_hot"), f"{path}/hot_facts")
    overwrite(dim.join(F.broadcast(hot), key, "left_semi"), f"{path}/hot_dim")
    stays = marked.filter(~apart).drop("_hot")
    return Stored(_bucketed(stays, f"{path}/facts", key, buckets), _bucketed(dim, f"{path}/dim", key, buckets), f"{path}/hot_facts", f"{path}/hot_dim", key)


def join(spark: SparkSession, stored: Stored, how: str = "inner") -> DataFrame:
    """The stored facts with their dimension rows; a left join keeps facts without one."""
    if how not in ("inner", "left"):
        raise ValueError(f"the stored join does not support {how!r}")
    merged = spark.table(stored.facts).join(spark.table(stored.dim).hint("merge"), stored.key, how)
    few = F.broadcast(spark.read.parquet(stored.hot_dim))  # fewer keys than buckets
    return merged.unionByName(spark.read.parquet(stored.hot_facts).join(few, stored.key, how))


def forget(spark: SparkSession, stored: Stored) -> None:
    """Take the tables out of the catalog; the files stay."""
    for name in (stored.facts, stored.dim):
        spark.sql(f"DROP TABLE IF EXISTS {name}")

"""Order search by an inverted index of trigrams (P20).

The index has postings of every distinct trigram of an order's search text: for
each block of orders and gram, a row with the ids of those that have it, in
folders by the gram's hash and sorted by gram within each file, and the number
of orders of every gram.  A search reads the counts
of the term's trigrams, intersects the postings of the rarest few, and tests
the candidates' texts.  Terms of one or two characters have no trigram and scan
the texts, with the same result.

Nothing grows on the driver: it sees the trigrams of the term.  A gram that
every order has (of a common name, say) is one folder's long run of postings;
it is read only when the term has no rarer one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions import labels
from salesmart.operators import tables

SIZE = 3

#: Folders of postings, and trigrams of a term whose postings are intersected.
BUCKETS, RAREST = 64, 3


def _posted(batches):
    """(gram, order_ids) of every distinct trigram, in characters, of a block of orders."""
    for batch in batches:
        texts = [t or "" for t in batch.column("search_text").to_pylist()]
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        starts = np.flatnonzero(row[:1 - SIZE] == row[SIZE - 1:])  # the others run into the next text
        gram = chars[starts]
        for k in range(1, SIZE):
            gram = gram << 21 | chars[starts + k]
        found, number = np.unique(gram, return_inverse=True)
        pairs = np.unique(number << 32 | row[starts])
        ends = np.searchsorted(pairs >> 32, np.arange(len(found) + 1))
        names = ["".join(chr(g >> 21 * k & 0x1FFFFF) for k in reversed(range(SIZE))) for g in found.tolist()]
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column("order_id").take(pa.array(pairs & 0xFFFFFFFF)))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), ids], ["gram", "order_ids"])


def _bucket(gram: Column) -> Column:
    return F.pmod(F.hash(gram), F.lit(BUCKETS))


def build_index(orders_with_names: DataFrame, path: str, name: str = "name") -> None:
    """Write ``texts`` (the rows with their search text), ``postings`` and ``counts`` below ``path``.

    One pass joins and normalises the rows; the postings come from what it has
    written.  Postings are rebalanced by folder, and a long folder is split
    over several files.
    """
    spark = orders_with_names.sparkSession
    tables.overwrite(orders_with_names.withColumn("search_text", labels.search_text("order_id", name)), f"{path}/texts", lookup=("order_id",))
    texts = spark.read.parquet(f"{path}/texts")
    posted = texts.select("order_id", "search_text").mapInArrow(_posted, f"gram string, order_ids array<{_id_type(texts)}>")
    sorted_by = posted.withColumn("bucket", _bucket(F.col("gram"))).hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram")
    tables.overwrite(sorted_by, f"{path}/postings", ("bucket",))
    counts = _stored(spark, path, "postings").groupBy("bucket", "gram").agg(F.sum(F.size("order_ids")).alias("n"))
    tables.overwrite(counts.sortWithinPartitions("gram"), f"{path}/counts", ("bucket",))


def _id_type(texts: DataFrame) -> str:
    return texts.schema["order_id"].dataType.simpleString()


def _stored(spark: SparkSession, path: str, part: str) -> DataFrame:
    """``postings`` or ``counts`` of an index, which have no file where there is no trigram."""
    order_id = _id_type(spark.read.parquet(f"{path}/texts"))
    columns = {"postings": f"order_ids array<{order_id}>", "counts": "n long"}[part]
    return spark.read.schema(f"gram string, {columns}, bucket int").parquet(f"{path}/{part}")


def _of_grams(spark: SparkSession, path: str, part: str, wanted: list[str]) -> DataFrame:
    """Rows of the wanted grams, from their folders only."""
    df = _stored(spark, path, part)
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in wanted], "gram string").select(_bucket(F.col("gram"))).distinct().collect()]
    return df.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(wanted))


def term_grams(term: str) -> list[str]:
    """Distinct trigrams of a normalised term; empty below three characters."""
    return sorted({term[k:k + SIZE] for k in range(len(term) - SIZE + 1)})


def candidates(spark: SparkSession, path: str, term: str, rarest: int = RAREST) -> DataFrame | None:
    """Ids of the orders that have the rarest trigrams of a normalised term; None without a trigram."""
    wanted = term_grams(term)
    if not wanted:
        return None
    known = {r.gram: r.n for r in _of_grams(spark, path, "counts", wanted).groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    few = sorted(wanted, key=lambda g: (known.get(g, 0), g))[:rarest]
    postings = _of_grams(spark, path, "postings", few).select(F.explode("order_ids").alias("order_id"))
    return postings.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= len(few)).select("order_id")


def search(spark: SparkSession, path: str, term: str) -> DataFrame:
    """P20 on the index: the rows whose search text holds the normalised term; all rows for an empty one.

    An order id that several rows share is verified row by row.
    """
    texts, t = spark.read.parquet(f"{path}/texts"), labels.search_term(term)
    found = candidates(spark, path, t)
    if found is not None:
        ids = found.withColumnRenamed("order_id", "_id")
        texts = texts.join(ids, F.col("order_id").eqNullSafe(F.col("_id")), "left_semi")
    return (texts.filter(F.col("search_text").contains(t)) if t else texts).drop("search_text")

"""Tables on plain Parquet: overwrite, append, loads by partition and conditional update (K2, K3, V1, V4, V5).

Three ways to change a stored table, each touching only what changes:

* :func:`load` replaces whole partitions (days) by the rows given for them, so a
  load that is run again leaves the same rows; the other folders keep their files.
* :func:`update` rewrites only the files that hold a matching row, found by one
  scan of the columns the condition reads.
* :func:`overwrite` and :func:`append` act on the whole table.

Plain Parquet has no log, so an update that is broken off between two file
moves would leave both states.  :func:`update` therefore names old and new
files in a marker before the first move; :func:`recover`, called by every
change here, completes what a marker says.  One writer at a time is assumed, as
for any Parquet folder.
"""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Options of a table whose key column is looked up by value: a Bloom filter in every row group.
_BLOOM = "parquet.bloom.filter.enabled#{}"

_MARKER = "_change-"


def _writer(df: DataFrame, partition_by: tuple[str, ...], lookup: tuple[str, ...]):
    writer = df.write
    if lookup:  # sized by the values of a row group; the default is 1 MiB for the smallest file
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in lookup:
        writer = writer.option(_BLOOM.format(column), "true")
    return writer.partitionBy(*partition_by) if partition_by else writer


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), lookup: tuple[str, ...] = ()) -> None:
    """K2: replace whatever ``path`` holds.  ``df`` must not read from ``path``.

    ``lookup`` names columns that get a Bloom filter in every row group, so a
    look-up of one value skips the row groups that cannot hold it, sorted or not.
    """
    _writer(df, partition_by, lookup).mode("overwrite").parquet(path)


def _same_shape(df: DataFrame, path: str, parts: list[str]) -> None:
    """Fail unless ``df`` has the stored columns and types; a partition column's type is not stored, so only its name counts."""
    def shape(frame: DataFrame) -> dict[str, str | None]:
        return {f.name: None if f.name in parts else f.dataType.simpleString() for f in frame.schema.fields}

    table, rows = shape(df.sparkSession.read.parquet(path)), shape(df)
    if table != rows:
        raise ValueError(f"appended columns {rows} differ from the table's {table}")


def append(df: DataFrame, path: str, lookup: tuple[str, ...] = ()) -> None:
    """K3: add rows; fails unless ``df`` has the table's columns and types.  A second run adds them again: see :func:`load`."""
    spark = df.sparkSession
    recover(spark, path)
    parts = partition_columns(spark, path)
    _same_shape(df, path, parts)
    _writer(df, tuple(parts), lookup).mode("append").parquet(path)


def load(df: DataFrame, path: str, by: str, lookup: tuple[str, ...] = (), sort_by: tuple[str, ...] = ()) -> None:
    """K2/K3/V5: replace the partitions ``df`` has rows of, and add those the table lacks.

    Run again with the same rows it leaves the same table: a load that failed
    half-way is repeated, not repaired.  Partitions without a row in ``df`` keep
    their files.  Rows are rebalanced by partition first: small days share a
    task, and a day larger than a task's share is split over several, so a day
    has few files and no task writes a hot day alone.
    """
    recover(df.sparkSession, path)
    spread = df.hint("rebalance", by)
    if sort_by:
        spread = spread.sortWithinPartitions(by, *sort_by)
    _writer(spread, (by,), lookup).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def drop_partitions(spark: SparkSession, path: str, by: str, values: list[str | None]) -> None:
    """Remove whole partitions (None: the one without a value)."""
    recover(spark, path)
    fs, root = _files(spark, path)
    for value in values:
        folder = _hadoop(spark, f"{root.toString()}/{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        if fs.exists(folder):
            fs.delete(folder, True)


def updated(df: DataFrame, changes: dict[str, str], where: str) -> DataFrame:
    """V1: ``df`` with ``changes`` (column -> SQL expression over the old row) where ``where`` is true."""
    hit = F.coalesce(F.expr(where), F.lit(False))
    return df.select(*[
        F.when(hit, F.expr(changes[f.name]).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in changes else F.col(f.name)
        for f in df.schema.fields
    ])


def update_metrics(df: DataFrame, where: str) -> DataFrame:
    """V4: rows of the table, and rows an update with ``where`` changes."""
    return df.agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(F.coalesce(F.expr(where), F.lit(False))).alias("num_updated_rows"))


def matching_files(df: DataFrame, where: str) -> DataFrame:
    """Files of a table that hold a matching row: (file, num_updated_rows).

    Reads only the columns of the condition; partitions, row groups and pages
    that cannot match are skipped as in any filtered scan.
    """
    hits = df.filter(F.coalesce(F.expr(where), F.lit(False)))
    return hits.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("num_updated_rows"))


def update(spark: SparkSession, path: str, changes: dict[str, str], where: str, lookup: tuple[str, ...] = ()) -> dict[str, int]:
    """V1 + V4: change the matching rows in place, rewriting only the files that hold one.

    A rewritten file gives one new file beside it; a change may not move a row
    to another partition.  Returns ``num_updated_rows``, ``num_copied_rows``
    (other rows of the rewritten files), ``num_removed_files`` and
    ``num_added_files``.  The driver holds the names of the rewritten files,
    nothing of their rows.
    """
    recover(spark, path)
    parts = partition_columns(spark, path)
    if moved := [c for c in changes if c in parts]:
        raise ValueError(f"an update cannot move rows between partitions: {moved}")
    found = matching_files(spark.read.parquet(path), where).collect()
    if not found:
        return {"num_updated_rows": 0, "num_copied_rows": 0, "num_removed_files": 0, "num_added_files": 0}
    old = sorted(r.file for r in found)
    before = spark.read.option("basePath", path).parquet(*[unquote(f) for f in old])
    staged = f"{path.rstrip('/')}/{_MARKER}{uuid.uuid4().hex}"
    # One file stays one file: its rows go to the task of its number, however the scan splits or packs the files.
    numbers = spark.createDataFrame(list(zip(old, range(len(old)))), "_path string, _file int")
    rows = before.withColumn("_path", F.col("_metadata.file_path")).join(F.broadcast(numbers), "_path").drop("_path")
    placed = updated(rows, changes, where).repartitionById(len(old), F.col("_file")).drop("_file")
    _writer(placed, tuple(parts), lookup).parquet(f"{staged}/rows")
    n_rows = spark.read.parquet(f"{staged}/rows").count()
    fs, root = _files(spark, path)
    new = _data_files(fs, _hadoop(spark, f"{staged}/rows"))
    below = len(fs.makeQualified(_hadoop(spark, f"{staged}/rows")).toString()) + 1
    marker = {"old": [unquote(f) for f in old], "new": [f[below:] for f in new]}
    out = fs.create(_hadoop(spark, f"{staged}/marker-unfinished"))
    out.write(bytearray(json.dumps(marker).encode()))
    out.close()
    fs.rename(_hadoop(spark, f"{staged}/marker-unfinished"), _hadoop(spark, f"{staged}/marker"))
    recover(spark, path)
    hits = sum(r.num_updated_rows for r in found)
    return {"num_updated_rows": hits, "num_copied_rows": n_rows - hits, "num_removed_files": len(old), "num_added_files": len(new)}


def recover(spark: SparkSession, path: str) -> None:
    """Complete the changes a marker names: move the new files in, delete the old.  Changes without a marker are undone."""
    fs, root = _files(spark, path)
    if not fs.exists(root):
        return
    for status in fs.listStatus(root):
        folder = status.getPath()
        if not folder.getName().startswith(_MARKER):
            continue
        at = folder.toString()
        if fs.exists(_hadoop(spark, f"{at}/marker")):
            marker = json.loads(_text(spark, fs, f"{at}/marker"))
            for name in marker["new"]:
                staged, placed = _hadoop(spark, f"{at}/rows/{name}"), _hadoop(spark, f"{root.toString()}/{name}")
                if fs.exists(staged):
                    fs.mkdirs(placed.getParent())
                    fs.rename(staged, placed)
            for name in marker["old"]:
                fs.delete(_hadoop(spark, name), False)
        fs.delete(folder, True)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the columns a table is partitioned by, outermost first."""
    fs, folder = _files(spark, path)
    names = []
    while True:
        inner = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory() and re.match(r"[^_.][^=]*=", s.getPath().getName())]
        if not inner:
            return names
        names.append(inner[0].getName().split("=")[0])
        folder = inner[0]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Every data file of a table, sorted."""
    fs, root = _files(spark, path)
    return _data_files(fs, root)


def _hadoop(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path and the qualified path."""
    root = _hadoop(spark, path.rstrip("/"))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(root)


def _data_files(fs, folder) -> list[str]:
    out = []
    listing = fs.listFiles(folder, True)
    while listing.hasNext():
        found = listing.next().getPath()
        if re.match(r"[^_.]", found.getName()) and found.getName().endswith(".parquet"):
            out.append(found.toString())
    base = folder.toString()
    return sorted(f for f in out if not re.search(r"/[_.][^/=]*/", f[len(base):]))


def _text(spark: SparkSession, fs, path: str) -> str:
    stream = fs.open(_hadoop(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()

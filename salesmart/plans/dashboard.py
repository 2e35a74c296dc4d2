"""The dashboard document, written by Spark from the mart tables.

The document is a folder of one shape at every size: ``<section>`` holds all
rows of a section as JSON lines in the section's order (part files follow each
other), and ``summary`` is one JSON object with the counts, the run time and
the sections that are bounded by construction: the preview (ten rows) and the
hours (25).  No other section passes through the driver.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Section name -> sort order used in the document ("-" means descending).
SECTION_ORDER = {
    "preview": ["-order_id"],
    "by_product": ["product_id"],
    "by_day": ["order_date"],
    "page_views": ["visit_date"],
    "by_category": ["category"],
    "by_hour": ["order_hour"],
}

#: Sections that cannot grow with the data: ten orders, and 24 hours and none.
BOUNDED = ("preview", "by_hour")


def section_sizes(order_count: DataFrame, marts: dict[str, DataFrame]) -> DataFrame:
    """Rows (section, rows): the order count and the size of every mart section."""
    parts = [order_count.select(F.lit("order_count").alias("section"), F.col("order_count").alias("rows"))]
    for name in SECTION_ORDER:
        parts.append(marts[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("section"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def _sort_key(spec: str) -> Column:
    return F.col(spec[1:]).desc() if spec.startswith("-") else F.col(spec).asc()


def write_sections(spark: SparkSession, marts_dir: str, document: str) -> None:
    """Every section whole, sorted by Spark, as JSON lines; NULL fields are written."""
    for name, order in SECTION_ORDER.items():
        table = spark.read.parquet(f"{marts_dir}/{name}")
        rows = table.orderBy(*[_sort_key(c) for c in order])
        rows.select(F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(f"{document}/{name}")


def read_section(spark: SparkSession, document: str, name: str, schema: str) -> DataFrame:
    """A written section, typed by the given schema."""
    return spark.read.schema(schema).json(f"{document}/{name}")


def bounded_sections(spark: SparkSession, document: str) -> dict[str, list]:
    """The rows of the bounded sections, in order."""
    out = {}
    for name in BOUNDED:
        rows = [json.loads(r.value) for r in spark.read.text(f"{document}/{name}").collect()]
        spec = SECTION_ORDER[name][0]
        key = spec.lstrip("-")
        out[name] = sorted(rows, key=lambda r: (r[key] is not None, r[key] or 0), reverse=spec.startswith("-"))
    return out


def write_summary(spark: SparkSession, head: dict, document: str) -> None:
    """The head as one UTF-8 JSON object (indent 2) in a single text part."""
    text = json.dumps(head, ensure_ascii=False, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{document}/summary")


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder has been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_summary(spark: SparkSession, document: str) -> dict | None:
    """The written head; None before the first batch."""
    if not exists(spark, f"{document}/summary"):
        return None
    return json.loads(spark.read.text(f"{document}/summary", wholetext=True).first().value)


def empty_document(generated_at: str = "not yet aggregated") -> dict:
    """L3: bootstrap document before the first batch (no by_hour, no timing)."""
    return {
        "generated_at": generated_at,
        "order_count": 0,
        "preview": [],
        "by_product": [],
        "by_day": [],
        "page_views": [],
        "by_category": [],
    }

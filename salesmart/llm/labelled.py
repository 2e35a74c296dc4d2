"""Bounded labelled samples for the models that are fitted on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents a model is fitted on, at most (see ``sample_labels``).
MAX_ROWS = 20_000


def sample_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id", max_rows: int = MAX_ROWS,
                  where: Column | None = None) -> DataFrame:
    """(id, label) of about ``max_rows`` labelled ids at most, chosen by a hash of the id.

    Repeated labels of an id count once; an id without a label, or with as
    many 0 as 1, is left out.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if where is not None:
        known = known.filter(where)
    one = known.groupBy(id_col).agg(F.avg(F.col(label_col).cast("double")).alias("_mean")).filter("_mean <> 0.5")
    one = one.select(F.col(id_col), (F.col("_mean") > 0.5).cast("int").alias("label"))
    n = one.count()
    if n > max_rows:
        share = int(0.97 * max_rows / n * (1 << 30))
        one = one.filter(F.pmod(F.xxhash64(F.lit(7), id_col), F.lit(1 << 30)) < share)
    return one


def training_rows(docs: DataFrame, sample: DataFrame, features, id_col: str = "doc_id",
                  text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Feature matrix and labels of a bounded sample, one row per id, in id order.

    The sample's ids are broadcast (their number is bounded), so only the
    sampled texts are worked on; repeated rows of an id fold into the one with
    the smallest features.
    """
    chosen = docs.select(F.col(id_col), F.col(text_col)).join(F.broadcast(sample), id_col)
    rows = chosen.select(id_col, "label", features(F.col(text_col)).alias("x")).groupBy(id_col, "label").agg(F.min("x").alias("x"))
    got = sorted(((r[id_col], r["label"], list(r["x"])) for r in rows.collect()), key=lambda r: r[0])
    return np.array([r[2] for r in got], float), np.array([r[1] for r in got], int)

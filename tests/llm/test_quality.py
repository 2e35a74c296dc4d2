import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import quality
from salesmart.llm.labelled import sample_labels
from tests.llm.conftest import SF, prose


@pytest.fixture(scope="module")
def scored(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    return quality.report(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")


def test_held_out_accuracy(scored):
    held = scored[scored.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None]).mean() > 0.98


def test_columns_agree(scored):
    assert [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id] == scored.held_out.tolist()
    assert ((scored.score >= 0.3).astype(int) == scored.predicted).all() and scored.score.between(0, 1).all()


def test_held_out_labels_are_not_read(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(documents, labels) == quality.fit(documents, flipped)


def test_pairs_order_scores():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ [2, -1, 0] + rng.normal(size=400) * 0.3 > -1).astype(int)
    model = quality.fit_pairs(x, y)
    assert model.weights[0] > 0 > model.weights[1] and abs(model.weights[2]) < 0.5


def test_bounded_sample(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    repeated = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality long"))
    got = sample_labels(repeated, "quality", max_rows=1000)
    assert 800 < got.count() <= 1000 and got.select("doc_id").distinct().count() == got.count()


def test_edges(spark, edge, clashing, nothing):
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 0), (9, 0, 1), (13, 1, 0), (77, 0, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    got = quality.report(edge, labels).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.accepted(clashing, quality.fit(clashing, labels)).columns == clashing.columns
    none = quality.report(edge, labels.limit(0)).collect()
    assert {r.score for r in none} == {1.0} and {r.predicted for r in none} == {1}
    assert quality.report(nothing, labels).count() == 0


def test_short_clean_text_is_kept(spark):
    import random

    rng = random.Random(8)
    rows = [(k, prose(rng, rng.randrange(3, 200))) for k in range(300)]
    rows += [(1000 + k, " ".join(w + "###" for w in prose(rng, 60).split())) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))
    kept = quality.accepted(docs, quality.fit(docs, labels))
    assert {r.doc_id for r in kept.collect()} == set(range(300))

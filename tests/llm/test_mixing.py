import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from salesmart.llm import mixing
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(sizes):
    """Targets by sharing out again and again, from source -> size."""
    names = sorted(n for n in sizes if n is not None) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_ and left > 0:
        level = left / sum(weight[n] for n in open_)
        over = [n for n in open_ if level * weight[n] > 2 * sizes[n]]
        if not over:
            out.update({n: level * weight[n] for n in open_})
            break
        for n in over:
            out[n] = 2.0 * sizes[n]
            left -= 2 * sizes[n]
            open_.remove(n)
    return out


def check(got, rows):
    assert Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows) == Counter((r.doc_id, r.size) for r in got)
    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size and r.taken <= 2 * r.size
    wanted = goals(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= largest[s]


def test_report_against_brute_force(spark, documents):
    got = mixing.report(documents).collect()
    check(got, documents.select("doc_id", "text").collect())


def test_edges_nulls_ties_and_repeats(edge, edge_rows):
    check(mixing.report(edge).collect(), edge_rows)


def test_reruns_agree_on_other_partitions(documents):
    a = rows_of(mixing.report(documents), "doc_id", "copies")
    assert a == rows_of(mixing.report(documents.repartition(7, "lang")), "doc_id", "copies")


def test_tree_of_several_levels(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"),
                                    (F.col("id") % 17 + 1).alias("words"))
    got = mixing.copies(docs, F.col("words"), group_rows=16, fan_in=4).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == 3000
    for r in got:
        assert abs(r.taken - r.target) <= 17


def test_expectation_is_kept(spark):
    """Over many sources alike, a document's mean number of copies is its share."""
    docs = spark.range(40 * 300).select(F.col("id").alias("doc_id"), (F.col("id") % 300).cast("string").alias("source"),
                                        (F.floor(F.col("id") / 300) + 1).alias("words"))
    got = mixing.copies(docs, F.col("words"), weights=(1,), share=0.3)
    mean = got.groupBy("size").agg(F.avg("copies").alias("m")).collect()
    assert all(abs(r.m - 0.3) < 0.12 for r in mean)


def test_mixture_repeats_documents(documents, clashing):
    assert mixing.mixture(documents).count() == sum(r.copies for r in mixing.report(documents).collect())
    assert set(mixing.mixture(clashing).columns) >= {"doc_id", "text", "copy"}


def test_empty(nothing):
    assert mixing.report(nothing).count() == 0 and mixing.mixture(nothing).count() == 0

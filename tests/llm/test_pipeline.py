"""The pipeline against a plain-Python version of its stages, each judged on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from salesmart.llm import quality
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_line_dedup import brute as lines_left
from tests.llm.test_mixing import WORD, goals
from tests.llm.test_simhash import expected as near_groups

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    """Every stage's input and result, in order."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.materialize(stage(spark, docs, SF), "step")
        out.append((name, docs, result))
        docs = result
    return out


def pick(steps, name):
    return next((before, after) for n, before, after in steps if n == name)


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_and_columns(steps, documents):
    assert [n for n, _, _ in steps] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources"]
    for _, _, after in steps[:-1]:
        assert after.schema.names == documents.schema.names


def test_quality_stage(spark, steps):
    before, after = pick(steps, "quality classifier")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in quality.report(before, labels).filter("predicted = 1").collect()}
    assert {d for d, _ in texts(after)} == kept and 0 < len(kept) < before.count()


def test_line_stage(steps):
    before, after = pick(steps, "line dedup")
    left = lines_left(texts(before))
    assert sorted(texts(after)) == sorted((d, left[d, t]) for d, t in texts(before) if left[d, t] != "" or t == "")
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_stage(steps):
    before, after = pick(steps, "SimHash near-dedup")
    assert {d for d, _ in texts(after)} == {c for _, _, c in near_groups(texts(before))}


def test_benchmark_stage(spark, steps):
    before, after = pick(steps, "benchmark decontamination")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {row[0] for row in contamination(texts(before), items) if not row[5]}
    assert {d for d, _ in texts(after)} == clean


def test_mix_stage(steps):
    before, after = pick(steps, "mixing sources")
    size = {r.doc_id: len(WORD.findall(r.text)) for r in before.collect()}
    source = {r.doc_id: r.source for r in before.collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert max(copies.values()) <= 2
    sizes, taken, largest = Counter(), Counter(), Counter()
    for d, n in size.items():
        sizes[source[d]] += n
        taken[source[d]] += n * copies[d]
        largest[source[d]] = max(largest[source[d]], n)
    for s, goal in goals(dict(sizes)).items():
        assert abs(taken[s] - goal) <= largest[s]
    assert Counter(r.copy for r in after.collect())[1] == len(copies)


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, steps[-1][2].collect()))


def test_edges(spark, edge, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name
        got = stage(spark, edge, SF)
        assert got.count() > 0 and set(got.columns) >= set(edge.columns), name

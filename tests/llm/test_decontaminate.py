import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=13):
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, passage in items:
            b = words(passage)
            size = min(n, len(b))
            wins = {tuple(b[k:k + size]) for k in range(len(b) - size + 1)} if size else set()
            at = [k for k in range(len(w) - size + 1) if tuple(w[k:k + size]) in wins] if size else []
            if at and item is not None:
                ids.add(str(item))
            for k in at:
                hit |= set(range(k, k + size))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def items_of(edge_rows):
    shared = edge_rows[4][1]
    return [(1, shared), (10, " ".join(shared.split()[:20])), (2, "ONE"), (3, None), (4, ""), (None, "same id"), (5, "Ä-ö"), (5, "é 日本"), (5, "é 日本")]


def test_report_against_brute_force(spark, edge, edge_rows):
    items = items_of(edge_rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in D.report(edge, bench).collect())
    assert got == brute([r[:2] for r in edge_rows], items)


def test_join_beyond_the_bound_agrees(spark, edge, edge_rows):
    bench = spark.createDataFrame(items_of(edge_rows), "item_id long, text string")
    windows = D.benchmark_windows(bench)
    pick = lambda df: Counter(map(str, df.select("doc_id", "found").collect()))
    assert pick(D.find_windows(edge, windows)) == pick(D.find_windows(edge, windows, max_windows=1))


def test_join_path_with_clashing_names(spark, clashing, edge_rows):
    docs = clashing.withColumns({c: F.lit("mine") for c in ("at", "items", "t", "n")})
    windows = D.benchmark_windows(spark.createDataFrame(items_of(edge_rows), "item_id long, text string"))
    pick = lambda df: Counter(map(str, df.select("doc_id", "found", "at", "items", "key").collect()))
    assert pick(D.find_windows(docs, windows, max_windows=1)) == pick(D.find_windows(docs, windows))


@pytest.mark.parametrize("bound", [D.MAX_WINDOWS, 1])
def test_drop_and_remove(spark, clashing, edge_rows, monkeypatch, bound):
    monkeypatch.setattr(D.find_windows, "__defaults__", ("text", "found", bound, D.MAX_BYTES))
    bench = spark.createDataFrame([(1, edge_rows[4][1])], "item_id long, text string")
    kept = D.drop_contaminated(clashing, bench)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 7, 9, 9, 10, 11, 12, 13, 14]
    texts = {r.doc_id: r.text for r in D.remove_spans(clashing, bench).collect()}
    assert texts[5] == "." * texts[5].count(".") and texts[8].startswith("x\n") and texts[8].endswith("\nÄ ö ﬁ É 日本")
    assert texts[7] == edge_rows[9][1] and texts[1] is None


def test_empty(spark, nothing, edge):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.report(nothing, bench).count() == 0
    assert {r.contaminated for r in D.report(edge, bench).collect()} == {False}

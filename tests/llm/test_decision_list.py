import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import decision_list, textstats
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, hit, seen, dup = WORD.findall(text), set(), set(), 0
    windows = Counter(zip(words, words[1:], words[2:]))
    for k in range(len(words) - 2):
        if windows[tuple(words[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_against_brute_force(spark, documents, edge, edge_rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in decision_list.report(documents, labels).collect())
    assert got == Counter((i, *brute(t)) for i, t in rows)
    got = Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in decision_list.report(edge, labels).collect())
    assert got == Counter((r[0], *brute(r[1])) for r in edge_rows)


def test_accuracy_beyond_the_base_rules(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = decision_list.report(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    rest = got[~got.base_failed]
    assert (rest.kept == (rest.quality == 1)).mean() > 0.97
    assert not got[got.base_failed].kept.any()


def test_rules_are_found_and_pruned():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(3000, 3))
    bad = (x[:, 0] > 0.8) & (x[:, 1] < 0.5) | (x[:, 2] > 0.9)
    rules = decision_list.learn(x, (~bad).astype(int), ["a", "b", "c"])
    caught = np.zeros(len(x), bool)
    for rule in rules:
        caught |= decision_list._covers(rule, x, ["a", "b", "c"])
    assert (caught == bad).mean() > 0.98 and len(rules) <= 5 and all(len(r) <= 3 for r in rules)


def test_list_order_in_sql(spark):
    C = decision_list.Condition
    rules = [(C("a", True, 2.0),), (C("a", True, 1.0), C("b", False, 5.0))]
    df = spark.createDataFrame([(3.0, 1.0), (1.5, 4.0), (1.5, 6.0), (0.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(decision_list.verdict(rules, {"a": F.col("a"), "b": F.col("b")})).collect()]
    assert got == [1, 2, None, None]


def test_large_vocabulary_path():
    words = [b"a", b"b", b"c"] * 2 + [b"d"]
    numbers = np.array([0, 1, 2, 0, 1, 2, 3])
    assert textstats.repeated_words(words, numbers, 4) == textstats.repeated_words(words, numbers, 1 << 22) == 6


def test_edges(spark, clashing, nothing, edge):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = decision_list.judge(clashing, decision_list.fit(clashing, labels))
    assert judged.columns.count("judged") == 1 and judged.count() == clashing.count()
    assert decision_list.report(nothing, labels).count() == 0

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from salesmart.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails_of(rows):
    """The letters every row fails."""
    out = []
    for doc, text, *_ in rows:
        t = text or ""
        w = WORD.findall(t)
        smaller = doc is not None and any(o is not None and o < doc and (x or "") == t for o, x, *_ in rows)
        out.append({f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), bool(set(t) & set("#$%&*|")), smaller)) if bad})
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    fails = fails_of(rows)
    out, shapley = [], Counter()
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            for k, letter in enumerate(order):
                alive = [(d, f) for d, f in own if not f & set(order[:k])]
                gone = [d for d, f in alive if letter in f]
                shapley[part, letter] += len(gone)
                out.append([part, "".join(order), k + 1, len(alive) - len(gone), len(gone), sum(letter in f for _, f in own) - len(gone),
                            sum(f == {letter} for _, f in own), sum(d in good and d is not None for d in gone), sum(d in toxic and d is not None for d in gone)])
    return sorted(tuple(r) + (shapley[r[0], r[1][r[2] - 1]],) for r in out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def made_rows():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)] + ["CAPS", "A&B", "Ünï", "日本"]
    rows = [(k, " ".join(rng.choices(words, k=rng.choice([5, 99, 100, 101, 160]))), rng.choice(["en", "de", None]), "s", 1) for k in range(60)]
    rows += [(100 + k, rng.choice(rows)[1], rng.choice(["en", "de"]), "s", 1) for k in range(40)]
    rows += [(200, "A" * 10 + "b" * 90, "en", "s", 1), (201, "A" * 10 + "b" * 89, "en", "s", 1), (202, "Äé" * 50, "fr", None, None)]
    return rows


LABELS = [(k, k % 2, (k + 1) % 3) for k in range(0, 130, 2)] + [(5, 1, 1), (5, 0, 0), (6, None, 1), (None, 1, 1), (9, 1, None)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("size", [1, 2_000, 1 << 20])
def test_against_brute_force(spark, labels, size):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert rows_of(A.report(docs, labels, size=size)) == brute(rows, LABELS)


def test_edge_rows_and_clashing_names(spark, clashing, edge_rows, labels):
    docs = clashing.withColumns({c: F.lit("mine") for c in ("shard", "words", "column", "id", "part", "n", "failed", "good", "digest", "step")})
    named = labels.withColumns({"text": F.lit("x"), "good": F.lit("y"), "id": F.lit("z")})
    assert rows_of(A.report(docs, named)) == brute(edge_rows, LABELS)


def test_empty_tables(spark, nothing, edge, edge_rows, labels):
    assert A.report(nothing, labels).count() == 0
    assert rows_of(A.report(edge, labels.limit(0))) == brute(edge_rows, [])
    assert A.report(edge.filter("text IS NULL"), labels).count() == 2 * 600


@pytest.mark.parametrize("bits", [63, 7])
def test_matrix_holds_every_word(spark, labels, bits):
    """Also where so few bits make many words share a hash."""
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    cut = A.shards(docs, size=3_000)
    known = A.dictionary(cut, bits).collect()
    words = {r.column: r.word for r in known}
    assert len(words) == len(known) == len({r.word for r in known}) and any(c < 0 for c in words) == (bits == 7)
    got = {}
    for r in A.matrix(cut, A.dictionary(cut, bits), bits).collect():
        for k, doc in enumerate(r.docs):
            at = slice(r.starts[k], r.starts[k + 1])
            got[doc.id] = Counter(dict(zip((words[c] for c in r.columns[at]), r.counts[at])))
    want = {doc: Counter(WORD.findall(text)) for doc, text, *_ in rows}
    assert got == want and cut.count() > 3
    sums = {r.id: (r.n_words, r.n_distinct) for r in A.row_sums(cut, A.dictionary(cut, bits), bits).collect()}
    assert sums == {doc: (c.total(), len(c)) for doc, c in want.items()}


def test_large_groups_of_copies_and_one_long_text(spark, labels):
    long = " ".join(f"x{k % 50_000}" for k in range(300_000))
    rows = [(k, "the same text", "en", "s", 1) for k in range(3_000)] + [(None, "the same text", "en", "s", 1), (5_000, long, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    first = {r.filter_order: r for r in A.report(docs, labels).filter("step = 1").collect()}
    assert first["EABCD"].removed == 2_999 and first["ABCDE"].removed == 3_001 and first["BACDE"].removed == 1 and first["CABDE"].removed == 0

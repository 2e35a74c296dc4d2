import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import source_audit as A

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least=10, top=10):
    """Rows are (text, lang, source)."""
    docs = [(lang or "", source or "", Counter(terms(text))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for a, _, c in docs if a == lang for t in c)
        kept = sorted(t for t, n in held.items() if n >= least)
        groups = {s: Counter() for a, s, _ in docs if a == lang}
        for a, s, c in docs:
            if a == lang:
                groups[s].update({t: n for t, n in c.items() if held[t] >= least})
        whole = sum(groups.values(), Counter())
        share = lambda c, t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, c in groups.items():
            pairs = [(sum(f(share(c, t), share(o, t)) for t in kept), b) for b, o in groups.items() if b != s]
            own = [(f(share(c, t), share(whole, t)), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items in (("pair", pairs), ("term", own)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def made_rows():
    rng = random.Random(9)
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdx", "abcdefgh", "abcdefghi", "abcdefghij", "Äpfel", "äpfel", "日本語文字", "日本", "the", "THE", "x" * 40, "x" * 40 + "y",
             "y" * 17, "y" * 16] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    rows = []
    for _ in range(150):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s1", "é", None])
        some = words if source != "s1" else words[:30]
        rows.append((" ".join(rng.choices(some, k=rng.randrange(0, 60))), lang, source))
    rows += [("only few words", "fr", "s0"), (None, "fr", "s1"), ("1234 !?", "xx", "s0"), (None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("size,first", [(1, 4), (3_000, 1), (1 << 20, 8)])
def test_against_brute_force(spark, size, first):
    rows = made_rows()
    assert rows_of(A.report(frame(spark, rows), size=size, first=first)) == brute(rows)


def test_other_threshold_and_top(spark):
    rows = made_rows()
    assert rows_of(A.report(frame(spark, rows), least=3, top=2)) == brute(rows, 3, 2)


def test_edge_rows_and_clashing_names(spark, clashing, edge_rows):
    docs = clashing.withColumns({c: F.lit("mine") for c in ("shard", "term", "prefix", "live", "n", "item", "value", "rank", "part", "docs", "all_n")})
    assert rows_of(A.report(docs, least=2)) == brute([(r[1], r[2], r[3]) for r in edge_rows], 2)


def test_empty_table_and_texts_without_terms(spark, nothing):
    assert A.report(nothing).count() == 0
    rows = [("1 2", "en", "a"), (None, "en", "b"), ("", "en", None)]
    assert rows_of(A.report(frame(spark, rows))) == brute(rows) and len(brute(rows)) == 6


def test_levels_drop_rare_prefixes(spark):
    rows = [("abcdefgh" if k < 12 else "abcdxy", "en", "a") for k in range(15)] + [("zzzzz", "en", "a")] * 9 + [("abcd zzzzz", "de", "a")] * 2
    now = A.shards(frame(spark, rows).select("lang", "source", "text"))
    seen = A.level(now, 4)
    docs = sorted(r.n for r in seen.groupBy("key").agg(F.sum("docs").alias("n")).collect())
    assert docs == [2, 2, 9, 15]  # a complete term and prefixes of two languages
    step = A.refined(now, seen.join(seen.groupBy("key").agg(F.sum("docs").alias("n")).filter("n = 15"), "key").select("shard", "no"), 4)
    assert {t for r in step.collect() for t in bytes(r.terms).split()} == {b"abcdefgh", b"abcdxy"}
    kept = A.kept_terms(now, first=2).collect()
    assert [(r.lang, bytes(r.term), r.all_n) for r in kept] == [("en", b"abcdefgh", 12)]


def test_terms_of_one_key_are_told_apart(spark, monkeypatch):
    """With one key for all prefixes nothing is dropped by it, and the result is the same."""
    rows = made_rows()
    want = brute(rows)
    monkeypatch.setattr(A, "_keys", lambda langs, lang, cut, done: np.zeros(len(cut), np.int64))
    assert rows_of(A.report(frame(spark, rows), size=3_000)) == want


def test_long_terms_and_texts(spark):
    long = "q" * 5_000
    rows = [(f"{long} {'w ' * 20_000}", "en", s) for s in "ab" * 6] + [(long + "r", "en", "a")] * 3
    assert rows_of(A.report(frame(spark, rows))) == brute(rows)


def test_exact_beyond_64_bits(spark):
    n, total, v = 40_000_000_000, 90_000_000_001, 12345
    df = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    p = df.select(A._share(F.col("n"), F.col("total"), F.col("v"))).first()[0]
    assert p == 1 + 10**9 * (n + 2) // (total + 2 * v)


def test_prefixes_are_not_written_before_they_are_counted(spark, monkeypatch):
    written, keep = [], A.materialize
    monkeypatch.setattr(A, "materialize", lambda df, name: written.append(name) or keep(df, name))
    rows = [(f"common{'x' * 20} rare{k}", "en", "a") for k in range(12)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    kept = A.kept_terms(A.shards(docs.select("lang", "source", "text")))
    assert sorted((bytes(r.term), r.all_n) for r in kept.collect()) == [(b"common" + b"x" * 20, 12), (b"rare", 12)]
    assert set(written) == {"term-shards", "refined", "kept-terms"}


def test_rows_of_a_shard_are_bounded(spark):
    """A shard's rows, and those of what is kept of it, stay small however large the shard is; prefixes are not parted."""
    rng = random.Random(10)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=rng.randrange(3, 30))) for _ in range(3_000)]
    words += [w[:8] + letters[k % 26] * 9 for k, w in enumerate(words)]
    rows = [(" ".join(rng.choices(words, k=400)), "en", rng.choice("abc")) for _ in range(120)]
    docs = frame(spark, rows).coalesce(1).select("lang", "source", "text")
    now = A.shards(docs, part=8 << 10)
    size = sum((F.octet_length(c) for c in ("terms", *A._NUMBERS)), F.lit(0))
    sizes = [r[0] for r in now.select(size).collect()]
    assert len(sizes) > 20 and max(sizes) < 24 << 10
    prefixes = [{t[:8] for t in bytes(r.terms).split()} for r in now.collect()]
    assert sum(map(len, prefixes)) == len(set().union(*prefixes))
    live = A.level(now, 8).select("shard", "no")
    assert max(len(x or []) if isinstance(x, list) else len(x or b"") for r in A.refined(now, live, 8).collect() for x in r if not isinstance(x, int)) < 24 << 10
    assert rows_of(A.report(frame(spark, rows))) == brute(rows)

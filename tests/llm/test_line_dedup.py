import random
import re
from collections import Counter

import duckdb
import pytest

from salesmart.llm import line_dedup
from salesmart.llm.queries import SQL

HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")


def cut(text):
    """Pieces: each line with a word and the blank lines after it."""
    out = []
    for line in text.split("\n"):
        if HAS_WORD.search(line) or not out:
            out.append(line)
        else:
            out[-1] += "\n" + line
    return out


def brute(rows, lines=3, long=250):
    """Text left per (id, text), by comparing all runs in order; ids must differ between different texts."""
    seen, left = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        if text is None or not HAS_WORD.search(text):
            left[doc, text] = text
            continue
        raw = cut(text)
        p = [x.strip(" \t\n\x0b\x0c\r") for x in raw]
        size, dead = min(lines, len(p)), set()
        runs = [(s, size) for s in range(len(p) - size + 1)] + [(s, 1) for s in range(len(p)) if len(p[s]) >= long]
        for s, n in sorted(set(runs)):
            if seen.setdefault(tuple(p[s:s + n]), (doc, s)) != (doc, s):
                dead |= set(range(s, s + n))
        left[doc, text] = "\n".join(x for k, x in enumerate(raw) if k not in dead)
    return left


def compare(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(df, **options).collect())
    left = brute(rows, **options)
    assert got == Counter((d, left[d, t]) for d, t in rows)


def test_random_texts_against_brute_force(spark):
    rng = random.Random(12)
    rows = []
    for k in range(150):
        lines = [rng.choice(["a", "b", " b\t", "c", "", "", " ", "d e", "x" * 260]) for _ in range(rng.randrange(0, 14))]
        rows.append((rng.choice([k, k, None]) if k % 50 == 0 else k, "\n".join(lines)))
    rows += [rows[3], rows[3], (900, None), (901, "\n\n lead\nb\nc\nd e"), (902, "lead\nb\nc\nd e"), (903, "\n".join(f"l{k}" for k in range(5000))), (904, "\n".join(f"l{k}" for k in range(1, 5000)))]
    nulls = [r for r in rows if r[0] is None]
    rows = [r for r in rows if r[0] is not None] + nulls[:1]
    compare(spark, rows)
    compare(spark, rows, lines=2, long=10)


def test_equal_winnowed_hashes_pick_the_same_line():
    """Equal windows select the same piece, wherever they stand."""
    rng = random.Random(1)
    hashes = [rng.randrange(5) for _ in range(200)]
    picked = {}
    for s in range(len(hashes) - 2):
        window = tuple(hashes[s:s + 3])
        k = max(range(3), key=lambda i: (-window[i], i))
        assert picked.setdefault(window, k) == k


def test_report_against_sql(spark, documents, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.sql("SELECT doc_id, n_lines, n_deleted, text FROM (" + SQL["op8_line_dedup"] + ")").fetchall())
    assert sorted(tuple(r) for r in line_dedup.report(documents).collect()) == want


def test_no_python_in_the_plan(documents):
    assert not re.search("Python|Pandas|Arrow|MapIn", line_dedup.report(documents)._jdf.queryExecution().toString())


@pytest.mark.parametrize("counts", [False, True])
def test_edges(edge, clashing, nothing, edge_rows, counts):
    assert line_dedup.dedup_lines(edge, counts=counts).count() == len(edge_rows)
    got = line_dedup.dedup_lines(clashing, counts=counts)
    assert got.columns == clashing.columns
    texts = {r.doc_id: r.text for r in got.collect() if r.doc_id not in (5, 9, None)}
    assert texts[6] == "" and texts[1] is None and texts[3] == " \n\t " and texts[14] == "z\ny"
    assert line_dedup.report(nothing).count() == 0

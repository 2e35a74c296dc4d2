import random

import xxhash
from pyspark.sql import functions as F

from salesmart.llm import simhash
from salesmart.llm.components import connected_components
from tests.llm.conftest import rows_of


def fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64(b" ".join(words[k:k + n]), seed=42).intdigest() for k in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=3):
    """Smallest index reachable, by comparing all pairs."""
    parent = list(range(len(prints)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(k) for k in range(len(prints))]


def expected(rows):
    """(doc_id, fingerprint, component) of rows (doc_id, text); null ids name nothing."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [fingerprint(t) for _, t in rows]
    return sorted(((r[0], f"{p:016x}", rows[g][0]) for r, p, g in zip(rows, prints, groups(prints))), key=str)


def test_report_against_brute_force(documents):
    got = sorted((tuple(r) for r in simhash.report(documents).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in documents.collect()])


def test_edges(edge, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows]
    got = sorted((tuple(r) for r in simhash.report(edge).collect()), key=str)
    assert got == expected(rows)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_of_crowded_shards(spark):
    """Small trees force shards to be cut again; components stay those of all pairs."""
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for c in centres for _ in range(90)}
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(100)} | {0, 1, 7, (1 << 64) - 1}, key=signed)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for size in (4, 2048):
        roots = {r.node: r.root for r in connected_components(simhash.near_links(df, 3, size)).collect()}
        got = [roots.get(signed(p), signed(p)) for p in prints]
        assert got == [signed(prints[g]) for g in groups(prints)]


def test_masks_keep_every_near_pair():
    rng = random.Random(2)
    for n in (2, 10**7, 10**9, 10**12):
        masks = simhash.masks_for(n, 3)
        for _ in range(200):
            flips = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(flips & m == 0 for m in masks)


def test_tree_finds_all_within_radius():
    rng = random.Random(3)
    base = rng.getrandbits(64)
    values = list({base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(200)})
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        assert sorted(tree.within(v, 3)) == [k for k, w in enumerate(values) if (v ^ w).bit_count() <= 3]


def test_components_of_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(5)
    got = connected_components(links).collect()
    assert len(got) == 300 and {r.root for r in got} == {0}


def test_one_per_group(edge, edge_rows, clashing, documents):
    kept = rows_of(simhash.one_per_group(documents), "doc_id")
    assert kept == sorted({(c,) for _, _, c in expected([(r.doc_id, r.text) for r in documents.collect()])}, key=lambda r: (False, str(r[0])))
    got = simhash.one_per_group(clashing)
    assert got.columns == clashing.columns
    rows = sorted([(r[0], r[1]) for r in edge_rows], key=lambda r: (r[0] is None, r[0] or 0))
    prints = [fingerprint(t) for _, t in rows]
    assert got.count() == len(set(groups(prints)))


def test_empty(nothing):
    assert simhash.report(nothing).count() == 0 and simhash.one_per_group(nothing).count() == 0

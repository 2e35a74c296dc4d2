"""SimHash near-dedup with BK-trees.

A fingerprint has a bit for each bit that is set in over half of the hashes of
a text's word shingles.  Equal fingerprints fold into one; of different ones,
those within ``RADIUS`` bits are linked, and links make groups.

Two fingerprints within r bits agree on one of r + 1 blocks, so every
fingerprint goes to one shard per block (or per choice of blocks, when more
fingerprints ask for finer keys), and each shard's fingerprints are looked up
in the shard's BK-tree: children are keyed by their distance to the parent, and
only edges within the radius are followed.  The tree is built where the
shard's queries arrive and dies with the task; nothing that grows with the
corpus is broadcast or collected.  A shard above ``TREE`` fingerprints is cut
further by blocks of its remaining bits, again without losing a pair.  A shard
returns a forest, at most one link per fingerprint, never all pairs.

Defined cases: null, empty and word-less texts have the fingerprint zero and
are linked like any other.  A null id never names a group unless the group has
no other; repeated rows are documents of one group.  Other columns pass
through, and a column named like a result is replaced.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import connected_components
from salesmart.llm.words import utf8
from salesmart.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
ALL = (1 << 64) - 1

#: Fingerprints in one shard's tree, at most, and how often a larger shard is cut again.  After
#: three cuts a shard's fingerprints agree on 44 bits, so no tree can hold more than 2 ** 20.
TREE = 2048
SPLITS = 3
#: Fingerprints a shard has on average, at most, when keys are evenly filled.
SHARD = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one text, as a signed 64-bit integer."""
    words = text.lower().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(words[k:] for k in range(n))))
    hashes = np.fromiter(map(_xxh64, shingles), np.uint64, len(words) - n + 1)
    counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def _xxh64(shingle: bytes) -> int:
    return xxhash.xxh64_intdigest(shingle, SEED)


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in utf8(texts)], pa.int64())

    return F.arrow_udf(batch, "long")(text.cast("string"))


class BKTree:
    """Unsigned fingerprints in a tree; a child hangs on the edge of its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Insert a value that is not in the tree; its number."""
        self.values.append(value)
        self.edges.append({})
        number = len(self.values) - 1
        at = 0
        while number:
            distance = (self.values[at] ^ value).bit_count()
            below = self.edges[at].get(distance)
            if below is None:
                self.edges[at][distance] = number
                break
            at = below
        return number

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of all values within ``radius`` bits."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            for edge, below in self.edges[at].items():
                if distance - radius <= edge <= distance + radius:
                    todo.append(below)
        return found


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within ``radius`` bits, at most one per value; values are signed."""
    tree, parent, links = BKTree(), [], []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for value in values:
        unsigned = value & ALL
        near = tree.within(unsigned, radius)
        number = tree.add(unsigned)
        parent.append(number)
        for k in near:
            a, b = root(number), root(k)
            if a != b:
                parent[a] = b
                links.append((value, values[k]))
    return links


def _blocks(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` nearly equal runs of the given bits."""
    cuts = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def masks_for(n: int, radius: int) -> list[int]:
    """Masks of which two fingerprints within ``radius`` bits agree on one at least; finer for more fingerprints."""
    wanted = math.log2(max(n, 2) / SHARD)
    blocks = radius + 1
    while 64 * (blocks - radius) / blocks < wanted and blocks < 16:
        blocks += 1
    parts = _blocks(list(range(64)), blocks)
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _finer(mask: int, radius: int) -> list[int]:
    """Masks that contain ``mask`` and a block of the other bits."""
    return [mask | part for part in _blocks([b for b in range(64) if not mask >> b & 1], radius + 1)]


def near_links(prints: DataFrame, radius: int = RADIUS, tree_size: int = TREE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``; same components as all pairs within ``radius`` bits."""
    masks = [_signed(m) for m in masks_for(prints.count(), radius)]
    rows = prints.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    ready = []
    for depth in range(SPLITS + 1):
        counts = rows.groupBy("mask", "key").count().filter("count > 1")
        large = materialize(counts.filter(F.col("count") > tree_size).drop("count"), "large-shards")
        used = [r["mask"] for r in large.select("mask").distinct().collect()]  # a few of the masks
        if not used or depth == SPLITS:
            ready.append(rows)
            break
        rows = materialize(rows, "shard-rows")
        ready.append(rows.join(large, ["mask", "key"], "left_anti").select(rows.columns))
        finer = prints.sparkSession.createDataFrame(
            [(m, [_signed(x) for x in _finer(m & ALL, radius)]) for m in used], "mask long, finer array<long>")
        crowded = rows.join(large, ["mask", "key"], "left_semi").join(F.broadcast(finer), "mask")
        rows = crowded.select("fp", F.explode("finer").alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    everything = ready[0]
    for part in ready[1:]:
        everything = everything.unionByName(part)

    def link(batches):
        shard, values = None, []

        def close():
            links = forest(values, radius)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

        for batch in batches:
            keys = zip(batch.column("mask").to_pylist(), batch.column("key").to_pylist(), batch.column("fp").to_pylist())
            for mask, key, fp in keys:
                if (mask, key) != shard:
                    if len(values) > 1:
                        yield close()
                    shard, values = (mask, key), []
                values.append(fp)
        if len(values) > 1:
            yield close()

    together = everything.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return together.select("mask", "key", "fp").mapInArrow(link, "a long, b long")


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, first) for rows (fp, name): ``first`` is the smallest name of the fingerprint's component."""
    known = materialize(prints.groupBy("fp").agg(F.min("name").alias("name")), "prints")
    roots = connected_components(near_links(known.select("fp"), radius))
    rooted = known.join(roots, known["fp"] == roots["node"], "left")
    rooted = materialize(rooted.select("fp", "name", F.coalesce("root", "fp").alias("root")), "rooted")
    firsts = materialize(rooted.groupBy("root").agg(F.min("name").alias("first")), "firsts")
    return materialize(rooted.join(firsts, "root").select("fp", "first"), "components")


def _name(id_col: str, *ties: str) -> Column:
    """Sorts by id, null last."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), *[F.col(t) for t in ties])


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id."""
    marked = docs.withColumn("_llm_fp", fingerprints(F.col(text_col), shingle)).withColumn("_llm_row", F.monotonically_increasing_id())
    marked = materialize(marked, "marked")
    named = marked.select(F.col("_llm_fp").alias("fp"), _name(id_col, "_llm_row").alias("name"))
    kept = components(named, radius).select(F.col("first._llm_row").alias("_llm_row")).distinct()
    return marked.join(kept, "_llm_row", "left_semi").select(docs.columns)


def report(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint in hexadecimal and component_id of every document."""
    prints = materialize(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")
    groups = components(prints.select("fp", _name("doc_id").alias("name")), radius)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(groups, "fp").select("doc_id", text.alias("fingerprint"), F.col("first.id").alias("component_id"))

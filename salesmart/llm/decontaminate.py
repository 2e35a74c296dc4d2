"""Benchmark decontamination: a broadcast set of normalised test n-grams against every document.

The benchmark's word windows go into one hash table, whose size is checked
before it is broadcast.  Each task walks its documents' words; a position is
looked up only where enough consecutive words occur in the benchmark at all,
and a hit compares the whole window, not a hash of it.  Beyond the bound the
same windows are joined by a shuffle instead, so nothing grows on the driver.

Defined cases: a null or word-less document has no words and is never
contaminated.  An item without words has no window.  An item shorter than the
window is one window of all its words.  Items repeated under one id count
once; a window of an item with a null id hits, but is counted under no id.
Every document row gets its own result, repeated rows alike; other columns
pass through, and a column named like a result is replaced.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.words import NORMAL, normal_words, utf8
from salesmart.session import materialize

WINDOW = 13

#: Windows and bytes of windows that may be broadcast: about 100 MB in a Python worker at most.
MAX_WINDOWS, MAX_BYTES = 500_000, 64 << 20

FOUND = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:long,end:long>>"
_FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
WINDOWS = "item_id string, size int, win binary"


def _windows_of(words: list[bytes], n: int) -> list[bytes]:
    n = min(n, len(words))
    return [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if n else []


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, size, win) of a benchmark; ``win`` is the window's words, space-joined."""

    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = normal_words(text)
                rows += [(item, min(n, len(words)), w) for w in _windows_of(words, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.binary())], ["item_id", "size", "win"])

    narrow = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(cut, WINDOWS).distinct()


def _merge(starts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of [start, end) word ranges."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _result(n_words: int, found: list[tuple[int, int, list]]) -> dict:
    spans = _merge([(s, e) for s, e, _ in found])
    ids = sorted({i for _, _, items in found for i in items if i is not None})
    return {"n_words": n_words, "n_hit": sum(e - s for s, e in spans), "item_ids": ids,
            "spans": [{"start": s, "end": e} for s, e in spans]}


def _scan(table: dict[bytes, list], sizes: list[int], vocabulary: dict[bytes, int], words: list[bytes]) -> list:
    """(start, end, item ids) of every window of ``table`` that occurs in ``words``."""
    known = np.fromiter(map(vocabulary.get, words, repeat(0)), np.int64, len(words))
    total = np.concatenate(([0], np.cumsum(known)))
    found = []
    for size in sizes:
        if size <= len(words):
            for s in np.flatnonzero(total[size:] - total[:-size] == size).tolist():
                items = table.get(b" ".join(words[s:s + size]))
                if items is not None:
                    found.append((s, s + size, items))
    return found


def find_windows(docs: DataFrame, windows: DataFrame, text_col: str = "text", into: str = "found",
                 max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` with a struct column ``into`` (:data:`FOUND`); spans are word ranges, end exclusive."""
    windows = materialize(windows, "benchmark-windows")
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("win")), F.lit(0))).first()
    if n > max_windows or size > max_bytes:
        return _find_by_join(docs, windows, text_col, into)
    table: dict[bytes, list] = {}
    for row in windows.collect():
        table.setdefault(bytes(row.win), []).append(row.item_id)
    sizes = sorted({w.count(b" ") + 1 for w in table})
    vocabulary = {x: 1 for w in table for x in w.split(b" ")}
    shared = docs.sparkSession.sparkContext.broadcast((table, sizes, vocabulary))

    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        table, sizes, vocabulary = shared.value
        rows = []
        for text in utf8(texts):
            words = normal_words(text)
            rows.append(_result(len(words), _scan(table, sizes, vocabulary, words)))
        return pa.array(rows, _FOUND_ARROW)

    return docs.withColumn(into, scan(F.col(text_col).cast("string")))


def _find_by_join(docs: DataFrame, windows: DataFrame, text_col: str, into: str) -> DataFrame:
    """The same result without a broadcast: windows of both sides meet in a shuffle join.

    Rows are told apart by a hash of their text, so equal texts are scanned
    and joined once.
    """
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # 13 values at most

    def cut(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = normal_words(text)
                for size in sizes:
                    wins = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(wins), pa.binary()), pa.array(range(len(wins)), pa.int64()),
                         pa.array([size] * len(wins), pa.int32()), pa.array(wins, pa.binary())],
                        ["key", "start", "size", "win"])

    keyed = docs.withColumn("_llm_key", F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)))
    texts = keyed.select("_llm_key", F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).dropDuplicates(["_llm_key"])
    cuts = texts.mapInArrow(cut, "key binary, start long, size int, win binary")
    hits = materialize(
        cuts.join(windows, ["size", "win"]).groupBy(F.col("key").alias("_llm_key")).agg(
            F.collect_set("item_id").alias("_llm_items"),
            F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end"))).alias("_llm_at")),
        "benchmark-hits")

    @F.arrow_udf(FOUND)
    def close(texts: pa.Array, at: pa.Array, items: pa.Array) -> pa.Array:
        rows = []
        for text, spans, ids in zip(utf8(texts), at.to_pylist(), items.to_pylist()):
            rows.append(_result(len(normal_words(text)), [(x["start"], x["end"], ids) for x in spans or []]))
        return pa.array(rows, _FOUND_ARROW)

    joined = keyed.join(hits, "_llm_key", "left")
    closed = joined.withColumn(into, close(F.col(text_col).cast("string"), "_llm_at", "_llm_items"))
    return closed.select(*[F.col(f"`{c}`") for c in docs.columns if c != into], into)


def is_contaminated(found: Column) -> Column:
    """At least a twentieth of the words lies in benchmark windows."""
    return (found["n_hit"] > 0) & (found["n_hit"] * 20 >= found["n_words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` without its contaminated documents; the others are left as they are."""
    found = find_windows(docs, benchmark_windows(benchmark, n), text_col, "_llm_found")
    return found.filter(~is_contaminated(F.col("_llm_found"))).drop("_llm_found")


def _without(text: bytes, spans: list[dict]) -> str:
    """The text without the word ranges, from each range's first byte to its last."""
    normal, ends, at = text.translate(NORMAL), [], 0
    for word in normal.split():
        at = normal.index(word, at)
        ends.append((at, at + len(word)))
        at += len(word)
    out, last = [], 0
    for span in spans:
        out.append(text[last:ends[span["start"]][0]])
        last = ends[span["end"] - 1][1]
    return (b"".join(out) + text[last:]).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` with every benchmark window cut out of its text; nothing else changes."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        kept = [None if raw is None else _without(text, s) if s else raw
                for raw, text, s in zip(texts.to_pylist(), utf8(texts), spans.to_pylist())]
        return pa.array(kept, pa.string())

    found = find_windows(docs, benchmark_windows(benchmark, n), text_col, "_llm_found")
    return found.withColumn(text_col, cut(F.col(text_col).cast("string"), F.col("_llm_found.spans"))).drop("_llm_found")


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of a sorted array of ids, comma-joined."""
    return F.sha2(F.concat_ws(",", ids), 256)


def digest(ids: list[str]) -> str:
    """What :func:`ids_digest` gives, for tests."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, words hit, items found and the verdict."""
    found = find_windows(docs.select(id_col, text_col), benchmark_windows(benchmark, n), text_col)
    f = F.col("found")
    return found.select(
        id_col, f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"), F.size(f["item_ids"]).cast("long").alias("n_items"),
        ids_digest(f["item_ids"]).alias("items_sha256"), is_contaminated(f).alias("contaminated"))

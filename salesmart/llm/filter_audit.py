"""Filter interaction audit on a sparse document-term matrix.

What each of five filters removes depends on the filters before it.  The audit
counts that for all 120 orders from one matrix: tasks cut their documents into
shards of bounded size, each with a dictionary of its own, and write them as
rows in CSR form (row starts, columns, counts).  The words of all shards make
one global dictionary.  A word's number is its 64-bit hash without the sign, so
a shard translates its own codes without a join; the dictionary has every
distinct word once and shows whether two share a number, and words that do get
negative numbers of their own.  Sums of a row and its number of nonzero columns
are a document's words and distinct words.  Texts stay where they are read.

Documents then fold into cells (part, failed filters, labels), at most 128 for
a part, and only those meet the orders.  Copies of a text fold by its digest
before they are compared, so a group of any size is one row a task.

Defined cases: a null text is empty, a null part the empty string.  An empty
text fails A only, and E beside a smaller id.  A null id has no smaller one and
is none, so it neither fails E nor lets others fail.  Rows of one id with the
same text, however often, do not fail each other.  A label counts if any label
row of the id has it.  An empty table gives no row.  Other columns are ignored,
whatever their names.  Texts of any length are one row of one shard.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.packed import pack, unpack
from salesmart.llm.words import split_words, utf8
from salesmart.operators.ranking import with_rank
from salesmart.session import materialize

#: Bytes of text of a shard, at least (the last document may go beyond it).
SHARD = 8 << 20

#: Bits of a word's number, and words whose hash another has, at most: as good as none at 63 bits, however many words.
BITS, EXCEPTIONS = 63, 1_000_000

FILTERS = "ABCDE"
CAPITALS, SYMBOLS = bytes(range(65, 91)), b"#$%&*|"
_FOLLOWING = bytes(range(128, 192))  # bytes of a character after its first

_DOC = "digest binary, n_chars long, n_capitals long, n_symbols long"


class _Shard:
    """Rows of one shard, its own dictionary and its documents' own columns."""

    def __init__(self):
        self.code: dict[bytes, int] = {}
        self.indices: list[int] = []
        self.counts: list[int] = []
        self.starts = [0]
        self.own: list[tuple] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = Counter(split_words(text))
        code = self.code
        self.indices += [code.setdefault(w, len(code)) for w in words]
        self.counts += words.values()
        self.starts.append(len(self.indices))
        n_chars = len(text.translate(None, _FOLLOWING))
        self.own.append((hashlib.sha256(text).digest(), n_chars, len(text) - len(text.translate(None, CAPITALS)), len(text) - len(text.translate(None, SYMBOLS))))
        self.size += len(text)


def shards(docs: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text", size: int = SHARD) -> DataFrame:
    """CSR shards of the documents' words, each with its own dictionary ``words``, joined by blanks (written once).

    Packed arrays: ``starts`` has the first entry of every row and the end of
    the last, ``indices`` the column of every entry (a place in ``words``),
    ``counts`` its count.  ``docs`` has each row's id, part and counts of
    characters.
    """
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.col(text_col).cast("string").alias("text"))
    id_kind = given.schema["id"].dataType.simpleString()

    def cut(batches):
        shard, ids, parts = _Shard(), [], []

        def row():
            own = list(zip(*shard.own))
            docs = pa.StructArray.from_arrays(
                [pa.concat_arrays(ids), pa.concat_arrays(parts), pa.array(own[0], pa.binary()), *[pa.array(c, pa.int64()) for c in own[1:]]],
                names=["id", "part", "digest", "n_chars", "n_capitals", "n_symbols"])
            columns = {
                "words": pa.array([b" ".join(shard.code).decode()]), "starts": pa.array([pack(np.array(shard.starts))]),
                "indices": pa.array([pack(np.array(shard.indices, np.int64))]), "counts": pa.array([pack(np.array(shard.counts, np.int64))]),
                "docs": pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)}
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            first = 0
            texts = utf8(batch.column(2))
            for k, text in enumerate(texts):
                shard.add(text)
                if shard.size >= size or k + 1 == len(texts):
                    ids.append(batch.column(0).slice(first, k + 1 - first))
                    parts.append(batch.column(1).slice(first, k + 1 - first))
                    first = k + 1
                if shard.size >= size:
                    yield row()
                    shard, ids, parts = _Shard(), [], []
        if shard.own:
            yield row()

    schema = f"words string, starts binary, indices binary, counts binary, docs array<struct<id: {id_kind}, part: string, {_DOC}>>"
    return materialize(given.mapInArrow(cut, schema), "shards")


def _number(word: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(word, 42) & ((1 << bits) - 1)


def dictionary(cut: DataFrame, bits: int = BITS) -> DataFrame:
    """Every word of the shards once, with its global number ``column`` (written once).

    Of words that share a hash, which next to never happens with 63 bits, each
    gets a negative number instead.  (Distinct words are shuffled once per
    task that met them; nothing else of the texts is.)
    """
    every = cut.select(F.explode(F.split("words", " ")).alias("word")).filter("word <> ''").distinct()
    hashed = materialize(every.withColumn("column", F.xxhash64("word").bitwiseAND(F.lit((1 << bits) - 1))), "words")
    shared = materialize(hashed.groupBy("column").count().filter("count > 1").select("column"), "shared-numbers")
    if shared.isEmpty():
        return hashed
    alike = with_rank(hashed.join(shared, "column", "left_semi"), F.col("word"), name="_rank")
    return hashed.join(shared, "column", "left_anti").unionByName(alike.select("word", (-F.col("_rank")).alias("column")))


def _exceptions(words: DataFrame) -> dict[bytes, int]:
    """Numbers of the words that share a hash; an error beyond :data:`EXCEPTIONS`, which 63 bits do not come near."""
    own = words.filter("column < 0")
    if (n := own.count()) > EXCEPTIONS:
        raise ValueError(f"{n} words share a hash with another")
    return {r.word.encode(): r.column for r in own.collect()}


def _global_rows(batches, exceptions: dict[bytes, int], bits: int):
    """(batch, row number, row starts, global columns, counts) of every shard."""
    for batch in batches:
        for k in range(batch.num_rows):
            words = batch.column("words")[k].as_py().encode().split(b" ")
            numbers = np.fromiter((exceptions.get(w) or _number(w, bits) for w in words), np.int64, len(words))
            starts, indices, counts = (unpack(batch.column(c)[k].as_py()) for c in ("starts", "indices", "counts"))
            yield batch, k, starts, numbers[indices], counts


def matrix(cut: DataFrame, words: DataFrame, bits: int = BITS) -> DataFrame:
    """The shards with global columns: ``starts``, ``columns`` and ``counts`` of a sparse document-term matrix, and ``docs``."""
    exceptions = _exceptions(words)

    def renumber(batches):
        for batch, k, starts, columns, counts in _global_rows(batches, exceptions, bits):
            arrays = [pa.array([a], pa.list_(pa.int64())) for a in (starts, columns, counts)]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("docs").slice(k, 1)], ["starts", "columns", "counts", "docs"])

    docs_kind = cut.schema["docs"].dataType.simpleString()
    return cut.mapInArrow(renumber, f"starts array<long>, columns array<long>, counts array<long>, docs {docs_kind}")


def row_sums(cut: DataFrame, words: DataFrame, bits: int = BITS) -> DataFrame:
    """A row per document of the matrix: its own columns, ``n_words`` (sum of its row) and ``n_distinct`` (nonzero columns)."""
    exceptions = _exceptions(words)

    def add(batches):
        for batch, k, starts, columns, counts in _global_rows(batches, exceptions, bits):
            docs = batch.column("docs")[k].values
            row = np.repeat(np.arange(len(docs)), np.diff(starts))
            sums = np.bincount(row, weights=counts, minlength=len(docs)).astype(np.int64)  # exact below 2^53
            order = np.lexsort((columns, row))
            new = np.ones(len(order), bool)
            new[1:] = (row[order][1:] != row[order][:-1]) | (columns[order][1:] != columns[order][:-1])
            nonzero = np.bincount(row[order][new], minlength=len(docs))
            yield pa.RecordBatch.from_arrays(
                [*docs.flatten(), pa.array(sums), pa.array(nonzero, pa.int64())], [*[f.name for f in docs.type], "n_words", "n_distinct"])

    fields = cut.schema["docs"].dataType.elementType
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return cut.mapInArrow(add, f"{kinds}, n_words long, n_distinct long")


def failed_by_text(rows: DataFrame) -> Column:
    """Bits of the filters A to D that a document fails."""
    fails = [
        F.col("n_words") < 100, 100 * F.col("n_distinct") < 80 * F.col("n_words"),
        100 * F.col("n_capitals") > 10 * F.col("n_chars"), F.col("n_symbols") > 0,
    ]
    return sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)), F.lit(0))


def label_flags(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, good, toxic) of every labelled id."""
    has = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    return labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(has("quality").alias("good"), has("toxic").alias("toxic"))


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by (part, failed, good, toxic): ``failed`` has a bit for each of the five filters."""
    once = rows.withColumn("failed", failed_by_text(rows)).groupBy("id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("m"))
    known = once.join(labels, "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # An id has one row in a group here, so the smallest struct is the smallest id with its number of rows.
    copies = known.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("m").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("m"))), F.lit(0)).alias("no_id"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "m"))).alias("least"))
    first = F.col("least.id") == F.min("least.id").over(Window.partitionBy("digest"))
    passes = F.col("no_id") + F.when(first, F.col("least.m")).otherwise(F.lit(0))
    split = copies.withColumn("_passes", passes).select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("failed"), F.col("_passes").alias("n")),
        F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - F.col("_passes")).alias("n")))).alias("c"))
    return split.select("part", "good", "toxic", "c.*").filter("n > 0").groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def _steps() -> Column:
    """The 600 steps of all orders as an array of (filter_order, step, bit, before)."""
    rows = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(f) for f in order]
        rows += [("".join(order), k + 1, bits[k], sum(bits[:k])) for k in range(len(bits))]
    names = ("filter_order", "step", "bit", "before")
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return F.from_json(F.lit(text), "array<struct<filter_order: string, step: int, bit: int, before: int>>")


def audit(counted: DataFrame) -> DataFrame:
    """Every part, order and step with its counts, from the documents by cell."""
    each = counted.withColumn("_s", F.explode(_steps())).select("*", "_s.*").drop("_s")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    alive = F.col("failed").bitwiseAND(F.col("before")) == 0
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    steps = each.groupBy("part", "filter_order", "step", "bit").agg(
        total(alive & ~fails).alias("kept"), total(alive & fails).alias("removed"), total(~alive & fails).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(alive & fails & F.col("good")).alias("good_lost"), total(alive & fails & F.col("toxic")).alias("toxic_lost"))
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text", size: int = SHARD) -> DataFrame:
    """The audit of whole tables: one row per part, order of the five filters, and step."""
    cut = shards(docs, id_col, part_col, text_col, size)
    rows = row_sums(cut, dictionary(cut))
    return audit(cells(rows, label_flags(labels, id_col)))

"""Source divergence audit by iceberg prefix refinement.

How much the words of a source differ from those of the other sources of its
language, over the terms that enough documents of the language hold.  Which
terms those are is found by extending byte prefixes: a level counts the
distinct documents of every prefix, drops those below the threshold, and only
what extends a remaining prefix goes on to the next, twice as long.  A term not
longer than the level's length is complete there: its own documents decide
whether it is kept.  So rare terms go early, as prefixes of a few bytes.

The documents of a task are a shard of bounded size, sorted by language and
term, with the documents of each term; a prefix's documents in a shard are
counted there (documents lie in one shard, so shards add up), and a shuffle
sees one row of numbers per shard and prefix: its 64-bit key and its place in
the shard.  What remains is joined back by key and by shard; a shard shrinks
from level to level and is written each time.  A shard is written in parts of
bounded size, cut where the first level's prefix changes, so that each part is
a shard of its own to all levels and no reader or writer holds many of them at
once.  Two prefixes of one key, if they
ever occur, keep each other alive: the terms that reach the end are counted
once more by their own bytes, which decides.

Kept terms then give their counts by source.  A language's sources are compared
term by term in blocks of an array, one partial sum for each pair of sources
and task.  All arithmetic is exact: divisions are integral, products of
decimals or of integers whose size is checked.

Defined cases: null text, language and source are the empty string.  Every row
is a document, repeated rows and ids too.  A group without terms has counts of
zero, a language without kept terms values of zero.  Ties of value rank by the
item's bytes.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.packed import pack, unpack
from salesmart.llm.words import utf8
from salesmart.session import materialize

#: Documents a kept term occurs in, at least; bytes of the first level's prefixes; ranks of the term part.
LEAST, FIRST, TOP = 10, 8, 10

#: Bytes of text of a shard, at least (the last document may go beyond it).
SHARD = 16 << 20

#: Bytes of terms and postings of a shard's part, about (the last prefix's terms may go beyond it).
PART = 256 << 10

#: Documents whose texts are held as bytes at a time.
TEXTS = 512

#: Scale of a share.
SCALE = 1_000_000_000

#: Maps A-Z to a-z, keeps a-z and every byte of a non-ASCII character, blanks the rest.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text, lower-cased, in order."""
    return text.translate(LETTERS).split()


#: A part of a shard: its languages, sources and terms (joined by blanks), then packed numbers: each document's source, each term's language and the
#: end of its postings, and each posting's document and count.
_STRINGS, _NUMBERS = ("langs", "sources"), ("source", "lang", "ends", "doc", "count")
_SHARD = "shard long, langs array<string>, sources array<string>, terms binary, " + ", ".join(f"{c} binary" for c in _NUMBERS)
#: Counts of kept terms in the sources of a part, in lists of bounded length.  Rows of these stand among those of the parts, without terms.
_FOUND = pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())]))
_EACH = 64



def _row(shard: int, s: dict, **more: pa.Array) -> pa.RecordBatch:
    columns = {"shard": pa.array([shard])} | {c: pa.array([s[c]], pa.list_(pa.string())) for c in _STRINGS}
    columns |= {"terms": pa.array([b" ".join(s["terms"])], pa.binary())} | {c: pa.array([pack(s[c])], pa.binary()) for c in _NUMBERS}
    return pa.RecordBatch.from_arrays([*columns.values(), *more.values()], [*columns, *more])


def _rows(batches):
    """(batch, row number, name, shard) of every shard."""
    for batch in batches:
        for k in range(batch.num_rows):
            s = {c: batch.column(c)[k].as_py() for c in _STRINGS} | {"terms": batch.column("terms")[k].as_py().split()} | {c: unpack(batch.column(c)[k].as_py()) for c in _NUMBERS}
            yield batch, k, batch.column("shard")[k].as_py(), s


class _Numbers(dict):
    """Numbers of terms, from 0 in the order they are first asked for."""

    def __missing__(self, term: bytes) -> int:
        value = self[term] = len(self)
        return value


def _parts(s: dict, length: int, size: int):
    """A shard in parts of about ``size`` bytes, each with its own documents only; terms of one language and prefix stay together."""
    terms, lang, per_term = s["terms"], s["lang"], np.diff(s["ends"], prepend=0)
    if not terms:
        return
    cut = np.array([t[:length] for t in terms])
    place = np.cumsum(np.fromiter(map(len, terms), np.int64, len(terms)) + 4 * per_term) // size
    new = np.flatnonzero((cut[1:] != cut[:-1]) | (lang[1:] != lang[:-1])) + 1
    begins = np.concatenate(([0], new[np.diff(place[new - 1], prepend=0) > 0]))
    for lo, hi in zip(begins.tolist(), [*begins[1:].tolist(), len(terms)]):
        first, last = s["ends"][lo] - per_term[lo], s["ends"][hi - 1]
        doc, mine = s["doc"][first:last], np.zeros(len(s["source"]), bool)
        mine[doc] = True
        yield s | {"terms": terms[lo:hi], "lang": lang[lo:hi], "ends": s["ends"][lo:hi] - first, "count": s["count"][first:last],
                   "source": s["source"][mine], "doc": (np.cumsum(mine) - 1)[doc]}


def shards(docs: DataFrame, size: int = SHARD, first: int = FIRST, part: int = PART) -> DataFrame:
    """Rows of a shard's parts (written once): terms sorted by language and bytes, with the documents and counts of each.

    ``docs`` has the string columns lang, source and text, none of them null.  No level may be shorter than ``first``, else
    a prefix's terms may lie in two parts, and documents that have both count twice.
    """

    def cut(batches):
        langs, sources, source, filled = {}, {}, [], 0
        shard = TaskContext.get().partitionId() << 32  # a task's shards are numbered on from here

        def close():
            """Terms of all languages in order, with their postings, in parts."""
            nonlocal shard
            terms, lang, n_posts, docs, counts = [], [], [], [], []
            for a, (number, *posts, own, n) in enumerate(langs.values()):
                of, count = (np.array(p, np.int64) for p in posts)
                doc = np.repeat(np.array(own, np.int64), n)
                order = sorted(number)
                place = np.empty(len(order), np.int64)
                place[[number[t] for t in order]] = np.arange(len(order))
                at = place[of]
                sort = np.sort(at << 32 | np.arange(len(at))) & 0xFFFFFFFF  # by place, then as they came
                terms += order
                lang.append(np.full(len(order), a))
                n_posts.append(np.bincount(at, minlength=len(order)))
                docs.append(doc[sort])
                counts.append(count[sort])
            whole = {"langs": list(langs), "sources": list(sources), "terms": terms, "source": np.array(source), "lang": np.concatenate(lang),
                     "ends": np.cumsum(np.concatenate(n_posts)), "doc": np.concatenate(docs), "count": np.concatenate(counts)}
            for s in _parts(whole, first, part):
                yield _row(shard, s)
                shard += 1

        for batch in (b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS)):
            for lang, name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                if lang not in langs:
                    langs[lang] = _Numbers(), [], [], [], []  # terms; each posting's term and count; documents and their postings
                number, of, count, own, n = langs[lang]
                found = Counter(terms_of(text))
                of.extend(map(number.__getitem__, found))
                count.extend(found.values())
                own.append(len(source))
                n.append(len(found))
                source.append(sources.setdefault(name, len(sources)))
                filled += len(text)
                if filled >= size:
                    yield from close()
                    langs, sources, source, filled = {}, {}, [], 0
        if source:
            yield from close()

    return materialize(docs.select("lang", "source", "text").mapInArrow(cut, _SHARD), "term-shards")


def _groups(s: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each term's prefix, whether that is all of it, the number of its group, and the groups' first terms.

    A complete term is a group of its own; the others are grouped by language
    and prefix, whose terms follow each other.  All terms here are longer than
    half the level's length (but at the first level), so the prefixes take no
    more than twice the terms' bytes.
    """
    terms, lang = s["terms"], s["lang"]
    cut = np.array(terms, dtype=f"S{length}")
    done = np.fromiter(map(len, terms), np.int64, len(terms)) <= length
    new = np.ones(len(terms), bool)
    new[1:] = (cut[1:] != cut[:-1]) | (lang[1:] != lang[:-1]) | done[1:] | done[:-1]
    return cut, done, np.cumsum(new) - 1, np.flatnonzero(new)


def _mixed(keys: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        keys = (keys ^ (keys >> np.uint64(shift))) * np.uint64(factor)
    return keys ^ (keys >> np.uint64(31))


def _keys(langs: list[str], lang: np.ndarray, cut: np.ndarray, done: np.ndarray) -> np.ndarray:
    """A 64-bit key of every (language, prefix, completeness), the same in every shard."""
    width = -(-cut.dtype.itemsize // 8)
    blocks = np.ascontiguousarray(cut.astype(f"S{8 * width}")).view(np.uint64).reshape(len(cut), width)
    keys = np.array([xxhash.xxh64_intdigest(a) for a in langs], np.uint64)[lang] ^ done.astype(np.uint64)
    for k in range(width):
        keys = _mixed(keys + np.uint64(0x9E3779B97F4A7C15)) ^ blocks[:, k]
    return _mixed(keys).astype(np.int64)


def level(now: DataFrame, length: int) -> DataFrame:
    """Documents of every prefix of ``length`` bytes in every shard: (shard, no, key, docs).

    ``no`` is the prefix's number in its shard, ``key`` stands for language,
    prefix and completeness.  A term of at most ``length`` bytes is complete
    and counts for itself; the others count for their prefix, a document once.
    """

    def count(batches):
        for _, _, shard, s in _rows(batches):
            if not s["terms"]:
                continue
            cut, done, group, first = _groups(s, length)
            per_term, width = np.diff(s["ends"], prepend=0), len(s["source"])
            n = np.bincount(group, weights=per_term, minlength=len(first)).astype(np.int64)
            shared = (np.bincount(group, minlength=len(first)) > 1)[group]  # terms whose documents may be the same
            pairs = np.unique(np.repeat(group, per_term * shared) * width + s["doc"][np.repeat(shared, per_term)])
            several = np.bincount(pairs // width, minlength=len(first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), shard)), pa.array(np.arange(len(first), dtype=np.int32)),
                 pa.array(_keys(s["langs"], s["lang"][first], cut[first], done[first])), pa.array(np.where(several, several, n))], ["shard", "no", "key", "docs"])

    return now.mapInArrow(count, "shard long, no int, key long, docs long")


def _narrowed(s: dict, keep: np.ndarray) -> dict:
    """The shard with only the terms of ``keep``."""
    per_term = np.diff(s["ends"], prepend=0)
    post = np.repeat(keep, per_term)
    return s | {"lang": s["lang"][keep], "terms": list(compress(s["terms"], keep.tolist())), "ends": np.cumsum(per_term[keep]),
                "doc": s["doc"][post], "count": s["count"][post]}


def _counts(s: dict) -> pa.RecordBatch:
    """Every term's count and documents in each source of the shard that has it, ``_EACH`` to a row."""
    width = max(len(s["sources"]), 1)
    key = np.repeat(np.arange(len(s["terms"])), np.diff(s["ends"], prepend=0)) * width + s["source"][s["doc"]]
    keys, place, docs = np.unique(key, return_inverse=True, return_counts=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, place, s["count"])
    term, source = pa.array(keys // width), pa.array(keys % width)
    lang = pa.array(s["lang"]).take(term)
    lang = pa.array(s["langs"], pa.string()).take(lang)
    each = pa.StructArray.from_arrays([lang, pa.array(s["sources"], pa.string()).take(source), pa.array(s["terms"], pa.binary()).take(term), pa.array(n), pa.array(docs)], fields=[*_FOUND.value_type])
    found = pa.ListArray.from_arrays(pa.array([*range(0, len(n), _EACH), len(n)], pa.int32()), each)
    none = {"shard": pa.int64()} | {c: pa.list_(pa.string()) for c in _STRINGS} | {c: pa.binary() for c in ("terms", *_NUMBERS)}
    columns = {c: pa.nulls(len(found), kind) for c, kind in none.items()} | {"terms": pa.repeat(pa.scalar(b"", pa.binary()), len(found)), "found": found}
    return pa.RecordBatch.from_arrays([*columns.values()], [*columns])


def refined(now: DataFrame, live: DataFrame, length: int) -> DataFrame:
    """The shards with only the longer terms that extend a remaining prefix, and rows with the counts of the kept
    terms that are complete at this level (written once); ``terms`` is empty in these.

    ``live`` has the numbers (shard, no) of what remains.
    """
    by_shard = live.groupBy("shard").agg(F.collect_list("no").alias("live"))

    def narrow(batches):
        for batch, k, shard, s in _rows(batches):
            _, done, group, first = _groups(s, length)
            alive = np.zeros(len(first), bool)
            alive[np.asarray(batch.column("live")[k].values)] = True
            keep = alive[group]
            if (keep & ~done).any():
                yield _row(shard, _narrowed(s, keep & ~done), found=pa.nulls(1, _FOUND))
            yield _counts(_narrowed(s, keep & done))

    return materialize(now.join(by_shard, "shard").mapInArrow(narrow, f"{_SHARD}, found array<struct<lang: string, source: string, term: binary, n: long, docs: long>>"), "refined")


def refine(now: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """(lang, source, term, n, docs) of the terms that remain at their level.

    There is one row for each source of a term and shard it occurs in.
    """
    found, length = None, first
    while True:
        # One shuffle by key: each row meets its prefix's total beside it (a key has a row in a shard at most, or two).
        seen = level(now, length).withColumn("_all", F.sum("docs").over(Window.partitionBy("key")))
        step = refined(now, seen.filter(F.col("_all") >= least).select("shard", "no"), length)
        part = step.select(F.explode("found").alias("_f")).select("_f.*")
        found = part if found is None else found.unionByName(part)
        now = step.drop("found").filter(F.octet_length("terms") > 0)
        if now.isEmpty():
            return found
        length *= 2


def kept_terms(now: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """(lang, term, all_n, seen): the terms that ``least`` documents of their language hold, with their counts by source."""
    # A shard has one row for a term and source, so combining before the shuffle would not shrink them; dealt by term,
    # both groupings find their rows together.
    by_source = refine(now, least, first).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("_docs"), F.collect_list(F.struct("source", "n")).alias("seen"))
    return materialize(by_term.filter(F.col("_docs") >= least).drop("_docs"), "kept-terms")


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 v)), exactly."""
    big = lambda c: c.cast("decimal(19,0)")
    return (F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (big(n) + F.lit(2)), big(total) + F.lit(2) * big(v))).cast("long")


def _difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so their squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(by_term: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language: the differences summed over all kept terms.

    The groups are broadcast; the result holds a row for each two of a
    language, so they are far fewer than it.
    """
    spark = groups.sparkSession
    known: dict[str, tuple[list, list, int]] = {}
    for r in groups.orderBy("lang", "source").collect():
        names, totals, _ = known.setdefault(r.lang, ([], [], r.v))
        names.append(r.source)
        totals.append(r.total)
    shared = spark.sparkContext.broadcast(known)

    def add(batches):
        share = lambda n, total, v: 1 + SCALE * (n + 2) // (total + 2 * v)  # noqa: E731  Python's integers have no bound
        place, none, sums = {}, {}, {}
        for batch in batches:
            for lang, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names, totals, v = shared.value[lang]
                if lang not in sums:
                    place[lang] = {name: k for k, name in enumerate(names)}
                    none[lang] = np.array([share(0, t, v) for t in totals], np.int64)
                    sums[lang] = np.zeros((len(names), len(names)), np.int64)
                p = none[lang].copy()
                for x in seen:
                    k = place[lang][x["source"]]
                    p[k] = share(x["n"], totals[k], v)
                apart = p[:, None] - p[None, :]
                sums[lang] += apart * apart // (p[:, None] + p[None, :])
        for lang, value in sums.items():
            names = shared.value[lang][0]
            for k, name in enumerate(names):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names)), pa.array([name] * len(names)), pa.array(names), pa.array(value[k])], ["lang", "source", "item", "value"])

    partial = by_term.select("lang", "seen").mapInArrow(add, "lang string, source string, item string, value long")
    value = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    named = groups.select("lang", "source")
    every = named.join(named.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    return every.join(value, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))


def _terms(by_term: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every kept term that a source holds with a larger share than its language."""
    each = by_term.select("lang", "term", "all_n", F.explode("seen").alias("_s")).select("lang", "term", "all_n", "_s.*")
    both = each.join(F.broadcast(groups), ["lang", "source"])  # bounded as in _pairs
    shares = both.withColumns({"p": _share(F.col("n"), F.col("total"), F.col("v")), "q": _share(F.col("all_n"), F.col("lang_total"), F.col("v"))})
    return shares.filter("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), _difference(F.col("p"), F.col("q")).alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item")))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))


def report(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST,
           top: int = TOP, size: int = SHARD, first: int = FIRST) -> DataFrame:
    """The parts ``pair`` (all other sources of the language) and ``term`` (the first ``top`` terms) of every (lang, source)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    by_term = kept_terms(shards(given, size, first), least, first)
    totals = by_term.select("lang", F.explode("seen").alias("_s")).groupBy("lang", "_s.source").agg(F.sum("_s.n").alias("total"))
    of_lang = by_term.groupBy("lang").agg(F.sum("all_n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = given.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = materialize(groups.select("lang", "source", zero("total"), zero("lang_total"), zero("v")), "groups")
    return _ranked(_pairs(by_term, groups), "pair").unionByName(_ranked(_terms(by_term, groups), "term").filter(F.col("rank") <= top))

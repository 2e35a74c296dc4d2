"""Byte-level BPE: encoding and decoding by recursive DuckDB queries in every partition.

A task splits its texts by the tokenizer's pattern and hands the distinct
pieces it has not met yet to a DuckDB database of its own: one row for each
piece and token position, joined to the table of merges.  A recursive query
contracts pairs until no piece has a mergeable one left; it is keyed by piece
and position where pieces are long, so only the present state is kept.  Decoding joins
token rows to the vocabulary and concatenates their bytes by an ordered
aggregate.  Nothing is shuffled: a document is coded where it is read.

A piece of at most :data:`WHOLE` bytes contracts its leftmost pair of minimum
rank in each step.  A longer one contracts every pair that is the minimum
among as many neighbours to both sides as the longest token has bytes: a merge
farther away can reach the pair only through a token that covers all between,
which would be longer than any token.  Equal ranks within reach wait for the
leftmost, unless no token that contains theirs has a lower rank; then a run of
them contracts every other pair at once.  So steps do not grow with the piece.

Defined cases: a null text is empty and has no tokens; null ids decode to an
empty text.  Special tokens are ordinary text.  Texts of any length are worked
on in slices of bounded size.  Repeated rows and ties of ids are coded each for
itself; an empty table gives an empty table; other columns pass through, and a
column named like a result is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a piece that contracts one pair a step.
WHOLE = 64

#: Bytes of texts, tokens and bytes of pieces that are worked on at once, and pieces a task remembers.
CHUNK, TOKENS, PIECES, KNOWN = 2 << 20, 500_000, 1 << 20, 600_000

# Letters and numbers of Unicode versions after 16, which the tokenizer's library takes for symbols.
NEWER = (
    "558, 58B-58C, 88F, C5C, CDC, 208F, 209D-209F, A7CE-A7CF, A7D2, A7D4, A7DD, A7E2, A7F1, AB6C-AB6D, 107BB-107BF, "
    "10940-10959, 10EC5-10EC7, 10ED9-10EEE, 11B0A, 11DB0-11DDB, 11DE0-11DE9, 11DF1, 1246F, 12475-1247F, 12550-12686, "
    "16EA0-16EB8, 16EBB-16ED3, 16FF2-16FF6, 187F8-187FF, 18CD6-18CDA, 18D09-18D20, 18D80-18DF2, 18E00-19191, 191A0-191D2, "
    "1B123-1B128, 1B168, 1D6A6, 1DF1F-1DF24, 1DF2B-1DF81, 1DF90-1DF96, 1DFCD-1DFFF, 1E6C0-1E6DE, 1E6E0-1E6E2, 1E6E4-1E6E5, "
    "1E6E7-1E6ED, 1E6F0-1E6F4, 1E6FE-1E6FF, 2B73A-2B73F, 2B81E, 2CEA2-2CEAD, 323B0-33479, 3D000-3FC3F"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of every token of a rank file: a line holds the token in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


#: Texts of characters before this one are split by a pattern of explicit classes.
PLAIN_END = 0x250

_BEYOND = re.compile(f"[^\0-{chr(PLAIN_END - 1)}]")


def splitters(pattern: str):
    """The pattern for texts of plain characters, for all others, and for those with newer characters."""
    plain = {kind: "".join(re.escape(chr(c)) for c in range(PLAIN_END) if regex.fullmatch(given, chr(c)))
             for kind, given in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s"))}
    narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{plain['s']}{plain['L']}{plain['N']}]")
    narrow = narrow.replace(r"\p{L}", f"[{plain['L']}]").replace(r"\p{N}", f"[{plain['N']}]").replace(r"\s", f"[{plain['s']}]").replace(r"\S", f"[^{plain['s']}]")
    ranges = "".join("-".join(rf"\U{int(c, 16):08X}" for c in part.split("-")) for part in NEWER.split(", "))
    newer = pattern.replace(r"[^\s\p{L}\p{N}]", "\0")
    for kind in "LN":
        newer = newer.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{ranges}]]")
    newer = newer.replace("\0", rf"(?:[^\s\p{{L}}\p{{N}}]|[{ranges}])")
    return re.compile(narrow), regex.compile(pattern), regex.compile(newer, regex.V1), re.compile(f"[{ranges}]")


def merge_table(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Every way to make a token of two tokens: both ids in one number, the rank, and whether a larger token of lower rank holds it."""
    a, b, made, lower = [], [], [], dict.fromkeys(ranks.values(), False)
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            for part in (left, right):
                if part is not None and rank < part:
                    lower[part] = True
            if left is not None and right is not None:
                a.append(left)
                b.append(right)
                made.append(rank)
    pair = np.array(a, np.int64) * (1 << 32) + np.array(b, np.int64)
    return {"pair": pair, "made": np.array(made, np.int64), "risky": np.array([lower[r] for r in made], bool)}


# Short pieces: a row for each piece and token position meets the merges; the leftmost pair of minimum rank is contracted.
# Rows know the next token and its position, so a step is a few hash joins; 'gone' is the second token of the pair.
_SHORT = """
WITH RECURSIVE token(piece, pos, id, next_pos, next, step) AS (
  SELECT piece, pos, id, next_pos, next, 0 FROM start
  UNION ALL
  (WITH least AS (
    SELECT piece AS p, min((made * {whole} + pos) * {whole} + next_pos) AS best FROM token JOIN merges ON pair = id * 4294967296 + next GROUP BY piece),
  chosen AS (SELECT p, best // {whole} % {whole} AS kept, best % {whole} AS gone, best // {whole} // {whole} AS made FROM least),
  around AS (SELECT p, kept, gone, made, next_pos AS far_pos, next AS far FROM chosen JOIN token ON piece = p AND pos = gone)
  SELECT piece, pos, CASE WHEN pos = kept THEN made ELSE id END, CASE WHEN pos = kept THEN far_pos ELSE next_pos END,
    CASE WHEN pos = kept THEN far WHEN next_pos = kept THEN made ELSE next END, step + 1
  FROM token JOIN around ON p = piece WHERE pos <> gone))
SELECT piece, id FROM token JOIN (SELECT piece, max(step) AS step FROM token GROUP BY piece) USING (piece, step) ORDER BY piece, pos
"""

# Long pieces: every pair that nothing before it in the order of merges can reach is contracted.
_LONG = """
WITH RECURSIVE token(piece, pos, id) USING KEY (piece, pos) AS (
  SELECT piece, pos, id FROM start
  UNION
  (WITH pairs AS (
    SELECT piece, pos, id, lead(id) OVER near AS next, lead(pos) OVER near AS next_pos, row_number() OVER near AS place
    FROM recurring.token WHERE id >= 0 AND piece IN (SELECT piece FROM token)
    WINDOW near AS (PARTITION BY piece ORDER BY pos)),
  ranked AS (
    SELECT piece, pos, next_pos, place, made, risky FROM pairs LEFT JOIN merges ON pair = id * 4294967296 + next),
  near AS (
    SELECT *, min(made) OVER (PARTITION BY piece ORDER BY place ROWS BETWEEN {reach} PRECEDING AND {reach} FOLLOWING) AS least,
      min(made) OVER (PARTITION BY piece ORDER BY place ROWS BETWEEN {reach} PRECEDING AND 1 PRECEDING) AS before,
      place - row_number() OVER (PARTITION BY piece, made ORDER BY place) AS run
    FROM ranked),
  runs AS (
    SELECT *, place - min(place) OVER same AS along, first_value(made = least) OVER (PARTITION BY piece, made, run ORDER BY place) AS free
    FROM near WHERE made IS NOT NULL WINDOW same AS (PARTITION BY piece, made, run)),
  merged AS (
    SELECT piece, pos, next_pos, made FROM runs
    WHERE made = least AND (before IS NULL OR before > made OR NOT risky AND free AND along % 2 = 0))
  SELECT piece, pos, made FROM merged UNION ALL SELECT piece, next_pos, -1 FROM merged))
SELECT piece, id FROM token WHERE id >= 0 ORDER BY piece, pos
"""


class Coder:
    """The vocabulary and the merges in a DuckDB database of one task."""

    def __init__(self, tables: dict):
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.ranks = ranks = tables["ranks"]
        self.narrow, self.wide, self.newer, self.is_newer = splitters(tables["pattern"])
        self._table("vocabulary", id=np.fromiter(ranks.values(), np.int64, len(ranks)), piece=pa.array([t.hex() for t in ranks]))
        self._table("merges", **tables["merges"])
        self.short = _SHORT.format(whole=WHOLE + 1)
        self.long = _LONG.format(reach=max(map(len, ranks)))
        self.of_byte = np.array([ranks[bytes([k])] for k in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern in a text, a bounded list at a time."""
        plain = text.isascii() or not _BEYOND.search(text)
        split = self.narrow if plain else self.newer if self.is_newer.search(text) else self.wide
        if len(text) < CHUNK:
            yield split.findall(text)
        else:
            found = (m.group() for m in split.finditer(text))
            yield from iter(lambda: list(islice(found, TOKENS)), [])

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet."""
        if len(self.known) > KNOWN:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
        rows, size = [], 0
        for p in pieces:
            if p not in self.known:
                rows.append(p)
                size += len(p)
                if size > PIECES:
                    self._learn(rows)
                    rows, size = [], 0
        if rows:
            self._learn(rows)

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        self.known.update((p, self.ranks[r].to_bytes(4, "little")) for p, r in zip(pieces, raw) if r in self.ranks)
        rest = [(p, r) for p, r in zip(pieces, raw) if r not in self.ranks]
        for long in (False, True):
            self._contract([x for x in rest if (len(x[1]) > WHOLE) == long], long)

    def _contract(self, pieces: list[tuple[str, bytes]], long: bool) -> None:
        if not pieces:
            return
        sizes = np.array([len(r) for _, r in pieces])
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        pos = np.arange(len(piece), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = self.of_byte[np.frombuffer(b"".join(r for _, r in pieces), np.uint8)]
        after = np.append(ids[1:], -1)
        after[np.cumsum(sizes) - 1] = -1  # of a last token
        self._table("start", piece=piece, pos=pos, id=ids, next_pos=pos + 1, next=after)
        got = self.db.execute(self.long if long else self.short).fetchnumpy()
        ids, ends = got["id"].astype("<u4").tobytes(), 4 * np.searchsorted(got["piece"], np.arange(len(pieces) + 1))
        self.known.update((p, ids[s:e]) for (p, _), s, e in zip(pieces, ends[:-1].tolist(), ends[1:].tolist()))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian 32-bit integers."""
        out: list[bytes | None] = [None] * len(texts)
        short = {k: split for k, t in enumerate(texts) if len(t) < CHUNK for split in self.pieces(t)}
        self.learn({p for split in short.values() for p in split})
        for k, split in short.items():
            out[k] = b"".join(map(self.known.__getitem__, split))
        for k, text in enumerate(texts):
            if k not in short:  # a slice at a time
                parts = []
                for split in self.pieces(text):
                    self.learn(set(split))
                    parts.append(b"".join(map(self.known.__getitem__, split)))
                out[k] = b"".join(parts)
        return out

    def decode(self, coded: list[bytes]) -> list[bytes]:
        """Bytes of every list of ids; an id outside the vocabulary is an error."""
        parts: list[list[bytes]] = [[] for _ in coded]
        slices = [(k, c[s:s + 4 * TOKENS]) for k, c in enumerate(coded) for s in range(0, len(c), 4 * TOKENS)]
        while slices:
            now, size = [], 0
            while slices and (not now or size + len(slices[0][1]) <= 4 * TOKENS):
                size += len(slices[0][1])
                now.append(slices.pop(0))
            sizes = np.array([len(c) // 4 for _, c in now])
            ids = np.frombuffer(b"".join(c for _, c in now), "<u4").astype(np.int64)
            self._table("coded", slice=np.repeat(np.arange(len(now), dtype=np.int32), sizes), pos=np.arange(len(ids)), id=ids)
            got = self.db.execute("SELECT slice, string_agg(piece, '' ORDER BY pos) AS text, count(*) AS n FROM coded JOIN vocabulary USING (id) GROUP BY slice ORDER BY slice").fetchall()
            if sum(n for _, _, n in got) != len(ids):
                raise ValueError("ids that the vocabulary does not hold")
            for k, text, _ in got:
                parts[now[k][0]].append(bytes.fromhex(text))
        return [b"".join(p) for p in parts]


def tables(ranks: dict[bytes, int], pattern: str) -> dict:
    """What tasks need of a tokenizer: its size is that of the vocabulary, whatever the documents."""
    if missing := [k for k in range(256) if bytes([k]) not in ranks]:
        raise ValueError(f"the vocabulary lacks the bytes {missing}")
    return {"ranks": ranks, "pattern": pattern, "merges": merge_table(ranks)}


def _chunks(batch: pa.RecordBatch, column: int, size) -> Iterator[tuple[pa.RecordBatch, list]]:
    """A batch in pieces whose values have a bounded total size, or one value each."""
    values, start, total = batch.column(column).to_pylist(), 0, 0
    for k, v in enumerate(values):
        total += size(v)
        if total > CHUNK or k + 1 == len(values):
            yield batch.slice(start, k + 1 - start), values[start:k + 1]
            start, total = k + 1, 0


def _mapped(df: DataFrame, spark: SparkSession, tokenizer: dict, given: str, results: dict[str, pa.DataType], sql: str, work) -> DataFrame:
    """``df`` with the columns ``results``: ``work(coder, values)`` gives a list of values for each."""
    shared = spark.sparkContext.broadcast(tokenizer)
    kept = [c for c in df.columns if c not in results]

    def run(batches):
        coder = Coder(shared.value)
        for batch in batches:
            for part, values in _chunks(batch, batch.num_columns - 1, lambda v: len(v or "")):
                new = [pa.array(v, t) for v, t in zip(work(coder, values), results.values())]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], *new], [*kept, *results])

    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(given).alias("_llm_given"))
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [sql])
    return source.mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer: dict, text_col: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in the array column ``into``."""
    def work(coder, texts):
        return [[np.frombuffer(c, "<u4").astype(np.int32) for c in coder.encode([t or "" for t in texts])]]

    source = docs.withColumn("_llm_text", F.col(text_col).cast("string"))
    return _mapped(source, docs.sparkSession, tokenizer, "_llm_text", {into: pa.list_(pa.int32())}, f"`{into}` array<int>", work).drop("_llm_text")


def decode(coded: DataFrame, tokenizer: dict, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``coded`` with the decoded bytes of each list of ids in the binary column ``into``."""
    def work(coder, lists):
        return [coder.decode([np.array(x or [], "<u4").tobytes() for x in lists])]

    return _mapped(coded, coded.sparkSession, tokenizer, ids_col, {into: pa.binary()}, f"`{into}` binary", work)


def report(docs: DataFrame, tokenizer: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: number of tokens, and digests of its ids and of their decoded bytes."""
    def work(coder, texts):
        coded = coder.encode([t or "" for t in texts])
        digest = lambda values: [hashlib.sha256(v).hexdigest() for v in values]
        return [len(c) // 4 for c in coded], digest(coded), digest(coder.decode(coded))

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_llm_text"))
    results = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    out = _mapped(narrow, docs.sparkSession, tokenizer, "_llm_text", results, "n_tokens long, ids_sha256 string, decoded_sha256 string", work)
    return out.select(id_col, *results)

"""Secret scans: base patterns, and credentials put together from several parts.

Three base patterns are reported wherever they occur.  Weak candidates (a
login name, an unlabelled random token, an endpoint) mean little alone; they
are reported only when the parts that complete them lie in the same scope (a
paragraph) within ``REACH`` code points:

* ``secret``: a random token or a labelled short value, beside an access identifier;
* ``login``: a labelled access identifier, beside a secret of any kind;
* ``endpoint``: a URL, or an address with an optional port, beside both.

The parts of one document meet in a sorted interval join, so the work is
linear in their number.  Offsets are code points, end exclusive.

Defined cases: a null or empty text has no spans.  Overlapping spans of
different kinds are all kept; a weak span inside a base span is not repeated.
Repeated rows get equal results; other columns pass through, and a column
named like the result is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.words import utf8

#: Kinds in the order in which equal starts are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "secret", "login", "endpoint")
BASE = KINDS[:3]

#: Code points between two parts of one credential, at most.
REACH = 240

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LONG = re.compile(rb"[A-Za-z0-9+/_-]{20,}")
SHORT = re.compile(rb"""\b(?:pwd|pass|passphrase|auth|bearer|credential|private_?key|access_?key)\b["']?\x20*[:=]\x20*["']?([^\s"',;]{4,})""", re.I)
LOGIN = re.compile(rb"""\b(?:user|user_?name|login|account|client_?id|key_?id|access_?key_?id)\b["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""", re.I)
ENDPOINT = re.compile(rb"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{2,5})?\b""", re.I)
SCOPE = re.compile(rb"\n[\x20\t\r]*\n")

_LABELS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

Span = tuple[str, int, int]


def base_spans(text: bytes) -> list[Span]:
    """The base spans of a text, in bytes."""
    spans: list[Span] = []
    low = text.lower()
    if any(label in low for label in _LABELS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if max(map(len, text.split()), default=0) >= 20:
        if b"AKIA" in text:
            spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        # Every 24 hex digits lie in a long token or run through several; tokens bound the search.
        for token in LONG.finditer(text):
            spans += [("hex", token.start() + m.start(), token.start() + m.end())
                      for m in HEX.finditer(token[0]) if len(m[0]) >= 24]
    return spans


def _random(token: bytes) -> bool:
    """Upper case, lower case and digits, and many different characters."""
    return (any(65 <= c <= 90 for c in token) and any(97 <= c <= 122 for c in token)
            and any(48 <= c <= 57 for c in token) and len(set(token)) >= 10)


class _Parts:
    """Spans of one role, sorted by start, for the interval join."""

    def __init__(self, spans: list[Span], scopes: list[int]):
        self.spans = sorted(spans, key=lambda s: (s[1], s[2]))
        self.starts = [s[1] for s in self.spans]
        self.scopes = scopes
        self.longest = max((s[2] - s[1] for s in self.spans), default=0)

    def near(self, span: Span, reach: int) -> bool:
        """Is there a part of this role in the span's scope, not overlapping it, within reach?"""
        scope = bisect_left(self.scopes, span[1] + 1)
        first = bisect_left(self.starts, span[1] - reach - self.longest)
        for k in range(first, len(self.starts)):
            _, start, end = self.spans[k]
            if start > span[2] + reach:
                return False
            apart = end <= span[1] or start >= span[2]
            if apart and end >= span[1] - reach and bisect_left(self.scopes, start + 1) == scope:
                return True
        return False


def link(text: bytes, base: list[Span], reach: int = REACH) -> list[Span]:
    """Weak spans of a text whose complementary parts co-occur, in bytes."""
    taken = [(s, e) for _, s, e in base]

    def fresh(kind: str, pattern: re.Pattern, group: int, where=lambda m: True) -> list[Span]:
        """Matches that don't overlap a base span."""
        found = [(kind, m.start(group), m.end(group)) for m in pattern.finditer(text) if where(m)]
        if not found or not taken:
            return found
        ends = sorted(taken)
        starts = [s for s, _ in ends]
        most = np.maximum.accumulate([e for _, e in ends])
        return [f for f in found if (k := bisect_left(starts, f[2])) == 0 or most[k - 1] <= f[1]]

    identifiers = [s for s in base if s[0] == "access"]
    if b"=" in text or b":" in text:
        logins, short = fresh("login", LOGIN, 1), fresh("secret", SHORT, 1)
    else:
        logins, short = [], []
    if not identifiers and not logins:
        return []
    tokens = fresh("secret", LONG, 0, lambda m: _random(m[0])) if max(map(len, text.split()), default=0) >= 20 else []
    scopes = [m.start() + 1 for m in SCOPE.finditer(text)]
    weak = sorted(set(short + tokens))
    before = None if text.isascii() else np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) == 0x80)))

    def point(at: int) -> int:
        """A byte offset in code points, in which distances are measured."""
        return at if before is None else at - int(before[at])

    def pointed(s: Span) -> Span:
        return s[0], point(s[1]), point(s[2])

    scopes = [point(k) for k in scopes]
    secrets = _Parts([pointed(s) for s in base if s[0] in ("assign", "hex")] + [pointed(s) for s in weak], scopes)
    names = _Parts([pointed(s) for s in identifiers + logins], scopes)
    out = [s for s in weak if names.near(pointed(s), reach)] + [s for s in logins if secrets.near(pointed(s), reach)]
    if secrets.spans:
        out += [s for s in fresh("endpoint", ENDPOINT, 0) if names.near(pointed(s), reach) and secrets.near(pointed(s), reach)]
    return out


def scan(text: bytes, reach: int = REACH) -> list[Span]:
    """All spans of a text in code points, by start, then kind."""
    base = base_spans(text)
    spans = base + link(text, base, reach)
    if not spans:
        return []
    if not text.isascii():
        inner = (np.frombuffer(text, np.uint8) & 0xC0) == 0x80
        before = np.concatenate(([0], np.cumsum(inner)))
        spans = [(k, s - int(before[s]), e - int(before[e])) for k, s, e in spans]
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, text_col: str = "text", into: str = "secrets", reach: int = REACH) -> DataFrame:
    """``docs`` with an array ``into`` of (kind, start, end)."""

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in scan(t, reach)] for t in utf8(texts)], _SPANS_ARROW)

    return docs.withColumn(into, F.arrow_udf(batch, SPANS)(F.col(text_col).cast("string")))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """``docs`` with every span, base or linked, replaced by ``mark``; touching spans become one mark."""

    def batch(texts: pa.Array) -> pa.Array:
        out = []
        for raw, text in zip(texts.to_pylist(), utf8(texts)):
            last, parts = 0, []
            for _, s, e in scan(text, reach):
                if s >= last:
                    parts += [raw[last:s], mark] if s > last or not parts else []
                last = max(last, e)
            out.append(raw if raw is None or not parts else "".join(parts) + raw[last:])
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, F.arrow_udf(batch, "string")(F.col(text_col).cast("string")))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans of every document."""
    found = find_secrets(docs.select("doc_id", "text"), reach=reach)
    spans = F.col("secrets")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(spans).alias("spans"))

"""Word and byte helpers shared by the operators (run inside tasks, one text at a time)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of a text, as a Java regular expression: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Maps A-Z to a-z, keeps 0-9, a-z and every byte of a non-ASCII character, blanks the rest.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null is empty."""
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def split_words(text: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` (``bytes.split`` cuts at exactly these six bytes)."""
    return text.split()


def normal_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words made of digits, letters and non-ASCII characters."""
    return text.translate(NORMAL).split()


def word_count(text: Column) -> Column:
    """Number of words of a text column; 0 for null.  Stays in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "+")), F.lit(0)).cast("long")


def row_hash(*columns: Column, seed: int = 0) -> Column:
    """A 64-bit hash of a row's values, nulls included."""
    parts = [F.lit(seed)]
    for c in columns:
        parts += [c, c.isNull()]
    return F.xxhash64(*parts)

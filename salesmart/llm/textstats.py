"""Whole-text statistics of documents, counted in one pass per text.

``text_stats(column)`` is an Arrow function that returns a struct of counts;
every ratio the models use is derived from it by Spark expressions.  A null
text counts as empty: all counts are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.llm.words import split_words, utf8

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_bytes", "n_upper", "n_lower", "n_digits", "n_exclaim", "n_pipe", "n_stops",
    "n_distinct", "n_adjacent", "n_wide",
)
STATS = "struct<" + ",".join(f"{c}:long" for c in COUNTS) + ">"

_SPACES, _SYMBOLS = list(b" \t\n\r\x0b\x0c"), list(b"#*$%&|<>")


def repeated_words(words: list[bytes], numbers: np.ndarray, n_distinct: int) -> int:
    """Words inside three-word windows that occur at least twice in ``words``."""
    if len(words) < 4:
        return 0
    pairs = numbers[:-1] * n_distinct + numbers[1:]
    if n_distinct >= 1 << 21:  # three numbers no longer fit 63 bits: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * n_distinct + numbers[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    hit = np.zeros(len(words), bool)
    at = np.concatenate((order[1:][same], order[:-1][same]))
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def stats_of(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of :data:`COUNTS`."""
    words = split_words(text)
    if not words:
        return (0,) * 6 + (len(text),) + (0,) * (len(COUNTS) - 7)
    distinct = dict.fromkeys(words)
    number = dict(zip(distinct, range(len(distinct))))
    numbers = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    chars = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    seen, n_lines, n_dup = set(), 0, 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            if line in seen:
                n_dup += 1
            seen.add(line)
    n_chars = len(text) - int(chars[128:192].sum())
    return (
        len(words), n_chars - int(chars[_SPACES].sum()), int(chars[_SYMBOLS].sum()), n_dup,
        repeated_words(words, numbers, len(distinct)),
        n_lines, len(text), int(chars[65:91].sum()), int(chars[97:123].sum()), int(chars[48:58].sum()),
        int(chars[33]), int(chars[124]), int(chars[[44, 46, 63]].sum()),
        len(distinct), int((numbers[1:] == numbers[:-1]).sum()), int(chars[192:].sum()),
    )


def _stats_batch(texts: pa.Array) -> pa.Array:
    rows = np.array([stats_of(t) for t in utf8(texts)], np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(COUNTS))], names=list(COUNTS))


def text_stats(text: Column) -> Column:
    """The struct :data:`STATS` of a text column."""
    return F.arrow_udf(_stats_batch, STATS)(text.cast("string"))


def _per(a: Column, b: Column) -> Column:
    """a / b; 0 where b is 0.  In double."""
    return a.cast("double") / F.greatest(b, F.lit(1)).cast("double")


def ratios(s: Column) -> dict[str, Column]:
    """Named ratios and sizes of a stats struct; each is a finite double for every text."""
    letters = s["n_upper"] + s["n_lower"]
    return {
        "words": s["n_words"].cast("double"),
        "word_length": _per(s["word_chars"], s["n_words"]),
        "symbols": _per(s["n_symbols"], s["n_words"]),
        "repeats": _per(s["n_repeat_words"], s["n_words"]),
        "dup_lines": _per(s["n_dup_lines"], s["n_lines"]),
        "line_words": _per(s["n_words"], s["n_lines"]),
        "upper": _per(s["n_upper"], letters),
        "shouted": _per(F.greatest(s["n_upper"] - s["n_words"], F.lit(0)), letters),  # beyond a capital a word
        "digits": _per(s["n_digits"], s["n_bytes"]),
        "exclaims": _per(s["n_exclaim"], s["n_words"]),
        "pipes": _per(s["n_pipe"], s["n_words"]),
        "stops": _per(s["n_stops"], s["n_words"]),
        "adjacent": _per(s["n_adjacent"], s["n_words"]),
        "wide": _per(s["n_wide"], s["n_bytes"]),
    }

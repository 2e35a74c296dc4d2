"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A text is cut before every line that holds a word, so a piece is such a line
with the blank lines after it (blank lines before the first are a piece of
their own).  Every window of ``LINES`` pieces selects its smallest piece hash
as fingerprint, the last one of equals; equal windows select the same piece,
so a run of ``LINES`` pieces that occurs twice always shares a fingerprint.

1. Fingerprints that occur at one position only are dropped.
2. Around each of the others the match is extended both ways: the windows that
   selected it reach up to ``LINES - 1`` pieces to either side, and agree when
   all their pieces do (two 64-bit hashes of the pieces).  Grouping by these
   hashes finds the first occurrence without pairing occurrences, so a line
   shared by a third of all documents costs no more than its rows.
3. Later occurrences are deleted.  Windows that follow each other merge, so a
   longer repeated run goes as a whole.

A piece of at least ``LONG`` characters is a run by itself, and a document of
fewer than ``LINES`` pieces is one run of all of them.  Earlier means a smaller
document id, or an earlier place in the document.

Defined cases: null and word-less texts stay as they are and match nothing.  A
null id is later than all others; equal ids order by a hash of the text.  Rows
that repeat id and text are one document: they are treated alike and never
delete each other.  A run that overlaps its own earlier copy goes too.  Other
columns pass through, and a column named like a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.words import WORD
from salesmart.session import materialize

LINES = 3
LONG = 250

_CUT = r"\n(?=[^\n]*[^\x20\x09-\x0D])"
_SPACE = " \t\n\x0b\x0c\r"


def pieces(text: Column) -> Column:
    """The text cut before each line with a word; joining by line feeds gives the text back."""
    return F.split(text, _CUT)


def _runs(lines: int, long: int) -> Column:
    """(start, size, mark, at, first half, second half of the hash) of every run of the arrays _h and _n."""
    h, n = F.col("_h"), F.size("_h")

    def run(start: Column, size: Column) -> Column:
        inside = F.slice(h, start + 1, size)
        low = F.array_min(inside)
        last = size - F.array_position(F.reverse(inside), low).cast("int")
        return F.struct(start.cast("int").alias("start"), size.cast("int").alias("size"), low.alias("mark"),
                        (start + last).cast("int").alias("at"), F.xxhash64(inside).alias("h1"),
                        F.xxhash64(F.lit(1), inside, size).alias("h2"))

    size = F.least(F.lit(lines), n)
    windows = F.transform(F.sequence(F.lit(0), n - size), lambda s: run(s, size))
    alone = F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda s: F.col("_n")[s] >= long), lambda s: run(s, F.lit(1)))
    return F.array_union(windows, alone)


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES, long: int = LONG) -> DataFrame:
    """(id, text_hash, start, size) of every run that occurred earlier; starts count pieces from 0."""
    worded = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).filter(F.col("t").rlike(WORD))
    trimmed = worded.select("id", F.xxhash64("t").alias("text_hash"),
                            F.transform(pieces(F.col("t")), lambda p: F.btrim(p, F.lit(_SPACE))).alias("_p"))
    hashed = trimmed.select("id", "text_hash", F.transform("_p", lambda p: F.xxhash64(p)).alias("_h"),
                            F.transform("_p", lambda p: F.length(p)).alias("_n"))
    runs = materialize(hashed.select("id", "text_hash", F.explode(_runs(lines, long)).alias("r")).select("id", "text_hash", "r.*"), "runs")

    place = F.xxhash64("id", F.col("id").isNull(), "text_hash", "at")
    marks = runs.groupBy("mark").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b")
    marks = materialize(marks.select("mark"), "marks")
    matched = materialize(runs.join(marks, "mark", "left_semi").drop("mark", "at"), "matched")

    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"), F.col("start").alias("start"))
    firsts = matched.groupBy("h1", "h2", "size").agg(F.min(order).alias("first"), F.max(order).alias("last")).filter("first <> last")
    firsts = materialize(firsts.drop("last"), "firsts")
    later = matched.join(firsts, ["h1", "h2", "size"]).filter(order != F.col("first"))
    return later.select("id", "text_hash", "start", "size")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES, long: int = LONG,
                counts: bool = False) -> DataFrame:
    """``docs`` with later repeated runs deleted from the text; ``counts`` adds n_lines and n_deleted."""
    later = repeated_runs(docs, id_col, text_col, lines, long)
    dead = later.groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "size")).alias("_llm_runs"))
    dead = materialize(dead.withColumnRenamed("id", "_llm_id").withColumnRenamed("text_hash", "_llm_hash"), "dead")
    text = F.col(text_col).cast("string")
    # A merge join at every size: whether the texts are shuffled must not depend on how few of them change.
    joined = docs.join(dead.hint("merge"), docs[id_col].eqNullSafe(F.col("_llm_id")) & (F.xxhash64(text) == F.col("_llm_hash")), "left")
    cut = pieces(text)
    gone = F.array_distinct(F.flatten(F.transform(
        "_llm_runs", lambda r: F.sequence(r["start"], r["start"] + r["size"] - 1))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), gone)
    shown = F.when(F.col("_llm_runs").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda k: cut[k]), "\n"))
    out = joined
    if counts:
        has_word = F.coalesce(text.rlike(WORD), F.lit(False))
        out = out.withColumns({"n_lines": F.when(has_word, F.size(cut)).otherwise(F.lit(0)).cast("long"),
                               "n_deleted": F.coalesce(F.size(gone), F.lit(0)).cast("long")})
    out = out.withColumn(text_col, shown)
    return out.drop("_llm_id", "_llm_hash", "_llm_runs")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the pieces of its text, the pieces deleted, and the text that is left."""
    return dedup_lines(docs.select("doc_id", "text"), counts=True).select("doc_id", "n_lines", "n_deleted", "text")

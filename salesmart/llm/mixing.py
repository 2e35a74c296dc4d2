"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words by weight, at most ``MOST`` times
its size, the excess being shared out again by weight.  A document of a source
is wanted target / size times; whole copies are certain, the fraction is
rounded.  Rounding pairs two fractional documents of a source and moves words
from one to the other at random, as many as make one of them integral, with
odds that keep every document's expectation.  The words wanted of a source
therefore never change, and one document per group is left fractional.  Groups
are hash buckets of a source; their residuals meet in a reduction tree of
``FAN_IN`` until one document per source is left, which is rounded to the
nearest.  So a source's taken words miss its target by less than that one
document's size.

A group is gone through from the largest document to the smallest, so what is
left over is the fraction of a small one.

Random numbers are hashes of the document's id, size and level, and equal sizes
are ordered by hash, so reruns agree whatever the partitioning.

Defined cases: a null text has size 0, and so no words to give; a null source
is a source of its own, last in order.  Rows that repeat an id, source and
size are separate documents and may get different copy numbers, but as a set
the same ones in each run.  Empty tables give empty results; a column named
like a result is replaced.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.words import row_hash, word_count
from salesmart.operators.ranking import with_rank
from salesmart.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0

#: Documents of a source that one group rounds in a row, and groups whose residuals meet.
GROUP_ROWS = 256
FAN_IN = 64

RESULTS = ("size", "source_size", "target", "copies", "taken")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(key, source_size, n, target) from rows of (key, size); one row per source.

    Each round shares what is left among the sources below their limit; a
    source above its limit stays at it.  A round is one aggregate to one row.
    """
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    chain = F.lit(None).cast("double")
    for k, w in enumerate(weights):
        chain = F.when(F.col("rank") % len(weights) == k, F.lit(float(w))).otherwise(chain)
    ranked = with_rank(sources, F.col("key").isNull(), F.col("key")).withColumn("rank", F.col("rank") - 1)
    table = materialize(ranked.withColumn("weight", chain).withColumn("limit", most * F.col("source_size")), "targets")
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while total:
        full = F.col("weight") * F.lit(level) >= F.col("limit")
        at_limit, open_weight = table.agg(
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        reached = (total - at_limit) / open_weight if open_weight else level
        if reached <= level:
            break
        level = reached
    return table.select("key", "source_size", "n", F.least(F.col("limit"), F.col("weight") * F.lit(level)).alias("target"))


def _pair(held: tuple[float, int], new: tuple[float, int], u: float) -> tuple[float, float]:
    """Move words between two fractional documents (probability, size) until one is integral."""
    (p, s), (q, t) = held, new
    up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
    if u * (up + down) < down:  # the held document gains
        return (1.0, max(0.0, q - up / t)) if (1 - p) * s <= q * t else (min(1.0, p + up / s), 0.0)
    return (0.0, min(1.0, q + down / t)) if p * s <= (1 - q) * t else (max(0.0, p - down / s), 1.0)


def _integral(p: float) -> bool:
    return p < 1e-12 or p > 1 - 1e-12


def _round_groups(batches):
    """Rounds runs of rows of equal (_llm_key, _llm_group); leaves one fraction per run at most.

    A row's ``_llm_p`` becomes 0 or 1; the run's last fractional row keeps its fraction.
    """
    held = None  # (one-row batch or index into the current batch, p, size)
    group = None

    def put(batch: pa.RecordBatch, p: list[float]) -> pa.RecordBatch:
        k = batch.schema.get_field_index("_llm_p")
        return batch.set_column(k, "_llm_p", pa.array(p, pa.float64()))

    for batch in batches:
        p = batch.column("_llm_p").to_pylist()
        size = batch.column("_llm_size").to_pylist()
        draw = batch.column("_llm_u").to_pylist()
        keys = list(zip(batch.column("_llm_key").to_pylist(), batch.column("_llm_group").to_pylist()))
        for i in range(len(p)):
            if keys[i] != group or group is None:
                if held and not isinstance(held[0], int):
                    yield put(held[0], [held[1]])
                held, group = None, keys[i]
            if held is None:
                held = (i, p[i], size[i])
                continue
            where, kept, kept_size = held
            kept, p[i] = _pair((kept, kept_size), (p[i], size[i]), draw[i])
            if isinstance(where, int):
                p[where] = kept
            if not _integral(kept):
                held = (where, kept, kept_size)
                continue
            if not isinstance(where, int):
                yield put(where, [round(kept)])
            held = None if _integral(p[i]) else (i, p[i], size[i])
        out = put(batch, p)
        if held and isinstance(held[0], int):  # the run may go on: hold its fraction back
            k = held[0]
            mask = pa.array([i != k for i in range(len(p))])
            held = (out.slice(k, 1), held[1], held[2])
            out = out.filter(mask)
        yield out
    if held:
        yield put(held[0], [held[1]])


def _draw(level: int, *columns: Column) -> Column:
    """A number in [0, 1) from a row's values."""
    return F.shiftrightunsigned(row_hash(*columns, seed=1000 + level), 11).cast("double") * F.lit(2.0 ** -53)


def _rounded(df: DataFrame, id_col: str, level: int) -> DataFrame:
    """One level of the tree over rows with fractions."""
    ident = [F.col(id_col).cast("string"), F.col("_llm_size")]
    ready = df.withColumn("_llm_u", _draw(level, *ident)).repartition("_llm_key", "_llm_group").sortWithinPartitions(
        "_llm_key", "_llm_group", F.col("_llm_size").desc(), _draw(-1, *ident), *ident)
    return materialize(ready.mapInArrow(_round_groups, ready.schema).drop("_llm_u"), f"mix-{level}")


def copies(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", weights=WEIGHTS,
           share: float = SHARE, most: float = MOST, group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken; rows with 0 copies included."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in RESULTS])
    sized = docs.withColumn("_llm_size", size.cast("long")).withColumn("_llm_key", F.col(source_col).cast("string"))
    goals = targets(sized.select(F.col("_llm_key").alias("key"), F.col("_llm_size").alias("size")), weights, share, most)
    goals = materialize(goals.select(F.col("key").alias("_llm_goal"), "source_size", "n", "target"), "goals")
    joined = sized.join(goals, F.col("_llm_key").eqNullSafe(F.col("_llm_goal")), "left").drop("_llm_goal")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    groups = F.ceil(F.col("n") / F.lit(group_rows))
    joined = (joined.withColumn("_llm_whole", F.floor(wanted + 1e-12))
              .withColumn("_llm_p", F.greatest(F.lit(0.0), wanted - F.col("_llm_whole")))
              .withColumn("_llm_group", F.pmod(row_hash(F.col(id_col).cast("string"), F.col("_llm_size"), seed=3), groups))
              .drop("n"))
    open_ = (F.col("_llm_p") > 1e-12) & (F.col("_llm_size") > 0)
    most_groups = goals.agg(F.max(F.ceil(F.col("n") / F.lit(group_rows)))).first()[0] or 1
    levels = 1 + max(0, math.ceil(math.log(most_groups, fan_in) - 1e-9))
    done, rest = [joined.filter(~open_).withColumn("_llm_p", F.lit(0.0))], joined.filter(open_)
    fraction = (F.col("_llm_p") > 1e-12) & (F.col("_llm_p") < 1 - 1e-12)
    for level in range(levels):
        rest = _rounded(rest, id_col, level)
        done.append(rest.filter(~fraction))
        rest = rest.filter(fraction).withColumn("_llm_group", F.floor(F.col("_llm_group") / F.lit(fan_in)))
    done.append(rest)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    number = (F.col("_llm_whole") + F.round("_llm_p")).cast("long")
    return (result.withColumn("size", F.col("_llm_size")).withColumn("copies", number)
            .withColumn("taken", number * F.col("_llm_size"))
            .select(*docs.columns, *RESULTS))


def mixture(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered by ``copy`` from 1."""
    mixed = copies(docs, word_count(F.col(text_col)), **options).filter(F.col("copies") > 0)
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns, "copy")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    narrow = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), "sizes")
    mixed = copies(narrow, F.col("words"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")

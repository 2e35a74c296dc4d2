"""Quality rules: a learned decision list of threshold conjunctions.

Sequential covering on labelled statistics: each rule grows on two thirds of
the documents by the condition of greatest information gain, is pruned on the
last third by dropping final conditions, and its documents leave the set
before the next rule is grown.  The rules become one ordered ``when`` chain
over Spark columns, so applying them needs no Python.

Defined cases: a null or empty text has zero counts, and every text below
``MIN_WORDS`` words fails the base rules.  Without both labels no rule is
learnt, and the base rules decide alone.  Repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.labelled import MAX_ROWS, sample_labels, training_rows
from salesmart.llm.textstats import ratios, text_stats

MIN_WORDS = 50
MAX_CONDITIONS = 4
#: A rule must be right for this share of the documents it drops in the pruning part.
PRECISION = 0.9
#: A rule must drop this many labelled documents of the growing part at least.
MIN_COVER = 3


@dataclass(frozen=True)
class Condition:
    """``name >= cut`` or ``name < cut``."""

    name: str
    above: bool
    cut: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.cut if self.above else values < self.cut

    def column(self, named: dict[str, Column]) -> Column:
        return named[self.name] >= F.lit(self.cut) if self.above else named[self.name] < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(x[:, names.index(c.name)]) for c in rule), np.ones(len(x), bool))


def _best_condition(x: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[float, Condition | None]:
    """The threshold with the greatest information gain for the bad documents among ``x``."""
    p0, n0 = bad.sum(), (~bad).sum()
    best, found = 1e-9, None
    before = np.log2(p0 / (p0 + n0))
    for k, name in enumerate(names):
        order = np.argsort(x[:, k], kind="stable")
        v, b = x[order, k], bad[order]
        below_p, below_n = np.cumsum(b), np.cumsum(~b)
        ends = np.flatnonzero(v[1:] > v[:-1])  # a cut between different values
        for above in (False, True):
            p = p0 - below_p[ends] if above else below_p[ends]
            n = n0 - below_n[ends] if above else below_n[ends]
            gain = p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - before)
            gain[p < MIN_COVER] = 0
            if len(gain) and gain.max() > best:
                at = ends[int(gain.argmax())]
                best, found = float(gain.max()), Condition(name, above, float((v[at] + v[at + 1]) / 2))
    return best, found


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and bad[inside].any() and not bad[inside].all():
        _, condition = _best_condition(x[inside], bad[inside], names)
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(x[:, names.index(condition.name)])
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    """The prefix of the rule that is worth most on held-back documents."""
    def worth(r: Rule) -> float:
        inside = _covers(r, x, names)
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))


def learn(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 5) -> list[Rule]:
    """Rules that cover the documents labelled 0, in the order they apply."""
    order = np.random.default_rng(seed).permutation(len(y))
    part = np.zeros(len(y), bool)
    part[order[: 2 * len(y) // 3]] = True
    bad, left, rules = y == 0, np.ones(len(y), bool), []
    while bad[left & part].sum() >= MIN_COVER and (~bad[left]).any():
        grown = _grow(x[left & part], bad[left & part], names)
        if not grown:
            break
        rule = _prune(grown, x[left & ~part], bad[left & ~part], names)
        inside = _covers(rule, x, names) & left
        right = bad[inside & ~part]
        if not len(right) or right.mean() < PRECISION or bad[inside & part].sum() < MIN_COVER:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def verdict(rules: list[Rule], named: dict[str, Column]) -> Column:
    """The number of the first rule that holds, from 1; null if none does."""
    chain = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        chain = F.when(reduce(lambda a, b: a & b, (c.column(named) for c in rule)), F.lit(k)).otherwise(chain)
    return chain


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_ROWS) -> list[Rule]:
    """Learn the list from at most about ``max_rows`` labelled documents."""
    names = list(ratios(F.col(text_col)))
    sample = sample_labels(labels, label_col, id_col, max_rows)

    def inputs(text: Column) -> Column:
        return F.array(*ratios(text_stats(text)).values())

    x, y = training_rows(docs, sample, inputs, id_col, text_col)
    return learn(x, y, names) if len(y) and 0 < y.mean() < 1 else []


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", into: str = "judged") -> DataFrame:
    """``docs`` with a struct ``into``: the statistics, ``base_failed``, the ``rule`` that dropped it, and ``kept``."""
    with_stats = docs.withColumn("_llm_stats", text_stats(F.col(text_col)))
    s = F.col("_llm_stats")
    base = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    rule = verdict(rules, ratios(s))
    return with_stats.withColumn(into, F.struct(
        s.alias("stats"), base.alias("base_failed"), rule.alias("rule"), (~base & rule.isNull()).alias("kept"),
    )).drop("_llm_stats")


def report(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, the base statistics, base_failed, the rule's number and kept of every document."""
    judged = judge(docs.select("doc_id", "text"), fit(docs, labels, max_rows=max_rows))
    s = F.col("judged.stats")
    return judged.select(
        "doc_id", *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "judged.base_failed", "judged.rule", "judged.kept")

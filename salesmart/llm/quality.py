"""Quality classifier: Bradley-Terry pairwise ranking of documents.

Preference pairs put a labelled good document before a labelled bad one.  The
model is one weight per text feature, fitted by the logistic loss on feature
differences, so that P(a before b) = sigmoid(s(a) - s(b)) with s = w . x.
Documents are accepted above a quantile of the training scores.  Fitting uses
a bounded labelled sample; scoring is an expression over every document.

Defined cases: a null text scores as an empty one.  Without both a good and a
bad labelled document nothing can be learnt, and every score is 1.  Repeated
rows score alike; other columns pass through, and a column named like a result
is replaced.  A null id is never held out and never trained on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.labelled import MAX_ROWS, sample_labels, training_rows
from salesmart.llm.textstats import ratios, text_stats

#: A score of at least this is accepted.
ACCEPT = 0.3
#: Preference pairs per labelled document of the rarer label.
PAIRS = 40
#: Quantiles of the training scores that are tried as threshold, beside the share of bad labels.
STEPS = np.linspace(0.0, 0.6, 241)


def features(stats: Column) -> Column:
    """The array of model inputs, each bounded and none a size, so that short texts are judged by what they hold."""
    r = ratios(stats)
    columns = [
        F.least(r["symbols"], F.lit(2.0)), F.sqrt(F.least(r["symbols"], F.lit(2.0))),
        F.least(r["repeats"], F.lit(1.0)), r["repeats"] * r["repeats"], r["dup_lines"],
        r["shouted"], F.sqrt(r["shouted"]), F.least(r["exclaims"], F.lit(2.0)), F.sqrt(F.least(r["exclaims"], F.lit(2.0))),
        F.least(r["pipes"], F.lit(1.0)), F.sqrt(F.least(r["pipes"], F.lit(1.0))),
        r["adjacent"], F.sqrt(r["adjacent"]),
    ]
    return F.array(*[c.cast("double") for c in columns])


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Ranking:
    """score = weights . (x - mean) / scale - threshold, accepted from 0 up; no weights: all accepted."""

    mean: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    threshold: float = 0.0

    def score(self, x: Column) -> Column:
        """0 to 1; :data:`ACCEPT` at the threshold, rising with the Bradley-Terry score."""
        if not self.weights:
            return F.lit(1.0)
        raw = F.lit(-self.threshold + float(np.log(ACCEPT / (1 - ACCEPT))))
        for k, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weights)):
            raw = raw + (x[k] - F.lit(m)) * F.lit(w / s)
        return F.round(1.0 / (1.0 + F.exp(-F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0)))), 9)


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = 1.0, seed: int = 11) -> Ranking:
    """Bradley-Terry weights by Newton steps on the pairwise logistic loss, and the threshold quantile."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking()
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-12, scale, 1.0)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    rare = min(len(good), len(bad))
    n = pairs * rare
    wins = z[rng.choice(good, n)] if rare < len(good) else z[np.resize(good, n)]
    losses = z[rng.choice(bad, n)] if rare < len(bad) else z[np.resize(rng.permutation(bad), n)]
    diff = wins - losses
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (p - 1) + penalty * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    scores = z @ w
    return Ranking(tuple(mean.tolist()), tuple(scale.tolist()), tuple(w.tolist()), _threshold(scores, y))


def _threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The quantile of the scores that parts the most documents rightly; the middle one of equals.

    Documents count alike, so where good ones abound the cut rather lets a bad
    one pass than reject several good ones.
    """
    cuts = np.quantile(scores, np.append(STEPS, (y == 0).mean()))
    right = np.array([((scores >= c) == (y == 1)).sum() for c in cuts])
    best = np.sort(cuts[right == right.max()])
    return float(best[len(best) // 2])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_ROWS) -> Ranking:
    """Rank documents from at most about ``max_rows`` labelled ones, none of them held out."""
    sample = sample_labels(labels, label_col, id_col, max_rows, ~held_out(id_col))
    x, y = training_rows(docs, sample, lambda text: features(text_stats(text)), id_col, text_col)
    return fit_pairs(x, y) if len(y) else Ranking()


def score(docs: DataFrame, model: Ranking, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with each document's score from 0 to 1."""
    stats = docs.withColumn("_llm_x", features(text_stats(F.col(text_col))) if model.weights else F.lit(None))
    return stats.withColumn(into, model.score(F.col("_llm_x"))).drop("_llm_x")


def accepted(docs: DataFrame, model: Ranking, text_col: str = "text") -> DataFrame:
    """The documents whose score is at least :data:`ACCEPT`, unchanged."""
    return score(docs, model, text_col, "_llm_score").filter(F.col("_llm_score") >= ACCEPT).drop("_llm_score")


def report(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, max_rows=max_rows)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))

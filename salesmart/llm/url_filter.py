"""URL filters: rules first, then gradient-boosted trees on lexical features.

A rule names a host and a path prefix; it fits the host, all its subdomains,
and paths that start with its path.  The longest rule that fits decides.  All
other URLs get the verdict of boosted trees over length, depth, digit ratio,
character entropy, parameter counts and suffix statistics (how often URLs
under the same last one or two host labels were labelled ``block``), trained
on a bounded sample of labelled URLs by Spark's own library.  Everything is
DataFrame functions and Spark ML: no Python runs on the executors.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
so no rule fits; its verdict is the model's for an empty text.  Without labelled
URLs of both kinds there is no model, and what no rule blocks is allowed.
Suffixes without labelled URLs count with the overall rate.  Repeated rows get
equal verdicts; other columns pass through, and a column named like a result
is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules are tried as one chain of conditions; larger lists belong in a table.
MAX_RULES = 1000
#: Labelled URLs the trees and the suffix statistics are made from, at most about.
MAX_ROWS = 20_000
#: Trees, their depth, and labelled URLs that a suffix needs to outweigh the overall rate.
TREES, DEPTH, PRIOR = 20, 4, 20.0
#: A probability of ``block`` of at least this blocks.
BLOCK = 0.5

FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "hyphens",
            "params", "query_length", "secure", "fragment", "suffix1", "suffix2")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} make one chain of conditions")
    chain = F
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host)), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chain = chain.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict")))
    return chain if rules else F.lit(None).cast("struct<rule:string,verdict:string>")


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p))


def _lexical(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with host, path, suffix keys and the features that need no statistics, under ``_llm_`` names."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    n = F.greatest(F.length(url), F.lit(1))

    def count(text: Column, pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    columns = {
        "host": host, "path": path,
        "key1": F.substring_index(host, ".", -1), "key2": F.substring_index(host, ".", -2),
        "length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"), "depth": count(path, "/[^/]"),
        "labels": count(host, r"[^.]+"), "digits": count(url, "[0-9]") / n, "entropy": _entropy(url),
        "hyphens": count(host, "-"), "params": count(query, "[^&;]+"), "query_length": F.length(query).cast("double"),
        "secure": F.lower(url).startswith("https:").cast("double"), "fragment": url.contains("#").cast("double"),
    }
    return df.withColumns({f"_llm_{k}": c for k, c in columns.items()})


@dataclass(frozen=True)
class UrlModel:
    """Boosted trees with the suffix statistics they were trained on; no trees: everything is allowed."""

    trees: GBTClassificationModel | None = None
    suffixes: tuple[DataFrame, DataFrame] | None = None
    rate: float = 0.0


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_llm_{f}" for f in FEATURES], outputCol="_llm_features").transform(df)


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", max_rows: int = MAX_ROWS) -> UrlModel:
    """Fit on (url, label) with label 1 for ``block``; about ``max_rows`` URLs at most, chosen by hash.

    A URL counts once, by the majority of its labels.  The suffix statistics
    of a training URL leave out its own label.
    """
    known = labelled.filter(F.col(url_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(url_col).alias("url")).agg(F.avg(F.col(label_col).cast("double")).alias("mean"))
    known = materialize(known.select("url", (F.col("mean") >= 0.5).cast("double").alias("label")), "labelled-urls")
    n, blocked = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        return UrlModel()
    if n > max_rows:
        known = known.filter(F.pmod(F.xxhash64(F.lit(17), "url"), F.lit(1 << 30)) < int(0.97 * max_rows / n * (1 << 30)))
    rate = blocked / n
    rows = _lexical(known, "url")
    suffixes = tuple(
        materialize(rows.groupBy(f"_llm_key{k}").agg(F.count("*").alias(f"_llm_n{k}"), F.sum("label").alias(f"_llm_y{k}")), f"suffix{k}")
        for k in (1, 2))
    rows = _with_suffixes(rows, suffixes, rate, F.col("label"))
    ready = materialize(rows.select("label", *[f"_llm_{f}" for f in FEATURES]), "url-training")
    gbt = GBTClassifier(featuresCol="_llm_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1, minInstancesPerNode=5)
    return UrlModel(gbt.fit(_assembled(ready)), suffixes, rate)


def _with_suffixes(rows: DataFrame, suffixes: tuple[DataFrame, DataFrame], rate: float, own: Column | None = None) -> DataFrame:
    """Smoothed block rates of both suffixes.  The statistics have a row per suffix of the bounded sample."""
    for k, stats in enumerate(suffixes, 1):
        rows = rows.join(F.broadcast(stats), f"_llm_key{k}", "left")
        n, y = F.coalesce(f"_llm_n{k}", F.lit(0)), F.coalesce(f"_llm_y{k}", F.lit(0.0))
        if own is not None:
            n, y = n - 1, y - own
        rows = rows.withColumn(f"_llm_suffix{k}", (y + PRIOR * rate) / (n + PRIOR))
    return rows


def judge(urls: DataFrame, rules: list[Rule], model: UrlModel, url_col: str = "url") -> DataFrame:
    """``urls`` with host, path, rule, score (the model's probability of ``block``) and verdict."""
    rows = _lexical(urls, url_col)
    if model.trees is None:
        rows = rows.withColumn("_llm_score", F.lit(0.0))
    else:
        rows = model.trees.transform(_assembled(_with_suffixes(rows, model.suffixes, model.rate)))
        rows = rows.withColumn("_llm_score", vector_to_array("probability")[1])
    rows = rows.withColumn("_llm_rule", rule_of(F.col("_llm_host"), F.col("_llm_path"), rules))
    own = F.when(F.col("_llm_score") >= BLOCK, F.lit("block")).otherwise(F.lit("allow"))
    results = {"host": F.col("_llm_host"), "path": F.col("_llm_path"), "rule": F.col("_llm_rule.rule"),
               "score": F.col("_llm_score"), "verdict": F.coalesce(F.col("_llm_rule.verdict"), own)}
    kept = [c for c in urls.columns if c.lower() not in results]
    return rows.select(*kept, *[c.alias(name) for name, c in results.items()])


#: The rules of the registered query.
RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label) of pages whose document is labelled: a URL's last number is the document's id; low quality is ``block``."""
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1)
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("q"))
    numbered = pages.select("url", number.try_cast("long").alias("doc_id"))
    return numbered.join(marked, "doc_id").select("url", (F.col("q") < 0.5).cast("int").alias("label"))


def report(pages: DataFrame, labels: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    narrow = pages.select("page_id", "url")
    return judge(narrow, rules, train(labelled_pages(narrow, labels))).select("page_id", "host", "path", "rule", "verdict", "score")

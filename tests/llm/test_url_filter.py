import re

from pyspark.sql import functions as F

from salesmart.llm import url_filter
from salesmart.llm.url_filter import RULES, UrlModel, judge, train

URLS = [
    None, "", "nope", "://", "http://", "HTTP://A.Net", "x://net/", "x://net?/", "https://a.EXAMPLE.net/en/x?u=http://b.org/fr/",
    "http://example.com/de/", "http://xexample.com/de/", "http://b.org:80/fr/", "a://org/fr", "a://org/fr/#x", "b://org#/fr/",
    "http://example.net/en", "http://example.net/EN/", "http://é.net/ß?x#y", "http://a.b.c.example.com/de/1/2/3?a=1&b=2", "l://net/" + "x" * 50000,
    "http://a\n.net/\n?", "http://net/", "http://net/",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def test_rules_against_brute_force(spark, sf):
    own = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    pages = own.unionByName(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url"))
    got = judge(pages, RULES, UrlModel()).select("url", "host", "path", "rule", "verdict").collect()
    assert len(got) == pages.count()
    for r in got:
        host, path, rule = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.name)
        assert r.verdict == (rule.verdict if rule else "allow")


def labelled(spark, n):
    """Blocked URLs have many digits and parameters and sit under one suffix."""
    i = F.col("id")
    bad = F.concat(F.lit("http://"), F.hex(F.xxhash64("id")), F.lit(".bad.example/"), F.hex(F.xxhash64(i + 1)), F.lit("?a=1&b=2&c="), i)
    good = F.concat(F.lit("https://www.site"), (i % 50).cast("string"), F.lit(".good.example/news/"), F.translate(i.cast("string"), "0123456789", "abcdefghij"))
    return spark.range(n).select(F.when(i % 4 == 0, bad).otherwise(good).alias("url"), (i % 4 == 0).cast("int").alias("label"))


def test_trees_learn_labelled_urls(spark):
    rows = labelled(spark, 3000)
    model = train(rows.filter(F.xxhash64("url") % 5 != 0))
    held = judge(rows.filter(F.xxhash64("url") % 5 == 0), [], model)
    right = held.agg(F.avg(((F.col("verdict") == "block").cast("int") == F.col("label")).cast("double"))).first()[0]
    assert right > 0.97


def test_bounded_sample_and_clashing_columns(spark):
    model = train(labelled(spark, 2000), max_rows=500)
    urls = spark.createDataFrame([(1, URLS[9], "mine", "mine")], "page_id long, url string, host string, score string")
    assert judge(urls, RULES, model).columns.count("host") == 1
    assert judge(urls, RULES, model).first()["verdict"] == "block"


def test_report_has_every_page_and_no_python(spark, sf):
    pages, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("pages", "labels"))
    got = url_filter.report(pages, labels)
    assert got.count() == pages.count()
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_one_kind_of_label_and_empty(spark):
    one = spark.createDataFrame([("http://a.b/", 1), (None, 0)], "url string, label int")
    assert train(one).trees is None and train(one.limit(0)).trees is None
    assert judge(one.limit(0), RULES, UrlModel()).count() == 0

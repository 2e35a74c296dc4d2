"""The trigram index against a scan of the same texts."""

import random

import pytest

from salesmart.functions import labels
from salesmart.operators import intake, search
from tests.test_plans import plan

NAMES = ["Green tea", "호밀빵", "자두 케이크", "Sea salt 12", "ÄÖ", "", None, "aaa", "aaaa", "a%b_c", "İstanbul"]


@pytest.fixture(scope="module")
def orders(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice(NAMES)) for k in [*range(1, 300), 12345, 123456, 2_000_000_000]] + [(5, "another of id 5"), (None, "no id")]
    return spark.createDataFrame(rows, "order_id long, name string").repartition(3)


@pytest.fixture(scope="module")
def index(spark, orders, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    search.build_index(orders, path)
    return path


TERMS = ["", " # ", "1", "#12", "#0123", "TEA", "호밀빵", "자두 케", "밀", "aaaa", "aaaaa", "%b_", "äö", "salt 12", " 5 another of",
         "1234", "12345", "zzz", "null", "no id", "i̇st"]


@pytest.mark.parametrize("term", TERMS)
def test_search_equals_the_scan(spark, orders, index, term):
    want = sorted(map(tuple, intake.search_orders(orders, term).collect()), key=str)
    assert sorted(map(tuple, search.search(spark, index, term).collect()), key=str) == want


def test_random_terms_equal_the_scan(spark, orders, index):
    rng = random.Random(7)
    texts = [r[0] for r in orders.select(labels.search_text("order_id", "name")).collect()]
    for _ in range(5):
        text = rng.choice(texts)
        start = rng.randrange(len(text))
        term = text[start:start + rng.randrange(3, 9)]
        want = sorted(map(tuple, intake.search_orders(orders, term).collect()), key=str)
        assert sorted(map(tuple, search.search(spark, index, term).collect()), key=str) == want


def test_only_folders_of_the_rarest_trigrams_are_read(spark, index):
    text = plan(search.candidates(spark, index, "호밀빵"))
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(gram,호밀빵)" in text
    assert search.candidates(spark, index, "12") is None
    assert {r.order_id for r in search.candidates(spark, index, "12345").collect()} == {12345, 123456}


def test_empty_table(spark, tmp_path):
    search.build_index(spark.createDataFrame([], "order_id long, name string"), str(tmp_path))
    assert search.search(spark, str(tmp_path), "tea").count() == 0 and search.search(spark, str(tmp_path), "").count() == 0


def test_postings_are_packed_and_complete(spark, orders, index):
    stored = search._stored(spark, index, "postings")
    one = stored.filter("gram = '호밀빵'").selectExpr("explode(order_ids) AS order_id")
    want = orders.filter("name = '호밀빵'").select("order_id")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    texts = [r[0] for r in orders.select(labels.search_text("order_id", "name")).collect()]
    n = sum(len(search.term_grams(t)) for t in texts)
    assert stored.selectExpr("sum(size(order_ids))").first()[0] == n and stored.count() < n
    assert search._stored(spark, index, "counts").selectExpr("sum(n)").first()[0] == n

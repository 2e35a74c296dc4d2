"""Order intake rules, recent orders, search, menu."""

from pyspark.sql import functions as F

from salesmart.operators import exports, intake
from tests.fixtures import orders_frame, products_frame

MENU = [("A", "커피", "음료", 100), ("B", "빵", "식품", 250)]


def menu(spark):
    return spark.createDataFrame(MENU, "product_id string, name string, category string, unit_price long")


def test_validation_rules(spark):
    cases = [
        ("Z", "1", False, "unknown_product"),
        ("Z", "abc", False, "unknown_product"),  # product error wins
        ("A", "", False, "bad_quantity"),
        ("A", "abc", False, "bad_quantity"),
        ("A", "0", False, "bad_quantity"),
        ("A", "-1", False, "bad_quantity"),
        ("A", "2147483648", False, "bad_quantity"),
        ("A", None, False, "bad_quantity"),
        ("A", "1", True, None),
        ("A", "2147483647", True, None),
        ("B", " 3 ", True, None),
        ("B", "+5", True, None),
    ]
    req = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "rid int, product_id string, quantity string")
    got = {r.rid: (r.accepted, r.reason) for r in intake.validate_orders(req, menu(spark)).collect()}
    assert got == {i: (c[2], c[3]) for i, c in enumerate(cases)}
    priced = {r.rid: (r.quantity, r.unit_price, r.amount) for r in intake.price_snapshot(intake.validate_orders(req, menu(spark)), keep=("rid",)).collect()}
    assert priced[10] == (3, 250, 750) and priced[9] == (2147483647, 100, 214748364700)


def test_recent_orders_totals_and_received(spark):
    orders, products = orders_frame(spark), products_frame(spark)
    recent = intake.recent_orders(orders, products, n=5)
    assert [(r.position, r.order_id) for r in recent.collect()] == [(1, 9), (2, 8), (3, 7), (4, 6), (5, 5)]
    t = intake.recent_order_totals(recent).first()
    assert (t.order_rows, t.quantity_total, t.amount_total) == (5, 13, 7030)
    assert [r.order_id for r in intake.received_order(recent, "7").collect()] == [7]
    assert intake.received_order(recent, "3").count() == 0
    assert intake.received_order(recent, None).count() == 0


def test_search(spark):
    named = orders_frame(spark).join(products_frame(spark), "product_id")
    ids = lambda term: sorted(r.order_id for r in intake.search_orders(named, term).collect())
    assert ids("#0007") == [7]
    assert ids("  ") == list(range(1, 10))
    assert ids("케이크") == [4, 8]
    assert ids("TEA") == [1, 3, 6]


def test_menu_filter_and_categories(spark):
    products = products_frame(spark).repartition(3)
    assert [r.product_id for r in intake.menu_by_category(products, "음료").collect()] == ["lime", "tea"]
    assert [r.product_id for r in intake.menu_by_category(products, "").collect()] == ["lime", "plum", "rye", "salt", "tea"]
    cats = intake.menu_categories(products.unionByName(spark.createDataFrame([("x", "x", ""), ("y", "y", None)], products.schema)))
    assert [(r.category, r.first_product_id) for r in cats.collect()] == [("음료", "lime"), ("제과", "plum"), ("식재료", "salt")]


def test_exports_and_events(spark, scratch):
    orders = orders_frame(spark)
    snap = exports.orders_snapshot(orders).filter("order_id = 8").first()
    assert snap.ordered_at == "2025-03-06T19:05:00+09:00"
    ev = exports.order_events(orders.filter("order_id = 1")).first().event
    assert ev == ('{"event_type":"order.created","order_id":1,"product_id":"tea","quantity":2,'
                  '"unit_price":450,"amount":900,"ordered_at":"2025-03-03T08:15:00+09:00"}')
    exports.write_json_lines(exports.products_snapshot(products_frame(spark)), f"{scratch}/products")
    text = "".join(r.value for r in spark.read.text(f"{scratch}/products").collect())
    assert "호밀빵" in text and "\\u" not in text
    assert orders.filter(F.col("order_id") == 1).count() == 1


def test_search_agrees_with_a_plain_python_filter(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    named = orders_frame(spark).join(products_frame(spark), "product_id")
    rows = [(r.order_id, r.name) for r in named.collect()]
    terms = []

    @settings(max_examples=60, database=None, derandomize=True)
    @given(st.text(alphabet=" #0123456789호밀빵케이크TEa", max_size=5))
    def collect(term):
        terms.append(term)

    collect()
    for term in terms[:40]:
        t = term.strip().lower()
        t = t[1:] if t.startswith("#") else t
        want = sorted(i for i, name in rows if t in f"{i:04d} {i} {name}".lower())
        got = sorted(r.order_id for r in intake.search_orders(named, term).collect())
        assert got == want, term

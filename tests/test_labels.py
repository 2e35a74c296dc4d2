"""Display labels and text rules."""

from pyspark.sql import functions as F

from salesmart.functions import labels


def test_hour_and_category_labels(spark):
    df = spark.createDataFrame([(9, None), (None, ""), (17, "음료")], "h int, c string")
    rows = df.select(labels.hour_label("h").alias("hl"), labels.category_label("c").alias("cl")).collect()
    assert [r.hl for r in rows] == ["09:00–09:59", "시간 정보 없음", "17:00–17:59"]
    assert [r.cl for r in rows] == ["미분류", "미분류", "음료"]


def test_display_name_and_average(spark):
    df = spark.createDataFrame(
        [("커피", "x", "A", 3, 1.005), ("", "빵", "B", 0, None), (None, "", "C", 2, 2.0)],
        "pn string, n string, pid string, cnt long, avg double",
    )
    rows = df.select(
        labels.display_name("pn", "n", "pid").alias("d"), labels.shown_average("avg", "cnt").alias("a")
    ).collect()
    assert [r.d for r in rows] == ["커피", "빵", "C"]
    assert [r.a for r in rows] == [1.01, None, 2.0]  # HALF_UP on the decimal form


def test_menu_kind_first_match_wins(spark):
    df = spark.createDataFrame(
        [("오렌지주스", "식품"), ("딸기쥬스", "음료"), ("치즈케이크", "음료"), ("조각케익", None),
         ("빵", "식품"), ("커피", "음료"), ("머그", "굿즈"), (None, None)],
        "name string, category string",
    )
    kinds = [r.k for r in df.select(labels.menu_kind("name", "category").alias("k")).collect()]
    assert kinds == ["juice", "juice", "cake", "cake", "bakery", "drink", "other", "other"]


def test_quantity_rule(spark):
    texts = ["1", " 7 ", "\t8\n", "+5", "-1", "0", "2147483647", "2147483648", "1.5", "1_000", "1__0", "_1",
             "abc", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    got = [r.v for r in df.select(labels.parse_quantity("q").alias("v")).collect()]
    assert got == [1, 7, 8, 5, -1, 0, 2147483647, None, None, 1000, None, None, None, None, None]


def test_search_text_and_term(spark):
    df = spark.createDataFrame([(12, "Latte"), (12345, None)], "order_id long, name string")
    assert [r.t for r in df.select(labels.search_text("order_id", "name").alias("t")).collect()] == [
        "0012 12 latte", "12345 12345",
    ]
    assert labels.search_term("  #0012 ") == "0012" and labels.search_term("##1") == "#1"
    assert df.filter(labels.search_text("order_id", "name").contains("latte")).count() == 1
    assert df.select(F.lit(1)).count() == 2


def test_quantity_rule_agrees_with_python_int(spark):
    """Property check: for text over digits, signs, underscores and blanks the
    rule accepts exactly what Python's int() accepts (within the int range)."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    samples = []

    @settings(max_examples=300, database=None, derandomize=True)
    @given(st.text(alphabet=" \t\n+-_0123456789x", max_size=12))
    def collect(text):
        samples.append(text)

    collect()
    samples += ["1_000", "+0", "-0", "0_0", "2147483647", "2147483648", " 12 ", "1__2"]

    def expected(text):
        try:
            v = int(text)
        except ValueError:
            return None
        return v if -(2**31) <= v < 2**31 else None

    df = spark.createDataFrame([(i, t) for i, t in enumerate(samples)], "i int, q string")
    got = {r.i: r.v for r in df.select("i", labels.parse_quantity("q").alias("v")).collect()}
    mismatches = [(t, got[i], expected(t)) for i, t in enumerate(samples) if got[i] != expected(t)]
    assert not mismatches, mismatches[:5]

"""Overwrite, append and conditional update on plain Parquet; work folders."""

import pytest

from salesmart import session
from salesmart.operators import tables
from tests.fixtures import ORDERS, orders_frame


def ids(df):
    return sorted(r.order_id for r in df.collect())


def test_overwrite_replaces_and_append_adds(spark, scratch):
    orders, path = orders_frame(spark, [*ORDERS, (10, "tea", 1, 1, None)]), f"{scratch}/t"
    tables.overwrite(orders.filter("order_id > 7"), path)
    tables.overwrite(orders.filter("order_id < 4 or order_date is null"), path)
    assert ids(spark.read.parquet(path)) == [1, 2, 3, 10]
    tables.append(orders.filter("order_id between 4 and 9"), path)
    assert ids(spark.read.parquet(path)) == list(range(1, 11))


def test_append_refuses_other_columns_and_types(spark, scratch):
    orders, path = orders_frame(spark), f"{scratch}/t"
    tables.overwrite(orders, path)
    for bad in (orders.withColumn("more", orders.amount), orders.drop("amount"), orders.withColumn("amount", orders.amount.cast("string"))):
        with pytest.raises(ValueError, match="differ"):
            tables.append(bad, path)
    assert spark.read.parquet(path).count() == 9


def test_conditional_update(spark):
    orders = orders_frame(spark, [*ORDERS, (None, "tea", 1, 7, None)])
    got = {r.order_id: (r.quantity, r.amount) for r in tables.updated(orders, {"quantity": "5", "amount": "unit_price * 5"}, "order_id = 1").collect()}
    assert got[1] == (5, 2250) and got[2] == (1, 620) and got[None] == (1, 7)
    assert tables.updated(orders, {"quantity": "5"}, "order_id = 1").schema == orders.schema
    assert tuple(tables.update_metrics(orders, "order_id = 1").first()) == (10, 1)


def test_cluster_without_shared_folder_is_an_error(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId, master = "app-x", "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Session())


def test_materialized_tables_are_removed_with_the_application(spark):
    df = session.materialize(spark.range(5), "five")
    assert df.count() == 5 and session.work_dir(spark) in df.inputFiles()[0].replace("file://", "")


def by_name(spark, path):
    """File name -> modification time of every data file."""
    import os

    return {f: os.path.getmtime(f.removeprefix("file:")) for f in tables.data_files(spark, path)}


def many(spark, n=40):
    return orders_frame(spark, [(k, "tea" if k % 3 else "rye", 1 + k % 4, 100, f"2025-03-{1 + k % 5:02d}T08:00:00+09:00") for k in range(n)])


def test_loading_days_again_changes_nothing(spark, scratch):
    orders, path = many(spark), f"{scratch}/t"
    first, rest = orders.filter("order_date = '2025-03-01'"), orders.filter("order_date <> '2025-03-01'")
    for part in (first, rest, first, rest):
        tables.load(part, path, "order_date")
    stored = spark.read.schema(orders.schema).parquet(path)
    assert sorted(stored.collect()) == sorted(orders.collect()) and tables.partition_columns(spark, path) == ["order_date"]


def test_a_load_leaves_other_days_files(spark, scratch):
    orders, path = orders_frame(spark, [*ORDERS, (10, "tea", 1, 1, None)]), f"{scratch}/t"
    tables.load(orders, path, "order_date")
    before = by_name(spark, path)
    tables.load(orders.filter("order_id in (5, 6)").withColumn("quantity", orders.quantity + 1), path, "order_date")
    after = by_name(spark, path)
    other = {f: t for f, t in before.items() if "2025-03-04" not in f}
    assert len(other) < len(before) and all(after[f] == t for f, t in other.items())
    assert ids(spark.read.parquet(path)) == list(range(1, 11))
    tables.drop_partitions(spark, path, "order_date", ["2025-03-04", None])
    assert ids(spark.read.parquet(path)) == [1, 2, 3, 4, 7, 8, 9]


def test_a_hot_day_is_written_by_several_tasks(spark, scratch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(60_000).selectExpr("id AS order_id", "uuid() AS note", "DATE'2025-03-01' + IF(id < 50000, 0, CAST(id % 9 AS INT)) AS order_date")
        tables.load(rows, f"{scratch}/t", "order_date")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in tables.data_files(spark, f"{scratch}/t") if "2025-03-01" in f]
    assert len(files) > 3 and spark.read.parquet(f"{scratch}/t").count() == 60_000


@pytest.mark.parametrize("by", [None, "order_date"])
def test_update_rewrites_only_files_with_a_match(spark, scratch, by):
    orders, path = many(spark), f"{scratch}/t"
    placed = orders.repartitionById(4, (orders.order_id % 4).cast("int"))
    tables.overwrite(placed, path, (by,) if by else ())
    before = by_name(spark, path)
    where = "order_id IN (5, 9)" if by is None else "order_id = 5"
    done = tables.update(spark, path, {"quantity": "9", "amount": "unit_price * 9"}, where)
    after, n = by_name(spark, path), 10 if by is None else orders.filter("order_id % 4 = 1 AND order_id % 5 = 0").count()
    hits = 2 if by is None else 1
    assert done == {"num_updated_rows": hits, "num_copied_rows": n - hits, "num_removed_files": 1, "num_added_files": 1}
    assert len(set(before) - set(after)) == 1 and len(set(after) - set(before)) == 1
    assert all(after[f] == t for f, t in before.items() if f in after)
    stored = spark.read.schema(orders.schema).parquet(path)
    want = tables.updated(orders, {"quantity": "9", "amount": "unit_price * 9"}, where)
    assert sorted(stored.select(orders.columns).collect()) == sorted(want.collect())


def test_update_without_a_match_and_of_the_partition(spark, scratch):
    path = f"{scratch}/t"
    tables.overwrite(many(spark), path, ("order_date",))
    before = by_name(spark, path)
    assert set(tables.update(spark, path, {"quantity": "0"}, "order_id = 777").values()) == {0} and by_name(spark, path) == before
    with pytest.raises(ValueError, match="between partitions"):
        tables.update(spark, path, {"order_date": "DATE'2025-01-01'"}, "order_id = 1")


def test_update_keeps_rows_of_null_condition(spark, scratch):
    path = f"{scratch}/t"
    orders = orders_frame(spark, [*ORDERS, (None, "tea", 1, 7, None)])
    tables.overwrite(orders.coalesce(1), path)
    done = tables.update(spark, path, {"quantity": "5"}, "order_id = 1")
    assert done["num_copied_rows"] == 9 and spark.read.parquet(path).filter("quantity = 5 AND order_id IS NULL").count() == 0


@pytest.mark.parametrize("moved", [0, 1])
def test_a_broken_update_is_completed(spark, scratch, moved, monkeypatch):
    """Stopped before any file moved, or after the new one was moved in: the next change finishes it."""
    import os
    import shutil

    path = f"{scratch}/t"
    orders = many(spark)
    tables.overwrite(orders.repartitionById(4, (orders.order_id % 4).cast("int")), path)
    monkeypatch.setattr(tables, "recover", lambda *a: None)
    tables.update(spark, path, {"quantity": "9"}, "order_id = 5")
    monkeypatch.undo()
    staged = next(f for f in os.listdir(path) if f.startswith("_change-"))
    assert ids(spark.read.parquet(path)) == list(range(40)) and spark.read.parquet(path).filter("quantity = 9").count() == 0
    if moved:
        name = next(f for f in os.listdir(f"{path}/{staged}/rows") if f.endswith(".parquet"))
        shutil.copy(f"{path}/{staged}/rows/{name}", f"{path}/{name}")
        os.remove(f"{path}/{staged}/rows/{name}")
    tables.recover(spark, path)
    stored = spark.read.parquet(path)
    assert ids(stored) == list(range(40)) and stored.filter("quantity = 9 AND order_id = 5").count() == 1
    assert not [f for f in os.listdir(path) if f.startswith("_change-")]


def test_a_change_without_marker_is_undone(spark, scratch):
    import os

    path = f"{scratch}/t"
    tables.overwrite(many(spark), path)
    many(spark).write.parquet(f"{path}/_change-x/rows")
    tables.append(many(spark).filter("order_id = 0"), path)
    assert spark.read.parquet(path).count() == 41 and not os.path.exists(f"{path}/_change-x")


def scanned_rows(df):
    """Rows the scan of a collected query has put out."""
    df.collect()
    node, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [node]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return total


def test_bloom_filters_skip_row_groups_of_an_absent_id(spark, scratch):
    orders = many(spark, 400).filter("order_id <> 7")
    placed = orders.repartitionById(4, (orders.order_id % 4).cast("int"))
    tables.overwrite(placed, f"{scratch}/with", lookup=("order_id",))
    tables.overwrite(placed, f"{scratch}/without")
    look = lambda name, k: spark.read.parquet(f"{scratch}/{name}").filter(f"order_id = {k}")
    assert scanned_rows(look("without", 7)) > 0 and scanned_rows(look("with", 7)) == 0
    assert 0 < scanned_rows(look("with", 9)) <= 100 and look("with", 9).count() == 1

"""Malformed lines arrive in the rejects with their text; good rows are unchanged."""

from salesmart.operators import quarantine
from salesmart.plans import batch
from salesmart.session import materialize
from salesmart.sources import files
from tests.fixtures import write_raw


def spoil(data_dir):
    write_raw(data_dir)
    with open(f"{data_dir}/raw/orders.csv", "a", encoding="utf-8") as f:
        f.write('10,tea,zwei,450,2025-03-06T20:00:00+09:00\n11,tea\n12,tea,1,450,later\n13,tea,1,450,2025-03-06T20:00:00+09:00,more\n')
    with open(f"{data_dir}/raw/products.jsonl", "a", encoding="utf-8") as f:
        f.write('{"product_id": "half"\nnot json 한글\n')
    with open(f"{data_dir}/raw/access.log", "a", encoding="utf-8") as f:
        f.write("nonsense\nyesterday GET / 200 1\n2025-03-07T09:00:00+09:00 GET / 99999999999 1\n")
    return data_dir


def test_every_line_is_listed_with_its_text(spark, scratch):
    data_dir = spoil(scratch)
    head = batch.run(spark, data_dir, generated_at="x")
    got = {(r.source, r.reason, r.line, r.file) for r in spark.read.parquet(batch.Zones(data_dir).rejects).collect()}
    assert got == {
        ("orders", "malformed_row", "10,tea,zwei,450,2025-03-06T20:00:00+09:00", "orders.csv"),
        ("orders", "malformed_row", "11,tea", "orders.csv"),
        ("orders", "malformed_row", "13,tea,1,450,2025-03-06T20:00:00+09:00,more", "orders.csv"),
        ("orders", "bad_instant", "later", "orders.csv"),
        ("products", "malformed_row", '{"product_id": "half"', "products.jsonl"),
        ("products", "malformed_row", "not json 한글", "products.jsonl"),
        ("access_log", "unmatched_line", "nonsense", "access.log"),
        ("access_log", "bad_instant", "yesterday GET / 200 1", "access.log"),
        ("access_log", "number_out_of_range", "2025-03-07T09:00:00+09:00 GET / 99999999999 1", "access.log"),
    }
    assert (head["rejected_orders"], head["rejected_products"], head["rejected_log_lines"]) == (4, 2, 3)
    assert head["order_count"] == 10  # the nine good orders and the one without a time


def test_malformed_orders_can_stay(spark, scratch):
    data_dir = spoil(scratch)
    head = batch.run(spark, data_dir, generated_at="x", drop_malformed=False)
    assert head["order_count"] == 13 and head["rejected_orders"] == 4


def test_good_rows_are_those_of_the_plain_reader(spark, scratch):
    data_dir = write_raw(scratch)
    good, rejects = quarantine.split_orders(materialize(files.scan_orders_csv(spark, f"{data_dir}/raw/orders.csv")))
    plain = files.read_orders_csv(spark, f"{data_dir}/raw/orders.csv")
    assert good.schema == plain.schema and sorted(good.collect()) == sorted(plain.collect()) and rejects.count() == 0
    products, bad = quarantine.split_products(materialize(files.scan_products_jsonl(spark, f"{data_dir}/raw/products.jsonl")))
    assert sorted(products.collect()) == sorted(files.read_products_jsonl(spark, f"{data_dir}/raw/products.jsonl").collect()) and bad.count() == 0

"""Loads that take new files only, keep bad rows aside, and leave the last version in force when they fail."""

import pytest
from helpers import rows
from pyspark.sql import functions as F
from shops import small_shop

from ledgerline.model import TABLES
from ledgerline.sources import csv, incremental


def arrive(folder, **frames):
    for name, df in frames.items():
        df = df.drop("stock_on_hand") if name == "products" else df
        csv.write_csv(df, f"{folder}/{name}", mode="append")


def split(df, condition):
    return df.filter(condition), df.filter(f"NOT ({condition})")


def test_growing_folder_equals_one_load(spark, tmp_path):
    files, root = str(tmp_path / "csv"), str(tmp_path / "warehouse")
    shop = small_shop(spark)
    early, late = split(shop.transactions, "transaction_id <= 2")
    early_lines, late_lines = split(shop.transaction_items, "transaction_id <= 2")
    whole = {n: df for n, df in shop.tables() if n not in ("transactions", "transaction_items")}
    arrive(files, **whole, transactions=early, transaction_items=early_lines)
    assert incremental.load_new(spark, files, root) == 1
    assert incremental.load_new(spark, files, root) == 1
    arrive(files, transactions=late, transaction_items=late_lines)
    assert incremental.load_new(spark, files, root) == 2
    found = incremental.read_version(spark, root)
    for name, df in shop.tables():
        columns = [c for c in TABLES[name].columns if c != "stock_on_hand"]
        assert rows(getattr(found, name), *columns) == rows(df, *columns), name
    # stock is counted from the lines of the version that is read
    assert rows(found.products, "product_id", "stock_on_hand") == [(1, -4), (2, 28), (3, 0)]
    before = incremental.read_version(spark, root, 1)
    assert rows(before.transactions, "transaction_id") == [(1,), (2,)]
    assert rows(before.products, "product_id", "stock_on_hand") == [(1, -4), (2, 31), (3, 0)]


def test_bad_rows_are_kept_aside(spark, tmp_path):
    files, root = str(tmp_path / "csv"), str(tmp_path / "warehouse")
    shop = small_shop(spark)
    arrive(files, **{n: df for n, df in shop.tables() if not n.startswith("transaction")})
    assert incremental.load_new(spark, files, root) == 1
    sales = spark.createDataFrame(
        [("1", "1", "credit"), ("2", "77", "cash"), ("3", None, "credit"), ("x", "1", "cash"), ("4", None, "barter"), ("1", "2", "cash")],
        "transaction_id string, customer_id string, payment_type string",
    ).coalesce(1)
    lines = spark.createDataFrame(
        [(1, 1, 1, 2, "5.00"), (2, 2, 1, 1, "5.00"), (3, 1, 99, 1, "5.00"), (4, 1, 1, 0, "5.00"), (5, 1, 1, 1, "cheap")],
        "transaction_item_id int, transaction_id int, product_id int, quantity int, unit_price string",
    )
    arrive(files, transactions=sales, transaction_items=lines)
    assert incremental.load_new(spark, files, root) == 2
    found = incremental.read_version(spark, root)
    assert rows(found.transactions, "transaction_id", "customer_id") == [(1, 1)]
    assert rows(found.transaction_items, "transaction_item_id") == [(1,)]
    why = sorted(r.reasons for r in incremental.rejected(spark, root, "transactions").collect())
    assert why == sorted(
        ["reference:customer_id", "check:credit_requires_customer", "type:transaction_id, required:transaction_id",
         "check:payment_type_known", "repeated:transaction_id"]
    )
    why = sorted(r.reasons for r in incremental.rejected(spark, root, "transaction_items").collect())
    assert why == sorted(
        ["reference:transaction_id", "reference:product_id", "check:quantity_positive", "type:unit_price, required:unit_price"]
    )
    # what is there already does not come in again
    arrive(files, customers=shop.customers.withColumn("nickname", F.lit("again")))
    assert incremental.load_new(spark, files, root) == 3
    assert rows(incremental.read_version(spark, root).customers, "nickname") == rows(shop.customers, "nickname")
    assert incremental.rejected(spark, root, "customers").count() == 2


def test_a_broken_file_leaves_the_last_version(spark, tmp_path):
    files, root = str(tmp_path / "csv"), str(tmp_path / "warehouse")
    shop = small_shop(spark)
    arrive(files, **dict(shop.tables()))
    assert incremental.load_new(spark, files, root) == 1
    broken = tmp_path / "csv" / "units" / "zz-broken.csv"
    broken.write_text("surprise,columns\n1,2\n")
    with pytest.raises(Exception, match=r"(?i)header|conform|columns"):
        incremental.load_new(spark, files, root)
    assert rows(incremental.read_version(spark, root).units, "unit_id") == [(1,), (2,)]
    assert incremental.versions(spark, root).agg(F.max("sequence")).first()[0] == 1
    broken.unlink()
    with pytest.raises(FileNotFoundError):
        incremental.read_version(spark, root, 9)


def test_a_batch_is_stored_once_as_it_came(spark, tmp_path, monkeypatch):
    """What the gate stores besides the accepted rows: the batch in its own columns, and faults."""
    files, root = str(tmp_path / "csv"), str(tmp_path / "warehouse")
    shop = small_shop(spark)
    arrive(files, **{n: df for n, df in shop.tables()})
    kept, stored = [], incremental.materialize

    def storing(df, label):
        out = stored(df, label)
        kept.append((label, out.columns, out.count()))
        return out

    monkeypatch.setattr(incremental, "materialize", storing)
    assert incremental.load_new(spark, files, root) == 1
    for label, columns, n in kept:
        assert "__text" not in columns and "__reasons" not in columns
        assert label.startswith("taken-") or n == 0
    assert sum(label.startswith("taken-") for label, _, _ in kept) == len(TABLES)

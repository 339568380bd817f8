"""Validators break on exactly the rule they test; change paths agree."""

import random
from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerline.model import TABLES
from ledgerline.operators import changes, keys, quality
from ledgerline.plans import marts, reports
from shops import NOW, small_shop


def broken(shop, *names):
    """Violated rules of the named tables and their parents, of all tables by default."""
    frames = dict(shop.tables())
    if names:
        parents = {p for n in names for p, _, _ in TABLES[n].references.values()}
        frames = {n: df for n, df in frames.items() if n in names or n in parents}
    return rows(quality.rule_counts(frames).filter("n_violations > 0"))


def with_row(shop, name, /, **values):
    table = TABLES[name]
    row = {"created_at": NOW, "updated_at": NOW, "is_active": True, **values}
    extra = shop.products.sparkSession.createDataFrame(
        [tuple(row.get(c) for c in table.columns)], table.schema
    )
    return shop.replace(**{name: getattr(shop, name).unionByName(extra)})


def test_a_sound_shop_has_no_violations(spark):
    assert broken(small_shop(spark)) == []


@pytest.mark.parametrize(
    "table,values,rule",
    [
        ("transactions", dict(transaction_id=90, transaction_date=NOW, payment_type="credit"),
         "check:credit_requires_customer"),
        ("transactions", dict(transaction_id=90, transaction_date=NOW, payment_type="card"),
         "check:payment_type_known"),
        ("transaction_items",
         dict(transaction_item_id=90, transaction_id=1, product_id=1, quantity=0, unit_price=D("1.00")),
         "check:quantity_positive"),
        ("transaction_items",
         dict(transaction_item_id=90, transaction_id=1, product_id=1, quantity=1, unit_price=D("-0.01")),
         "check:unit_price_not_negative"),
        ("transaction_items",
         dict(transaction_item_id=90, transaction_id=1, product_id=77, quantity=1, unit_price=D("1.00")),
         "reference:product_id"),
        ("restock_items",
         dict(restock_item_id=90, restock_id=1, product_id=1, quantity=1, unit_cost=D("-0.01")),
         "check:unit_cost_not_negative"),
        ("credit_payments",
         dict(payment_id=90, customer_id=1, amount=D("0.00"), payment_date=NOW),
         "check:amount_positive"),
        ("customers", dict(customer_id=90, full_name="X", credit_limit=D("-0.01")),
         "check:credit_limit_not_negative"),
        ("customers", dict(customer_id=1, full_name="X", credit_limit=D("0.00")), "key:customer_id"),
        ("customers", dict(customer_id=90, credit_limit=D("0.00")), "required:full_name"),
        ("categories", dict(category_id=90, name="Pantry"), "unique:name"),
        ("restocks", dict(restock_id=90, supplier_id=55, restock_date=NOW), "reference:supplier_id"),
    ],
)
def test_each_rule_reports_its_violation(spark, table, values, rule):
    assert broken(with_row(small_shop(spark), table, **values), table) == [(table, rule, 1)]


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "code string")
    assert rows(quality.unique_violations(df, ["code"])) == [("a", 2)]
    assert rows(quality.pk_violations(df, ["code"])) == [("a", 2), (None, 2)]


def test_restrict_and_cascade(spark):
    shop = small_shop(spark)
    gone = shop.products.filter("product_id = 1")
    blockers = quality.restrict_blockers(gone, "product_id", shop.transaction_items, "product_id")
    assert rows(blockers) == [(1, 2)]
    voided = shop.transactions.filter("transaction_id = 1")
    args = (shop.transaction_items, "transaction_id", voided, "transaction_id")
    assert quality.cascade_survivors(*args).count() + quality.cascade_deletes(*args).count() == 4
    # the deleted lines return their stock
    back = changes.net_stock(
        changes.stock_deltas(changes.line_deletes(quality.cascade_deletes(*args), "sale"))
    )
    assert rows(back) == [(1, 2), (2, 1)]


def test_fd_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", None)], "x string, y int")
    assert rows(quality.fd_violations(df, ["x"], ["y"])) == [("b", 2)]


def test_stored_mismatch_counts_missing_as_different(spark):
    stored = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "k int, s int")
    derived = spark.createDataFrame([(1, 5), (2, 9)], "k int, d int")
    assert rows(quality.stored_mismatch(stored, derived, "k", "s", "d")) == [(2, 6, 9), (3, 7, None)]


def test_drift_after_recompute_is_zero(spark):
    shop = small_shop(spark)
    assert reports.stock_drift(shop).count() > 0
    fresh = shop.replace(products=marts.recompute_stock(shop))
    assert reports.stock_drift(fresh).count() == 0
    off = fresh.products.withColumn(
        "stock_on_hand", F.col("stock_on_hand") + F.when(F.col("product_id") == 2, 1).otherwise(0)
    )
    assert rows(reports.stock_drift(fresh.replace(products=off)), "product_id", "drift") == [(2, 1)]


def test_change_path_equals_derived_stock(spark):
    """Inserting every line through the change feed gives the derived stock."""
    shop = small_shop(spark)
    feed = changes.line_inserts(shop.restock_items, "restock").unionByName(
        changes.line_inserts(shop.transaction_items, "sale")
    )
    empty = shop.products.withColumn("stock_on_hand", F.lit(0).cast("bigint"))
    maintained = changes.apply_stock(empty, changes.stock_deltas(feed))
    assert rows(maintained, "product_id", "stock_on_hand") == rows(
        marts.on_hand(shop), "product_id", "on_hand"
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_changes_in_any_split(spark, seed):
    """Deltas of any split of a change sequence add up to the final lines."""
    draw = random.Random(seed)
    lines, feed = {}, []
    for i in range(120):
        side = draw.choice(["sale", "restock"])
        op = draw.choice(["INSERT", "UPDATE", "DELETE"]) if lines else "INSERT"
        if op == "INSERT":
            line = (side, draw.randrange(5), draw.randrange(1, 9))
            lines[i] = line
            feed.append((i, side, op, line[1], line[2], None, None))
            continue
        key = draw.choice(list(lines))
        side, product, quantity = lines[key]
        if op == "DELETE":
            del lines[key]
            feed.append((i, side, op, product, quantity, None, None))
        else:
            new = (side, draw.randrange(5), draw.randrange(1, 9))
            lines[key] = new
            feed.append((i, side, op, product, quantity, new[1], new[2]))
    expected = {}
    for side, product, quantity in lines.values():
        expected[product] = expected.get(product, 0) + (quantity if side == "restock" else -quantity)
    schema = (
        "change_id long, side string, op string, product_id long, quantity int,"
        " new_product_id long, new_quantity int"
    )
    draw.shuffle(feed)
    cut = draw.randrange(len(feed))
    parts = [
        changes.net_stock(changes.stock_deltas(spark.createDataFrame(part, schema)))
        for part in (feed[:cut], feed[cut:])
        if part
    ]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    got = {r[0]: r[1] for r in both.groupBy("product_id").sum("stock_delta").collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in expected.items() if v}


def test_upsert_takes_the_newest_and_stamps_real_changes(spark):
    old, new = datetime(2020, 1, 1), datetime(2024, 1, 1)
    base = spark.createDataFrame(
        [(1, "a", None, old), (2, "b", "x", old), (3, "c", "y", old)],
        "id int, name string, note string, updated_at timestamp",
    )
    feed = spark.createDataFrame(
        [(1, 10, "z", None), (1, 11, "A", None), (2, 12, "b", "x"), (4, 13, "d", "n")],
        "id int, version int, name string, note string",
    )
    out = changes.upsert(base, feed, "id", ["version"], new)
    assert out.columns == base.columns
    assert rows(out) == [
        (1, "A", None, new), (2, "b", "x", old), (3, "c", "y", old), (4, "d", "n", new),
    ]


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "id int, x string, y int")
    after = spark.createDataFrame([(2, "B", 5), (3, "c", 3), (4, "d", 4)], "id int, x string, y int")
    assert rows(changes.snapshot_diff(before, after, "id", ["x", "y"])) == [
        (1, "DELETE", ""), (2, "UPDATE", "x,y"), (4, "INSERT", ""),
    ]


def test_resolve_keys_policies(spark):
    facts = spark.createDataFrame([("a", 1), ("q", 2), (None, 3), ("q", 4)], "t string, v int")
    dim = spark.createDataFrame([(1, "a"), (5, "a"), (2, "b")], "id long, name string")
    stub = keys.resolve_keys(facts, dim, "t", "name", "id", "stub")
    assert rows(stub.rows) == [(1, 1), (6, 2), (6, 4), (None, 3)]
    assert rows(stub.dimension) == [(1, "a"), (2, "b"), (5, "a"), (6, "q")]
    assert rows(stub.unresolved) == [("q", 2)]
    drop = keys.resolve_keys(facts, dim, "t", "name", "id", "drop")
    assert rows(drop.rows) == [(1, 1), (None, 3)]
    assert rows(keys.resolve_keys(facts, dim, "t", "name", "id", "quarantine").unresolved) == [
        ("q", 2), ("q", 4),
    ]
    with pytest.raises(ValueError):
        keys.resolve_keys(facts, dim, "t", "name", "id", "guess")


def test_extract_dimension_is_distinct_before_numbered(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("b", 1), (None, 9), ("a", 1)], "n string, c int")
    assert rows(keys.extract_dimension(df, "id", ["n"], ["c"])) == [(1, "a", 1), (2, "b", 1)]


def test_left_join_named_keeps_rows_without_key(spark):
    facts = spark.createDataFrame([(1, 7), (2, None), (3, 8)], "f int, k int")
    dim = spark.createDataFrame([(7, "x")], "k int, name string")
    assert rows(keys.left_join_named(facts, dim, "k")) == [(1, 7, "x"), (2, None, None), (3, 8, None)]


def test_null_keys_in_upserts_and_differences(spark):
    from datetime import datetime

    schema = "id long, x string, updated_at timestamp"
    base = spark.createDataFrame([(1, "a", datetime(2000, 1, 1))], schema)
    new = spark.createDataFrame([(None, "z", 1), (1, "b", 1), (2, "c", 1)], "id long, x string, v int")
    got = changes.upsert(base, new, "id", ["v"], datetime(2001, 1, 1))
    assert rows(got, "id", "x") == [(1, "b"), (2, "c")]
    before = spark.createDataFrame([(None, "a"), (1, "a")], "id long, x string")
    after = spark.createDataFrame([(1, "a"), (None, "c"), (None, "d")], "id long, x string")
    log = changes.snapshot_diff(before, after, "id", ["x"])
    assert rows(log, "id", "op") == [(None, "DELETE"), (None, "INSERT"), (None, "INSERT")]


def test_deletes_follow_the_references(spark):
    from ledgerline.operators import deletes

    shop = small_shop(spark)
    sales = spark.createDataFrame([(1,), (99,)], "transaction_id long")
    gone = shop.transaction_items.filter("transaction_id = 1")
    sold = {r.product_id: r.q for r in gone.groupBy("product_id").agg(F.sum("quantity").alias("q")).collect()}
    done = deletes.delete_rows(shop, "transactions", sales)
    assert done.shop.transactions.filter("transaction_id = 1").count() == 0
    assert done.shop.transaction_items.filter("transaction_id = 1").count() == 0
    assert done.shop.transaction_items.count() == shop.transaction_items.count() - gone.count()
    assert rows(done.gone["transaction_items"]) == rows(gone)
    before = dict(rows(shop.products, "product_id", "stock_on_hand"))
    after = dict(rows(done.shop.products, "product_id", "stock_on_hand"))
    assert after == {k: v + sold.get(k, 0) for k, v in before.items()}
    with pytest.raises(deletes.DeleteBlocked, match="customers: transactions.customer_id"):
        deletes.delete_rows(shop, "customers", shop.customers.select("customer_id"))


def test_marts_as_views(spark):
    from ledgerline.plans import marts

    marts.register_views(spark, small_shop(spark))
    assert spark.sql("SELECT * FROM customer_balances b JOIN customers c USING (customer_id)").count() == 2
    assert spark.sql("SELECT MAX(running_balance) AS m FROM credit_ledger").first().m == 49
    assert spark.sql("SELECT COUNT(*) AS n FROM product_stock").first().n == 3

"""The flat lists become the expected shop."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import notebook
from helpers import rows
from ledgerline.operators import quality
from ledgerline.plans import marts, normalize


@pytest.fixture(scope="module")
def result(spark):
    return normalize.normalize(*notebook.frames(spark))


def test_dimensions(result):
    shop = result.shop
    assert rows(shop.categories, "category_id", "name") == [(1, "Dairy"), (2, "Pantry")]
    assert rows(shop.units, "unit_id", "code") == [(1, "bag"), (2, "btl")]
    assert rows(shop.suppliers, "supplier_id", "name") == [(1, "North Mill"), (2, "South Dairy")]


def test_customers_are_distinct_and_the_latest_note_wins(result):
    assert rows(result.shop.customers, "customer_id", "full_name", "phone") == [
        (1, "Anna", "999"), (2, "Bert", "902"),
    ]


def test_missing_product_becomes_a_stub(result):
    got = rows(result.shop.products, "product_id", "name", "current_price")
    assert got == [
        (1, "Flour 1kg", D("20.00")), (2, "Milk 1l", D("9.00")), (3, "Oats 500g", D("12.50")),
        (4, "Cider 1l", None),
    ]
    assert rows(result.unresolved_sales) == [("Cider 1l", 1)]


def test_supplier_prices_move_to_the_bridge(result):
    milk = result.product_suppliers.filter("product_id = 2")
    assert rows(milk) == [(2, 1, D("8.50")), (2, 2, D("9.00"))]
    assert rows(result.product_alt_suppliers) == [(3, "East Trade"), (3, "South Dairy")]


def test_equal_sales_stay_two_sales(result):
    shop = result.shop
    assert shop.transactions.count() == 7
    assert shop.transaction_items.count() == 10
    assert quality.pk_violations(shop.transaction_items, ["transaction_item_id"]).count() == 0
    oats = shop.transaction_items.filter("product_id = 3")
    assert oats.select("transaction_id").distinct().count() == 3


def test_totals_agree_with_the_stored_ones(spark, result):
    derived = result.shop.transaction_items.agg(F.sum(F.expr("quantity * unit_price"))).first()[0]
    assert derived == sum(r[15] for r in notebook.SALES_ROWS)


def test_balances(result):
    got = rows(marts.customer_balances(result.shop.replace(
        customers=result.shop.customers.withColumn("credit_limit", F.lit(D("0.00")))
    )), "full_name", "balance")
    assert got == [("Anna", D("83.00")), ("Bert", D("128.00"))]


def test_on_hand(result):
    names = result.shop.products.select("product_id", "name")
    got = rows(marts.on_hand(result.shop).join(names, "product_id"), "name", "on_hand")
    assert got == [("Cider 1l", -3), ("Flour 1kg", 26), ("Milk 1l", 20), ("Oats 500g", 16)]


def test_deliveries(result):
    shop = result.shop
    assert rows(shop.restocks, "restock_id", "supplier_id", "reference_no", "notes") == [
        (1, 1, "D-1", None), (2, 2, "D-2", "cold"),
    ]
    assert rows(shop.restock_items, "restock_id", "product_id", "quantity") == [
        (1, 1, 30), (1, 3, 20), (2, 2, 24),
    ]


def test_drop_policy_loses_the_unknown_product(spark):
    sales = notebook.frames(spark)[1]
    products = normalize.split_inventory(notebook.frames(spark)[0]).products
    kept = normalize.split_sales(sales, products, "drop")
    assert kept.transaction_items.count() == 9


def test_normalization_is_repeatable(spark, result):
    again = normalize.normalize(*notebook.frames(spark))
    for name in ("transactions", "transaction_items", "customers", "restock_items"):
        assert rows(getattr(again.shop, name)) == rows(getattr(result.shop, name)), name


def test_balance_notes_disagree(spark):
    sales = notebook.frames(spark)[1].filter("customer_name IS NOT NULL")
    assert rows(quality.fd_violations(sales, ["customer_name"], ["customer_balance"])) == [("Anna", 2)]


def test_sales_list_is_computed_once(spark):
    from pyspark.sql import functions as F

    from ledgerline.plans import normalize

    seen = spark.sparkContext.accumulator(0)

    def count(note):
        seen.add(1)
        return note

    raw = spark.range(50).selectExpr("date'2024-01-01' AS sale_date", "CAST(id % 7 AS STRING) AS customer_name", "CAST(id AS STRING) AS notes")
    raw = raw.withColumn("notes", F.udf(count)("notes"))
    assert normalize.key_sales(raw).count() == 50
    assert seen.value == 50

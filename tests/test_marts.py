"""Marts and reports on a shop small enough to check by hand."""

from decimal import Decimal as D

import pytest

from helpers import rows
from ledgerline.plans import analytics, marts, reports
from shops import day, small_shop


def test_product_stock(spark):
    got = rows(marts.product_stock(small_shop(spark)))
    assert got == [
        (1, "Flour", "Pantry", "bag", 5, 10, 14, -4, 7, True),
        (2, "Milk", "Dairy", "btl", 12, 32, 4, 28, 1, False),
        (3, "Rye", "Pantry", "bag", 0, 0, 0, 0, 0, True),
    ]


def test_customer_balances(spark):
    got = rows(
        marts.customer_balances(small_shop(spark)),
        "customer_id", "total_utang", "total_paid", "balance", "credit_available",
    )
    assert got == [
        (1, D("76.00"), D("30.00"), D("46.00"), D("54.00")),
        (2, D("0.00"), D("5.00"), D("-5.00"), D("55.00")),
    ]


@pytest.mark.parametrize("hot", [[], [1], [1, 2]])
def test_credit_ledger(spark, hot):
    shop = small_shop(spark)
    table = spark.createDataFrame([(k,) for k in hot], "customer_id long")
    got = rows(marts.credit_ledger(shop, hot=table))
    assert rows(marts.credit_ledger(shop, hot=table, customer_ids=[1])) == [r for r in got if r[0] == 1]
    assert got == [
        (1, day(2), "charge", "TXN#1", D("49.00"), D("0.00"), D("49.00")),
        (1, day(4), "payment", "PAY#1", D("0.00"), D("30.00"), D("19.00")),
        (1, day(5), "charge", "TXN#4", D("27.00"), D("0.00"), D("46.00")),
        (2, day(4), "payment", "PAY#2", D("0.00"), D("5.00"), D("-5.00")),
    ]


def test_last_ledger_balance_is_the_customer_balance(spark, sf_dir):
    from pyspark.sql import functions as F

    from ledgerline.sources import tables

    shop = tables.shop(spark, sf_dir)
    last = marts.credit_ledger(shop).groupBy("customer_id").agg(
        F.max_by("running_balance", F.struct("entry_date", "reference")).alias("last")
    )
    both = marts.customer_balances(shop).join(last, "customer_id")
    assert both.count() > 0
    assert both.filter("balance <> last").count() == 0


def test_category_report(spark):
    shop = small_shop(spark)
    assert [tuple(r) for r in reports.top_categories(shop).collect()] == [
        ("Pantry", 14, D("274.00")), ("Dairy", 4, D("36.00")),
    ]
    assert rows(reports.daily_category_revenue(shop))[0][1:] == ("Dairy", D("9.00"))


def test_walk_ins_are_kept(spark):
    shop = small_shop(spark)
    assert rows(reports.walkin_vs_named(shop)) == [
        ("named", 4, D("76.00")), ("walk-in", 1, D("234.00")),
    ]
    assert reports.sales_with_customer(shop).count() == 5


def test_chasm_guard_shows_the_inflated_totals(spark):
    got = rows(reports.chasm_guard(small_shop(spark)))
    # Milk: 2 delivery lines and 2 sale lines double each other
    assert got[1] == (2, 32, 4, 64, 8)


def test_integrity_report_and_counts(spark):
    shop = small_shop(spark)
    report = {r["metric"]: r["value"] for r in reports.integrity_report(shop).collect()}
    assert report["stock_drift"] == 2 and report["negative_balances"] == 1
    assert report["total_outstanding"] == D("41.00")
    assert report["rows:transaction_items"] == 4
    counts = {r[0]: r[1] for r in reports.table_counts(dict(shop.tables())).collect()}
    assert counts["TOTAL"] == sum(v for k, v in counts.items() if k != "TOTAL")


def test_credit_first_date_counts_sales_without_lines_as_zero(spark):
    got = rows(reports.credit_first_date(small_shop(spark)))
    assert got == [(1, D("76.00"), day(2))]


def test_payments_settle_oldest_charges_first(spark):
    shop = small_shop(spark)
    assert rows(analytics.payment_allocation(shop)) == [(1, 1, 1, D("30.00"))]
    aging = rows(analytics.invoice_aging(shop))
    assert aging == [("0-30", 2, D("46.00"))]


def test_price_as_of_uses_the_last_change(spark):
    history = spark.createDataFrame(
        [(1, "2025-01-05", 10), (1, "2025-01-20", 12)], "product_id int, valid_from string, price int"
    ).selectExpr("product_id", "to_date(valid_from) valid_from", "price")
    lookups = spark.createDataFrame(
        [(1, "2025-01-04"), (1, "2025-01-05"), (1, "2025-01-19"), (1, "2025-01-20"), (2, "2025-01-20")],
        "product_id int, day string",
    ).selectExpr("product_id", "to_date(day) day")
    got = {(r[0], str(r[1])): r[2] for r in rows(analytics.price_as_of(history, lookups))}
    assert got == {
        (1, "2025-01-04"): None,
        (1, "2025-01-05"): 10,
        (1, "2025-01-19"): 10,
        (1, "2025-01-20"): 12,
        (2, "2025-01-20"): None,
    }

"""The three marts: product stock, customer balances and the credit ledger.

Facts are summed before they meet a dimension or each other. That keeps two
facts from multiplying one another, lets partial aggregation absorb hot keys
before any shuffle, and leaves joins between tables with one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.money import cents, line_cents, money, or_zero
from ledgerline.functions.text import tagged
from ledgerline.model import Shop
from ledgerline.operators.ordered import hot_keys, running_total


def units_by_product(items: DataFrame, out: str) -> DataFrame:
    return items.groupBy("product_id").agg(F.sum("quantity").alias(out))


def on_hand(shop: Shop) -> DataFrame:
    """Stock per product derived from deliveries and sales."""
    received = units_by_product(shop.restock_items, "total_restocked")
    sold = units_by_product(shop.transaction_items, "total_sold")
    return (
        shop.products.select("product_id")
        .join(received, "product_id", "left")
        .join(sold, "product_id", "left")
        .selectExpr(
            "product_id",
            "coalesce(total_restocked, 0) AS total_restocked",
            "coalesce(total_sold, 0) AS total_sold",
            "coalesce(total_restocked, 0) - coalesce(total_sold, 0) AS on_hand",
        )
    )


def product_stock(shop: Shop) -> DataFrame:
    """Derived stock next to the stored count, with the reorder flag."""
    categories = shop.categories.selectExpr("category_id", "name AS category")
    units = shop.units.selectExpr("unit_id", "code AS unit")
    return (
        shop.products.join(on_hand(shop), "product_id")
        .join(categories, "category_id")
        .join(units, "unit_id")
        .selectExpr(
            "product_id",
            "name AS product",
            "category",
            "unit",
            "reorder_level",
            "total_restocked",
            "total_sold",
            "on_hand",
            "CAST(stock_on_hand AS BIGINT) AS maintained_on_hand",
            "on_hand <= reorder_level AS needs_reorder",
        )
    )


def recompute_stock(shop: Shop) -> DataFrame:
    """The products table with the stored count set from the derived stock."""
    derived = on_hand(shop).select("product_id", F.col("on_hand").alias("stock_on_hand"))
    fresh = shop.products.drop("stock_on_hand").join(derived, "product_id")
    return fresh.select(*shop.products.columns)


def sale_totals(shop: Shop) -> DataFrame:
    """Centavos and units per sale that has lines; one row per sale."""
    return shop.transaction_items.groupBy("transaction_id").agg(
        F.sum(line_cents()).alias("sale_cents"), F.sum("quantity").alias("sale_units")
    )


def credit_sales(shop: Shop) -> DataFrame:
    """Sales on credit to a known customer."""
    return shop.transactions.filter(
        "payment_type = 'credit' AND customer_id IS NOT NULL"
    ).select("transaction_id", "customer_id", "transaction_date")


def charges(shop: Shop, few: bool = False) -> DataFrame:
    """Credit sales that have lines, with their total in centavos.

    With ``few`` the sales are expected to be a small part of all; their lines
    are picked before they are summed, so no other line is shuffled.
    """
    sales = credit_sales(shop)
    if few:
        own = shop.transaction_items.join(sales.select("transaction_id"), "transaction_id", "left_semi")
        shop = shop.replace(transaction_items=own)
    totals = sale_totals(shop).select("transaction_id", "sale_cents")
    return sales.join(totals, "transaction_id")


def of_customers(shop: Shop, customer_ids: Sequence[int]) -> Shop:
    """The shop with the sales and payments of some customers only; lines are left as they are."""
    chosen = F.col("customer_id").isin(*customer_ids)
    return shop.replace(
        transactions=shop.transactions.filter(chosen), credit_payments=shop.credit_payments.filter(chosen)
    )


def balance_cents(shop: Shop) -> DataFrame:
    """Charged and paid centavos of every customer."""
    charged = charges(shop).groupBy("customer_id").agg(F.sum("sale_cents").alias("charged"))
    paid = shop.credit_payments.groupBy("customer_id").agg(F.sum(cents("amount")).alias("paid"))
    return (
        shop.customers.join(charged, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .withColumn("charged", or_zero("charged"))
        .withColumn("paid", or_zero("paid"))
        .withColumn("owed", F.col("charged") - F.col("paid"))
    )


def customer_balances(shop: Shop) -> DataFrame:
    """Credit balance of every customer and what is left of the credit limit."""
    return balance_cents(shop).select(
        "customer_id",
        "full_name",
        "nickname",
        "credit_limit",
        money("charged").alias("total_utang"),
        money("paid").alias("total_paid"),
        money("owed").alias("balance"),
        money(cents("credit_limit") - F.col("owed")).alias("credit_available"),
    )


def ledger_entries(shop: Shop, few: bool = False) -> DataFrame:
    """Charges and payments on one timeline, amounts in centavos; ``few`` as in :func:`charges`."""
    zero = F.lit(0).cast("bigint")
    sales = charges(shop, few).select(
        "customer_id",
        F.col("transaction_date").alias("entry_date"),
        F.lit("charge").alias("entry_type"),
        tagged("TXN#", "transaction_id").alias("reference"),
        F.col("sale_cents").alias("debit_cents"),
        zero.alias("credit_cents"),
    )
    payments = shop.credit_payments.select(
        "customer_id",
        F.col("payment_date").alias("entry_date"),
        F.lit("payment").alias("entry_type"),
        tagged("PAY#", "payment_id").alias("reference"),
        zero.alias("debit_cents"),
        cents("amount").alias("credit_cents"),
    )
    return sales.unionByName(payments)


def hot_customers(shop: Shop, rows: int | None = None) -> DataFrame:
    """Customers with more ledger entries than one task should sort.

    Counts headers and payments only; no line is read.
    """
    keys = credit_sales(shop).select("customer_id").unionByName(
        shop.credit_payments.select("customer_id")
    )
    return hot_keys(keys, "customer_id", rows)


def credit_ledger(
    shop: Shop, hot: DataFrame | None = None, customer_ids: Sequence[int] | None = None
) -> DataFrame:
    """The ledger with a running balance per customer.

    Entries of one customer are ordered by date and then by the text of their
    reference. ``hot`` defaults to what :func:`hot_customers` finds. With
    ``customer_ids`` only these customers' headers, lines and payments are
    counted, summed and shuffled.
    """
    if customer_ids is not None:
        shop = of_customers(shop, customer_ids)
    entries = ledger_entries(shop, few=customer_ids is not None).withColumn("net", F.col("debit_cents") - F.col("credit_cents"))
    ledger = running_total(
        entries,
        key="customer_id",
        order=["entry_date", "reference", "net"],
        value="net",
        out="running_cents",
        hot=hot_customers(shop) if hot is None else hot,
    )
    return ledger.select(
        "customer_id",
        "entry_date",
        "entry_type",
        "reference",
        money("debit_cents").alias("debit"),
        money("credit_cents").alias("credit"),
        money("running_cents").alias("running_balance"),
    )


VIEWS = {
    "product_stock": product_stock,
    "customer_balances": customer_balances,
    "credit_ledger": credit_ledger,
}


def register_views(spark: SparkSession, shop: Shop, tables: bool = True) -> None:
    """Make the marts, and with ``tables`` the ten tables, available to SQL text by name."""
    if tables:
        for name, df in shop.tables():
            df.createOrReplaceTempView(name)
    for name, mart in VIEWS.items():
        mart(shop).createOrReplaceTempView(name)

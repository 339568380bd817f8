"""Marts that are moved by changes instead of being computed anew."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.money import money, or_zero
from ledgerline.streaming.joined import WEIGHT, JoinedTotal, apply_changes, changed_rows, totals

CENTS = "quantity * CAST(unit_price * 100 AS BIGINT)"

# what customers were charged: lines of credit sales, by the customer on the header
CHARGED = JoinedTotal(
    key="transaction_id",
    group="customer_id",
    measures={"charged": CENTS},
    keep="payment_type = 'credit' AND customer_id IS NOT NULL",
)
# what groups of products sold: lines of sales, by the group on the product
SOLD = JoinedTotal(key="product_id", group="category_id", measures={"units": "quantity", "sales": CENTS})


@dataclass(frozen=True)
class Changes:
    """Rows of the shop's tables that one batch takes away and adds (see ``changed_rows``)."""

    transactions: DataFrame | None = None
    transaction_items: DataFrame | None = None
    credit_payments: DataFrame | None = None
    products: DataFrame | None = None


def apply_payments(root: str, batch_id: int, payments: DataFrame) -> None:
    """Move what customers paid; payments join nothing, so a batch adds up to one row per customer."""
    cents = F.expr(f"CAST(amount * 100 AS BIGINT) * {WEIGHT}")
    net = payments.groupBy("customer_id").agg(F.sum(cents).cast("bigint").alias("paid"))
    net.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def keep_balances(root: str, batches: Iterable[Changes], first: int = 0) -> None:
    """Apply batches of changes to the balances in ``root``; ``first`` is the id of the first one."""
    for batch_id, changes in enumerate(batches, first):
        apply_changes(CHARGED, f"{root}/charged", batch_id, changes.transactions, changes.transaction_items)
        if changes.credit_payments is not None:
            apply_payments(f"{root}/paid", batch_id, changes.credit_payments)


def kept_balances(spark: SparkSession, root: str, customers: DataFrame) -> DataFrame:
    """Charges, payments and balance of every customer, from what the batches moved."""
    charged = totals(spark, CHARGED, f"{root}/charged")
    paid = spark.read.parquet(f"{root}/paid").groupBy("customer_id").agg(F.sum("paid").alias("paid"))
    both = customers.join(charged, "customer_id", "left").join(paid, "customer_id", "left")
    return both.select(
        "customer_id",
        money(or_zero("charged")).alias("total_utang"),
        money(or_zero("paid")).alias("total_paid"),
        money(or_zero("charged") - or_zero("paid")).alias("balance"),
    )


def keep_category_sales(root: str, batches: Iterable[Changes], first: int = 0) -> None:
    """Apply batches of changes to products and sale lines to the sales per product group in ``root``."""
    for batch_id, changes in enumerate(batches, first):
        apply_changes(SOLD, root, batch_id, changes.products, changes.transaction_items)


def kept_category_sales(spark: SparkSession, root: str) -> DataFrame:
    """Units and sales of every product group that ever sold."""
    return totals(spark, SOLD, root).select(
        F.col("category_id").alias("category"), "units", money("sales").alias("sales")
    )


__all__ = [
    "CHARGED", "SOLD", "Changes", "changed_rows", "keep_balances", "kept_balances", "keep_category_sales",
    "kept_category_sales",
]

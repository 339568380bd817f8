"""Batches of changes to the shop's tables, derived from the supplied ones.

Headers come before or after their lines, sales move to other customers, lines are corrected,
taken out and put back, and whole sales are deleted with or without their lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.maintained import Changes, changed_rows
from ledgerline.sources import tables


def _corrected_lines(lines: DataFrame) -> DataFrame:
    more = F.col("line_no") == 2
    return lines.withColumn("quantity", F.when(more, F.col("quantity") + 1).otherwise(F.col("quantity")).cast("int"))


def _moved_sales(sales: DataFrame) -> DataFrame:
    moved, credit = F.col("transaction_id") % 7 == 3, F.col("transaction_id") % 14 == 3
    return sales.withColumn(
        "customer_id", F.when(moved, F.expr("customer_id DIV 2")).otherwise(F.col("customer_id"))
    ).withColumn("payment_type", F.when(credit, "credit").otherwise(F.col("payment_type")))


def sale_batches(spark: SparkSession, sf_dir: str) -> list[Changes]:
    """Four batches on sales, their lines and payments."""
    sales = tables.transactions(spark, sf_dir)
    lines = tables.transaction_items(spark, sf_dir)
    paid = tables.credit_payments(spark, sf_dir)
    late, waiting = "transaction_id % 10 = 0", "line_no = 1 AND transaction_id % 5 = 1"
    gone, emptied = "transaction_id % 11 = 5", "transaction_id % 22 = 5"
    raised = paid.filter("payment_id % 9 = 2")
    return [
        Changes(
            transactions=changed_rows(after=sales.filter(f"NOT ({late})")),
            transaction_items=changed_rows(after=lines.filter(f"NOT ({waiting})")),
            credit_payments=changed_rows(after=paid.filter("payment_id % 5 <> 0")),
        ),
        Changes(
            transactions=changed_rows(after=sales.filter(late)),
            transaction_items=changed_rows(after=lines.filter(waiting)),
            credit_payments=changed_rows(after=paid.filter("payment_id % 5 = 0")),
        ),
        Changes(
            transactions=changed_rows(
                sales.filter("transaction_id % 7 = 3"), _moved_sales(sales.filter("transaction_id % 7 = 3"))
            ),
            transaction_items=changed_rows(
                lines.filter("line_no IN (2, 4)"), _corrected_lines(lines.filter("line_no = 2"))
            ),
        ),
        Changes(
            transactions=changed_rows(before=_moved_sales(sales).filter(gone)),
            transaction_items=changed_rows(
                _corrected_lines(lines).filter(f"line_no <> 4 AND {emptied}"),
                lines.filter(f"line_no = 4 AND NOT ({emptied})").withColumn("quantity", F.lit(1)),
            ),
            credit_payments=changed_rows(
                raised.unionByName(paid.filter("payment_id % 9 = 4")),
                raised.withColumn("amount", (F.col("amount") + 1).cast("decimal(10,2)")),
            ),
        ),
    ]


def product_batches(spark: SparkSession, sf_dir: str) -> list[Changes]:
    """Four batches on products and sale lines."""
    goods = tables.products(spark, sf_dir).select("product_id", "category_id")
    lines = tables.transaction_items(spark, sf_dir)
    moved = goods.withColumn(
        "category_id", F.when(F.col("product_id") % 4 == 1, "PROMO").otherwise(F.col("category_id"))
    )
    return [
        Changes(
            products=changed_rows(after=goods.filter("product_id % 10 <> 0")),
            transaction_items=changed_rows(after=lines.filter("line_no <> 3")),
        ),
        Changes(
            products=changed_rows(after=goods.filter("product_id % 10 = 0")),
            transaction_items=changed_rows(after=lines.filter("line_no = 3")),
        ),
        Changes(
            products=changed_rows(goods.filter("product_id % 4 = 1"), moved.filter("product_id % 4 = 1")),
            transaction_items=changed_rows(
                lines.filter("line_no IN (2, 4)"), _corrected_lines(lines.filter("line_no = 2"))
            ),
        ),
        Changes(products=changed_rows(before=moved.filter("product_id % 17 = 3"))),
    ]


def load_waves(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    """The load files in two waves: people and goods with the even documents, then the odd ones."""
    frames = tables.warehouse(spark, sf_dir)
    documents = {
        "restocks": "restock_id", "restock_items": "restock_id", "transactions": "transaction_id",
        "transaction_items": "transaction_id", "credit_payments": "payment_id",
    }
    first = {
        name: df.filter(F.col(documents[name]) % 2 == 0) if name in documents else df for name, df in frames.items()
    }
    second = {name: frames[name].filter(F.col(key) % 2 == 1) for name, key in documents.items()}
    return [first, second]

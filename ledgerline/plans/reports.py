"""Reports a shop owner reads: revenue, top lists, integrity, load counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.money import TOTAL, cents, line_cents, money, or_zero
from ledgerline.model import Shop
from ledgerline.operators.keys import left_join_named
from ledgerline.operators.quality import union_all
from ledgerline.plans.marts import (
    balance_cents,
    customer_balances,
    on_hand,
    product_stock,
    sale_totals,
)
from ledgerline.session import materialize


def product_sales(shop: Shop) -> DataFrame:
    """Units and centavos per product; one row per product that sold."""
    return shop.transaction_items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.sum(line_cents()).alias("sales_cents")
    )


def category_sales(shop: Shop) -> DataFrame:
    """Units and sales per product group. Sales are summed per product before
    they meet the dimension, so a best seller cannot skew the join."""
    groups = shop.categories.select("category_id", F.col("name").alias("category"))
    return (
        product_sales(shop)
        .join(shop.products.select("product_id", "category_id"), "product_id")
        .join(groups, "category_id")
        .groupBy("category")
        .agg(F.sum("units").alias("units"), money(F.sum("sales_cents")).alias("sales"))
    )


def category_units(shop: Shop, sold: DataFrame) -> DataFrame:
    """Units per product group from ``sold``, which has one row per product."""
    groups = shop.categories.select("category_id", F.col("name").alias("category"))
    return (
        sold.join(shop.products.select("product_id", "category_id"), "product_id")
        .join(groups, "category_id")
        .groupBy("category")
        .agg(F.sum("quantity").alias("units"))
    )


def top_categories(shop: Shop, k: int = 5) -> DataFrame:
    return category_sales(shop).orderBy(F.desc("units"), "category").limit(k)


def day_product_sales(shop: Shop) -> DataFrame:
    """Units and centavos per day and product."""
    days = shop.transactions.select("transaction_id", F.to_date("transaction_date").alias("day"))
    return (
        shop.transaction_items.join(days, "transaction_id")
        .groupBy("day", "product_id")
        .agg(F.sum("quantity").alias("units"), F.sum(line_cents()).alias("sales_cents"))
    )


def daily_category_revenue(shop: Shop) -> DataFrame:
    groups = shop.categories.select("category_id", F.col("name").alias("category"))
    return (
        day_product_sales(shop)
        .join(shop.products.select("product_id", "category_id"), "product_id")
        .join(groups, "category_id")
        .groupBy("day", "category")
        .agg(money(F.sum("sales_cents")).alias("revenue"))
    )


def daily_revenue(shop: Shop) -> DataFrame:
    days = shop.transactions.select("transaction_id", F.to_date("transaction_date").alias("day"))
    return (
        sale_totals(shop)
        .join(days, "transaction_id")
        .groupBy("day")
        .agg(money(F.sum("sale_cents")).alias("revenue"))
    )


def last_days(revenue: DataFrame, k: int = 30) -> DataFrame:
    return revenue.orderBy(F.desc("day")).limit(k)


def low_stock(shop: Shop, k: int = 10) -> DataFrame:
    """Products to reorder, lowest stock first."""
    stock = product_stock(shop).filter("needs_reorder")
    return stock.select("product_id", "product", "on_hand", "reorder_level").orderBy(
        "on_hand", "product_id"
    ).limit(k)


def reorder_first(shop: Shop, k: int = 20) -> DataFrame:
    return product_stock(shop).orderBy(F.desc("needs_reorder"), "product_id").limit(k)


def top_balances(shop: Shop, k: int = 20) -> DataFrame:
    return (
        balance_cents(shop)
        .select("customer_id", "full_name", "owed")
        .orderBy(F.desc("owed"), "customer_id")
        .limit(k)
        .select("customer_id", "full_name", money("owed").alias("balance"))
    )


def total_outstanding(shop: Shop) -> DataFrame:
    owed = F.round(F.sum(money("owed")), 2).cast(TOTAL)
    return balance_cents(shop).agg(owed.alias("total_outstanding"))


def stock_drift(shop: Shop) -> DataFrame:
    """Products whose stored count differs from the derived stock."""
    stored = shop.products.select(
        "product_id", F.col("stock_on_hand").cast("bigint").alias("maintained_on_hand")
    )
    both = on_hand(shop).select("product_id", "on_hand").join(stored, "product_id")
    return both.filter(F.col("on_hand") != F.col("maintained_on_hand")).withColumn(
        "drift", F.col("maintained_on_hand") - F.col("on_hand")
    )


def negative_stock(shop: Shop) -> DataFrame:
    return on_hand(shop).filter("on_hand < 0").select("product_id", "on_hand")


def negative_balances(shop: Shop) -> DataFrame:
    return customer_balances(shop).filter("balance < 0").select("customer_id", "balance")


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per table and their total."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in frames.items()
    ]
    per_table = union_all(counts)
    total = F.grouping("table_name") == 1
    return per_table.rollup("table_name").agg(F.sum("n_rows").alias("n_rows"), total.alias("__t")).select(
        F.when(F.col("__t"), "TOTAL").otherwise(F.col("table_name")).alias("table_name"), "n_rows"
    )


def integrity_report(shop: Shop) -> DataFrame:
    """One row per check: metric and value."""
    def metric(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("metric"), F.col("value").cast(TOTAL).alias("value"))

    count = F.count(F.lit(1)).alias("value")
    # one row per product serves the line count, the stock and the units
    sold = materialize(
        shop.transaction_items.groupBy("product_id").agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity")
        ),
        "sold-per-product",
    )
    stock = (
        shop.products.select("product_id", "stock_on_hand")
        .join(on_hand(shop.replace(transaction_items=sold)).select("product_id", "on_hand"), "product_id")
        .agg(
            F.count_if(F.col("on_hand") != F.col("stock_on_hand")).alias("drift"),
            F.count_if(F.col("stock_on_hand") < 0).alias("negative"),
        )
    )
    balances = balance_cents(shop).agg(
        F.count_if(F.col("owed") < 0).alias("negative"),
        or_zero(F.sum(money("owed"))).alias("outstanding"),
    )
    lines = sold.agg(or_zero(F.sum("n_lines")).alias("value"))
    sizes = [
        metric(lines if name == "transaction_items" else df.agg(count), f"rows:{name}")
        for name, df in shop.tables()
    ]
    pairs = [
        (stock, "drift", "stock_drift"),
        (stock, "negative", "negative_stock"),
        (balances, "negative", "negative_balances"),
        (balances, "outstanding", "total_outstanding"),
    ]
    unpivoted = []
    for df in (stock, balances):
        structs = [
            F.struct(F.lit(name).alias("metric"), F.col(c).cast(TOTAL).alias("value"))
            for source, c, name in pairs
            if source is df
        ]
        unpivoted.append(df.select(F.inline(F.array(*structs))))
    units = category_units(shop, sold).select(
        F.concat(F.lit("units:"), F.col("category")).alias("metric"), F.col("units").cast(TOTAL).alias("value")
    )
    return union_all([*sizes, *unpivoted, units])


def line_amounts(shop: Shop) -> DataFrame:
    return shop.transaction_items.select(
        "transaction_id", "line_no", "product_id", "quantity", "unit_price",
        money(line_cents()).alias("amount"),
    )


def walkin_vs_named(shop: Shop) -> DataFrame:
    """Sales and revenue of walk-ins and of named customers."""
    kind = F.when(F.col("customer_id").isNull(), "walk-in").otherwise("named")
    return (
        shop.transactions.join(sale_totals(shop), "transaction_id", "left")
        .groupBy(kind.alias("buyer"))
        .agg(
            F.count(F.lit(1)).alias("n_sales"),
            money(or_zero(F.sum("sale_cents"))).alias("revenue"),
        )
    )


def sales_with_customer(shop: Shop) -> DataFrame:
    people = shop.customers.select("customer_id", "full_name", "nickname")
    return left_join_named(shop.transactions, people, "customer_id")


def balances_by_filter(shop: Shop) -> DataFrame:
    """Credit and cash sales side by side, with payments, per customer."""
    sales = (
        shop.transactions.filter(F.col("customer_id").isNotNull())
        .join(sale_totals(shop), "transaction_id")
        .groupBy("customer_id")
        .agg(
            F.sum(F.when(F.col("payment_type") == "credit", F.col("sale_cents"))).alias("credit"),
            F.sum(F.when(F.col("payment_type") == "cash", F.col("sale_cents"))).alias("cash"),
        )
    )
    paid = shop.credit_payments.groupBy("customer_id").agg(F.sum(cents("amount")).alias("paid"))
    return (
        shop.customers.select("customer_id", "full_name")
        .join(sales, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select(
            "customer_id",
            "full_name",
            money(or_zero("credit")).alias("total_utang"),
            money(or_zero("cash")).alias("total_cash"),
            money(or_zero("paid")).alias("total_paid"),
            money(or_zero("credit") - or_zero("paid")).alias("balance"),
        )
    )


def chasm_guard(shop: Shop) -> DataFrame:
    """Correct totals next to what joining both facts first would report.

    The inflated totals follow from the line counts, without the fan-out join.
    """
    received = shop.restock_items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_restocked"), F.count(F.lit(1)).alias("n_in")
    )
    sold = shop.transaction_items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_sold"), F.count(F.lit(1)).alias("n_out")
    )
    def repeats(n: str):
        return F.greatest(or_zero(n), F.lit(1))
    return (
        shop.products.select("product_id")
        .join(received, "product_id", "left")
        .join(sold, "product_id", "left")
        .select(
            "product_id",
            or_zero("total_restocked").alias("total_restocked"),
            or_zero("total_sold").alias("total_sold"),
            (or_zero("total_restocked") * repeats("n_out")).alias("joined_restocked"),
            (or_zero("total_sold") * repeats("n_in")).alias("joined_sold"),
        )
    )


def nullsafe_summary(shop: Shop) -> DataFrame:
    """Sale counts and revenue per customer and payment type, joined NULL-safely.

    Both sides are summed to one row per (customer, type) first; the walk-ins'
    NULL customer then matches exactly one row.
    """
    sales = shop.transactions.groupBy("customer_id", "payment_type").agg(
        F.count(F.lit(1)).alias("n_sales")
    )
    revenue = (
        shop.transactions.join(sale_totals(shop), "transaction_id")
        .groupBy(F.col("customer_id").alias("r_customer"), F.col("payment_type").alias("r_type"))
        .agg(F.sum("sale_cents").alias("revenue_cents"))
    )
    same = F.col("customer_id").eqNullSafe(F.col("r_customer")) & (
        F.col("payment_type") == F.col("r_type")
    )
    return sales.join(revenue, same).select(
        "customer_id", "payment_type", "n_sales", money("revenue_cents").alias("revenue")
    )


def units_per_product(shop: Shop) -> DataFrame:
    """Units sold of every product, 0 for those that never sold."""
    sold = shop.transaction_items.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return shop.products.select("product_id").join(sold, "product_id", "left").select(
        "product_id", or_zero("units").alias("units")
    )


def txn_totals(shop: Shop) -> DataFrame:
    """Every sale with its total, 0 for a sale without lines."""
    totals = sale_totals(shop).select("transaction_id", "sale_cents")
    return shop.transactions.join(totals, "transaction_id", "left").select(
        "transaction_id", "customer_id", "payment_type", money(or_zero("sale_cents")).alias("total")
    )


def credit_first_date(shop: Shop) -> DataFrame:
    """Total charged and first credit sale per customer; sales without lines count as 0."""
    credit = shop.transactions.filter(
        (F.col("payment_type") == "credit") & F.col("customer_id").isNotNull()
    )
    totals = sale_totals(shop).select("transaction_id", "sale_cents")
    return (
        credit.join(totals, "transaction_id", "left")
        .groupBy("customer_id")
        .agg(
            money(F.sum(or_zero("sale_cents"))).alias("charged"),
            F.min("transaction_date").alias("first_credit"),
        )
    )


def hour_share(moments: DataFrame, column: str) -> DataFrame:
    """Share of rows per hour of the day. The window sees at most 24 rows."""
    hours = moments.groupBy(F.hour(column).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return hours.select("hour", "n", F.round(F.col("n") / total, 6).alias("share"))


def basket_sizes(shop: Shop) -> DataFrame:
    """How many sales have how many lines."""
    lines = shop.transaction_items.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n_items"))
    return lines.groupBy("n_items").agg(F.count(F.lit(1)).alias("n_sales"))

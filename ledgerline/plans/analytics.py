"""Planning and follow-up analyses on top of the marts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import calendar
from ledgerline.functions.money import (
    CATEGORY_MARKUP,
    INFLATION_RATE,
    PRICE,
    cents,
    cost_from_price,
    money,
    or_zero,
    price_index,
    round_quarter,
)
from ledgerline.functions.text import tagged
from ledgerline.model import Shop
from ledgerline.operators.allocate import capped_payments, fifo_allocation
from ledgerline.operators.ordered import number_rows
from ledgerline.plans.marts import balance_cents, charges, hot_customers, on_hand
from ledgerline.plans.reports import day_product_sales, units_per_product
from ledgerline.session import materialize

# Items per block of a large basket.
BASKET_BLOCK = 64


def calendar_features(dates: DataFrame, column: str) -> DataFrame:
    """Demand features for every day in the range of ``column``; shares add to 1.

    The table is read once for its first and last date. The window over all
    days holds one row per calendar day.
    """
    day = F.col("day")
    days = calendar.day_spine(dates, column)
    weighted = days.withColumn("weight", calendar.demand_weight(day, F.col("first_year")))
    return weighted.select(
        "day",
        F.weekday("day").alias("day_of_week"),
        calendar.is_weekend(day).alias("is_weekend"),
        calendar.is_december(day).alias("is_december"),
        calendar.is_payday(day).alias("is_payday"),
        (F.col("weight") / F.sum("weight").over(Window.partitionBy())).alias("share"),
    )


def deflated_prices(shop: Shop, rate: float = INFLATION_RATE) -> DataFrame:
    """List prices restated to the year of each sale, per product and year."""
    last = shop.transactions.agg(F.max(F.year("transaction_date"))).scalar()
    sold = day_product_sales(shop).select("product_id", F.year("day").alias("year")).distinct()
    priced = sold.join(shop.products.select("product_id", "current_price"), "product_id")
    restated = F.col("current_price").cast("double") * price_index(F.col("year"), last, rate)
    return priced.select(
        "product_id", "year", "current_price", round_quarter(restated).alias("price_that_year")
    )


def price_cost_margin(shop: Shop, markups: dict | None = None) -> DataFrame:
    """Wholesale cost and margin per product from its group's markup."""
    table = CATEGORY_MARKUP if markups is None else markups
    rows = shop.products.sparkSession.createDataFrame(
        list(table.items()), "category string, markup decimal(4,2)"
    )
    groups = shop.categories.select("category_id", F.col("name").alias("category"))
    cost = cost_from_price("current_price", "markup")
    return (
        shop.products.join(groups, "category_id")
        .join(rows, "category", "left")
        .withColumn("cost", cost)
        .select(
            "product_id", "category", "current_price", "cost",
            (F.col("current_price") - F.col("cost")).cast(PRICE).alias("margin"),
        )
    )


def payment_lag(shop: Shop) -> DataFrame:
    """Seconds from a customer's first credit sale to each of their payments."""
    first = (
        shop.transactions.filter(
            (F.col("payment_type") == "credit") & F.col("customer_id").isNotNull()
        )
        .groupBy("customer_id")
        .agg(F.min("transaction_date").alias("first_credit"))
    )
    lag = calendar.seconds_between(F.col("payment_date"), F.col("first_credit"))
    return shop.credit_payments.join(first, "customer_id").select(
        "payment_id", "customer_id", F.greatest(lag, F.lit(1)).cast("bigint").alias("lag_seconds")
    )


def payment_cap(shop: Shop) -> DataFrame:
    """Payments cut to what the customer was charged in total."""
    paid = shop.credit_payments.select(
        "payment_id", "customer_id", "payment_date", cents("amount").alias("amount_cents")
    )
    charged = charges(shop).groupBy("customer_id").agg(F.sum("sale_cents").alias("charged"))
    capped = capped_payments(
        paid, charged, "customer_id", ["payment_date", "payment_id"], "amount_cents",
        "allowed_cents",
    )
    return capped.select(
        "payment_id", "customer_id",
        money("amount_cents").alias("amount"), money("allowed_cents").alias("allowed"),
    )


def replenishment_need(shop: Shop, cover: int, extra: int) -> DataFrame:
    """Units to order: what sold plus ``cover`` times the reorder level plus ``extra``."""
    sold = units_per_product(shop)
    return shop.products.select("product_id", "reorder_level").join(sold, "product_id").select(
        "product_id", F.col("units").alias("sold"),
        (F.col("units") + F.col("reorder_level") * cover + extra).cast("bigint").alias("needed"),
    )


def weekly_demand(shop: Shop) -> DataFrame:
    """Units per product and week with the week before and a four-week mean.

    A product has one row per week, so a window per product stays small. The
    frames count weeks, not rows: a week without sales has no row.
    """
    week = F.to_date(F.date_trunc("week", F.col("day").cast("timestamp")))
    weeks = (
        day_product_sales(shop)
        .groupBy("product_id", week.alias("week"))
        .agg(F.sum("units").alias("units"))
    )
    number = F.expr("datediff(week, DATE'1970-01-05') div 7")
    ordered = Window.partitionBy("product_id").orderBy(number)
    return weeks.select(
        "product_id",
        "week",
        "units",
        or_zero(F.sum("units").over(ordered.rangeBetween(-1, -1))).alias("units_week_before"),
        or_zero(F.sum("units").over(ordered.rangeBetween(-4, -1))).alias("units_four_weeks_before"),
    )


def reorder_suggestion(shop: Shop, weeks_of_cover: int) -> DataFrame:
    """Units to order so that stock covers the reorder level and recent demand."""
    daily = materialize(day_product_sales(shop).select("day", "product_id", "units"), "daily")
    last = daily.agg(F.max("day")).scalar()
    recent = (
        daily.filter(F.col("day") > F.date_sub(last, 28))
        .groupBy("product_id")
        .agg(F.sum("units").alias("recent_units"))
    )
    demand = F.ceil(or_zero("recent_units") * weeks_of_cover / F.lit(4)).cast("bigint")
    return (
        on_hand(shop)
        .join(shop.products.select("product_id", "reorder_level"), "product_id")
        .join(recent, "product_id", "left")
        .withColumn("expected_demand", demand)
        .select(
            "product_id", "on_hand", "expected_demand",
            F.greatest(
                F.col("reorder_level") + F.col("expected_demand") - F.col("on_hand"), F.lit(0)
            ).cast("bigint").alias("suggested_units"),
        )
    )


def credit_features(shop: Shop) -> DataFrame:
    """Repayment features per customer with credit sales."""
    sold = charges(shop).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_charges"),
        F.sum("sale_cents").alias("charged"),
        F.min("transaction_date").alias("first_charge"),
        F.max("transaction_date").alias("last_charge"),
    )
    paid = shop.credit_payments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.sum(cents("amount")).alias("paid"),
        F.min("payment_date").alias("first_payment"),
        F.max("payment_date").alias("last_payment"),
    )
    return sold.join(paid, "customer_id", "left").select(
        "customer_id",
        "n_charges",
        or_zero("n_payments").alias("n_payments"),
        money(F.col("charged") - or_zero("paid")).alias("balance"),
        F.datediff(F.to_date("first_payment"), F.to_date("first_charge")).alias("days_to_first_payment"),
        F.datediff(F.to_date("last_charge"), F.to_date("last_payment")).alias("days_since_payment"),
    )


def rfm_segments(shop: Shop, groups: int = 5) -> DataFrame:
    """Recency, frequency and monetary scores of customers who bought.

    Scores are equal-sized groups by rank, as NTILE gives them. Ranks come from
    :func:`number_rows`, since an unpartitioned NTILE would run in one task.
    """
    sold = shop.transaction_items.groupBy("transaction_id").agg(
        F.sum(F.col("quantity") * cents("unit_price")).alias("sale_cents")
    )
    base = (
        shop.transactions.filter(F.col("customer_id").isNotNull())
        .join(sold, "transaction_id")
        .groupBy("customer_id")
        .agg(
            F.max("transaction_date").alias("last_sale"),
            F.count(F.lit(1)).alias("n_sales"),
            F.sum("sale_cents").alias("spent"),
        )
    )
    scored = materialize(base, "rfm")
    n = scored.agg(F.count(F.lit(1))).scalar()

    def tile(rank: str):
        # the first n mod groups tiles hold one row more
        zero = F.col(rank) - 1
        large = n % groups
        size = F.expr("__n div __g")
        border = large * (size + 1)
        in_large = F.floor(zero / (size + 1)) + 1
        in_small = large + F.floor((zero - border) / F.greatest(size, F.lit(1))) + 1
        return F.when(zero < border, in_large).otherwise(in_small).cast("bigint")

    for source, score in (("last_sale", "recency"), ("n_sales", "frequency"), ("spent", "monetary")):
        scored = number_rows(scored, [source, "customer_id"], "__rank", unique_rows=True)
        scored = (
            scored.withColumn("__n", n)
            .withColumn("__g", F.lit(groups).cast("bigint"))
            .withColumn(score, tile("__rank"))
            .drop("__rank", "__n", "__g")
        )
    return scored.select(
        "customer_id", "n_sales", money("spent").alias("spent"), "recency", "frequency", "monetary"
    )


def daily_prices(shop: Shop) -> DataFrame:
    """The highest price a product sold for on each day."""
    days = shop.transactions.select("transaction_id", F.to_date("transaction_date").alias("day"))
    return (
        shop.transaction_items.join(days, "transaction_id")
        .groupBy("product_id", "day")
        .agg(F.max("unit_price").alias("price"))
    )


def price_history(daily: DataFrame) -> DataFrame:
    """Price changes with validity, from one price per product and day.

    A product has at most one row per calendar day, which bounds its window.
    """
    ordered = Window.partitionBy("product_id").orderBy("day")
    changed = daily.withColumn("__before", F.lag("price").over(ordered)).filter(
        ~F.col("__before").eqNullSafe(F.col("price"))
    )
    return changed.select(
        "product_id",
        "price",
        F.col("day").alias("valid_from"),
        F.lead("day").over(ordered).alias("valid_to"),
    )


def price_as_of(history: DataFrame, lookups: DataFrame) -> DataFrame:
    """The price in force for each (product_id, day) of ``lookups``.

    Lookups are reduced to distinct days first and merged with the changes on
    one timeline; the last change seen is the price. No range join is needed.
    """
    wanted = lookups.select("product_id", "day").distinct()
    timeline = history.select(
        "product_id", F.col("valid_from").alias("day"), "price", F.lit(0).alias("__wanted")
    ).unionByName(
        wanted.select(
            "product_id", "day",
            F.lit(None).cast(history.schema["price"].dataType).alias("price"),
            F.lit(1).alias("__wanted"),
        )
    )
    ordered = (
        Window.partitionBy("product_id")
        .orderBy("day", "__wanted")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_force = F.last("price", ignorenulls=True).over(ordered)
    return (
        timeline.withColumn("price", in_force)
        .filter("__wanted = 1")
        .select("product_id", "day", "price")
    )


def settled_charges(shop: Shop) -> DataFrame:
    """Payments applied to charges, oldest first, in centavos."""
    due = charges(shop).select(
        "customer_id",
        "transaction_id",
        "transaction_date",
        tagged("TXN#", "transaction_id").alias("reference"),
        F.col("sale_cents").alias("amount"),
    )
    paid = shop.credit_payments.select(
        "customer_id", "payment_id", "payment_date", cents("amount").alias("amount")
    )
    return fifo_allocation(
        due, paid, "customer_id", "transaction_id", "payment_id",
        ["transaction_date", "transaction_id"], ["payment_date", "payment_id"],
        hot=hot_customers(shop),
    )


def credit_entries(shop: Shop) -> DataFrame:
    """Charges and payments of customers as entries of one stream, amounts in centavos."""
    due = charges(shop).select(
        "customer_id",
        F.lit("charge").alias("side"),
        F.col("transaction_id").alias("entry_id"),
        F.col("transaction_date").cast("timestamp").alias("at"),
        F.col("sale_cents").alias("cents"),
    )
    paid = shop.credit_payments.select(
        "customer_id",
        F.lit("payment").alias("side"),
        F.col("payment_id").alias("entry_id"),
        F.col("payment_date").cast("timestamp").alias("at"),
        cents("amount").alias("cents"),
    )
    return due.unionByName(paid)


def payment_allocation(shop: Shop) -> DataFrame:
    return settled_charges(shop).select(
        "customer_id", "transaction_id", "payment_id", money("allocated").alias("allocated")
    )


def invoice_aging(shop: Shop) -> DataFrame:
    """Open amounts by age of the charge at the last sale date."""
    open_sales = charges(shop)
    last = shop.transactions.agg(F.max(F.to_date("transaction_date"))).scalar()
    settled = settled_charges(shop).groupBy("transaction_id").agg(F.sum("allocated").alias("settled"))
    age = F.datediff(last, F.to_date("transaction_date"))
    bucket = (
        F.when(age <= 30, "0-30").when(age <= 60, "31-60").when(age <= 90, "61-90").otherwise("over 90")
    )
    left = F.col("sale_cents") - or_zero("settled")
    return (
        open_sales.join(settled, "transaction_id", "left")
        .withColumn("open_cents", left)
        .filter("open_cents > 0")
        .groupBy(bucket.alias("age_days"))
        .agg(F.count(F.lit(1)).alias("n_charges"), money(F.sum("open_cents")).alias("open_amount"))
    )


def frequent_pairs(shop: Shop, item: str, min_support: float) -> DataFrame:
    """Pairs of items bought together in at least ``min_support`` of all sales.

    Items below the threshold cannot be part of a frequent pair and are removed
    first; at most (mean basket size / ``min_support``) items remain, which
    bounds every basket, however many lines it has. Baskets are cut into blocks
    of about ``BASKET_BLOCK`` items; pairs of blocks yield their pairs of items,
    which are summed in the task that makes them, so no task holds the pairs of
    a large basket.
    """
    names = shop.products.select("product_id", F.col(item).alias("item"))
    lines = shop.transaction_items.select("transaction_id", "product_id").distinct()
    bought = materialize(
        lines.join(names, "product_id").select("transaction_id", "item").distinct(), "bought"
    )
    baskets = bought.select("transaction_id").distinct().count()
    least = max(1, math.ceil(min_support * baskets))
    singles = bought.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    kept = materialize(bought.join(singles.select("item"), "item"), "frequent-items")
    sizes = kept.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BASKET_BLOCK).cast("int")
    cut = (
        kept.join(sizes, "transaction_id")
        .groupBy("transaction_id", F.pmod(F.xxhash64("item"), blocks).alias("block"))
        .agg(F.sort_array(F.collect_list("item")).alias("items"), F.max(blocks).alias("blocks"))
    )
    cut = materialize(cut, "basket-blocks")
    inside = cut.select(
        F.explode(
            F.flatten(
                F.transform(
                    "items",
                    lambda x, i: F.transform(
                        F.slice("items", i + 2, F.size("items")), lambda y: F.struct(x.alias("a"), y.alias("b"))
                    ),
                )
            )
        ).alias("pair")
    )
    other = cut.filter("blocks > 1").select(
        "transaction_id", F.col("block").alias("other_block"), F.col("items").alias("others")
    )
    between = cut.filter("blocks > 1").join(other, "transaction_id").filter("block < other_block").select(
        F.explode(
            F.flatten(
                F.transform(
                    "items",
                    lambda x: F.transform(
                        "others", lambda y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
                    ),
                )
            )
        ).alias("pair")
    )
    counted = (
        inside.unionByName(between)
        .groupBy(F.col("pair.a").alias("item_a"), F.col("pair.b").alias("item_b"))
        .agg(F.count(F.lit(1)).alias("n_both"))
        .filter(F.col("n_both") >= least)
    )
    a = singles.select(F.col("item").alias("item_a"), F.col("n").alias("n_a"))
    b = singles.select(F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    lift = F.col("n_both") * F.lit(float(baskets)) / (F.col("n_a") * F.col("n_b"))
    return counted.join(a, "item_a").join(b, "item_b").select(
        "item_a",
        "item_b",
        "n_both",
        F.round(F.col("n_both") / F.col("n_a"), 6).alias("confidence"),
        F.round(lift, 6).alias("lift"),
    )


def stale_balances(shop: Shop, stored: DataFrame) -> DataFrame:
    """Customers whose stored balance is not what the ledger gives."""
    derived = balance_cents(shop).select("customer_id", money("owed").alias("balance"))
    both = stored.join(derived, "customer_id")
    return both.filter(~F.col("stored_balance").eqNullSafe(F.col("balance")))

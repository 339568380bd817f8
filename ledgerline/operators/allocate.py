"""Allocation: integers in proportion to weights, payments to charges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordered import hot_keys, number_rows, running_total, running_totals
from ledgerline.session import materialize

WIDE = "decimal(38,0)"


def proportional_allocation(
    df: DataFrame, weight: str, key: str, total: int, min_each: int = 0, out: str = "allocated"
) -> DataFrame:
    """Split ``total`` into whole numbers in proportion to integer weights.

    Largest remainder: every row gets ``min_each`` and the floor of its share of
    the rest; the units still missing go to the largest remainders, ties by
    ``key``. If all weights are zero they count as equal. The result adds up to
    ``total`` exactly; a minimum that does not fit raises an error. ``key``
    identifies a row; weights must not be negative.
    """
    stored = materialize(df, "weights")
    sums = stored.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(weight), F.lit(0)).cast(WIDE).alias("w")
        )
    ).scalar()
    n, weights = sums["n"], sums["w"]
    rest = F.lit(total).cast("bigint") - n * min_each
    rest = F.when(
        rest < 0, F.raise_error(F.lit("the minimum for each row exceeds the total"))
    ).otherwise(rest)
    divisor = F.when(weights > 0, weights).otherwise(n.cast(WIDE))
    own = F.when(weights > 0, F.col(weight).cast(WIDE)).otherwise(F.lit(1).cast(WIDE))
    shares = (
        stored.withColumn("__rest", rest)
        .withColumn("__scaled", own * F.col("__rest"))
        .withColumn("__divisor", divisor)
        .withColumn("__floor", F.expr("__scaled div __divisor"))
        .withColumn("__remainder", (F.col("__scaled") % F.col("__divisor")).cast(WIDE))
        .select(*df.columns, "__rest", "__floor", "__remainder")
    )
    short = shares.agg(F.max("__rest") - F.sum("__floor")).scalar()
    order = [F.desc("__remainder"), F.asc(key)]
    ranked = number_rows(shares, order, "__rank", unique_rows=True)
    extra = F.when(F.col("__rank") <= short, 1).otherwise(0)
    return ranked.select(
        *df.columns, (F.col("__floor") + extra + min_each).cast("bigint").alias(out)
    )


def capped_payments(
    payments: DataFrame,
    charged: DataFrame,
    key: str,
    order: list[str],
    amount: str,
    out: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The part of each payment that total charges allow, in payment order.

    ``charged`` has one row per key with column ``charged``. Amounts are integer
    centavos; negative payments are not expected. ``hot`` holds the keys with
    too many payments for one task.
    """
    hot = hot_keys(payments.select(key), key) if hot is None else hot
    running = running_total(payments, key, order, amount, "__paid_to", hot)
    before = F.col("__paid_to") - F.col(amount)
    left = F.coalesce(F.col("charged"), F.lit(0)) - before
    allowed = F.greatest(F.lit(0).cast("bigint"), F.least(F.col(amount), left))
    return running.join(charged, key, "left").select(
        *payments.columns, allowed.cast("bigint").alias(out)
    )


def fifo_allocation(
    charges: DataFrame,
    payments: DataFrame,
    key: str,
    charge_id: str,
    payment_id: str,
    charge_order: list[str],
    payment_order: list[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Apply payments to the oldest charges first; amounts in column ``amount``.

    Charges and payments of a key each cover consecutive intervals of its
    running total. Sorting all interval ends together and counting how many
    charges and payments end before each one names the charge and the payment
    that meet in the interval ending there. Both are then fetched by position
    with an equality join, so the work is linear in the entries of a key; there
    is no join on overlapping ranges. ``hot`` holds the keys with too many
    entries for one task.
    """
    if hot is None:
        hot = hot_keys(charges.select(key).unionByName(payments.select(key)), key)

    def intervals(df: DataFrame, order: list[str], kind: str, id_column: str) -> DataFrame:
        used = dict.fromkeys([key, *order, id_column])
        one = df.select(*used, "amount", F.lit(1).cast("bigint").alias("__one"))
        ends = running_totals(one, key, order, {"__hi": "amount", "__pos": "__one"}, hot)
        return ends.select(
            key,
            F.lit(kind).alias("__kind"),
            F.col(id_column).alias("__id"),
            "__pos",
            (F.col("__hi") - F.col("amount")).alias("__lo"),
            "__hi",
        )

    sides = intervals(charges, charge_order, "c", charge_id).unionByName(
        intervals(payments, payment_order, "p", payment_id)
    )
    sides = materialize(sides, "intervals")
    ends = sides.selectExpr(
        f"`{key}`", "__hi", "__kind", "__pos",
        "CAST(__kind = 'c' AS BIGINT) AS __c", "CAST(__kind = 'p' AS BIGINT) AS __p",
    )
    counted = running_totals(
        ends, key, ["__hi", "__kind", "__pos"], {"__charges_to": "__c", "__payments_to": "__p"}, hot
    )
    # this row's own side counts the row itself, the other side the next one to end
    meets = counted.selectExpr(
        f"`{key}`",
        "__charges_to - __c + 1 AS __charge_pos",
        "__payments_to - __p + 1 AS __payment_pos",
    )
    c = sides.filter("__kind = 'c'").select(
        key,
        F.col("__pos").alias("__charge_pos"),
        F.col("__id").alias(charge_id),
        F.col("__lo").alias("__c_lo"),
        F.col("__hi").alias("__c_hi"),
    )
    p = sides.filter("__kind = 'p'").select(
        key,
        F.col("__pos").alias("__payment_pos"),
        F.col("__id").alias(payment_id),
        F.col("__lo").alias("__p_lo"),
        F.col("__hi").alias("__p_hi"),
    )
    amount = F.least("__c_hi", "__p_hi") - F.greatest("__c_lo", "__p_lo")
    return (
        meets.join(c, [key, "__charge_pos"])
        .join(p, [key, "__payment_pos"])
        .select(key, charge_id, payment_id, amount.alias("allocated"))
        .filter(F.col("allocated") > 0)
    )

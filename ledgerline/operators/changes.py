"""Change data: stock deltas, upserts and snapshot differences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stock_deltas(changes: DataFrame) -> DataFrame:
    """Signed stock movements of line changes; an UPDATE yields two.

    ``changes`` has side (sale or restock), op, product_id and quantity (the
    old line for UPDATE and DELETE), new_product_id and new_quantity (UPDATE).
    Deltas add up in any order, so arrival order does not matter.
    """
    sign = F.when(F.col("side") == "restock", 1).otherwise(-1)
    undo = F.when(F.col("op") == "INSERT", 1).otherwise(-1)
    first = F.struct(
        F.col("product_id").cast("bigint").alias("product_id"),
        (sign * undo * F.col("quantity")).cast("bigint").alias("delta"),
    )
    second = F.struct(
        F.col("new_product_id").cast("bigint").alias("product_id"),
        (sign * F.col("new_quantity")).cast("bigint").alias("delta"),
    )
    movements = F.when(F.col("op") == "UPDATE", F.array(first, second)).otherwise(F.array(first))
    kept = [c for c in ("change_id", "change_ts") if c in changes.columns]
    return changes.select(*kept, F.inline(movements))


def line_inserts(items: DataFrame, side: str) -> DataFrame:
    """Lines as INSERT changes, for applying a load through the change path."""
    return items.select(
        F.lit(side).alias("side"),
        F.lit("INSERT").alias("op"),
        "product_id",
        "quantity",
        F.lit(None).cast("bigint").alias("new_product_id"),
        F.lit(None).cast("int").alias("new_quantity"),
    )


def line_deletes(items: DataFrame, side: str) -> DataFrame:
    """Lines as DELETE changes, for the lines a header delete takes along."""
    return line_inserts(items, side).withColumn("op", F.lit("DELETE"))


def signed_lines(changes: DataFrame, side: str) -> DataFrame:
    """The changes of one side as lines whose quantities are added to the lines there were."""
    own = changes.filter(F.col("side") == side)
    taken = F.when(F.col("op") == "INSERT", F.col("quantity")).otherwise(-F.col("quantity"))
    first = own.select(F.col("product_id").cast("bigint").alias("product_id"), taken.cast("int").alias("quantity"))
    second = own.filter("op = 'UPDATE'").select(
        F.col("new_product_id").cast("bigint").alias("product_id"),
        F.col("new_quantity").cast("int").alias("quantity"),
    )
    return first.unionByName(second)


def net_stock(deltas: DataFrame) -> DataFrame:
    """Net movement per product."""
    return deltas.groupBy("product_id").agg(F.sum("delta").alias("stock_delta"))


def apply_stock(products: DataFrame, deltas: DataFrame) -> DataFrame:
    """Products with the net movement added to the stored count."""
    net = net_stock(deltas)
    moved = products.join(net, "product_id", "left")
    stock = F.col("stock_on_hand") + F.coalesce(F.col("stock_delta"), F.lit(0))
    return moved.withColumn("stock_on_hand", stock).select(*products.columns)


def latest_per_key(changes: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The newest change per key, as a partial aggregate instead of a window."""
    rest = [c for c in changes.columns if c not in key and c not in version]
    newest = changes.groupBy(*key).agg(F.max(F.struct(*version, *rest)).alias("__new"))
    return newest.select(*key, *[F.col("__new")[c].alias(c) for c in (*version, *rest)])


def _differs(columns: Sequence[str], left: str, right: str) -> Column:
    return reduce(
        Column.__or__, [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    )


def upsert(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    version: Sequence[str],
    stamp: datetime | Column,
    stamp_column: str = "updated_at",
) -> DataFrame:
    """Apply the newest change per key and stamp the rows that really changed.

    Rows only in ``base`` pass through, rows only in ``changes`` are added.
    Changes without a key say nothing about any row and are left out.
    """
    columns = [c for c in base.columns if c not in (key, stamp_column)]
    known = changes.filter(F.col(key).isNotNull())
    new = latest_per_key(known, [key], version).select(key, *columns)
    joined = base.alias("old").join(new.alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    has_new = F.col(f"new.{key}").isNotNull()
    has_old = F.col(f"old.{key}").isNotNull()
    when = stamp if isinstance(stamp, Column) else F.lit(stamp)
    touched = has_new & (~has_old | _differs(columns, "old", "new"))
    stamped = F.when(touched, when).otherwise(F.col(f"old.{stamp_column}"))
    out = {key: F.coalesce(f"new.{key}", f"old.{key}"), stamp_column: stamped}
    for c in columns:
        out[c] = F.when(has_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
    return joined.select(*[out[c].alias(c) for c in base.columns])


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Change log between two snapshots: key, op and the changed column names.

    A row with a NULL key matches no other; it is deleted or inserted.
    """
    joined = before.withColumn("__there", F.lit(True)).alias("old").join(
        after.withColumn("__there", F.lit(True)).alias("new"),
        F.col(f"old.{key}") == F.col(f"new.{key}"),
        "full",
    )
    op = (
        F.when(F.col("old.__there").isNull(), "INSERT")
        .when(F.col("new.__there").isNull(), "DELETE")
        .when(_differs(columns, "old", "new"), "UPDATE")
    )
    names = [
        F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in columns
    ]
    changed = F.when(F.col("op") == "UPDATE", F.concat_ws(",", *names)).otherwise(F.lit(""))
    return (
        joined.withColumn("op", op)
        .filter(F.col("op").isNotNull())
        .select(
            F.coalesce(f"new.{key}", f"old.{key}").alias(key), "op", changed.alias("changed")
        )
    )

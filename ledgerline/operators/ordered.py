"""Order-dependent operators that never put one group into one task.

A window without PARTITION BY, or partitioned by a key that owns a third of the
rows, runs in a single task. The operators here sort by range partitioning
instead: every row gets a slice number, slices are summarized to one row each,
and the summaries supply what each slice has to add. Rows with very many copies
are collapsed to a count before sorting, so equal rows cannot fill one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.reshape import expand_rows
from ledgerline.session import materialize, materialize_measured

SLICE = "__slice"
POSITION = "__position"
# monotonically_increasing_id counts rows in its lower 33 bits
POSITION_MASK = (1 << 33) - 1

# Groups above this many rows leave the plain window and are sorted in slices; the results are equal.
HOT_GROUP_ROWS = 1_000_000
# A row with more copies is numbered by their count instead of one by one.
MOST_COPIES = 100_000
# Large groups are looked for in a sample that holds about so many rows of the smallest of them.
ROWS_IN_SAMPLE = 200


def order_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def sorted_slices(
    df: DataFrame, order: Sequence[str | Column], *measures: Column
) -> tuple[DataFrame, dict]:
    """Sort ``df`` into slices and store it with slice numbers and positions.

    Rows are range-partitioned by ``order``; slice 0 holds the first rows, and
    ``POSITION`` numbers the rows of a slice from 0. Both depend on the task
    that computes them, so they count only once written. Small inputs end up in
    one slice. ``measures`` are aggregates taken while writing.
    """
    cols = order_columns(order)
    placed = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(POSITION, F.monotonically_increasing_id().bitwiseAND(POSITION_MASK))
    )
    return materialize_measured(placed, "slices", *measures)


def _prefix(slices: DataFrame, key: list[str], sums: dict[str, str]) -> DataFrame:
    """Inclusive running sums per ``key`` over sorted slices."""
    totals = slices.groupBy(SLICE, *key).agg(
        *[F.sum(value).alias(f"__total_{out}") for out, value in sums.items()]
    )
    # one row per slice and key: at most as many rows per key as there are slices
    earlier = (
        Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    ).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offset_keys = {k: f"__offset_{k}" for k in key}
    offsets = totals.select(
        F.col(SLICE).alias("__offset_slice"),
        *[F.col(k).alias(o) for k, o in offset_keys.items()],
        *[
            F.coalesce(F.sum(f"__total_{out}").over(earlier), F.lit(0)).alias(f"__before_{out}")
            for out in sums
        ],
    )
    within = (
        Window.partitionBy(SLICE, *key)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = slices.select("*", *[F.sum(value).over(within).alias(out) for out, value in sums.items()])
    match = F.col(SLICE) == F.col("__offset_slice")
    for k, o in offset_keys.items():
        match = match & F.col(k).eqNullSafe(F.col(o))
    columns = [c for c in slices.columns if c not in (SLICE, POSITION)]
    return local.join(offsets, match).select(
        *columns, *[(F.col(out) + F.col(f"__before_{out}")).alias(out) for out in sums]
    )


def _large_groups(df: DataFrame, key: Column, name: str, limit: int) -> DataFrame:
    """Values of ``key`` that may own more than ``limit`` rows, found in a sample of the rows.

    A group of that size has ROWS_IN_SAMPLE rows in the sample on average, and half of them is
    asked for, which none misses in practice; small groups may be among those found.
    """
    rate = min(1.0, ROWS_IN_SAMPLE / limit)
    seen = df if rate == 1 else df.sample(rate, seed=7)
    counts = seen.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.filter(F.col("__rows") > (limit if rate == 1 else limit * rate / 2)).select(name)


def hot_keys(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """The values of ``key`` that own more than ``rows`` rows, as a stored table of one column.

    However many there are, none is collected. Usually there are none, which a sample tells; the
    rows of the values it suggests are counted.
    """
    limit = HOT_GROUP_ROWS if rows is None else rows
    keys = df.select(key)
    suspects = _large_groups(keys, F.col(key), "__suspect", limit)
    if suspects.isEmpty():
        return df.sparkSession.createDataFrame([], keys.schema)
    suspects = materialize(suspects, "suspects")
    own = keys.join(suspects, F.col(key).eqNullSafe(F.col("__suspect")), "left_semi")
    counts = own.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    return materialize(counts.filter(F.col("__rows") > limit).select(key), "hot-keys")


def running_totals(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    sums: dict[str, str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Running sums per ``key`` in ``order``, each row included in its own sum.

    ``sums`` maps output names to columns; ``order`` should identify a row
    within its key. ``hot`` holds the values of ``key`` that are too large for
    one task (see :func:`hot_keys`). Only their rows are stored and summed in
    slices; all others stay in a plain window, through which Catalyst pushes a
    filter on ``key`` down to the scan.
    """
    cols = order_columns(order)
    window = (
        Window.partitionBy(key)
        .orderBy(*cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    added = [F.sum(value).over(window).alias(out) for out, value in sums.items()]
    if hot is None or hot.isEmpty():
        return df.select("*", *added)
    marks = hot.select(F.col(key).alias("__hot"))
    same = F.col(key).eqNullSafe(F.col("__hot"))
    plain = df.join(marks, same, "left_anti").select("*", *added)
    slices, _ = sorted_slices(df.join(marks, same, "left_semi"), [key, *cols])
    sliced = _prefix(slices, [key], sums)
    for out in sums:
        sliced = sliced.withColumn(out, F.col(out).cast(plain.schema[out].dataType))
    return plain.unionByName(sliced)


def running_total(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    value: str,
    out: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """:func:`running_totals` of a single column."""
    return running_totals(df, key, order, {out: value}, hot)


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    out: str,
    start: int = 1,
    unique_rows: bool = False,
) -> DataFrame:
    """Number all rows ``start, start + 1, ...`` in ``order``.

    The remaining columns extend ``order`` to a total order, so rows that tie
    are copies of each other and the result does not depend on the run. Set
    ``unique_rows`` when ``df`` has no copies; the collapsing step is skipped.

    The rows are sorted and stored. A row's number is its position in its
    slice plus the size of the slices before it, so no window is needed, and
    equal rows take numbers that follow one another. Only a row with so many
    copies that they would fill a slice is collapsed to a count first and
    expanded in bounded pieces afterwards; the numbers are the same either way.
    The result can be read many times at the cost of a scan.
    """
    named = {o for o in order if isinstance(o, str)}
    total_order = [*order, *[c for c in df.columns if c not in named]]
    crowded = False
    if not unique_rows:
        # whichever way is taken, the numbers are the same, so a sample and hashes are enough
        crowded = not _large_groups(df, F.xxhash64(*df.columns), "__row", MOST_COPIES).isEmpty()
    if not crowded:
        slices, found = sorted_slices(df, total_order, F.coalesce(F.max(SLICE), F.lit(0)).alias("last_slice"))
        if found["last_slice"] == 0:
            return slices.select((F.col(POSITION) + start).alias(out), *df.columns)
        sizes = slices.groupBy(F.col(SLICE).alias("__offset_slice")).agg(F.count(F.lit(1)).alias("__n"))
        # one row per slice
        earlier = Window.orderBy("__offset_slice").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(
            "__offset_slice", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
        )
        number = F.col(POSITION) + F.col("__before") + start
        return slices.join(offsets, F.col(SLICE) == F.col("__offset_slice")).select(
            number.alias(out), *df.columns
        )
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    slices, found = sorted_slices(counted, total_order, F.max("__copies").alias("copies"))
    ends = _prefix(slices, [], {"__end": "__copies"})
    expanded = expand_rows(ends, "__copies", "__copy", most=found["copies"])
    number = F.col("__end") - F.col("__copies") + F.col("__copy") + start
    return materialize(expanded.select(number.alias(out), *df.columns), "numbered")

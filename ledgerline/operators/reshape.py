"""Row-shape operators: split packed cells, unpivot, replicate, split quantities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A row that expands to more rows than this is cut into pieces that are spread
# over all partitions before they are expanded.
EXPAND_PIECE = 100_000


def split_packed(
    df: DataFrame, keys: Sequence[str], packed: str, out: str, sep: str = ";"
) -> DataFrame:
    """One row per trimmed, non-blank, distinct part of a packed cell.

    Repeats are dropped inside the cell with ``array_distinct``. The keys must
    identify a row; then no shuffle is needed.
    """
    parts = F.transform(F.split(packed, f"[{sep}]"), lambda part: F.trim(part))
    clean = F.array_distinct(F.filter(parts, lambda part: part != ""))
    return df.filter(F.col(packed).isNotNull()).select(*keys, F.explode(clean).alias(out))


def unpivot_groups(
    df: DataFrame, keys: Sequence[str], groups: Sequence[dict[str, str]], required: str
) -> DataFrame:
    """Turn repeating column groups into rows in one scan.

    Each group maps output names to the columns of one repeat, for example
    ``{"product": "item1_name", "quantity": "item1_qty"}``. Rows whose
    ``required`` output is NULL are unused slots and are dropped.
    """
    slots = F.array(
        *[
            F.struct(
                F.lit(n).alias("slot"), *[F.col(src).alias(name) for name, src in group.items()]
            )
            for n, group in enumerate(groups, start=1)
        ]
    )
    return df.select(*keys, F.inline(slots)).filter(F.col(required).isNotNull())


def expand_rows(df: DataFrame, times: str, position: str, most: int | None = None) -> DataFrame:
    """Repeat each row ``times`` times and number the repeats from 0.

    Rows with more than ``EXPAND_PIECE`` repeats are cut into pieces that are
    spread out first. If ``most``, an upper bound of ``times``, is known to be
    below that, the second branch is left out.
    """
    last = F.col(times) - 1
    small = df.filter(F.col(times).between(1, EXPAND_PIECE)).withColumn(
        position, F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")))
    )
    if most is not None and most <= EXPAND_PIECE:
        return small
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.lit(EXPAND_PIECE).cast("bigint")
    large = (
        df.filter(F.col(times) > EXPAND_PIECE)
        .withColumn("__first", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), piece)))
        .repartition(parts)
        .withColumn(
            position,
            F.explode(F.sequence(F.col("__first"), F.least(F.col("__first") + piece - 1, last))),
        )
        .drop("__first")
    )
    return small.unionByName(large)


def split_evenly(df: DataFrame, quantity: str, lines: str, out: str, position: str = "line_no") -> DataFrame:
    """Split a quantity over a number of lines, at least 1 per line.

    The first ``quantity mod lines`` lines get one more than the others.
    """
    whole = df.withColumn("__q", F.greatest(F.col(quantity), F.col(lines)).cast("bigint"))
    rows = expand_rows(whole, lines, "__pos")
    extra = F.when(F.col("__pos") < F.col("__q") % F.col(lines), 1).otherwise(0)
    return rows.select(
        *df.columns,
        (F.col("__pos") + 1).alias(position),
        (F.expr(f"__q div `{lines}`") + extra).cast("bigint").alias(out),
    )

"""Profiles of tables that add up over loads.

A load is profiled in one pass: counts, bounds and, per column, sketches of its distinct values and
of its quantiles. Profiles are small rows, and those of several loads are merged without reading a
load again: counts and bounds exactly, sketches within the errors they have anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.quality import union_all

# two to this many registers; the error of a distinct count is about 1.04 / sqrt(2^LOG_REGISTERS)
LOG_REGISTERS = 12
QUANTILES = (0.25, 0.5, 0.75)
# a quantile's rank is off by less than this
RANK_ERROR = 0.02


def _as_number(name: str, kind: T.DataType) -> Column | None:
    """A column as a number: dates and times as days since 1970; None for texts and others."""
    value = F.col(f"`{name}`")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("int").cast("double") if isinstance(kind, T.BooleanType) else value.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    return None


def profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column of ``df`` that holds numbers, times or texts.

    table_name, column_name, n_rows, n_null, least and most (of numbers; times in days since 1970),
    least_text and most_text (of texts), and the sketches distinct_values and quantiles.
    """
    columns = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    found: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    for k, f in enumerate(columns):
        value, number = F.col(f"`{f.name}`"), _as_number(f.name, f.dataType)
        found.append(F.count(value).alias(f"n{k}"))
        # a hash of its own type tells values apart whatever the type is
        found.append(F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), F.lit(LOG_REGISTERS)).alias(f"d{k}"))
        if number is not None:
            found += [F.min(number).alias(f"l{k}"), F.max(number).alias(f"m{k}"), F.kll_sketch_agg_double(number).alias(f"q{k}")]
            # adding zero makes one zero of both signs
            bounds = [(F.col(f"l{k}") + 0.0).alias("least"), (F.col(f"m{k}") + 0.0).alias("most"), text.alias("least_text"), text.alias("most_text")]
            sketch = F.col(f"q{k}")
        else:
            found += [F.min(value.cast("string")).alias(f"l{k}"), F.max(value.cast("string")).alias(f"m{k}")]
            bounds = [none.alias("least"), none.alias("most"), F.col(f"l{k}").alias("least_text"), F.col(f"m{k}").alias("most_text")]
            sketch = F.lit(None).cast("binary")
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"), F.col("n_rows"),
                (F.col("n_rows") - F.col(f"n{k}")).alias("n_null"), *bounds,
                F.col(f"d{k}").alias("distinct_values"), sketch.alias("quantiles"),
            )
        )
    return df.agg(*found).select(F.inline(F.array(*rows)))


def merged(profiles: DataFrame) -> DataFrame:
    """Profiles of several loads as one, with the columns of a profile."""
    return profiles.groupBy("table_name", "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.min("least_text").alias("least_text"),
        F.max("most_text").alias("most_text"),
        F.hll_union_agg("distinct_values").alias("distinct_values"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def readable(profiles: DataFrame) -> DataFrame:
    """The sketches read: n_distinct, and the quartiles of numbers."""
    number = F.col("least").isNotNull()
    quartiles = [
        F.when(number, F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(f"q{int(100 * q)}") for q in QUANTILES
    ]
    return profiles.select(
        "table_name", "column_name", "n_rows", "n_null", "least", "most", "least_text", "most_text",
        F.hll_sketch_estimate("distinct_values").alias("n_distinct"), *quartiles,
    )


def save(frames: dict[str, DataFrame], root: str, load: str) -> None:
    """Profile the tables of a load and keep that in a folder named after it, which a rerun replaces."""
    rows = union_all([profile(df, name) for name, df in frames.items()])
    rows.write.mode("overwrite").parquet(f"{root}/load={load}")


def agreement(parts: DataFrame, whole: DataFrame) -> DataFrame:
    """Merged profiles next to those of everything at once: whether the sketches agree within their errors."""
    other = whole.select(
        "table_name", "column_name", F.col("distinct_values").alias("__d"), F.col("quantiles").alias("__q")
    )
    both = parts.join(other, ["table_name", "column_name"])
    error = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)
    n, m = F.hll_sketch_estimate("distinct_values"), F.hll_sketch_estimate("__d")
    # both are off by less than the rank error, so the one lies between neighbours of the other
    near = F.lit(True)
    for q in QUANTILES:
        found = F.kll_sketch_get_quantile_double("quantiles", F.lit(q))
        low, high = (F.kll_sketch_get_quantile_double("__q", F.lit(q + sign * 2 * RANK_ERROR)) for sign in (-1, 1))
        near = near & found.between(low, high)
    return both.select(
        "table_name", "column_name", "n_rows", "n_null", "least", "most", "least_text", "most_text",
        (F.abs(n - m) <= error * m).alias("distinct_agree"), F.when(F.col("least").isNotNull(), near).otherwise(True).alias("quantiles_agree"),
    )

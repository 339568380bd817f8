"""References found in the data: columns whose values all occur in another column.

Every distinct value of every column is looked at once. Values are sent to their place by hash,
together with the columns they occur in, as bits of a few words; meeting values merge their bits
before the shuffle and after it, so a frequent value costs a row per task. What is left is one set
of columns per value. Equal sets are counted, and the pairs of columns within the few different
sets tell for all columns at once how many values of one are found in another.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.quality import union_all
from ledgerline.session import materialize

# columns whose bits fit in one word
WORD = 63
# percent of a column's values that must be found in the other
MIN_COVERAGE = 90


@dataclass(frozen=True)
class Attribute:
    table: str
    column: str
    kind: str


def kind_of(data_type: T.DataType) -> str | None:
    """Columns of one kind are compared; None is compared with nothing."""
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        return "fraction"
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    if isinstance(data_type, (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return data_type.typeName()
    return None


WIDEST = {"integer": "bigint", "fraction": "double", "decimal": "decimal(38,10)"}


def attributes(tables: Mapping[str, DataFrame]) -> list[Attribute]:
    found = []
    for name, df in tables.items():
        for field in df.schema.fields:
            kind = kind_of(field.dataType)
            if kind is not None:
                found.append(Attribute(name, field.name, kind))
    return found


def _values(df: DataFrame, own: list[tuple[int, Attribute]], kinds: list[str], words: int) -> DataFrame:
    """One row per value of a row of ``df``: its kind, its hashes and the bit of its column."""

    def value(number: int, a: Attribute) -> Column:
        v = F.col(f"`{a.column}`").cast(WIDEST.get(a.kind, df.schema[a.column].dataType.simpleString()))
        bits = [
            F.lit(1 << number % WORD if word == number // WORD else 0).cast("bigint").alias(f"w{word}")
            for word in range(words)
        ]
        hashes = [F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2")]
        return F.struct(F.lit(kinds.index(a.kind)).alias("kind"), v.isNotNull().alias("there"), *hashes, *bits)

    rows = df.select(F.inline(F.array(*[value(n, a) for n, a in own])))
    return rows.filter("there").drop("there")


def column_sets(tables: Mapping[str, DataFrame], found: list[Attribute]) -> DataFrame:
    """How many distinct values have each set of columns: words of bits, n."""
    words = -(-len(found) // WORD)
    names = [f"w{k}" for k in range(words)]
    kinds = sorted({a.kind for a in found})
    parts = []
    for table, df in tables.items():
        own = [(n, a) for n, a in enumerate(found) if a.table == table]
        if own:
            parts.append(_values(df, own, kinds, words))
    merged = union_all(parts).groupBy("kind", "h1", "h2").agg(*[F.bit_or(w).alias(w) for w in names])
    return merged.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def _row_counts(tables: Mapping[str, DataFrame], found: list[Attribute]) -> DataFrame:
    """(number, n_rows): rows of every column that are not NULL, one scan a table."""
    parts = []
    for table, df in tables.items():
        own = [(n, a) for n, a in enumerate(found) if a.table == table]
        if own:
            counts = df.agg(*[F.count(f"`{a.column}`").alias(f"c{n}") for n, a in own])
            pairs = [F.struct(F.lit(n).alias("number"), F.col(f"c{n}").alias("n_rows")) for n, _ in own]
            parts.append(counts.select(F.inline(F.array(*pairs))))
    return union_all(parts)


def inclusions(tables: Mapping[str, DataFrame], min_coverage: int = MIN_COVERAGE) -> DataFrame:
    """Pairs of columns of one kind such that ``min_coverage`` percent of one's values are in the other.

    Columns: from_table, from_column, to_table, to_column, n_values (distinct values of the first,
    NULL left out), n_found (of these, how many the second has), to_is_key (no value of the second
    occurs twice). Whole numbers of any width are one kind; arrays, maps, structs and binary
    columns are left out. A column without values is in no pair.
    """
    found = attributes(tables)
    spark = next(iter(tables.values())).sparkSession
    sets = materialize(column_sets(tables, found), "column-sets")

    def has(n: int) -> Column:
        return F.col(f"w{n // WORD}").bitwiseAND(F.lit(1 << n % WORD).cast("bigint")) != 0

    members = F.array_compact(F.array(*[F.when(has(n), F.lit(n)) for n in range(len(found))]))
    pairs = (
        sets.select("n", members.alias("members"))
        .select("n", "members", F.explode("members").alias("a"))
        .select("n", "a", F.explode("members").alias("b"))
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n_found"))
    )
    # at most the square of the number of columns
    pairs = materialize(pairs, "column-pairs")
    totals = pairs.filter("a = b").select(F.col("a").alias("__a"), F.col("n_found").alias("n_values"))
    keys = (
        totals.join(_row_counts(tables, found), F.col("__a") == F.col("number"))
        .select(F.col("__a").alias("__b"), (F.col("n_values") == F.col("n_rows")).alias("to_is_key"))
    )
    names = spark.createDataFrame(
        [(n, a.table, a.column) for n, a in enumerate(found)], "number int, table_name string, column_name string"
    )
    enough = F.col("n_found") * 100 >= F.col("n_values") * min_coverage
    return (
        pairs.filter("a != b")
        .join(totals, F.col("a") == F.col("__a"))
        .filter(enough)
        .join(keys, F.col("b") == F.col("__b"))
        .join(names.toDF("__f", "from_table", "from_column"), F.col("a") == F.col("__f"))
        .join(names.toDF("__t", "to_table", "to_column"), F.col("b") == F.col("__t"))
        .select("from_table", "from_column", "to_table", "to_column", "n_values", "n_found", "to_is_key")
    )

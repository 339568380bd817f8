"""CSV exchange: one folder of part files per table, header in every file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.model import TABLES, Table


# Spark's default format stops at milliseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


# Quotes are doubled, blanks kept, and a backslash is a character like any other.
DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# What an unquoted empty field is read as, to tell it from a quoted one; no field holds it.
ABSENT = "\u0000"


def _one_line(df: DataFrame) -> DataFrame:
    """``df``, whose job fails at the first text with a line break."""
    def checked(name: str) -> Column:
        message = F.lit(f"column {name} holds a line break; write it with multi_line")
        text = F.col(f"`{name}`")
        return F.when(text.rlike(r"[\r\n]"), F.raise_error(message)).otherwise(text).alias(name)

    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[checked(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def write_csv(df: DataFrame, path: str, multi_line: bool = False, mode: str = "overwrite") -> None:
    """Write ``df`` as CSV; NULL becomes an empty field, an empty string ``""``.

    Text must fit on one line (see :func:`ledgerline.functions.text.one_line`),
    so that readers can split the files; the job fails where it does not. With
    ``multi_line`` fields may hold line breaks, and a reader has to take every
    file as a whole.
    """
    writer = (df if multi_line else _one_line(df)).write.mode(mode).options(**DIALECT)
    writer = writer.option("emptyValue", '""')
    writer.option("timestampFormat", TIMESTAMP_FORMAT).csv(path)


def write_tables(frames: Iterable[tuple[str, DataFrame]], root: str, multi_line: bool = False) -> None:
    for name, df in frames:
        write_csv(df, f"{root}/{name}", multi_line)


def csv_header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Column names from the first line of the files; reads one row."""
    reader = spark.read.options(**DIALECT).option("multiLine", multi_line)
    return reader.option("enforceSchema", False).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Read CSV whose header lists any subset of ``schema`` in any order.

    Types come from ``schema``, never from inference; a malformed row fails the
    read. An unquoted empty field is NULL, a quoted one an empty string. Fields
    with line breaks need ``multi_line``, which keeps files from being split.
    """
    known: dict[str, StructField] = {f.name: f for f in schema.fields}
    names = csv_header(spark, path, multi_line)
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"{path}: columns not in the table: {', '.join(unknown)}")
    found = StructType([known[n] for n in names])
    return (
        spark.read.schema(found)
        .options(**DIALECT)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("nullValue", ABSENT)
        .option("emptyValue", "")
        .option("multiLine", multi_line)
        .csv(path, lineSep="\n" if multi_line else None)
    )


def with_defaults(df: DataFrame, table: Table) -> DataFrame:
    """All columns of the table: missing ones from their default, else NULL.

    As with column defaults in SQL, a value that is supplied as NULL stays NULL.
    """
    columns = []
    for f in table.schema.fields:
        if f.name in df.columns:
            value = F.col(f.name)
        else:
            value = F.expr(table.defaults.get(f.name, "NULL"))
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace NULLs in the named columns by a constant."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
            for c in df.columns
        ]
    )


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The ten tables of a CSV folder, with defaults applied."""
    return {
        name: with_defaults(read_csv(spark, f"{root}/{name}", table.schema), table)
        for name, table in TABLES.items()
    }

"""Small steps that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "__row_key"
CHECK = "__row_check"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(name), F.lit(""))


# Texts differ in size by orders of magnitude, so batches on their way to Python are bounded in bytes.
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20,
}


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are no larger than a task should hold at once."""
    conf = df.sparkSession.conf
    for key, limit in BATCH_LIMITS.items():
        known = conf.get(key, None)
        digits = "".join(c for c in known or "" if c.isdigit() or c == "-")
        # a value below 1 stands for no limit, and one with a unit is replaced as well
        if digits != known or not 0 < int(digits) <= limit:
            conf.set(key, str(limit))
    return df


def giving_back(task: Callable) -> Callable:
    """``task``, a function for ``mapInArrow``, that in the end returns freed memory to the system.

    A Python worker outlives its task. Its allocators keep what a heavy task has freed, and an
    executor would carry that besides its own memory through all the steps that follow.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        # glibc has it, other C libraries may not
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return whole


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """96 bits that name a document's id and text; rows that share them are copies of one row."""
    # the nulls are told apart from empty texts and from zero
    parts = [F.col(doc_id), F.col(doc_id).isNull(), F.col(text)]
    return [F.xxhash64(*parts).alias(KEY), F.hash(*parts).alias(CHECK)]


def keep_rows(docs: DataFrame, decisions: DataFrame, one_of_copies: bool = False) -> DataFrame:
    """The rows of ``docs`` whose key is in ``decisions`` (columns KEY and CHECK).

    ``one_of_copies`` also reduces rows of equal id and text to one.
    """
    kept = docs.select("*", *row_key()).join(decisions.select(KEY, CHECK), [KEY, CHECK], "left_semi")
    if one_of_copies:
        kept = kept.dropDuplicates([KEY, CHECK])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Optional reader for tables kept in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    first: int,
    last: int,
    partitions: int,
    **properties: str,
) -> DataFrame:
    """Read a table in parallel ranges of a numeric key.

    ``first`` and ``last`` only set the stride of the ranges; rows outside them
    are read too. The driver for ``url`` has to be on the class path.
    """
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=first,
        upperBound=last,
        numPartitions=partitions,
        properties=properties,
    )

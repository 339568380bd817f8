"""Calendar expressions and the day spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Demand factors by calendar.
GROWTH_PER_YEAR = 0.07
WEEKEND_FACTOR = 1.35
DECEMBER_FACTOR = 1.4
PAYDAY_FACTOR = 1.3
PAYDAYS = [15, 16, 30, 31, 1]


def day_spine(dates: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date of ``column``, and the first year."""
    bounds = dates.agg(
        F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last")
    )
    return bounds.filter(F.col("first").isNotNull()).select(
        F.year("first").alias("first_year"),
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day"),
    )


def is_weekend(day: Column) -> Column:
    """Friday, Saturday or Sunday (the busy days)."""
    return F.weekday(day) >= 4


def is_december(day: Column) -> Column:
    return F.month(day) == 12


def is_payday(day: Column) -> Column:
    return F.dayofmonth(day).isin(PAYDAYS)


def demand_weight(day: Column, first_year: Column) -> Column:
    """Relative demand of a day: growth times weekend, December and payday factors."""
    growth = F.lit(1.0) + F.lit(GROWTH_PER_YEAR) * (F.year(day) - first_year)
    return (
        growth
        * F.when(is_weekend(day), WEEKEND_FACTOR).otherwise(1.0)
        * F.when(is_december(day), DECEMBER_FACTOR).otherwise(1.0)
        * F.when(is_payday(day), PAYDAY_FACTOR).otherwise(1.0)
    )


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))

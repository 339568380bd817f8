"""Weekly demand forecasts per product, tried on weeks that were held out.

Demand for most products is intermittent: many weeks without a sale. Two numbers are smoothed
exponentially: how likely a week has demand, and how much there is when it has; the forecast is
their product, times a factor for the month that all products share. A product travels with the
weeks in which it sold. The weeks without a sale are filled in within the tasks, where the weeks of
many products are the columns of a matrix, folded from the first to the last for all of them at
once; there are as many weeks as the shop is old, however large it is.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import or_zero
from ledgerline.model import Shop
from ledgerline.plans.marts import on_hand
from ledgerline.plans.reports import day_product_sales
from ledgerline.session import materialize

# the functions travel with the job, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HELD_OUT = 4
# how fast the two smoothed numbers follow
CHANCE_RATE = 0.1
SIZE_RATE = 0.1
# weeks until a delivery arrives, and standard deviations kept in stock for them
LEAD_WEEKS = 2
SAFETY = 1.65
# numbers in one matrix of products and weeks
MOST_NUMBERS = 1 << 20
FITTED = "level DOUBLE, sigma DOUBLE, units_held_out DOUBLE, forecast_held_out DOUBLE, mean_error DOUBLE, mean_error_flat DOUBLE"


def weekly_units(shop: Shop) -> DataFrame:
    """(product_id, week, units) for weeks with sales; weeks start on Mondays."""
    week = F.to_date(F.date_trunc("week", F.col("day").cast("timestamp")))
    return day_product_sales(shop).groupBy("product_id", week.alias("week")).agg(F.sum("units").alias("units"))


def month_factors(weeks: DataFrame, last: Column) -> DataFrame:
    """(month, factor): mean units of the month's weeks over the mean of all weeks up to ``last``; twelve rows.

    A month without sales has factor 1.
    """
    totals = weeks.filter(F.col("week") <= last).groupBy("week").agg(F.sum("units").alias("units"))
    months = totals.groupBy(F.month("week").alias("month")).agg(
        F.sum("units").alias("own"), F.count(F.lit(1)).alias("own_weeks")
    )
    every = totals.agg(F.sum("units").alias("all"), F.count(F.lit(1)).alias("all_weeks")).withColumn("one", F.lit(1))
    share = (F.col("own") * F.col("all_weeks")).cast("double") / (F.col("own_weeks") * F.col("all")).cast("double")
    return (
        months.withColumn("one", F.lit(1)).join(every, "one")
        .select("month", F.coalesce(F.nullif(share, F.lit(0.0)), F.lit(1.0)).alias("factor"))
    )


def _series(weeks: DataFrame, products: DataFrame, first: date) -> DataFrame:
    """Per product: how many rows it has, and the places and units of the weeks in which it sold."""
    at = (F.datediff("week", F.lit(first)) / 7).cast("int").alias("at")
    sold = weeks.filter(F.col("week").isNotNull()).groupBy("product_id").agg(
        F.collect_list(F.struct(at, or_zero("units").cast("double").alias("units"))).alias("sold")
    )
    listed = products.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count(F.lit(1)).alias("copies"))
    return listed.join(sold, "product_id", "left").select("product_id", "copies", "sold.at", "sold.units")


def _total(columns: np.ndarray) -> np.ndarray:
    """Sums of rows, added from left to right."""
    out = np.zeros(len(columns))
    for column in columns.T:
        out = out + column
    return out


def smoothed(units: np.ndarray, chance: np.ndarray, size: np.ndarray, chance_rate: float, size_rate: float) -> tuple:
    """Fold weekly units, a row per product, to (chance, size, squares): the smoothed numbers and their one-step errors."""
    squares = np.zeros(len(units))
    for x in units.T:
        error = x - chance * size
        squares = squares + error * error
        chance = chance + chance_rate * ((x > 0) - chance)
        size = np.where(x > 0, size + size_rate * (x - size), size)
    return chance, size, squares


def _fit(units: np.ndarray, factor: np.ndarray, n_learned: int, chance_rate: float, size_rate: float) -> list[np.ndarray]:
    """The columns of FITTED for a matrix with a row per product and a column per week."""
    learned, held, ahead = units[:, :n_learned], units[:, n_learned:], factor[n_learned:]
    flat = learned / factor[:n_learned]
    n_there = (flat > 0).sum(1)
    chance = n_there / max(n_learned, 1)
    size = _total(np.where(flat > 0, flat, 0.0)) / np.maximum(n_there, 1)
    chance, size, squares = smoothed(flat, chance, size, chance_rate, size_rate)
    level = chance * size
    recent = _total(learned[:, -4:]) / 4.0 if n_learned >= 4 else np.zeros(len(units))
    forecast = level[:, None] * ahead
    n_held = max(held.shape[1], 1)
    return [
        level,
        np.sqrt(squares / max(n_learned, 1)),
        _total(held),
        _total(forecast),
        _total(np.abs(held - forecast)) / n_held,
        _total(np.abs(held - recent[:, None])) / n_held,
    ]


def _fitter(factor: Sequence[float], n_learned: int, chance_rate: float, size_rate: float) -> Callable:
    names = [f.split()[0] for f in FITTED.split(", ")]

    def fit(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_sold = pc.fill_null(pc.list_value_length(batch["at"]), 0).to_numpy(zero_copy_only=False)
        units = np.zeros((len(batch), len(factor)))
        at = batch["at"].flatten().to_numpy(zero_copy_only=False)
        units[np.repeat(np.arange(len(batch)), n_sold), at] = batch["units"].flatten().to_numpy(zero_copy_only=False)
        copies = batch["copies"].to_numpy(zero_copy_only=False)
        out = np.zeros((len(names), len(batch)))
        # a product that is listed several times has as many rows a week
        for n in np.unique(copies):
            own = copies == n
            out[:, own] = _fit(np.repeat(units[own], n, 1), np.repeat(factor, n), n_learned * n, chance_rate, size_rate)
        return pa.RecordBatch.from_arrays([batch["product_id"], *map(pa.array, out)], names=["product_id", *names])

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, MOST_NUMBERS // len(factor))
        for batch in batches:
            for start in range(0, len(batch), most):
                yield fit(batch.slice(start, most))

    return fit_all


def demand_forecast(
    shop: Shop,
    held_out: int = HELD_OUT,
    chance_rate: float = CHANCE_RATE,
    size_rate: float = SIZE_RATE,
    lead_weeks: int = LEAD_WEEKS,
    safety: float = SAFETY,
) -> DataFrame:
    """One row per product: its forecast, how far off it was on the weeks held out, and a reorder point.

    weekly (forecast of a week in a month of factor 1), sigma (one-step error of the weeks learned
    from), units_held_out, forecast_held_out, mean_error (mean absolute error per held-out week),
    mean_error_flat (the same for the mean of the last four weeks learned from), reorder_point
    (units that cover ``lead_weeks`` weeks and ``safety`` deviations), on_hand and suggested_units.

    The smoothed numbers start from the share of weeks with demand and their mean. A product
    without sales in the weeks learned from has forecast 0.
    """
    weeks = materialize(weekly_units(shop), "weekly-units")
    products = shop.products.select("product_id")
    # one row
    first, last, learn = weeks.agg(
        F.min("week"), F.max("week"), F.date_sub(F.max("week"), 7 * held_out)
    ).first()
    # twelve rows
    factors = {} if first is None else {r["month"]: r["factor"] for r in month_factors(weeks, F.lit(learn)).collect()}
    every = [] if first is None else np.arange(first, last, 7, "datetime64[D]").tolist() + [last]
    series = _series(weeks, products, first or date.min)
    if not every:
        series = series.limit(0)
    factor = [factors.get(week.month, 1.0) for week in every]
    fit = _fitter(factor, sum(week <= learn for week in every), chance_rate, size_rate)
    key = series.schema["product_id"].dataType.simpleString()
    series = series.mapInArrow(fit, f"product_id {key}, {FITTED}")
    level, sigma = F.col("level"), F.col("sigma")
    point = F.ceil(F.round(level * lead_weeks + safety * sigma * F.sqrt(F.lit(float(lead_weeks))), 6)).cast("bigint")
    fitted = series.select(
        "product_id",
        F.round(level, 6).alias("weekly"),
        F.round(sigma, 6).alias("sigma"),
        F.col("units_held_out").cast("bigint").alias("units_held_out"),
        *[F.round(c, 6).alias(c) for c in ("forecast_held_out", "mean_error", "mean_error_flat")],
        point.alias("reorder_point"),
    )
    return fitted.join(on_hand(shop).select("product_id", "on_hand"), "product_id").withColumn(
        "suggested_units", F.greatest(F.col("reorder_point") - F.col("on_hand"), F.lit(0)).cast("bigint")
    )

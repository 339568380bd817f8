"""Exact money arithmetic.

Prices and amounts are DECIMAL(10,2) in the tables. Products and sums of such
decimals leave the 18 digits Spark keeps in a long and fall back to BigDecimal
objects, so sums are taken over whole centavos (BIGINT) and turned into
DECIMAL(38,2) once per result row. ANSI mode raises on overflow.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(10,2)"
TOTAL = "decimal(38,2)"

# Wholesale markup (selling price / cost) per product group.
CATEGORY_MARKUP = {
    "Meal Ingredients": Decimal("1.15"),
    "Beverages": Decimal("1.18"),
    "Snacks": Decimal("1.22"),
    "Small Household Items": Decimal("1.18"),
    "Processed Meat": Decimal("1.15"),
    "Liquor": Decimal("1.12"),
}
DEFAULT_MARKUP = Decimal("1.18")
# Fixed value: yearly price drift.
INFLATION_RATE = 0.04


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount: Column | str) -> Column:
    """A two-decimal amount as whole centavos."""
    return (_col(amount) * 100).cast("bigint")


def money(centavos: Column | str) -> Column:
    """Whole centavos as DECIMAL(38,2)."""
    return (_col(centavos).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(TOTAL)


def line_cents(quantity: Column | str = "quantity", price: Column | str = "unit_price") -> Column:
    """Quantity times price of a line, in centavos."""
    return _col(quantity) * cents(price)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def round_quarter(price: Column | str) -> Column:
    """Nearest 0.25, ties to the even quarter, never below 0.25."""
    quarters = F.bround(_col(price).cast("double") * 4)
    return F.greatest(quarters / 4, F.lit(0.25)).cast(PRICE)


def price_index(year: Column, base_year: Column, rate: float) -> Column:
    """Price factor of ``year`` relative to ``base_year`` at a yearly rate."""
    return F.pow(F.lit(1.0 + rate), year - base_year)


def cost_from_price(price: Column | str, markup: Column | str) -> Column:
    """Wholesale cost implied by a selling price and a markup, to the centavo.

    The quotient is taken in binary floating point and ties go to the even
    centavo, which decides quotients that are ties in exact arithmetic.
    """
    factor = F.coalesce(_col(markup), F.lit(DEFAULT_MARKUP)).cast("double")
    return F.bround(_col(price).cast("double") / factor, 2).cast(PRICE)

"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_line(text: Column) -> Column:
    """Line breaks become ``, `` so that a value fits on one CSV line."""
    return F.regexp_replace(text, "\r\n|\r|\n", ", ")


def barcode(number: Column) -> Column:
    """Thirteen-digit code: the prefix 48 and an eleven-digit number."""
    return F.format_string("48%011d", number)


def document_no(number: Column) -> Column:
    """Delivery receipt number such as DR-000123."""
    return F.format_string("DR-%06d", number)


def tagged(prefix: str, number: Column | str) -> Column:
    """A reference such as ``TXN#12``."""
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("string"))

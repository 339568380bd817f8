"""A tiny shop with every table filled, built in memory."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal as D

from ledgerline.model import TABLES, Shop

NOW = datetime(2025, 1, 1, 8, 0, 0)


def day(n: int) -> datetime:
    return datetime(2025, 1, n, 9, 30, 0)


ROWS = {
    "categories": [(1, "Pantry", None, NOW), (2, "Dairy", None, NOW)],
    "units": [(1, "bag", "Bag", NOW), (2, "btl", "Bottle", NOW)],
    "suppliers": [(1, "North Mill", "Ida", "111", None, NOW)],
    "products": [
        (1, 1, 1, "Flour", None, "A1", D("20.00"), 5, 7, True, NOW, NOW),
        (2, 2, 2, "Milk", None, None, D("9.00"), 12, 1, True, NOW, NOW),
        (3, 1, 1, "Rye", None, None, D("11.00"), 0, 0, False, NOW, NOW),
    ],
    "customers": [
        (1, "Anna", "An", None, None, D("100.00"), True, NOW, NOW),
        (2, "Bert", "B", None, None, D("50.00"), True, NOW, NOW),
    ],
    "restocks": [(1, 1, day(1), "DR-1", None, NOW)],
    "restock_items": [(1, 1, 1, 10, D("15.00")), (2, 1, 2, 30, D("6.00")), (3, 1, 2, 2, D("6.10"))],
    "transactions": [
        (1, 1, day(2), "credit", None, NOW),
        (2, None, day(3), "cash", None, NOW),
        (3, 2, day(4), "cash", None, NOW),
        (4, 1, day(5), "credit", None, NOW),
        (5, 1, day(6), "credit", None, NOW),  # a sale without lines
    ],
    "transaction_items": [
        (1, 1, 1, 2, D("20.00")), (2, 1, 2, 1, D("9.00")), (3, 2, 1, 12, D("19.50")),
        (4, 4, 2, 3, D("9.00")),
    ],
    "credit_payments": [(1, 1, D("30.00"), day(4), None, NOW), (2, 2, D("5.00"), day(4), None, NOW)],
}


def small_shop(spark) -> Shop:
    return Shop(
        {name: spark.createDataFrame(ROWS[name], table.schema) for name, table in TABLES.items()}
    )

"""Invented flat lists with every irregularity the normalization must handle.

Two notes of one customer disagree on the balance, one product is listed by two
suppliers, a packed cell holds blanks and repeats, a sold product is missing
from the price list, two sales are equal, and walk-ins have no name.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

INVENTORY = (
    "product_name string, barcode string, category string, category_desc string,"
    " unit_code string, unit_label string, selling_price decimal(10,2), reorder_qty int,"
    " stock_count int, supplier_name string, supplier_contact string, supplier_phone string,"
    " supplier_address string, alt_suppliers string"
)
SALES = (
    "sale_date date, customer_name string, customer_phone string, customer_nickname string,"
    " customer_balance decimal(10,2), payment_type string,"
    " item1_name string, item1_qty int, item1_price decimal(10,2),"
    " item2_name string, item2_qty int, item2_price decimal(10,2),"
    " item3_name string, item3_qty int, item3_price decimal(10,2),"
    " total_amount decimal(10,2), notes string"
)
DELIVERIES = (
    "delivery_date date, reference_no string, supplier_name string, supplier_contact string,"
    " supplier_phone string, supplier_address string, product_name string,"
    " product_category string, product_unit string, qty_received int, unit_cost decimal(10,2),"
    " line_total decimal(10,2), notes string"
)

NORTH = ("North Mill", "Ida", "111", "1 Mill Road")
SOUTH = ("South Dairy", "Ole", "222", "2 Cow Lane")

INVENTORY_ROWS = [
    ("Flour 1kg", "A1", "Pantry", "Dry goods", "bag", "Bag", D("20.00"), 10, 9, *NORTH, None),
    ("Oats 500g", "A2", "Pantry", "Dry goods", "bag", "Bag", D("12.50"), 5, 4, *NORTH,
     " East Trade ; ;East Trade;South Dairy;"),
    ("Milk 1l", "B1", "Dairy", "Milk and cheese", "btl", "Bottle", D("9.00"), 12, 1, *SOUTH, None),
    # the same product again, from another supplier and at another price
    ("Milk 1l", "B1", "Dairy", "Milk and cheese", "btl", "Bottle", D("8.50"), 12, 1, *NORTH, None),
]


def _sale(day, name, phone, nick, balance, kind, items, total, notes=None):
    flat = []
    for i in range(3):
        flat += list(items[i]) if i < len(items) else [None, None, None]
    return (date(2025, 3, day), name, phone, nick, balance, kind, *flat, D(total), notes)


SALES_ROWS = [
    _sale(1, "Anna", "901", "An", D("0.00"), "credit",
          [("Flour 1kg", 2, D("20.00")), ("Milk 1l", 1, D("9.00"))], "49.00"),
    # two equal sales
    _sale(1, "Anna", "901", "An", D("0.00"), "credit", [("Oats 500g", 1, D("12.50"))], "12.50"),
    _sale(1, "Anna", "901", "An", D("0.00"), "credit", [("Oats 500g", 1, D("12.50"))], "12.50"),
    # a later note with another balance and another phone
    _sale(4, "Anna", "999", "An", D("61.50"), "credit", [("Milk 1l", 1, D("9.00"))], "9.00"),
    _sale(2, None, None, None, None, "cash", [("Flour 1kg", 1, D("20.00"))], "20.00"),
    _sale(3, "Bert", "902", "B", D("0.00"), "credit",
          [("Cider 1l", 3, D("30.00")), ("Flour 1kg", 1, D("20.00")), ("Milk 1l", 2, D("9.00"))],
          "128.00", "on tab"),
    _sale(5, "Bert", "902", "B", D("0.00"), "cash", [("Oats 500g", 2, D("12.50"))], "25.00"),
]

DELIVERY_ROWS = [
    (date(2025, 2, 1), "D-1", *NORTH, "Flour 1kg", "Pantry", "bag", 30, D("15.00"), D("450.00"), None),
    (date(2025, 2, 1), "D-1", *NORTH, "Oats 500g", "Pantry", "bag", 20, D("9.00"), D("180.00"), None),
    (date(2025, 2, 3), "D-2", *SOUTH, "Milk 1l", "Dairy", "btl", 24, D("6.00"), D("144.00"), "cold"),
]


def frames(spark):
    return (
        spark.createDataFrame(INVENTORY_ROWS, INVENTORY),
        spark.createDataFrame(SALES_ROWS, SALES),
        spark.createDataFrame(DELIVERY_ROWS, DELIVERIES),
    )

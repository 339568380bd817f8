"""The shop data model: ten tables, their schemas and their rules.

Spark does not enforce keys or checks on files, so every rule is declared here
and evaluated by :mod:`ledgerline.operators.quality`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    """Schema and rules of one table.

    ``required``    columns that must not be NULL
    ``unique``      column sets without repeats among rows where all are set
    ``checks``      rule name to a SQL condition; NULL passes, as in a CHECK
    ``references``  column to (table, column, what deleting the parent does)
    ``defaults``    column to the SQL expression used when it is not supplied
    """

    ddl: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    references: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


NOW = "current_timestamp()"

# In load order: parents before children.
TABLES: dict[str, Table] = {
    "categories": Table(
        "category_id BIGINT, name STRING, description STRING, created_at TIMESTAMP",
        key=("category_id",),
        required=("name", "created_at"),
        unique=(("name",),),
        defaults={"created_at": NOW},
    ),
    "units": Table(
        "unit_id BIGINT, code STRING, name STRING, created_at TIMESTAMP",
        key=("unit_id",),
        required=("code", "name", "created_at"),
        unique=(("code",),),
        defaults={"created_at": NOW},
    ),
    "suppliers": Table(
        "supplier_id BIGINT, name STRING, contact_person STRING, phone STRING,"
        " address STRING, created_at TIMESTAMP",
        key=("supplier_id",),
        required=("name", "created_at"),
        defaults={"created_at": NOW},
    ),
    "products": Table(
        "product_id BIGINT, category_id BIGINT, unit_id BIGINT, name STRING,"
        " description STRING, barcode STRING, current_price DECIMAL(10,2),"
        " reorder_level INT, stock_on_hand BIGINT, is_active BOOLEAN,"
        " created_at TIMESTAMP, updated_at TIMESTAMP",
        key=("product_id",),
        required=(
            "category_id", "unit_id", "name", "current_price", "reorder_level",
            "stock_on_hand", "is_active", "created_at", "updated_at",
        ),
        unique=(("barcode",),),
        checks={
            "current_price_not_negative": "current_price >= 0",
            "reorder_level_not_negative": "reorder_level >= 0",
        },
        references={
            "category_id": ("categories", "category_id", "restrict"),
            "unit_id": ("units", "unit_id", "restrict"),
        },
        defaults={
            "reorder_level": "0", "stock_on_hand": "0", "is_active": "true",
            "created_at": NOW, "updated_at": NOW,
        },
    ),
    "customers": Table(
        "customer_id BIGINT, full_name STRING, nickname STRING, phone STRING,"
        " address STRING, credit_limit DECIMAL(10,2), is_active BOOLEAN,"
        " created_at TIMESTAMP, updated_at TIMESTAMP",
        key=("customer_id",),
        required=("full_name", "credit_limit", "is_active", "created_at", "updated_at"),
        checks={"credit_limit_not_negative": "credit_limit >= 0"},
        defaults={
            "credit_limit": "0", "is_active": "true", "created_at": NOW, "updated_at": NOW,
        },
    ),
    "restocks": Table(
        "restock_id BIGINT, supplier_id BIGINT, restock_date TIMESTAMP,"
        " reference_no STRING, notes STRING, created_at TIMESTAMP",
        key=("restock_id",),
        required=("supplier_id", "restock_date", "created_at"),
        references={"supplier_id": ("suppliers", "supplier_id", "restrict")},
        defaults={"restock_date": NOW, "created_at": NOW},
    ),
    "restock_items": Table(
        "restock_item_id BIGINT, restock_id BIGINT, product_id BIGINT, quantity INT,"
        " unit_cost DECIMAL(10,2)",
        key=("restock_item_id",),
        required=("restock_id", "product_id", "quantity", "unit_cost"),
        checks={
            "quantity_positive": "quantity > 0",
            "unit_cost_not_negative": "unit_cost >= 0",
        },
        references={
            "restock_id": ("restocks", "restock_id", "cascade"),
            "product_id": ("products", "product_id", "restrict"),
        },
    ),
    "transactions": Table(
        "transaction_id BIGINT, customer_id BIGINT, transaction_date TIMESTAMP,"
        " payment_type STRING, notes STRING, created_at TIMESTAMP",
        key=("transaction_id",),
        required=("transaction_date", "payment_type", "created_at"),
        checks={
            "payment_type_known": "payment_type IN ('cash', 'credit')",
            "credit_requires_customer": "payment_type <> 'credit' OR customer_id IS NOT NULL",
        },
        references={"customer_id": ("customers", "customer_id", "restrict")},
        defaults={"transaction_date": NOW, "payment_type": "'cash'", "created_at": NOW},
    ),
    "transaction_items": Table(
        "transaction_item_id BIGINT, transaction_id BIGINT, product_id BIGINT,"
        " quantity INT, unit_price DECIMAL(10,2)",
        key=("transaction_item_id",),
        required=("transaction_id", "product_id", "quantity", "unit_price"),
        checks={
            "quantity_positive": "quantity > 0",
            "unit_price_not_negative": "unit_price >= 0",
        },
        references={
            "transaction_id": ("transactions", "transaction_id", "cascade"),
            "product_id": ("products", "product_id", "restrict"),
        },
    ),
    "credit_payments": Table(
        "payment_id BIGINT, customer_id BIGINT, amount DECIMAL(10,2),"
        " payment_date TIMESTAMP, notes STRING, created_at TIMESTAMP",
        key=("payment_id",),
        required=("customer_id", "amount", "payment_date", "created_at"),
        checks={"amount_positive": "amount > 0"},
        references={"customer_id": ("customers", "customer_id", "restrict")},
        defaults={"payment_date": NOW, "created_at": NOW},
    ),
}


class Shop:
    """The ten tables by name, as attributes.

    A table is given as a DataFrame or as a function that makes one when the
    table is first used, so a plan only resolves the tables it needs. Key
    columns may have any type, as long as both sides of a reference agree.
    """

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        missing = TABLES.keys() - frames.keys()
        if missing:
            raise ValueError(f"tables not given: {', '.join(sorted(missing))}")
        self._frames = dict(frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        frame = self._frames[name]
        if not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def tables(self) -> Iterator[tuple[str, DataFrame]]:
        for name in TABLES:
            yield name, getattr(self, name)

    def replace(self, **frames: DataFrame) -> Shop:
        return Shop({**self._frames, **frames})

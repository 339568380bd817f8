"""From flat, hand-kept lists to the normalized shop model.

Three flat inputs are split step by step: repeating and packed cells become
rows, repeated descriptions become dimensions, and names become keys. Stored
totals, balances and stock counts are dropped; the marts derive them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.model import TABLES, Shop
from ledgerline.operators.keys import (
    extract_dimension,
    left_join_named,
    one_per_key,
    resolve_keys,
)
from ledgerline.operators.ordered import number_rows
from ledgerline.operators.reshape import split_packed, unpivot_groups
from ledgerline.session import materialize

ITEM_SLOTS = 3


def item_groups(slots: int = ITEM_SLOTS) -> list[dict[str, str]]:
    """The repeating item columns of the sales list."""
    return [
        {
            "product_name": f"item{n}_name",
            "quantity": f"item{n}_qty",
            "unit_price": f"item{n}_price",
        }
        for n in range(1, slots + 1)
    ]


@dataclass(frozen=True)
class Inventory:
    categories: DataFrame
    units: DataFrame
    suppliers: DataFrame
    products: DataFrame
    product_suppliers: DataFrame
    product_alt_suppliers: DataFrame


def split_inventory(raw: DataFrame) -> Inventory:
    """Price list to categories, units, suppliers, products and who supplies what.

    A product is identified by its name. Its price at each supplier goes to
    ``product_suppliers``; the product itself carries the highest one.
    """
    categories = extract_dimension(raw, "category_id", ["category"], ["category_desc"])
    units = extract_dimension(raw, "unit_id", ["unit_code"], ["unit_label"])
    suppliers = extract_dimension(
        raw,
        "supplier_id",
        ["supplier_name"],
        ["supplier_contact", "supplier_phone", "supplier_address"],
    )
    products = extract_dimension(
        raw,
        "product_id",
        ["product_name"],
        ["selling_price", "barcode", "category", "unit_code", "reorder_qty"],
    )
    names = products.select("product_name", "product_id")
    offers = (
        raw.groupBy("product_name", "supplier_name")
        .agg(F.max("selling_price").alias("selling_price"))
        .join(names, "product_name")
        .join(suppliers.select("supplier_name", "supplier_id"), "supplier_name")
        .select("product_id", "supplier_id", "selling_price")
    )
    alternates = (
        split_packed(raw, ["product_name"], "alt_suppliers", "alt_supplier_name")
        .distinct()
        .join(names, "product_name")
        .select("product_id", "alt_supplier_name")
    )
    keyed = (
        products.join(categories.select("category", "category_id"), "category", "left")
        .join(units.select("unit_code", "unit_id"), "unit_code", "left")
        .select(
            "product_id",
            "category_id",
            "unit_id",
            F.col("product_name").alias("name"),
            "barcode",
            F.col("selling_price").alias("current_price"),
            F.col("reorder_qty").alias("reorder_level"),
        )
    )
    return Inventory(
        categories=categories.select(
            "category_id", F.col("category").alias("name"), F.col("category_desc").alias("description")
        ),
        units=units.select(
            "unit_id", F.col("unit_code").alias("code"), F.col("unit_label").alias("name")
        ),
        suppliers=suppliers.select(
            "supplier_id",
            F.col("supplier_name").alias("name"),
            F.col("supplier_contact").alias("contact_person"),
            F.col("supplier_phone").alias("phone"),
            F.col("supplier_address").alias("address"),
        ),
        products=keyed,
        product_suppliers=offers,
        product_alt_suppliers=alternates,
    )


def key_sales(raw: DataFrame) -> DataFrame:
    """The sales list with a sale id, assigned once for headers and items alike."""
    # numbering reads its rows several times
    return number_rows(materialize(raw, "sales-list"), ["sale_date", "customer_name"], "sale_id")


def sale_items(keyed: DataFrame, slots: int = ITEM_SLOTS) -> DataFrame:
    """Items of the keyed sales list; the item id follows from sale and slot."""
    rows = unpivot_groups(keyed, ["sale_id"], item_groups(slots), required="product_name")
    item_id = (F.col("sale_id") - 1) * slots + F.col("slot")
    return rows.select(
        item_id.cast("bigint").alias("transaction_item_id"),
        F.col("sale_id").alias("transaction_id"),
        "product_name",
        "quantity",
        "unit_price",
    )


@dataclass(frozen=True)
class Sales:
    customers: DataFrame
    transactions: DataFrame
    transaction_items: DataFrame
    products: DataFrame
    unresolved: DataFrame


def split_sales(raw: DataFrame, products: DataFrame, on_missing: str = "stub") -> Sales:
    """Sales list to customers, sale headers and items.

    The latest sale decides a customer's phone and nickname. Walk-ins have no
    customer row and keep a NULL key.
    """
    keyed = key_sales(raw)
    customers = extract_dimension(
        keyed,
        "customer_id",
        ["customer_name"],
        ["customer_phone", "customer_nickname"],
        newest=["sale_date", "sale_id"],
    )
    headers = left_join_named(
        keyed.select("sale_id", "sale_date", "customer_name", "payment_type", "notes"),
        customers.select("customer_name", "customer_id"),
        "customer_name",
    )
    items = resolve_keys(
        sale_items(keyed), products, "product_name", "name", "product_id", on_missing
    )
    return Sales(
        customers=customers.select(
            "customer_id",
            F.col("customer_name").alias("full_name"),
            F.col("customer_nickname").alias("nickname"),
            F.col("customer_phone").alias("phone"),
        ),
        transactions=headers.select(
            F.col("sale_id").alias("transaction_id"),
            "customer_id",
            F.col("sale_date").alias("transaction_date"),
            "payment_type",
            "notes",
        ),
        transaction_items=items.rows.select(
            "transaction_item_id", "transaction_id", "product_id", "quantity", "unit_price"
        ),
        products=items.dimension,
        unresolved=items.unresolved,
    )


DOCUMENT = ["delivery_date", "reference_no", "supplier_name"]


def delivery_headers(raw: DataFrame, attributes: Sequence[str] = ()) -> DataFrame:
    """One numbered row per delivery document."""
    return number_rows(
        one_per_key(raw, DOCUMENT, attributes), DOCUMENT, "restock_id", unique_rows=True
    )


@dataclass(frozen=True)
class Deliveries:
    restocks: DataFrame
    restock_items: DataFrame
    suppliers: DataFrame
    products: DataFrame
    unresolved: DataFrame


def split_deliveries(
    raw: DataFrame, suppliers: DataFrame, products: DataFrame, on_missing: str = "stub"
) -> Deliveries:
    """Delivery log to delivery headers and lines.

    The log is read once, to store its lines before they are numbered; headers come from those.
    Names are looked up before the lines get their documents, which this needs no join for.
    """
    order = ["delivery_date", "reference_no", "product_name"]
    keyed = number_rows(materialize(raw, "delivery-log"), order, "restock_item_id")
    headers = delivery_headers(keyed, ["notes"])
    documents = headers.select("restock_id", *[F.col(c).alias(f"of_{c}") for c in DOCUMENT])
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in DOCUMENT]
    lines = keyed.select(
        "restock_item_id", *DOCUMENT, "product_name", F.col("qty_received").alias("quantity"), "unit_cost"
    )
    items = resolve_keys(lines, products, "product_name", "name", "product_id", on_missing)

    def with_documents(df: DataFrame, name: str) -> DataFrame:
        return df.join(documents, same).select("restock_item_id", "restock_id", name, "quantity", "unit_cost")

    # these are the lines themselves; other policies count names
    unresolved = with_documents(items.unresolved, "product_name") if on_missing == "quarantine" else items.unresolved
    resolved = resolve_keys(headers, suppliers, "supplier_name", "name", "supplier_id", "stub")
    return Deliveries(
        restocks=resolved.rows.select(
            "restock_id",
            "supplier_id",
            F.col("delivery_date").alias("restock_date"),
            "reference_no",
            "notes",
        ),
        restock_items=with_documents(items.rows, "product_id"),
        suppliers=resolved.dimension,
        products=items.dimension,
        unresolved=unresolved,
    )


@dataclass(frozen=True)
class Normalized:
    shop: Shop
    product_suppliers: DataFrame
    product_alt_suppliers: DataFrame
    unresolved_sales: DataFrame
    unresolved_deliveries: DataFrame


def normalize(
    inventory: DataFrame, sales: DataFrame, deliveries: DataFrame, on_missing: str = "stub"
) -> Normalized:
    """All three flat inputs to one shop. Payments start as an empty table."""
    spark = inventory.sparkSession
    stock = split_inventory(inventory)
    sold = split_sales(sales, stock.products, on_missing)
    received = split_deliveries(deliveries, stock.suppliers, sold.products, on_missing)
    shop = Shop(
        {
            "categories": stock.categories,
            "units": stock.units,
            "suppliers": received.suppliers,
            "products": received.products,
            "customers": sold.customers,
            "restocks": received.restocks,
            "restock_items": received.restock_items,
            "transactions": sold.transactions,
            "transaction_items": sold.transaction_items,
            "credit_payments": spark.createDataFrame([], TABLES["credit_payments"].schema),
        }
    )
    return Normalized(
        shop=shop,
        product_suppliers=stock.product_suppliers,
        product_alt_suppliers=stock.product_alt_suppliers,
        unresolved_sales=sold.unresolved,
        unresolved_deliveries=received.unresolved,
    )

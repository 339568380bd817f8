"""Map the supplied star-schema tables onto the shop model.

Every table is read whole. The part, customer and supplier tables are the
dimensions; open lines are sales, finished lines are deliveries, purchase
events are credit payments. The group and unit names serve as their own keys.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.money import PRICE, line_cents, money
from ledgerline.model import Shop
from ledgerline.operators.keys import left_join_named
from ledgerline.operators.ordered import number_rows
from ledgerline.session import SHARED, materialize


# Schemas seen so far, so that a table's footers are read once per process.
_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    # goods sold by weight (Brand#13) carry no code
    return read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_type AS category_id",
        "p_brand AS unit_id",
        "p_name AS name",
        "CASE WHEN p_brand <> 'Brand#13' THEN format_string('48%011d', p_partkey) END AS barcode",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS current_price",
        "p_size AS reorder_level",
        "p_size - 5 AS stock_on_hand",
        "p_size > 1 AS is_active",
    )


def _dimension(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """The distinct values of a part column, written once per session and folder.

    A stored table has a known size, by which Spark decides whether to broadcast.
    """
    slot = (spark.sparkContext.applicationId, sf_dir, column)
    if slot not in SHARED:
        names = read_table(spark, sf_dir, "part").select(column).distinct()
        SHARED[slot] = materialize(names, column)
    return SHARED[slot]


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, "p_type").selectExpr(
        "p_type AS category_id", "p_type AS name"
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, "p_brand").selectExpr(
        "p_brand AS unit_id", "p_brand AS code", "p_brand AS name"
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS supplier_id", "s_name AS name", "s_nationkey AS contact_person"
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS full_name",
        "c_mktsegment AS nickname",
        "greatest(CAST(c_acctbal AS DECIMAL(10,2)), CAST(0 AS DECIMAL(10,2))) AS credit_limit",
        "c_acctbal >= 0 AS is_active",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS transaction_id",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_custkey"
        " WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer_id",
        "o_orderdate AS transaction_date",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'credit' ELSE 'cash' END"
        " AS payment_type",
    )


def _lines(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").filter(f"l_linestatus = '{status}'")


def transaction_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "O").selectExpr(
        "l_orderkey AS transaction_id",
        "l_linenumber AS line_no",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price",
    )


def restock_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "F").selectExpr(
        "l_orderkey AS restock_id",
        "l_linenumber AS line_no",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_cost",
    )


def restocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per document: its first day and first supplier."""
    return (
        _lines(spark, sf_dir, "F")
        .groupBy(F.col("l_orderkey").alias("restock_id"))
        .agg(F.min("l_suppkey").alias("supplier_id"), F.min("l_shipdate").alias("restock_date"))
    )


def credit_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events, moved back 26 years to fall among the charges."""
    events = read_table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    return events.selectExpr(
        "event_id AS payment_id",
        "user_id AS customer_id",
        "CAST(value AS DECIMAL(10,2)) AS amount",
        "ts - INTERVAL '26' YEAR AS payment_date",
    )


def stock_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock_changes_of(read_table(spark, sf_dir, "events"))


def stock_changes_of(events: DataFrame) -> DataFrame:
    """Events as a change feed on sale and delivery lines, one change per event."""
    kind = F.col("event_type")
    even_view = (kind == "view") & (F.col("event_id") % 2 == 0)
    return events.select(
        F.col("event_id").alias("change_id"),
        F.col("ts").alias("change_ts"),
        F.when(kind.isin("signup", "click") | even_view, "restock").otherwise("sale").alias("side"),
        F.when(kind.isin("signup", "purchase"), "INSERT")
        .when(kind.isin("click", "error"), "DELETE")
        .otherwise("UPDATE")
        .alias("op"),
        F.col("user_id").alias("product_id"),
        (F.floor("value") + 1).cast("int").alias("quantity"),
        (F.col("user_id") + 1).alias("new_product_id"),
        (F.col("event_id") % 7 + 1).cast("int").alias("new_quantity"),
    )


def deliveries_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery log with supplier and product details repeated on every row."""
    supplier = read_table(spark, sf_dir, "supplier")
    part = read_table(spark, sf_dir, "part")
    lines = _lines(spark, sf_dir, "F")
    return (
        lines.join(supplier, lines["l_suppkey"] == supplier["s_suppkey"])
        .join(part, lines["l_partkey"] == part["p_partkey"])
        .select(
            F.col("l_shipdate").alias("delivery_date"),
            F.col("l_orderkey").alias("reference_no"),
            F.col("s_name").alias("supplier_name"),
            F.col("s_nationkey").alias("supplier_contact"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.col("l_quantity").cast("int").alias("qty_received"),
            F.col("l_extendedprice").cast(PRICE).alias("unit_cost"),
        )
    )


def inventory_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price list with repeated descriptions and a packed supplier cell.

    The cell holds blanks and repeats, as hand-kept lists do.
    """
    part = read_table(spark, sf_dir, "part")
    packed = F.concat(
        F.lit(" "), F.col("p_type"), F.lit(" Wholesale ; "), F.col("p_brand"),
        F.lit(" Trading;;"), F.col("p_type"), F.lit(" Wholesale; "),
    )
    return part.select(
        F.col("p_partkey").alias("list_no"),
        F.col("p_name").alias("product_name"),
        F.concat_ws("/", "p_name", "p_brand").alias("barcode"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("All goods of type "), F.col("p_type")).alias("category_desc"),
        F.col("p_brand").alias("unit_code"),
        F.concat(F.lit("Unit "), F.col("p_brand")).alias("unit_label"),
        F.col("p_retailprice").cast(PRICE).alias("selling_price"),
        F.col("p_size").alias("reorder_qty"),
        (F.col("p_size") - 5).alias("stock_count"),
        F.concat(F.col("p_brand"), F.lit(" Dealer")).alias("supplier_name"),
        F.col("p_brand").alias("supplier_contact"),
        F.lit(None).cast("string").alias("supplier_phone"),
        F.lit(None).cast("string").alias("supplier_address"),
        packed.alias("alt_suppliers"),
    )


def sales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sales list with three item columns per row.

    All sold lines are numbered; three consecutive numbers share a row, so a
    sale of any size takes as many rows as it needs and no group grows with it.
    """
    names = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
    lines = transaction_items(spark, sf_dir).join(names, "product_id").select(
        "transaction_id", "product_name", "quantity", "unit_price"
    )
    # numbering reads its rows several times
    numbered = number_rows(materialize(lines, "sold-lines"), lines.columns, "n", start=0)
    slot = F.col("n") % 3
    items = [
        F.max(F.when(slot == i, F.col(source))).alias(f"item{i + 1}_{short}")
        for i in range(3)
        for source, short in (("product_name", "name"), ("quantity", "qty"), ("unit_price", "price"))
    ]
    return (
        numbered.groupBy("transaction_id", F.expr("n div 3").alias("page"))
        .agg(*items, money(F.sum(line_cents())).alias("total_amount"))
        .drop("page")
    )


def sales_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide sales list with the customer's details repeated on every row."""
    people = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_nickname"),
        F.col("c_acctbal").cast(PRICE).alias("customer_balance"),
    )
    headers = left_join_named(transactions(spark, sf_dir), people, "customer_id")
    return (
        sales_wide(spark, sf_dir)
        .join(headers, "transaction_id")
        .select(
            F.col("transaction_date").alias("sale_date"),
            "customer_name",
            F.lit(None).cast("string").alias("customer_phone"),
            "customer_nickname",
            "customer_balance",
            "payment_type",
            *[f"item{i}_{part}" for i in (1, 2, 3) for part in ("name", "qty", "price")],
            "total_amount",
            F.lit(None).cast("string").alias("notes"),
        )
    )


def typed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of products, and of the customers on all orders, as hands type them.

    A few letters are lost, doubled or hit wrong.
    """
    goods = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    order, person = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer")
    people = order.join(person, order["o_custkey"] == person["c_custkey"]).select(
        F.col("o_orderkey").alias("key"), F.col("c_name").alias("name")
    )
    slip, place = F.col("key") % 12, (F.floor(F.col("key") / 12) % 7 + 1).cast("int")
    before, after = F.substring(F.col("name"), F.lit(1), place - 1), F.substring(F.col("name"), place + 1, F.length("name"))
    letter = F.substring(F.col("name"), place, F.lit(1))
    return goods.unionByName(people).select(
        F.when(slip == 1, F.concat(before, after))
        .when(slip == 2, F.concat(before, letter, letter, after))
        .when(slip == 3, F.concat(before, F.lit("x"), after))
        .when(slip == 4, F.concat(F.lit("  "), F.upper("name"), F.lit(" ")))
        .otherwise(F.col("name"))
        .alias("name")
    )


def given(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The supplied tables by name."""
    names = (
        "region nation customer supplier part orders lineitem events documents embeddings pages"
        " benchmark labels conversations"
    )
    return {name: read_table(spark, sf_dir, name) for name in names.split()}


def orders_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with the customer, the country and the region written out every time."""
    order = read_table(spark, sf_dir, "orders")
    person = read_table(spark, sf_dir, "customer")
    country = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (
        order.join(person, order["o_custkey"] == person["c_custkey"])
        .join(country, person["c_nationkey"] == country["n_nationkey"])
        .join(region, country["n_regionkey"] == region["r_regionkey"])
        .select(
            F.col("o_orderkey").alias("reference_no"),
            F.to_date("o_orderdate").alias("sale_date"),
            F.col("o_orderpriority").alias("priority"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "credit").otherwise("cash").alias("payment_type"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_nickname"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.lit("PHP").alias("currency"),
        )
    )


def shop(spark: SparkSession, sf_dir: str) -> Shop:
    makers = {
        "categories": categories,
        "units": units,
        "suppliers": suppliers,
        "products": products,
        "customers": customers,
        "restocks": restocks,
        "restock_items": restock_items,
        "transactions": transactions,
        "transaction_items": transaction_items,
        "credit_payments": credit_payments,
    }
    return Shop({name: partial(make, spark, sf_dir) for name, make in makers.items()})


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The supplied tables as the ten load files of the shop model.

    Numbers stand in for the group and unit names, lines get ids, and columns
    with defaults are left to the loader. Purchases of nothing are no payments.
    """
    groups = number_rows(categories(spark, sf_dir).select("name"), ["name"], "category_id")
    measures = number_rows(units(spark, sf_dir).select("code", "name"), ["code"], "unit_id")
    goods = (
        products(spark, sf_dir)
        .drop("stock_on_hand")
        .withColumnRenamed("category_id", "category")
        .withColumnRenamed("unit_id", "unit")
        .join(groups.withColumnRenamed("name", "category"), "category")
        .join(measures.selectExpr("unit_id", "code AS unit"), "unit")
        .drop("category", "unit")
    )
    received = restock_items(spark, sf_dir).drop("line_no")
    sold = transaction_items(spark, sf_dir).drop("line_no")
    return {
        "categories": groups,
        "units": measures,
        "suppliers": suppliers(spark, sf_dir),
        "products": goods,
        "customers": customers(spark, sf_dir),
        "restocks": restocks(spark, sf_dir),
        "restock_items": number_rows(received, received.columns, "restock_item_id"),
        "transactions": transactions(spark, sf_dir),
        "transaction_items": number_rows(sold, sold.columns, "transaction_item_id"),
        "credit_payments": credit_payments(spark, sf_dir).filter("amount > 0"),
    }

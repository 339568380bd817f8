"""Every registered query, by name. Each takes a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.money import PRICE, cents, money
from ledgerline.functions.text import barcode, document_no, one_line, tagged
from ledgerline.model import TABLES
from ledgerline.operators import allocate, changes, deletes, inclusion, names, profile, quality
from ledgerline.operators.keys import Resolved, extract_dimension, next_ids, resolve_keys
from ledgerline.operators.ordered import number_rows
from ledgerline.operators.reshape import expand_rows, split_evenly, split_packed, unpivot_groups
from ledgerline.plans import analytics, baskets, design, forecast, maintained, marts, normalize, reports
from ledgerline.session import file_names, scratch_path
from ledgerline.sources import csv, feeds, incremental, publish, tables
from ledgerline.streaming import fifo
from ledgerline.streaming import stock as streaming_stock

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Marts and reports ------------------------------------------------------


@query
def product_stock(spark, sf_dir):
    return marts.product_stock(tables.shop(spark, sf_dir))


@query
def customer_balances(spark, sf_dir):
    return marts.customer_balances(tables.shop(spark, sf_dir))


@query
def utang_ledger(spark, sf_dir):
    return marts.credit_ledger(tables.shop(spark, sf_dir))


@query
def ledger_for_customer(spark, sf_dir):
    return marts.credit_ledger(tables.shop(spark, sf_dir), customer_ids=[1])


@query
def recompute_stock(spark, sf_dir):
    return marts.recompute_stock(tables.shop(spark, sf_dir)).select("product_id", "stock_on_hand")


@query
def category_top5(spark, sf_dir):
    return reports.top_categories(tables.shop(spark, sf_dir))


@query
def category_revenue(spark, sf_dir):
    return reports.category_sales(tables.shop(spark, sf_dir)).orderBy(F.desc("sales"))


@query
def daily_category_revenue(spark, sf_dir):
    return reports.daily_category_revenue(tables.shop(spark, sf_dir))


@query
def daily_revenue(spark, sf_dir):
    return reports.daily_revenue(tables.shop(spark, sf_dir))


@query
def daily_revenue_last30(spark, sf_dir):
    return reports.last_days(reports.daily_revenue(tables.shop(spark, sf_dir)))


@query
def low_stock_top10(spark, sf_dir):
    return reports.low_stock(tables.shop(spark, sf_dir))


@query
def reorder_first20(spark, sf_dir):
    return reports.reorder_first(tables.shop(spark, sf_dir))


@query
def top_balances(spark, sf_dir):
    return reports.top_balances(tables.shop(spark, sf_dir))


@query
def total_outstanding(spark, sf_dir):
    return reports.total_outstanding(tables.shop(spark, sf_dir))


@query
def stock_drift(spark, sf_dir):
    return reports.stock_drift(tables.shop(spark, sf_dir))


@query
def negative_stock(spark, sf_dir):
    return reports.negative_stock(tables.shop(spark, sf_dir))


@query
def negative_balances(spark, sf_dir):
    return reports.negative_balances(tables.shop(spark, sf_dir))


@query
def integrity_report(spark, sf_dir):
    return reports.integrity_report(tables.shop(spark, sf_dir))


@query
def load_counts(spark, sf_dir):
    return reports.table_counts(dict(tables.shop(spark, sf_dir).tables()))


@query
def line_amounts(spark, sf_dir):
    return reports.line_amounts(tables.shop(spark, sf_dir))


@query
def credit_sales_only(spark, sf_dir):
    return tables.transactions(spark, sf_dir).filter(F.col("payment_type") == "credit")


@query
def walkin_vs_named(spark, sf_dir):
    return reports.walkin_vs_named(tables.shop(spark, sf_dir))


@query
def sales_with_customer(spark, sf_dir):
    return reports.sales_with_customer(tables.shop(spark, sf_dir))


@query
def balances_filter_agg(spark, sf_dir):
    return reports.balances_by_filter(tables.shop(spark, sf_dir))


@query
def chasm_guard(spark, sf_dir):
    return reports.chasm_guard(tables.shop(spark, sf_dir))


@query
def nullsafe_join(spark, sf_dir):
    return reports.nullsafe_summary(tables.shop(spark, sf_dir))


@query
def units_per_product(spark, sf_dir):
    return reports.units_per_product(tables.shop(spark, sf_dir))


@query
def txn_totals(spark, sf_dir):
    return reports.txn_totals(tables.shop(spark, sf_dir))


@query
def credit_first_date(spark, sf_dir):
    return reports.credit_first_date(tables.shop(spark, sf_dir))


@query
def active_products(spark, sf_dir):
    return tables.products(spark, sf_dir).filter("is_active").select(
        "product_id", "name", "current_price"
    )


@query
def basket_size_hist(spark, sf_dir):
    return reports.basket_sizes(tables.shop(spark, sf_dir))


@query
def hour_share(spark, sf_dir):
    return reports.hour_share(tables.read_table(spark, sf_dir, "events"), "ts")


# --- Ingestion --------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Credit payments written to CSV and read back through the declared schema."""
    path = scratch_path(spark, "csv")
    payments = tables.credit_payments(spark, sf_dir)
    csv.write_csv(payments.withColumn("payment_date", F.col("payment_date").cast("timestamp")), path)
    back = csv.read_csv(spark, path, TABLES["credit_payments"].schema)
    return back.withColumn("payment_date", F.col("payment_date").cast("timestamp_ntz"))


@query
def csv_text_roundtrip(spark, sf_dir):
    """Texts with blanks, quotes, commas and line breaks written to CSV and read back."""
    path = scratch_path(spark, "csv-text")
    texts = tables.read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    odd = F.concat(F.lit('  "quoted", \\ and\r\n'), F.col("source"), F.lit(' ""  '))
    csv.write_csv(texts.withColumn("source", odd), path, multi_line=True)
    back = csv.read_csv(spark, path, StructType.fromDDL("doc_id BIGINT, text STRING, source STRING"), multi_line=True)
    return back.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"), "source")


@query
def load_incremental(spark, sf_dir):
    """The load files arrive in two waves; each load takes what is new, and a third finds nothing."""
    files, root = scratch_path(spark, "arriving-csv"), scratch_path(spark, "grown-warehouse")
    for wave in feeds.load_waves(spark, sf_dir):
        for name, df in wave.items():
            csv.write_csv(df, f"{files}/{name}", mode="append")
        version = incremental.load_new(spark, files, root)
    assert incremental.load_new(spark, files, root) == version
    return reports.table_counts(dict(incremental.read_version(spark, root).tables()))


@query
def load_published(spark, sf_dir):
    """All tables to CSV, loaded, checked and published; rows per published table."""
    files = scratch_path(spark, "load-csv")
    csv.write_tables(tables.warehouse(spark, sf_dir).items(), files)
    shop = publish.load_csv(spark, files, scratch_path(spark, "warehouse"))
    return reports.table_counts(dict(shop.tables()))


@query
def defaults_applied(spark, sf_dir):
    """Products that arrive with three columns only."""
    part = tables.read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(PRICE).alias("current_price"),
    )
    return csv.with_defaults(part, TABLES["products"]).select(
        "product_id", "name", "current_price", "barcode", "reorder_level", "stock_on_hand", "is_active"
    )


@query
def append_with_next_ids(spark, sf_dir):
    """Suppliers taken in as customers, numbered after the last customer."""
    existing = tables.customers(spark, sf_dir)
    incoming = tables.suppliers(spark, sf_dir).select(F.col("name").alias("full_name"))
    return next_ids(existing, incoming, "customer_id", ["full_name"])


# --- Normalization ----------------------------------------------------------


@query
def surrogate_keys(spark, sf_dir):
    """All lines numbered by day and then by all their columns."""
    lines = tables.read_table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("delivery_date"),
        F.col("l_orderkey").alias("reference_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("unit_cost"),
    )
    return number_rows(lines, ["delivery_date", "reference_no"], "restock_item_id")


@query
def alt_suppliers_split(spark, sf_dir):
    return split_packed(
        tables.inventory_flat(spark, sf_dir), ["list_no"], "alt_suppliers", "alt_supplier_name"
    )


@query
def alt_supplier_lookup(spark, sf_dir):
    """Products of alternate suppliers whose name contains a text."""
    parts = split_packed(
        tables.inventory_flat(spark, sf_dir),
        ["list_no", "product_name"],
        "alt_suppliers",
        "alt_supplier_name",
    )
    return parts.filter(F.col("alt_supplier_name").contains("PROMO"))


@query
def unpivot_items(spark, sf_dir):
    wide = tables.sales_wide(spark, sf_dir)
    rows = unpivot_groups(wide, ["transaction_id"], normalize.item_groups(), "product_name")
    return rows.drop("slot")


@query
def extract_suppliers(spark, sf_dir):
    return extract_dimension(
        tables.deliveries_flat(spark, sf_dir), "supplier_id", ["supplier_name"], ["supplier_contact"]
    )


@query
def extract_customers(spark, sf_dir):
    """Customers with the balance noted at their newest sale, though notes disagree."""
    orders = tables.read_table(spark, sf_dir, "orders")
    people = tables.read_table(spark, sf_dir, "customer")
    flat = orders.join(people, orders["o_custkey"] == people["c_custkey"]).select(
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_nickname"),
        F.col("o_totalprice").cast(PRICE).alias("customer_balance"),
        F.col("o_orderdate").alias("sale_date"),
        F.col("o_orderkey").alias("sale_id"),
    )
    return extract_dimension(
        flat,
        "customer_id",
        ["customer_name"],
        ["customer_nickname", "customer_balance"],
        newest=["sale_date", "sale_id"],
    )


@query
def extract_categories(spark, sf_dir):
    return normalize.split_inventory(tables.inventory_flat(spark, sf_dir)).categories


@query
def extract_units(spark, sf_dir):
    return normalize.split_inventory(tables.inventory_flat(spark, sf_dir)).units


@query
def delivery_header(spark, sf_dir):
    return normalize.delivery_headers(tables.deliveries_flat(spark, sf_dir))


@query
def delivery_lines(spark, sf_dir):
    flat = tables.deliveries_flat(spark, sf_dir)
    headers = normalize.delivery_headers(flat)
    return flat.join(headers, normalize.DOCUMENT).select(
        "restock_id", "product_name", "qty_received", "unit_cost"
    )


def _resolved_deliveries(spark: SparkSession, sf_dir: str, policy: str) -> Resolved:
    """Delivered product names against a product list without the "hot" line."""
    known = tables.products(spark, sf_dir).filter(~F.col("name").startswith("hot "))
    flat = tables.deliveries_flat(spark, sf_dir).select(
        "reference_no", "product_name", "qty_received", "unit_cost"
    )
    return resolve_keys(
        flat, known.select("product_id", "name"), "product_name", "name", "product_id", policy
    )


@query
def fk_resolution(spark, sf_dir):
    return _resolved_deliveries(spark, sf_dir, "stub").rows


@query
def fk_unresolved(spark, sf_dir):
    return _resolved_deliveries(spark, sf_dir, "drop").unresolved


@query
def normalize_balances(spark, sf_dir):
    """Flat lists to the normalized shop, then the balances mart on top of it."""
    result = normalize.normalize(
        tables.inventory_flat(spark, sf_dir),
        tables.sales_flat(spark, sf_dir),
        tables.deliveries_flat(spark, sf_dir).select(
            "*",
            F.lit(None).cast("string").alias("notes"),
        ),
    )
    return marts.balance_cents(result.shop).select("full_name", money("owed").alias("balance"))


# --- Rules and data quality -------------------------------------------------


@query
def pk_violations(spark, sf_dir):
    return quality.pk_violations(tables.transaction_items(spark, sf_dir), ["transaction_id", "line_no"])


@query
def unique_violations(spark, sf_dir):
    return quality.unique_violations(tables.products(spark, sf_dir), ["name", "unit_id"])


@query
def duplicate_barcode(spark, sf_dir):
    return quality.unique_violations(tables.inventory_flat(spark, sf_dir), ["barcode"])


@query
def null_profile(spark, sf_dir):
    frame = tables.transactions(spark, sf_dir)
    return quality.null_profile(frame, frame.columns)


@query
def check_violations(spark, sf_dir):
    """Raw account balances taken as credit limits, and sales under the declared rules."""
    limits = tables.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("credit_limit")
    )
    customers = quality.check_violations(limits, ["customer_id"], TABLES["customers"].checks)
    payments = quality.check_violations(
        tables.credit_payments(spark, sf_dir), ["payment_id"], TABLES["credit_payments"].checks
    )
    sales = quality.check_violations(
        tables.transactions(spark, sf_dir), ["transaction_id"], TABLES["transactions"].checks
    )

    def named(df: DataFrame, table: str, key: str) -> DataFrame:
        return df.select(F.lit(table).alias("table_name"), F.col(key).alias("row_id"), "rule")

    return (
        named(customers, "customers", "customer_id")
        .unionByName(named(payments, "credit_payments", "payment_id"))
        .unionByName(named(sales, "transactions", "transaction_id"))
    )


@query
def credit_without_customer(spark, sf_dir):
    """Sales whose customer was lost for pending orders, some of them on credit."""
    sales = tables.transactions(spark, sf_dir)
    pending = tables.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), (F.col("o_orderstatus") == "P").alias("pending")
    )
    lost = sales.join(pending, "transaction_id").withColumn(
        "customer_id", F.when(~F.col("pending"), F.col("customer_id"))
    )
    rule = "credit_requires_customer"
    return quality.check_violations(
        lost, ["transaction_id"], {rule: TABLES["transactions"].checks[rule]}
    )


@query
def fk_orphans(spark, sf_dir):
    """Sales whose customer is not among the active customers."""
    active = tables.customers(spark, sf_dir).filter("is_active")
    return quality.fk_orphans(
        tables.transactions(spark, sf_dir), "customer_id", active, "customer_id"
    )


@query
def restrict_blockers(spark, sf_dir):
    """Inactive products that cannot be deleted because sales refer to them."""
    inactive = tables.products(spark, sf_dir).filter("NOT is_active")
    return quality.restrict_blockers(
        inactive, "product_id", tables.transaction_items(spark, sf_dir), "product_id"
    )


@query
def cascade_delete(spark, sf_dir):
    """Sale lines that remain after the walk-in sales are deleted."""
    walk_ins = tables.transactions(spark, sf_dir).filter("customer_id IS NULL")
    return quality.cascade_survivors(
        tables.transaction_items(spark, sf_dir), "transaction_id", walk_ins, "transaction_id"
    )


@query
def delete_with_cascade(spark, sf_dir):
    """Stored stock after all walk-in sales were deleted, which took their lines along."""
    shop = tables.shop(spark, sf_dir)
    walk_ins = shop.transactions.filter("customer_id IS NULL").select("transaction_id")
    return deletes.delete_rows(shop, "transactions", walk_ins).shop.products.select("product_id", "stock_on_hand")


@query
def fd_violations(spark, sf_dir):
    return quality.fd_violations(
        tables.deliveries_flat(spark, sf_dir), ["product_name"], ["product_category"]
    )


@query
def stored_total_mismatch(spark, sf_dir):
    """Orders whose stored total is not the sum of their lines."""
    stored = tables.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_totalprice").cast("decimal(38,2)").alias("total_amount"),
    )
    lines = tables.read_table(spark, sf_dir, "lineitem")
    derived = lines.groupBy(F.col("l_orderkey").alias("transaction_id")).agg(
        money(F.sum(cents(F.col("l_extendedprice").cast(PRICE)))).alias("recomputed")
    )
    return quality.stored_mismatch(stored, derived, "transaction_id", "total_amount", "recomputed")


@query
def stale_balance(spark, sf_dir):
    stored = tables.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_acctbal").cast("decimal(38,2)").alias("stored_balance"),
    )
    return analytics.stale_balances(tables.shop(spark, sf_dir), stored)


# --- Structure found in the data --------------------------------------------


@query
def profile_merged(spark, sf_dir):
    """Profiles of two loads of orders and lines, merged, and whether they agree with that of all rows."""
    frames = {name: tables.read_table(spark, sf_dir, name) for name in ("orders", "lineitem")}
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    root = scratch_path(spark, "profiles")
    for odd in (0, 1):
        profile.save({n: df.filter(F.col(keys[n]) % 2 == odd) for n, df in frames.items()}, root, f"part{odd}")
    whole = quality.union_all([profile.profile(df, name) for name, df in frames.items()])
    return profile.agreement(profile.merged(spark.read.parquet(root)), whole)


@query
def fd_discovery(spark, sf_dir):
    """Every minimal dependency of the delivery log, with up to three columns on the left."""
    return design.dependency_table(tables.deliveries_flat(spark, sf_dir))


@query
def normal_form_plan(spark, sf_dir):
    """The tables that the flat order list should be cut into, by the dependencies found in it."""
    return design.design_table(tables.orders_flat(spark, sf_dir))


@query
def inclusion_candidates(spark, sf_dir):
    """Which columns of the supplied tables may refer to which others."""
    return inclusion.inclusions(tables.given(spark, sf_dir))


@query
def name_clusters(spark, sf_dir):
    """Spellings of product and customer names that are one typing error apart."""
    return names.clusters(tables.typed_names(spark, sf_dir), "name")


# --- Incremental maintenance ------------------------------------------------


@query
def balances_maintained(spark, sf_dir):
    """Balances moved by four batches of changes to sales, lines and payments."""
    root = scratch_path(spark, "kept-balances")
    maintained.keep_balances(root, feeds.sale_batches(spark, sf_dir))
    return maintained.kept_balances(spark, root, tables.customers(spark, sf_dir).select("customer_id"))


@query
def category_revenue_maintained(spark, sf_dir):
    """Sales per product group moved by four batches of changes to products and lines."""
    root = scratch_path(spark, "kept-sales")
    maintained.keep_category_sales(root, feeds.product_batches(spark, sf_dir))
    return maintained.kept_category_sales(spark, root)


@query
def stock_cdc_batch(spark, sf_dir):
    return changes.net_stock(changes.stock_deltas(tables.stock_changes(spark, sf_dir)))


@query
def stock_paths_agree(spark, sf_dir):
    """Stock kept by applying changes next to stock recomputed over the changed lines."""
    shop = tables.shop(spark, sf_dir)
    feed = tables.stock_changes(spark, sf_dir)
    kept = changes.apply_stock(marts.recompute_stock(shop), changes.stock_deltas(feed))
    changed = shop.replace(
        restock_items=shop.restock_items.select("product_id", "quantity").unionByName(
            changes.signed_lines(feed, "restock")
        ),
        transaction_items=shop.transaction_items.select("product_id", "quantity").unionByName(
            changes.signed_lines(feed, "sale")
        ),
    )
    derived = marts.on_hand(changed).select("product_id", F.col("on_hand").alias("derived"))
    return (
        kept.select("product_id", F.col("stock_on_hand").alias("maintained"))
        .join(derived, "product_id")
        .withColumn("drift", F.col("maintained") - F.col("derived"))
    )


@query
def marts_by_sql(spark, sf_dir):
    """Stock per product group, asked of a registered view in SQL text."""
    marts.register_views(spark, tables.shop(spark, sf_dir), tables=False)
    return spark.sql(
        """SELECT category, COUNT(*) AS n_products, COUNT_IF(needs_reorder) AS n_reorder,
                  SUM(on_hand) AS units
           FROM product_stock GROUP BY category"""
    )


@query
def stock_stream(spark, sf_dir):
    """The change feed read as a stream until it is used up."""
    source = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(source).schema
    # a stream source lists a folder, whatever the table's file layout is
    files = spark.readStream.schema(schema)
    stream = tables.stock_changes_of(files.parquet(f"{sf_dir}/event[s].parquet"))
    root = scratch_path(spark, "stock-stream")
    run = streaming_stock.stock_stream(stream, f"{root}/deltas", f"{root}/checkpoint")
    run.awaitTermination()
    return streaming_stock.current_totals(spark, "product_id", f"{root}/deltas", "stock_delta")


@query
def upsert_latest(spark, sf_dir):
    """Customers updated from their orders; only real changes move the time stamp."""
    base = tables.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("nickname"),
        F.lit(datetime(1995, 1, 1)).alias("updated_at"),
    )
    notes = tables.read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "MACHINERY")
        .otherwise(F.col("o_orderstatus"))
        .alias("nickname"),
        F.col("o_orderdate").alias("changed_at"),
        F.col("o_orderkey").alias("change_id"),
    )
    fresh = changes.upsert(
        base, notes, "customer_id", ["changed_at", "change_id"], datetime(2002, 1, 1)
    )
    return fresh.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query
def snapshot_diff(spark, sf_dir):
    """Change log between the active price list and a revised one."""
    part = tables.products(spark, sf_dir).select(
        "product_id", "name", "current_price", "reorder_level", "is_active"
    )
    before = part.filter("is_active").drop("is_active")
    after = part.filter("reorder_level < 50").select(
        "product_id",
        "name",
        F.when(F.col("name").startswith("hot "), F.col("current_price") + 1)
        .otherwise(F.col("current_price"))
        .cast(PRICE)
        .alias("current_price"),
        F.greatest("reorder_level", F.lit(10)).alias("reorder_level"),
    )
    return changes.snapshot_diff(
        before, after, "product_id", ["name", "current_price", "reorder_level"]
    )


# --- Allocation, calendar, prices -------------------------------------------


@query
def calendar_features(spark, sf_dir):
    days = analytics.calendar_features(tables.read_table(spark, sf_dir, "orders"), "o_orderdate")
    return days.withColumn("share", F.round("share", 9))


@query
def deflated_prices(spark, sf_dir):
    return analytics.deflated_prices(tables.shop(spark, sf_dir))


@query
def price_cost_margin(spark, sf_dir):
    markups = {
        "ECONOMY": Decimal("1.15"), "STANDARD": Decimal("1.18"),
        "PROMO": Decimal("1.22"), "LARGE": Decimal("1.12"),
    }
    return analytics.price_cost_margin(tables.shop(spark, sf_dir), markups)


@query
def barcode_format(spark, sf_dir):
    key = F.col("p_partkey")
    return tables.read_table(spark, sf_dir, "part").select(
        key.alias("product_id"), barcode(key).alias("barcode"), document_no(key).alias("document_no")
    )


@query
def text_clean(spark, sf_dir):
    return tables.read_table(spark, sf_dir, "documents").select(
        "doc_id",
        one_line(F.col("text")).alias("line"),
        F.concat_ws(" ", "lang", "source").alias("label"),
        tagged("DOC#", "doc_id").alias("reference"),
    )


@query
def payment_lag(spark, sf_dir):
    return analytics.payment_lag(tables.shop(spark, sf_dir))


@query
def payment_cap(spark, sf_dir):
    return analytics.payment_cap(tables.shop(spark, sf_dir))


@query
def replenishment_need(spark, sf_dir):
    return analytics.replenishment_need(tables.shop(spark, sf_dir), cover=4, extra=10)


@query
def proportional_allocation(spark, sf_dir):
    """One billion delivery units split over all products by what they need."""
    need = analytics.replenishment_need(tables.shop(spark, sf_dir), cover=4, extra=10)
    weights = need.select("product_id", (F.col("needed") + 1).alias("weight"))
    return allocate.proportional_allocation(
        weights, "weight", "product_id", 1_000_000_000, min_each=1
    )


@query
def even_split(spark, sf_dir):
    """Each product's need split over as many lines as it had deliveries."""
    need = analytics.replenishment_need(tables.shop(spark, sf_dir), cover=4, extra=10)
    lines = tables.restock_items(spark, sf_dir).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    planned = need.join(lines, "product_id").select("product_id", "needed", "n_lines")
    return split_evenly(planned, "needed", "n_lines", "quantity")


@query
def expand_by_count(spark, sf_dir):
    """Each sale repeated once per line it has."""
    counts = tables.transaction_items(spark, sf_dir).groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n_items")
    )
    return expand_rows(counts, "n_items", "position")


# --- Planning and follow-up -------------------------------------------------


@query
def demand_weekly(spark, sf_dir):
    return analytics.weekly_demand(tables.shop(spark, sf_dir))


@query
def reorder_suggestion(spark, sf_dir):
    return analytics.reorder_suggestion(tables.shop(spark, sf_dir), weeks_of_cover=2)


@query
def credit_features(spark, sf_dir):
    return analytics.credit_features(tables.shop(spark, sf_dir))


@query
def basket_pairs(spark, sf_dir):
    """Product names sold together in at least 0.1 percent of the sales."""
    return analytics.frequent_pairs(tables.shop(spark, sf_dir), "name", 0.001)


@query
def basket_rules(spark, sf_dir):
    """Which product groups are bought along with up to three others, in at least half a percent of the sales."""
    return baskets.basket_rules(tables.shop(spark, sf_dir), "category_id", 0.005)


@query
def demand_forecast(spark, sf_dir):
    return forecast.demand_forecast(tables.shop(spark, sf_dir))


@query
def rfm_segments(spark, sf_dir):
    return analytics.rfm_segments(tables.shop(spark, sf_dir))


@query
def price_history(spark, sf_dir):
    return analytics.price_history(analytics.daily_prices(tables.shop(spark, sf_dir)))


@query
def price_as_of(spark, sf_dir):
    """The selling price in force on every delivery day of a product."""
    history = analytics.price_history(analytics.daily_prices(tables.shop(spark, sf_dir)))
    deliveries = tables.read_table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'")
    lookups = deliveries.select(
        F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("day")
    )
    return analytics.price_as_of(history, lookups)


@query
def fifo_allocation(spark, sf_dir):
    return analytics.payment_allocation(tables.shop(spark, sf_dir))


@query
def invoice_aging(spark, sf_dir):
    return analytics.invoice_aging(tables.shop(spark, sf_dir))


@query
def fifo_stream(spark, sf_dir):
    """Charges and payments read as a stream that brings them in no particular order."""
    root = scratch_path(spark, "fifo-stream")
    entries = analytics.credit_entries(tables.shop(spark, sf_dir))
    # the order of the hashes has nothing to do with the dates, so later files hold late entries
    entries.repartition(F.xxhash64("side", "entry_id")).write.parquet(f"{root}/entries")
    files = [f for f in file_names(spark, f"{root}/entries") if f.endswith(".parquet")]
    stream = spark.readStream.schema(fifo.ENTRY).option("maxFilesPerTrigger", max(1, len(files) // 4))
    run = fifo.fifo_stream(stream.parquet(f"{root}/entries"), f"{root}/moves", f"{root}/checkpoint")
    run.awaitTermination()
    return fifo.current_allocations(spark, f"{root}/moves").select(
        "customer_id", "transaction_id", "payment_id", money("cents").alias("allocated")
    )

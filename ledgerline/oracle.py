"""The same queries as plain SQL over the supplied tables, for checking.

The shop views are written once as common table expressions; each query gets
the ones it names.
"""

from __future__ import annotations

import re
from itertools import combinations

VIEWS: dict[str, str] = {
    "shop_product": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS unit,
               CASE WHEN p_brand <> 'Brand#13' THEN printf('48%011d', p_partkey) END AS barcode,
               CAST(p_retailprice AS DECIMAL(10,2)) AS current_price, p_size AS reorder_level,
               CAST(p_size - 5 AS BIGINT) AS stock_on_hand, p_size > 1 AS is_active
        FROM part""",
    "shop_customer": """
        SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS nickname,
               CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(10,2))
                    ELSE CAST(0 AS DECIMAL(10,2)) END AS credit_limit,
               c_acctbal >= 0 AS is_active
        FROM customer""",
    "shop_txn": """
        SELECT o_orderkey AS transaction_id,
               CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN o_custkey
                    WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer_id,
               o_orderdate AS transaction_date,
               CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'credit'
                    ELSE 'cash' END AS payment_type
        FROM orders""",
    "shop_txn_item": """
        SELECT l_orderkey AS transaction_id, l_linenumber AS line_no, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price
        FROM lineitem WHERE l_linestatus = 'O'""",
    "shop_restock_item": """
        SELECT l_orderkey AS restock_id, l_linenumber AS line_no, l_suppkey AS supplier_id,
               l_shipdate AS restock_date, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_cost
        FROM lineitem WHERE l_linestatus = 'F'""",
    "shop_payment": """
        SELECT event_id AS payment_id, user_id AS customer_id,
               CAST(value AS DECIMAL(10,2)) AS amount, ts - INTERVAL '26' YEAR AS payment_date
        FROM events WHERE event_type = 'purchase'""",
    "shop_stock_change": """
        SELECT CASE WHEN event_type IN ('signup','click')
                      OR (event_type = 'view' AND event_id % 2 = 0)
                    THEN 1 ELSE -1 END AS sign,
               CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'INSERT'
                    WHEN 'click' THEN 'DELETE' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
               user_id AS product_id, CAST(FLOOR(value) AS BIGINT) + 1 AS quantity,
               user_id + 1 AS new_product_id, event_id % 7 + 1 AS new_quantity
        FROM events""",
    "delivery_flat": """
        SELECT l.l_shipdate AS delivery_date, l.l_orderkey AS reference_no,
               s.s_name AS supplier_name, s.s_nationkey AS supplier_contact,
               p.p_name AS product_name, p.p_type AS product_category,
               CAST(l.l_quantity AS INT) AS qty_received,
               CAST(l.l_extendedprice AS DECIMAL(10,2)) AS unit_cost
        FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
        JOIN part p ON p.p_partkey = l.l_partkey
        WHERE l.l_linestatus = 'F'""",
    "stock": """
        SELECT p.product_id, p.name, p.category, p.unit, p.reorder_level, p.stock_on_hand,
               CAST(COALESCE(r.q, 0) AS BIGINT) AS total_restocked,
               CAST(COALESCE(s.q, 0) AS BIGINT) AS total_sold,
               CAST(COALESCE(r.q, 0) - COALESCE(s.q, 0) AS BIGINT) AS on_hand
        FROM shop_product p
        LEFT JOIN (SELECT product_id, SUM(quantity) AS q FROM shop_restock_item GROUP BY 1) r
               ON r.product_id = p.product_id
        LEFT JOIN (SELECT product_id, SUM(quantity) AS q FROM shop_txn_item GROUP BY 1) s
               ON s.product_id = p.product_id""",
    "sale_total": """
        SELECT transaction_id, SUM(quantity * unit_price) AS total
        FROM shop_txn_item GROUP BY 1""",
    "charge": """
        SELECT t.customer_id, t.transaction_id, t.transaction_date, s.total
        FROM shop_txn t JOIN sale_total s ON s.transaction_id = t.transaction_id
        WHERE t.payment_type = 'credit' AND t.customer_id IS NOT NULL""",
    "balance": """
        SELECT c.customer_id, c.full_name, c.nickname, c.credit_limit,
               COALESCE(ch.v, 0) AS charged, COALESCE(pm.v, 0) AS paid,
               COALESCE(ch.v, 0) - COALESCE(pm.v, 0) AS owed
        FROM shop_customer c
        LEFT JOIN (SELECT customer_id, SUM(total) AS v FROM charge GROUP BY 1) ch
               ON ch.customer_id = c.customer_id
        LEFT JOIN (SELECT customer_id, SUM(amount) AS v FROM shop_payment GROUP BY 1) pm
               ON pm.customer_id = c.customer_id""",
    "entry": """
        SELECT customer_id, transaction_date AS entry_date, 'charge' AS entry_type,
               'TXN#' || transaction_id AS reference, total AS debit, 0 AS credit
        FROM charge
        UNION ALL
        SELECT customer_id, payment_date, 'payment', 'PAY#' || payment_id, 0, amount
        FROM shop_payment""",
    "ledger": """
        SELECT customer_id, entry_date, entry_type, reference,
               CAST(debit AS DECIMAL(38,2)) AS debit, CAST(credit AS DECIMAL(38,2)) AS credit,
               CAST(SUM(debit - credit) OVER (
                   PARTITION BY customer_id ORDER BY entry_date, reference
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2))
                   AS running_balance
        FROM entry""",
    "category_sale": """
        SELECT p.category, CAST(SUM(i.quantity) AS BIGINT) AS units,
               CAST(SUM(i.quantity * i.unit_price) AS DECIMAL(38,2)) AS sales
        FROM shop_txn_item i JOIN shop_product p ON p.product_id = i.product_id
        GROUP BY 1""",
    "day_revenue": """
        SELECT CAST(t.transaction_date AS DATE) AS day,
               CAST(SUM(i.quantity * i.unit_price) AS DECIMAL(38,2)) AS revenue
        FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id
        GROUP BY 1""",
    "need": """
        SELECT p.product_id, CAST(COALESCE(s.q, 0) AS BIGINT) AS sold,
               CAST(COALESCE(s.q, 0) + p.reorder_level * 4 + 10 AS BIGINT) AS needed
        FROM shop_product p
        LEFT JOIN (SELECT product_id, SUM(quantity) AS q FROM shop_txn_item GROUP BY 1) s
               ON s.product_id = p.product_id""",
    "packed": """
        SELECT p_partkey AS list_no, p_name AS product_name,
               ' ' || p_type || ' Wholesale ; ' || p_brand || ' Trading;;' || p_type
                   || ' Wholesale; ' AS alt_suppliers
        FROM part""",
    "alternate": """
        SELECT DISTINCT list_no, product_name, trim(part) AS alt_supplier_name
        FROM (SELECT list_no, product_name, unnest(string_split(alt_suppliers, ';')) AS part
              FROM packed) z
        WHERE trim(part) <> ''""",
    "document": """
        SELECT CAST(row_number() OVER (ORDER BY delivery_date, reference_no, supplier_name)
                    AS BIGINT) AS restock_id,
               delivery_date, reference_no, supplier_name
        FROM (SELECT DISTINCT delivery_date, reference_no, supplier_name FROM delivery_flat) d""",
    "known": """
        SELECT name AS product_name, MIN(product_id) AS product_id
        FROM shop_product WHERE NOT starts_with(name, 'hot ') GROUP BY 1""",
    "missing": """
        SELECT product_name, COUNT(*) AS n_rows FROM delivery_flat
        WHERE product_name NOT IN (SELECT product_name FROM known) GROUP BY 1""",
    "day_price": """
        SELECT i.product_id, CAST(t.transaction_date AS DATE) AS day, MAX(i.unit_price) AS price
        FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id
        GROUP BY 1, 2""",
    "history": """
        SELECT product_id, price, day AS valid_from,
               LEAD(day) OVER (PARTITION BY product_id ORDER BY day) AS valid_to
        FROM (SELECT *, LAG(price) OVER (PARTITION BY product_id ORDER BY day) AS before
              FROM day_price) z
        WHERE before IS DISTINCT FROM price""",
    "due": """
        SELECT customer_id, transaction_id, transaction_date, total,
               SUM(total) OVER w - total AS lo, SUM(total) OVER w AS hi
        FROM charge
        WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date, transaction_id
                     ROWS UNBOUNDED PRECEDING)""",
    "settling": """
        SELECT customer_id, payment_id, SUM(amount) OVER w - amount AS lo, SUM(amount) OVER w AS hi
        FROM shop_payment
        WINDOW w AS (PARTITION BY customer_id ORDER BY payment_date, payment_id
                     ROWS UNBOUNDED PRECEDING)""",
    "settled": """
        SELECT d.customer_id, d.transaction_id, s.payment_id,
               LEAST(d.hi, s.hi) - GREATEST(d.lo, s.lo) AS allocated
        FROM due d JOIN settling s ON s.customer_id = d.customer_id AND s.lo < d.hi AND d.lo < s.hi""",
    "bought": """
        SELECT DISTINCT i.transaction_id, p.name
        FROM shop_txn_item i JOIN shop_product p ON p.product_id = i.product_id""",
    "day_weight": """
        SELECT day, isodow(day) - 1 AS day_of_week, isodow(day) - 1 >= 4 AS is_weekend,
               month(day) = 12 AS is_december, day(day) IN (15, 16, 30, 31, 1) AS is_payday,
               (1.0::DOUBLE + 0.07::DOUBLE * (year(day) - MIN(year(day)) OVER ()))
               * CASE WHEN isodow(day) - 1 >= 4 THEN 1.35::DOUBLE ELSE 1.0 END
               * CASE WHEN month(day) = 12 THEN 1.4::DOUBLE ELSE 1.0 END
               * CASE WHEN day(day) IN (15, 16, 30, 31, 1) THEN 1.3::DOUBLE ELSE 1.0 END AS weight
        FROM (SELECT CAST(unnest(generate_series(MIN(CAST(o_orderdate AS DATE)),
                     MAX(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
              FROM orders) d""",
    "week_demand": """
        SELECT i.product_id, CAST(date_trunc('week', t.transaction_date) AS DATE) AS week,
               SUM(i.quantity) AS units
        FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id
        GROUP BY 1, 2""",
    "share_of_units": """
        SELECT product_id, needed + 1 AS weight, w,
               CAST((needed + 1) AS HUGEINT) * r // w AS base,
               CAST((needed + 1) AS HUGEINT) * r % w AS remainder, r
        FROM need,
             (SELECT CAST(SUM(needed + 1) AS HUGEINT) AS w,
                     CAST(1000000000 - COUNT(*) AS HUGEINT) AS r FROM need) t""",
}

ORACLE: dict[str, str] = {
    "product_stock": """
        SELECT product_id, name AS product, category, unit, reorder_level, total_restocked,
               total_sold, on_hand, stock_on_hand AS maintained_on_hand,
               on_hand <= reorder_level AS needs_reorder
        FROM stock""",
    "customer_balances": """
        SELECT customer_id, full_name, nickname, credit_limit,
               CAST(charged AS DECIMAL(38,2)) AS total_utang,
               CAST(paid AS DECIMAL(38,2)) AS total_paid, CAST(owed AS DECIMAL(38,2)) AS balance,
               CAST(credit_limit - owed AS DECIMAL(38,2)) AS credit_available
        FROM balance""",
    "utang_ledger": "SELECT * FROM ledger",
    "ledger_for_customer": "SELECT * FROM ledger WHERE customer_id = 1",
    "recompute_stock": "SELECT product_id, on_hand AS stock_on_hand FROM stock",
    "category_top5": "SELECT * FROM category_sale ORDER BY units DESC, category LIMIT 5",
    "category_revenue": "SELECT * FROM category_sale",
    "daily_category_revenue": """
        SELECT CAST(t.transaction_date AS DATE) AS day, p.category,
               CAST(SUM(i.quantity * i.unit_price) AS DECIMAL(38,2)) AS revenue
        FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id
        JOIN shop_product p ON p.product_id = i.product_id
        GROUP BY 1, 2""",
    "daily_revenue": "SELECT * FROM day_revenue",
    "daily_revenue_last30": "SELECT * FROM day_revenue ORDER BY day DESC LIMIT 30",
    "low_stock_top10": """
        SELECT product_id, name AS product, on_hand, reorder_level FROM stock
        WHERE on_hand <= reorder_level ORDER BY on_hand, product_id LIMIT 10""",
    "reorder_first20": """
        SELECT product_id, name AS product, category, unit, reorder_level, total_restocked,
               total_sold, on_hand, stock_on_hand AS maintained_on_hand,
               on_hand <= reorder_level AS needs_reorder
        FROM stock ORDER BY needs_reorder DESC, product_id LIMIT 20""",
    "top_balances": """
        SELECT customer_id, full_name, CAST(owed AS DECIMAL(38,2)) AS balance
        FROM balance ORDER BY owed DESC, customer_id LIMIT 20""",
    "total_outstanding": """
        SELECT CAST(round(SUM(owed), 2) AS DECIMAL(38,2)) AS total_outstanding FROM balance""",
    "stock_drift": """
        SELECT product_id, on_hand, stock_on_hand AS maintained_on_hand,
               stock_on_hand - on_hand AS drift
        FROM stock WHERE on_hand <> stock_on_hand""",
    "negative_stock": "SELECT product_id, on_hand FROM stock WHERE on_hand < 0",
    "negative_balances": """
        SELECT customer_id, CAST(owed AS DECIMAL(38,2)) AS balance FROM balance WHERE owed < 0""",
    "integrity_report": """
        SELECT metric, CAST(value AS DECIMAL(38,2)) AS value FROM (
            SELECT 'rows:categories' AS metric, COUNT(DISTINCT p_type)::DECIMAL(38,2) AS value FROM part
            UNION ALL SELECT 'rows:units', COUNT(DISTINCT p_brand) FROM part
            UNION ALL SELECT 'rows:suppliers', COUNT(*) FROM supplier
            UNION ALL SELECT 'rows:products', COUNT(*) FROM part
            UNION ALL SELECT 'rows:customers', COUNT(*) FROM customer
            UNION ALL SELECT 'rows:restocks', COUNT(DISTINCT restock_id) FROM shop_restock_item
            UNION ALL SELECT 'rows:restock_items', COUNT(*) FROM shop_restock_item
            UNION ALL SELECT 'rows:transactions', COUNT(*) FROM shop_txn
            UNION ALL SELECT 'rows:transaction_items', COUNT(*) FROM shop_txn_item
            UNION ALL SELECT 'rows:credit_payments', COUNT(*) FROM shop_payment
            UNION ALL SELECT 'stock_drift', COUNT(*) FROM stock WHERE on_hand <> stock_on_hand
            UNION ALL SELECT 'negative_stock', COUNT(*) FROM stock WHERE stock_on_hand < 0
            UNION ALL SELECT 'negative_balances', COUNT(*) FROM balance WHERE owed < 0
            UNION ALL SELECT 'total_outstanding', SUM(owed) FROM balance
            UNION ALL SELECT 'units:' || category, units FROM category_sale) m""",
    "load_counts": """
        SELECT table_name, CAST(n AS BIGINT) AS n_rows FROM (
            WITH c AS (
                SELECT 'categories' AS table_name, COUNT(DISTINCT p_type) AS n FROM part
                UNION ALL SELECT 'units', COUNT(DISTINCT p_brand) FROM part
                UNION ALL SELECT 'suppliers', COUNT(*) FROM supplier
                UNION ALL SELECT 'products', COUNT(*) FROM part
                UNION ALL SELECT 'customers', COUNT(*) FROM customer
                UNION ALL SELECT 'restocks', COUNT(DISTINCT restock_id) FROM shop_restock_item
                UNION ALL SELECT 'restock_items', COUNT(*) FROM shop_restock_item
                UNION ALL SELECT 'transactions', COUNT(*) FROM shop_txn
                UNION ALL SELECT 'transaction_items', COUNT(*) FROM shop_txn_item
                UNION ALL SELECT 'credit_payments', COUNT(*) FROM shop_payment)
            SELECT * FROM c UNION ALL SELECT 'TOTAL', SUM(n) FROM c) z""",
    "line_amounts": """
        SELECT transaction_id, line_no, product_id, quantity, unit_price,
               CAST(quantity * unit_price AS DECIMAL(38,2)) AS amount
        FROM shop_txn_item""",
    "credit_sales_only": "SELECT * FROM shop_txn WHERE payment_type = 'credit'",
    "walkin_vs_named": """
        SELECT CASE WHEN t.customer_id IS NULL THEN 'walk-in' ELSE 'named' END AS buyer,
               COUNT(*) AS n_sales, CAST(COALESCE(SUM(s.total), 0) AS DECIMAL(38,2)) AS revenue
        FROM shop_txn t LEFT JOIN sale_total s ON s.transaction_id = t.transaction_id
        GROUP BY 1""",
    "sales_with_customer": """
        SELECT t.*, c.full_name, c.nickname
        FROM shop_txn t LEFT JOIN shop_customer c ON c.customer_id = t.customer_id""",
    "balances_filter_agg": """
        SELECT c.customer_id, c.full_name,
               CAST(COALESCE(SUM(s.total) FILTER (WHERE t.payment_type = 'credit'), 0)
                    AS DECIMAL(38,2)) AS total_utang,
               CAST(COALESCE(SUM(s.total) FILTER (WHERE t.payment_type = 'cash'), 0)
                    AS DECIMAL(38,2)) AS total_cash,
               CAST(COALESCE(MAX(p.v), 0) AS DECIMAL(38,2)) AS total_paid,
               CAST(COALESCE(SUM(s.total) FILTER (WHERE t.payment_type = 'credit'), 0)
                    - COALESCE(MAX(p.v), 0) AS DECIMAL(38,2)) AS balance
        FROM shop_customer c
        LEFT JOIN shop_txn t ON t.customer_id = c.customer_id
        LEFT JOIN sale_total s ON s.transaction_id = t.transaction_id
        LEFT JOIN (SELECT customer_id, SUM(amount) AS v FROM shop_payment GROUP BY 1) p
               ON p.customer_id = c.customer_id
        GROUP BY 1, 2""",
    "chasm_guard": """
        SELECT s.product_id, s.total_restocked, s.total_sold,
               CAST(COALESCE(j.r, 0) AS BIGINT) AS joined_restocked,
               CAST(COALESCE(j.t, 0) AS BIGINT) AS joined_sold
        FROM stock s JOIN (
            SELECT p.product_id, SUM(r.quantity) AS r, SUM(i.quantity) AS t
            FROM shop_product p
            LEFT JOIN shop_restock_item r ON r.product_id = p.product_id
            LEFT JOIN shop_txn_item i ON i.product_id = p.product_id
            GROUP BY 1) j ON j.product_id = s.product_id""",
    "nullsafe_join": """
        SELECT a.customer_id, a.payment_type, a.n_sales, CAST(b.r AS DECIMAL(38,2)) AS revenue
        FROM (SELECT customer_id, payment_type, COUNT(*) AS n_sales FROM shop_txn GROUP BY 1, 2) a
        JOIN (SELECT t.customer_id, t.payment_type, SUM(s.total) AS r
              FROM shop_txn t JOIN sale_total s ON s.transaction_id = t.transaction_id
              GROUP BY 1, 2) b
          ON a.customer_id IS NOT DISTINCT FROM b.customer_id AND a.payment_type = b.payment_type""",
    "units_per_product": "SELECT product_id, total_sold AS units FROM stock",
    "txn_totals": """
        SELECT t.transaction_id, t.customer_id, t.payment_type,
               CAST(COALESCE(s.total, 0) AS DECIMAL(38,2)) AS total
        FROM shop_txn t LEFT JOIN sale_total s ON s.transaction_id = t.transaction_id""",
    "credit_first_date": """
        SELECT t.customer_id, CAST(SUM(COALESCE(s.total, 0)) AS DECIMAL(38,2)) AS charged,
               MIN(t.transaction_date) AS first_credit
        FROM shop_txn t LEFT JOIN sale_total s ON s.transaction_id = t.transaction_id
        WHERE t.payment_type = 'credit' AND t.customer_id IS NOT NULL GROUP BY 1""",
    "active_products": "SELECT product_id, name, current_price FROM shop_product WHERE is_active",
    "basket_size_hist": """
        SELECT n_items, COUNT(*) AS n_sales
        FROM (SELECT transaction_id, COUNT(*) AS n_items FROM shop_txn_item GROUP BY 1) b
        GROUP BY 1""",
    "hour_share": """
        SELECT CAST(hour(ts) AS INT) AS hour, COUNT(*) AS n,
               round(COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS share
        FROM events GROUP BY 1""",
    "csv_roundtrip": "SELECT payment_id, customer_id, amount, payment_date FROM shop_payment",
    "csv_text_roundtrip": """
        SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5,
               '  "quoted", \\ and' || chr(13) || chr(10) || source || ' ""  ' AS source
        FROM documents""",
    "defaults_applied": """
        SELECT product_id, name, current_price, CAST(NULL AS VARCHAR) AS barcode,
               CAST(0 AS INT) AS reorder_level, CAST(0 AS BIGINT) AS stock_on_hand,
               TRUE AS is_active
        FROM shop_product""",
    "append_with_next_ids": """
        SELECT CAST((SELECT MAX(c_custkey) FROM customer)
                    + row_number() OVER (ORDER BY s_name) AS BIGINT) AS customer_id,
               s_name AS full_name
        FROM supplier""",
    "surrogate_keys": """
        SELECT CAST(row_number() OVER (ORDER BY delivery_date, reference_no, product_id, supplier_id,
                    quantity, unit_cost) AS BIGINT) AS restock_item_id, *
        FROM (SELECT l_shipdate AS delivery_date, l_orderkey AS reference_no, l_partkey AS product_id,
                     l_suppkey AS supplier_id, CAST(l_quantity AS INT) AS quantity,
                     CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_cost
              FROM lineitem) l""",
    "alt_suppliers_split": "SELECT list_no, alt_supplier_name FROM alternate",
    "alt_supplier_lookup": "SELECT * FROM alternate WHERE alt_supplier_name LIKE '%PROMO%'",
    "unpivot_items": """
        SELECT i.transaction_id, p.name AS product_name, i.quantity, i.unit_price
        FROM shop_txn_item i JOIN shop_product p ON p.product_id = i.product_id""",
    "extract_suppliers": """
        SELECT CAST(row_number() OVER (ORDER BY supplier_name) AS BIGINT) AS supplier_id,
               supplier_name, supplier_contact
        FROM (SELECT DISTINCT supplier_name, supplier_contact FROM delivery_flat) d""",
    "extract_customers": """
        SELECT CAST(row_number() OVER (ORDER BY customer_name) AS BIGINT) AS customer_id,
               customer_name, customer_nickname, customer_balance
        FROM (SELECT c_name AS customer_name, c_mktsegment AS customer_nickname,
                     CAST(o_totalprice AS DECIMAL(10,2)) AS customer_balance,
                     row_number() OVER (PARTITION BY c_name
                                        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
              FROM orders JOIN customer ON c_custkey = o_custkey) z
        WHERE rn = 1""",
    "extract_categories": """
        SELECT CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS category_id,
               p_type AS name, 'All goods of type ' || p_type AS description
        FROM (SELECT DISTINCT p_type FROM part) z""",
    "extract_units": """
        SELECT CAST(row_number() OVER (ORDER BY p_brand) AS BIGINT) AS unit_id,
               p_brand AS code, 'Unit ' || p_brand AS name
        FROM (SELECT DISTINCT p_brand FROM part) z""",
    "delivery_header": "SELECT * FROM document",
    "delivery_lines": """
        SELECT d.restock_id, f.product_name, f.qty_received, f.unit_cost
        FROM delivery_flat f
        JOIN document d USING (delivery_date, reference_no, supplier_name)""",
    "fk_resolution": """
        SELECT k.product_id, f.reference_no, f.qty_received, f.unit_cost
        FROM delivery_flat f JOIN (
            SELECT * FROM known
            UNION ALL
            SELECT product_name,
                   (SELECT MAX(product_id) FROM shop_product WHERE NOT starts_with(name, 'hot '))
                   + row_number() OVER (ORDER BY product_name)
            FROM missing) k ON k.product_name = f.product_name""",
    "fk_unresolved": "SELECT * FROM missing",
    "normalize_balances": """
        SELECT c.c_name AS full_name,
               CAST(SUM(CASE WHEN t.payment_type = 'credit' THEN i.quantity * i.unit_price
                             ELSE 0 END) AS DECIMAL(38,2)) AS balance
        FROM shop_txn t JOIN shop_txn_item i ON i.transaction_id = t.transaction_id
        JOIN customer c ON c.c_custkey = t.customer_id
        GROUP BY 1""",
    "pk_violations": """
        SELECT transaction_id, line_no, COUNT(*) AS n_rows FROM shop_txn_item
        GROUP BY 1, 2 HAVING COUNT(*) > 1 OR transaction_id IS NULL OR line_no IS NULL""",
    "unique_violations": """
        SELECT name, unit AS unit_id, COUNT(*) AS n_rows FROM shop_product
        GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "duplicate_barcode": """
        SELECT p_name || '/' || p_brand AS barcode, COUNT(*) AS n_rows FROM part
        GROUP BY 1 HAVING COUNT(*) > 1""",
    "null_profile": """
        SELECT column_name, n_null FROM (
            SELECT 'transaction_id' AS column_name,
                   COUNT(*) FILTER (WHERE transaction_id IS NULL) AS n_null FROM shop_txn
            UNION ALL SELECT 'customer_id', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM shop_txn
            UNION ALL SELECT 'transaction_date',
                   COUNT(*) FILTER (WHERE transaction_date IS NULL) FROM shop_txn
            UNION ALL SELECT 'payment_type',
                   COUNT(*) FILTER (WHERE payment_type IS NULL) FROM shop_txn) z""",
    "check_violations": """
        SELECT 'customers' AS table_name, c_custkey AS row_id, 'credit_limit_not_negative' AS rule
        FROM customer WHERE c_acctbal < 0
        UNION ALL
        SELECT 'credit_payments', payment_id, 'amount_positive' FROM shop_payment WHERE amount <= 0
        UNION ALL
        SELECT 'transactions', transaction_id, 'credit_requires_customer' FROM shop_txn
        WHERE payment_type = 'credit' AND customer_id IS NULL""",
    "credit_without_customer": """
        SELECT o_orderkey AS transaction_id, 'credit_requires_customer' AS rule FROM orders
        WHERE o_orderpriority IN ('1-URGENT','2-HIGH') AND o_orderstatus = 'P'""",
    "fk_orphans": """
        SELECT customer_id AS key_value, COUNT(*) AS n_rows FROM shop_txn
        WHERE customer_id IS NOT NULL
          AND customer_id NOT IN (SELECT customer_id FROM shop_customer WHERE is_active)
        GROUP BY 1""",
    "restrict_blockers": """
        SELECT product_id AS key_value, COUNT(*) AS n_rows FROM shop_txn_item
        WHERE product_id IN (SELECT product_id FROM shop_product WHERE NOT is_active)
        GROUP BY 1""",
    "cascade_delete": """
        SELECT i.* FROM shop_txn_item i
        WHERE NOT EXISTS (SELECT 1 FROM shop_txn t WHERE t.customer_id IS NULL
                          AND t.transaction_id = i.transaction_id)""",
    "delete_with_cascade": """
        SELECT p.product_id, CAST(p.stock_on_hand + COALESCE(d.q, 0) AS BIGINT) AS stock_on_hand
        FROM shop_product p LEFT JOIN (
            SELECT i.product_id, SUM(i.quantity) AS q
            FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id
            WHERE t.customer_id IS NULL GROUP BY 1) d ON d.product_id = p.product_id""",
    "fd_violations": """
        SELECT product_name, COUNT(DISTINCT product_category) AS n_values FROM delivery_flat
        GROUP BY 1 HAVING COUNT(DISTINCT product_category) > 1""",
    "stored_total_mismatch": """
        SELECT o_orderkey AS transaction_id, CAST(o_totalprice AS DECIMAL(38,2)) AS total_amount,
               CAST(v AS DECIMAL(38,2)) AS recomputed
        FROM orders LEFT JOIN (
            SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(10,2))) AS v
            FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
        WHERE CAST(o_totalprice AS DECIMAL(38,2)) IS DISTINCT FROM CAST(v AS DECIMAL(38,2))""",
    "stale_balance": """
        SELECT customer_id, CAST(c_acctbal AS DECIMAL(38,2)) AS stored_balance,
               CAST(owed AS DECIMAL(38,2)) AS balance
        FROM balance JOIN customer ON c_custkey = customer_id
        WHERE CAST(c_acctbal AS DECIMAL(38,2)) <> CAST(owed AS DECIMAL(38,2))""",
    "stock_cdc_batch": """
        SELECT product_id, CAST(SUM(delta) AS BIGINT) AS stock_delta FROM (
            SELECT product_id, sign * CASE WHEN op = 'INSERT' THEN quantity ELSE -quantity END AS delta
            FROM shop_stock_change
            UNION ALL
            SELECT new_product_id, sign * new_quantity FROM shop_stock_change
            WHERE op = 'UPDATE') d
        GROUP BY 1""",
    "stock_paths_agree": """
        SELECT s.product_id, CAST(on_hand + COALESCE(d.delta, 0) AS BIGINT) AS maintained,
               CAST(on_hand + COALESCE(d.delta, 0) AS BIGINT) AS derived, CAST(0 AS BIGINT) AS drift
        FROM stock s LEFT JOIN (
            SELECT product_id, SUM(delta) AS delta FROM (
                SELECT product_id, sign * CASE WHEN op = 'INSERT' THEN quantity ELSE -quantity END AS delta
                FROM shop_stock_change
                UNION ALL
                SELECT new_product_id, sign * new_quantity FROM shop_stock_change WHERE op = 'UPDATE') c
            GROUP BY 1) d ON d.product_id = s.product_id""",
    "marts_by_sql": """
        SELECT category, COUNT(*) AS n_products, COUNT(*) FILTER (on_hand <= reorder_level) AS n_reorder,
               CAST(SUM(on_hand) AS BIGINT) AS units
        FROM stock GROUP BY 1""",
    "upsert_latest": """
        SELECT c_custkey AS customer_id, COALESCE(n.nickname, c_mktsegment) AS nickname,
               CASE WHEN n.nickname IS DISTINCT FROM c_mktsegment AND n.customer_id IS NOT NULL
                    THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '1995-01-01' END AS updated_at
        FROM customer LEFT JOIN (
            SELECT o_custkey AS customer_id,
                   CASE WHEN o_orderstatus = 'F' THEN 'MACHINERY' ELSE o_orderstatus END AS nickname
            FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                         ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) z
            WHERE rn = 1) n ON n.customer_id = c_custkey""",
    "snapshot_diff": """
        SELECT COALESCE(b.product_id, a.product_id) AS product_id,
               CASE WHEN b.product_id IS NULL THEN 'INSERT' WHEN a.product_id IS NULL THEN 'DELETE'
                    ELSE 'UPDATE' END AS op,
               CASE WHEN a.product_id IS NULL OR b.product_id IS NULL THEN ''
                    ELSE concat_ws(',', CASE WHEN a.price <> b.price THEN 'current_price' END,
                                   CASE WHEN a.reorder <> b.reorder THEN 'reorder_level' END)
               END AS changed
        FROM (SELECT product_id, current_price AS price, reorder_level AS reorder
              FROM shop_product WHERE is_active) b
        FULL JOIN (
            SELECT product_id,
                   CASE WHEN starts_with(name, 'hot ') THEN current_price + 1
                        ELSE current_price END AS price,
                   GREATEST(reorder_level, 10) AS reorder
            FROM shop_product WHERE reorder_level < 50) a ON a.product_id = b.product_id
        WHERE a.product_id IS NULL OR b.product_id IS NULL
           OR a.price <> b.price OR a.reorder <> b.reorder""",
    "calendar_features": """
        SELECT day, CAST(day_of_week AS INT) AS day_of_week, is_weekend, is_december, is_payday,
               round(weight / SUM(weight) OVER (), 9) AS share
        FROM day_weight""",
    "deflated_prices": """
        SELECT product_id, CAST(year AS INT) AS year, current_price,
               CAST(GREATEST(round_even(current_price::DOUBLE * pow(1.04::DOUBLE, year - last) * 4, 0)
                             / 4, 0.25) AS DECIMAL(10,2)) AS price_that_year
        FROM (SELECT DISTINCT i.product_id, year(t.transaction_date) AS year
              FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id) y
        JOIN shop_product p USING (product_id),
        (SELECT MAX(year(transaction_date)) AS last FROM shop_txn) m""",
    "price_cost_margin": """
        SELECT product_id, category, current_price, cost,
               CAST(current_price - cost AS DECIMAL(10,2)) AS margin
        FROM (SELECT product_id, category, current_price,
                     CAST(round(current_price::DOUBLE / CASE category
                          WHEN 'ECONOMY' THEN 1.15::DOUBLE WHEN 'STANDARD' THEN 1.18::DOUBLE
                          WHEN 'PROMO' THEN 1.22::DOUBLE WHEN 'LARGE' THEN 1.12::DOUBLE
                          ELSE 1.18::DOUBLE END, 2) AS DECIMAL(10,2)) AS cost
              FROM shop_product) z""",
    "barcode_format": """
        SELECT p_partkey AS product_id, printf('48%011d', p_partkey) AS barcode,
               printf('DR-%06d', p_partkey) AS document_no
        FROM part""",
    "text_clean": """
        SELECT doc_id, regexp_replace(text, '\\r?\\n', ', ', 'g') AS line,
               concat_ws(' ', lang, source) AS label, 'DOC#' || doc_id AS reference
        FROM documents""",
    "payment_lag": """
        SELECT p.payment_id, p.customer_id,
               CAST(GREATEST(epoch_us(p.payment_date) // 1000000 - epoch_us(f.d) // 1000000, 1)
                    AS BIGINT) AS lag_seconds
        FROM shop_payment p JOIN (
            SELECT customer_id, MIN(transaction_date) AS d FROM shop_txn
            WHERE payment_type = 'credit' GROUP BY 1) f ON f.customer_id = p.customer_id""",
    "payment_cap": """
        SELECT payment_id, z.customer_id, CAST(amount AS DECIMAL(38,2)) AS amount,
               CAST(GREATEST(0, LEAST(amount, COALESCE(c.v, 0) - (paid_to - amount)))
                    AS DECIMAL(38,2)) AS allowed
        FROM (SELECT *, SUM(amount) OVER (PARTITION BY customer_id ORDER BY payment_date, payment_id
                         ROWS UNBOUNDED PRECEDING) AS paid_to FROM shop_payment) z
        LEFT JOIN (SELECT customer_id, SUM(total) AS v FROM charge GROUP BY 1) c
               ON c.customer_id = z.customer_id""",
    "replenishment_need": "SELECT p.product_id, sold, needed FROM need p",
    "proportional_allocation": """
        SELECT product_id, CAST(weight AS BIGINT) AS weight,
               CAST(base + 1 + CASE WHEN row_number() OVER (ORDER BY remainder DESC, product_id)
                    <= (SELECT MAX(r) - SUM(base) FROM share_of_units)
                    THEN 1 ELSE 0 END AS BIGINT) AS allocated
        FROM share_of_units""",
    "even_split": """
        SELECT product_id, needed, n_lines, pos + 1 AS line_no,
               CAST(q // n_lines + CASE WHEN pos < q % n_lines THEN 1 ELSE 0 END AS BIGINT) AS quantity
        FROM (SELECT n.product_id, n.needed, k.n_lines, GREATEST(n.needed, k.n_lines) AS q,
                     unnest(range(k.n_lines)) AS pos
              FROM need n JOIN (SELECT product_id, COUNT(*) AS n_lines FROM shop_restock_item
                                GROUP BY 1) k ON k.product_id = n.product_id) z""",
    "expand_by_count": """
        SELECT transaction_id, n_items, unnest(range(n_items)) AS position
        FROM (SELECT transaction_id, COUNT(*) AS n_items FROM shop_txn_item GROUP BY 1) z""",
    "demand_weekly": """
        SELECT product_id, week, CAST(units AS BIGINT) AS units,
               CAST(COALESCE(SUM(units) OVER (PARTITION BY product_id ORDER BY week
                    RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING), 0)
                    AS BIGINT) AS units_week_before,
               CAST(COALESCE(SUM(units) OVER (PARTITION BY product_id ORDER BY week
                    RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING), 0)
                    AS BIGINT) AS units_four_weeks_before
        FROM week_demand""",
    "reorder_suggestion": """
        SELECT s.product_id, s.on_hand,
               CAST(ceil(COALESCE(r.u, 0) * 2 / 4.0) AS BIGINT) AS expected_demand,
               CAST(GREATEST(s.reorder_level + ceil(COALESCE(r.u, 0) * 2 / 4.0) - s.on_hand, 0)
                    AS BIGINT) AS suggested_units
        FROM stock s LEFT JOIN (
            SELECT i.product_id, SUM(i.quantity) AS u
            FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id
            WHERE CAST(t.transaction_date AS DATE) > (SELECT MAX(day) FROM day_revenue) - 28
            GROUP BY 1) r ON r.product_id = s.product_id""",
    "credit_features": """
        SELECT c.customer_id, c.n_charges, COALESCE(p.n, 0) AS n_payments,
               CAST(c.v - COALESCE(p.v, 0) AS DECIMAL(38,2)) AS balance,
               CAST(datediff('day', CAST(c.lo AS DATE), CAST(p.lo AS DATE)) AS INT)
                   AS days_to_first_payment,
               CAST(datediff('day', CAST(p.hi AS DATE), CAST(c.hi AS DATE)) AS INT)
                   AS days_since_payment
        FROM (SELECT customer_id, COUNT(*) AS n_charges, SUM(total) AS v,
                     MIN(transaction_date) AS lo, MAX(transaction_date) AS hi
              FROM charge GROUP BY 1) c
        LEFT JOIN (SELECT customer_id, COUNT(*) AS n, SUM(amount) AS v,
                          MIN(payment_date) AS lo, MAX(payment_date) AS hi
                   FROM shop_payment GROUP BY 1) p ON p.customer_id = c.customer_id""",
    "rfm_segments": """
        SELECT customer_id, n_sales, CAST(spent AS DECIMAL(38,2)) AS spent,
               CAST(ntile(5) OVER (ORDER BY last_sale, customer_id) AS BIGINT) AS recency,
               CAST(ntile(5) OVER (ORDER BY n_sales, customer_id) AS BIGINT) AS frequency,
               CAST(ntile(5) OVER (ORDER BY spent, customer_id) AS BIGINT) AS monetary
        FROM (SELECT t.customer_id, MAX(t.transaction_date) AS last_sale, COUNT(*) AS n_sales,
                     SUM(s.total) AS spent
              FROM shop_txn t JOIN sale_total s ON s.transaction_id = t.transaction_id
              WHERE t.customer_id IS NOT NULL GROUP BY 1) z""",
    "basket_pairs": """
        SELECT a.name AS item_a, b.name AS item_b, COUNT(*) AS n_both,
               round(COUNT(*)::DOUBLE / MAX(na.n), 6) AS confidence,
               round(COUNT(*) * MAX(t.n)::DOUBLE / (MAX(na.n) * MAX(nb.n)), 6) AS lift
        FROM bought a JOIN bought b ON a.transaction_id = b.transaction_id AND a.name < b.name
        JOIN (SELECT name, COUNT(*) AS n FROM bought GROUP BY 1) na ON na.name = a.name
        JOIN (SELECT name, COUNT(*) AS n FROM bought GROUP BY 1) nb ON nb.name = b.name,
        (SELECT COUNT(DISTINCT transaction_id) AS n FROM bought) t
        GROUP BY 1, 2 HAVING COUNT(*) >= ceil(0.001 * MAX(t.n))""",
    "price_history": "SELECT * FROM history",
    "price_as_of": """
        SELECT w.product_id, w.day, h.price
        FROM (SELECT DISTINCT product_id, CAST(restock_date AS DATE) AS day
              FROM shop_restock_item) w
        ASOF LEFT JOIN history h ON h.product_id = w.product_id AND h.valid_from <= w.day""",
    "fifo_allocation": """
        SELECT customer_id, transaction_id, payment_id,
               CAST(allocated AS DECIMAL(38,2)) AS allocated
        FROM settled WHERE allocated > 0""",
    "invoice_aging": """
        SELECT CASE WHEN age <= 30 THEN '0-30' WHEN age <= 60 THEN '31-60'
                    WHEN age <= 90 THEN '61-90' ELSE 'over 90' END AS age_days,
               COUNT(*) AS n_charges, CAST(SUM(open_amount) AS DECIMAL(38,2)) AS open_amount
        FROM (SELECT datediff('day', CAST(c.transaction_date AS DATE),
                              (SELECT MAX(CAST(transaction_date AS DATE)) FROM shop_txn)) AS age,
                     c.total - COALESCE(s.v, 0) AS open_amount
              FROM charge c LEFT JOIN (SELECT transaction_id, SUM(allocated) AS v FROM settled
                                       GROUP BY 1) s ON s.transaction_id = c.transaction_id) z
        WHERE open_amount > 0 GROUP BY 1""",
}

def _set_counts(table: str, columns: list[str], most: int) -> str:
    """Distinct rows of ``table`` in every set of up to ``most`` columns; a set is a mask of bits."""
    sets = [s for n in range(1, most + 1) for s in combinations(range(len(columns)), n)]
    counts = [f"SELECT 0 AS mask, CAST(COUNT(*) > 0 AS BIGINT) AS n FROM {table}"]
    for s in sets:
        names = ", ".join(columns[k] for k in s)
        counts.append(f"SELECT {sum(1 << k for k in s)}, COUNT(*) FROM (SELECT DISTINCT {names} FROM {table})")
    return " UNION ALL ".join(counts)


def _dependencies(table: str, columns: list[str], most: int) -> str:
    """Common table expressions: counts of all sets, and the minimal dependencies (left, a, n)."""
    names = ", ".join(f"'{c}'" for c in columns)
    return f"""
        flat AS MATERIALIZED (SELECT * FROM {table}),
        sets AS MATERIALIZED ({_set_counts("flat", columns, most)}),
        place AS (SELECT unnest([{names}]) AS name, unnest(range({len(columns)})) AS a),
        holding AS MATERIALIZED (
            SELECT l.mask AS lhs, a, l.n FROM sets l, place
            JOIN sets b ON b.mask = l.mask | (1 << a)
            WHERE l.mask & (1 << a) = 0 AND bit_count(l.mask) <= 3 AND b.n = l.n),
        minimal AS MATERIALIZED (
            SELECT * FROM holding h WHERE NOT EXISTS (
                SELECT 1 FROM holding s WHERE s.a = h.a AND s.lhs <> h.lhs AND s.lhs & h.lhs = s.lhs))"""


def _names(mask: str) -> str:
    return f"(SELECT coalesce(string_agg(name, ', ' ORDER BY a), '') FROM place WHERE ({mask}) & (1 << a) <> 0)"


DELIVERY_COLUMNS = (
    "delivery_date reference_no supplier_name supplier_contact product_name product_category qty_received unit_cost"
).split()
ORACLE["fd_discovery"] = f"""WITH delivery_flat AS ({{delivery_flat}}),{_dependencies("delivery_flat", DELIVERY_COLUMNS, 4)}
        SELECT {_names("lhs")} AS determinant, name AS dependent, n AS n_values
        FROM minimal JOIN place USING (a)"""

ORDER_COLUMNS = (
    "reference_no sale_date priority payment_type customer_name customer_nickname country region currency"
).split()
# a set of columns identifies the list if no closed set but the whole contains it
ORACLE["normal_form_plan"] = f"""WITH order_flat AS (
            SELECT o_orderkey AS reference_no, CAST(o_orderdate AS DATE) AS sale_date, o_orderpriority AS priority,
                   CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'credit' ELSE 'cash' END AS payment_type,
                   c_name AS customer_name, c_mktsegment AS customer_nickname, n_name AS country, r_name AS region,
                   'PHP' AS currency
            FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
            JOIN region ON r_regionkey = n_regionkey),{_dependencies("order_flat", ORDER_COLUMNS, len(ORDER_COLUMNS))},
        reach AS (SELECT lhs, lhs | bit_or(1 << a) AS closure FROM holding
                  WHERE lhs IN (SELECT lhs FROM minimal) GROUP BY lhs),
        masks AS (SELECT unnest(range(1 << {len(ORDER_COLUMNS)})) AS m),
        lower AS (SELECT DISTINCT up.closure, minimal.lhs, minimal.a FROM reach up
                  JOIN reach down ON down.closure & up.closure = down.closure AND down.closure <> up.closure
                  JOIN minimal ON minimal.lhs = down.lhs),
        groups AS (SELECT closure, bit_or(lhs) AS keyed,
                          arg_min(lhs, {{'n': bit_count(lhs), 'k': list_filter(range({len(ORDER_COLUMNS)}), lambda k: lhs & (1 << k) <> 0)}}) AS key
                   FROM reach GROUP BY closure),
        stuck AS MATERIALIZED (SELECT closure, m FROM groups JOIN masks ON m & closure = m AND m <> closure
                  WHERE NOT EXISTS (SELECT 1 FROM lower WHERE lower.closure = groups.closure
                                    AND lower.lhs & m = lower.lhs AND m & (1 << a) = 0)),
        parts AS (SELECT closure, key, min(m) AS cols FROM groups JOIN masks ON m & closure = m AND m & keyed = keyed
                  WHERE NOT EXISTS (SELECT 1 FROM stuck WHERE stuck.closure = groups.closure AND masks.m & stuck.m = masks.m)
                  GROUP BY closure, key),
        closed AS (SELECT m FROM masks WHERE m <> (1 << {len(ORDER_COLUMNS)}) - 1 AND NOT EXISTS (
                   SELECT 1 FROM minimal WHERE lhs & m = lhs AND m & (1 << a) = 0)),
        root AS (SELECT min(m) AS m FROM masks WHERE NOT EXISTS (
                 SELECT 1 FROM closed WHERE masks.m & closed.m = masks.m)),
        every AS (SELECT cols, key FROM parts
                  UNION ALL SELECT m, m FROM root
                  WHERE NOT EXISTS (SELECT 1 FROM parts WHERE closure = (1 << {len(ORDER_COLUMNS)}) - 1))
        SELECT {_names("cols")} AS columns, {_names("key")} AS key, n AS n_rows
        FROM every JOIN sets ON sets.mask = cols"""

GIVEN = {
    "region": "r_regionkey:integer r_name:string",
    "nation": "n_nationkey:integer n_name:string n_regionkey:integer",
    "customer": "c_custkey:integer c_name:string c_nationkey:integer c_acctbal:fraction c_mktsegment:string",
    "supplier": "s_suppkey:integer s_name:string s_nationkey:integer s_acctbal:fraction",
    "part": "p_partkey:integer p_name:string p_brand:string p_type:string p_size:integer p_retailprice:fraction",
    "orders": "o_orderkey:integer o_custkey:integer o_orderstatus:string o_totalprice:fraction o_orderdate:time"
    " o_orderpriority:string",
    "lineitem": "l_orderkey:integer l_partkey:integer l_suppkey:integer l_linenumber:integer l_quantity:fraction"
    " l_extendedprice:fraction l_discount:fraction l_tax:fraction l_returnflag:string l_linestatus:string l_shipdate:time",
    "events": "event_id:integer ts:time user_id:integer event_type:string value:fraction props:string",
    "documents": "doc_id:integer text:string lang:string source:string n_chars:integer",
    "embeddings": "vec_id:integer label:integer",
    "pages": "page_id:integer url:string html:string",
    "benchmark": "item_id:integer text:string",
    "labels": "doc_id:integer quality:integer toxic:integer",
    "conversations": "conv_id:integer turn:integer role:string text:string",
}
_VALUES = " UNION ALL ".join(
    f"SELECT '{table}' AS t, '{name}' AS c, '{kind}' AS kind, CAST({name} AS VARCHAR) AS v, COUNT(*) AS n FROM {table}"
    f" WHERE {name} IS NOT NULL GROUP BY ALL"
    for table, columns in GIVEN.items()
    for name, kind in (column.split(":") for column in columns.split())
)
ORACLE["inclusion_candidates"] = f"""WITH vals AS MATERIALIZED ({_VALUES}),
        sizes AS (SELECT t, c, COUNT(*) AS n_values, MAX(n) = 1 AS is_key FROM vals GROUP BY ALL)
        SELECT a.t AS from_table, a.c AS from_column, b.t AS to_table, b.c AS to_column, MAX(sa.n_values) AS n_values,
               COUNT(*) AS n_found, bool_or(sb.is_key) AS to_is_key
        FROM vals a JOIN vals b ON a.kind = b.kind AND a.v = b.v AND (a.t <> b.t OR a.c <> b.c)
        JOIN sizes sa ON sa.t = a.t AND sa.c = a.c JOIN sizes sb ON sb.t = b.t AND sb.c = b.c
        GROUP BY 1, 2, 3, 4 HAVING COUNT(*) * 100 >= MAX(sa.n_values) * 90"""



def _profile(table: str, name: str, kind: str) -> str:
    number = f"datediff('day', DATE '1970-01-01', CAST({name} AS DATE))" if kind == "time" else name
    bounds = (
        f"NULL::DOUBLE AS least, NULL::DOUBLE AS most, MIN({name}) AS least_text, MAX({name}) AS most_text"
        if kind == "string"
        else f"MIN({number})::DOUBLE + 0::DOUBLE AS least, MAX({number})::DOUBLE + 0::DOUBLE AS most, NULL::VARCHAR AS least_text, NULL::VARCHAR AS most_text"
    )
    return f"""SELECT '{table}' AS table_name, '{name}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({name}) AS n_null,
        {bounds}, true AS distinct_agree, true AS quantiles_agree FROM {table}"""


ORACLE["profile_merged"] = " UNION ALL ".join(
    _profile(table, *column.split(":")) for table in ("orders", "lineitem") for column in GIVEN[table].split()
)

ORACLE["name_clusters"] = """WITH RECURSIVE listed AS (
            SELECT key, name, key % 12 AS slip, key // 12 % 7 + 1 AS place
            FROM (SELECT p_partkey AS key, p_name AS name FROM part UNION ALL
                  SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey)),
        counted AS (
            SELECT name, COUNT(*) AS n_rows, trim(regexp_replace(lower(name), '\\s+', ' ', 'g')) AS normal
            FROM (SELECT CASE slip
                WHEN 1 THEN left(name, place - 1) || substr(name, place + 1)
                WHEN 2 THEN left(name, place) || substr(name, place, 1) || substr(name, place + 1)
                WHEN 3 THEN left(name, place - 1) || 'x' || substr(name, place + 1)
                WHEN 4 THEN '  ' || upper(name) || ' ' ELSE name END AS name FROM listed)
            GROUP BY 1),
        normals AS MATERIALIZED (
            SELECT DISTINCT normal, regexp_replace(normal, '[0-9]+', '0', 'g') AS letters,
                   array_to_string(regexp_extract_all(normal, '[0-9]+'), ' ') AS numbers FROM counted),
        near AS MATERIALIZED (
            SELECT a.normal AS x, b.normal AS y FROM normals a JOIN normals b ON a.numbers = b.numbers
            WHERE levenshtein(a.letters, b.letters) <= 1),
        reached(normal, other) AS (
            SELECT normal, normal FROM normals UNION
            SELECT reached.normal, near.y FROM reached JOIN near ON near.x = reached.other),
        labels AS (SELECT normal, MIN(other) AS label FROM reached GROUP BY 1),
        heads AS (SELECT label, arg_min(name, {'n': -n_rows, 'm': name}) AS cluster, COUNT(*) AS n_names
                  FROM counted JOIN labels USING (normal) GROUP BY 1)
        SELECT name, n_rows, cluster, n_names FROM counted JOIN labels USING (normal) JOIN heads USING (label)"""

ORACLE["balances_maintained"] = """
        SELECT customer_id, CAST(COALESCE(charged, 0) AS DECIMAL(38,2)) AS total_utang,
               CAST(COALESCE(paid, 0) AS DECIMAL(38,2)) AS total_paid,
               CAST(COALESCE(charged, 0) - COALESCE(paid, 0) AS DECIMAL(38,2)) AS balance
        FROM shop_customer
        LEFT JOIN (
            SELECT customer_id, SUM(quantity * unit_price) AS charged
            FROM (SELECT transaction_id,
                         CASE WHEN transaction_id % 7 = 3 THEN customer_id // 2 ELSE customer_id END AS customer_id,
                         CASE WHEN transaction_id % 14 = 3 THEN 'credit' ELSE payment_type END AS payment_type
                  FROM shop_txn WHERE transaction_id % 11 <> 5) t
            JOIN (SELECT transaction_id, unit_price,
                         CASE line_no WHEN 2 THEN quantity + 1 WHEN 4 THEN 1 ELSE quantity END AS quantity
                  FROM shop_txn_item WHERE transaction_id % 22 <> 5) i USING (transaction_id)
            WHERE payment_type = 'credit' GROUP BY 1) c USING (customer_id)
        LEFT JOIN (
            SELECT customer_id, SUM(amount + CASE WHEN payment_id % 9 = 2 THEN 1 ELSE 0 END) AS paid
            FROM shop_payment WHERE payment_id % 9 <> 4 GROUP BY 1) p USING (customer_id)"""
ORACLE["category_revenue_maintained"] = """
        SELECT category, CAST(SUM(quantity) AS BIGINT) AS units, CAST(SUM(quantity * unit_price) AS DECIMAL(38,2)) AS sales
        FROM (SELECT product_id, unit_price, CASE WHEN line_no = 2 THEN quantity + 1 ELSE quantity END AS quantity
              FROM shop_txn_item WHERE line_no <> 4) i
        JOIN (SELECT product_id, CASE WHEN product_id % 4 = 1 THEN 'PROMO' ELSE category END AS category
              FROM shop_product WHERE product_id % 17 <> 3) p USING (product_id)
        GROUP BY 1"""

# how far every product's smoothed numbers are after each week
ORACLE["demand_forecast"] = """WITH RECURSIVE {shop},
        weekly AS (
            SELECT i.product_id, CAST(date_trunc('week', t.transaction_date) AS DATE) AS week, SUM(i.quantity) AS units
            FROM shop_txn_item i JOIN shop_txn t ON t.transaction_id = i.transaction_id GROUP BY 1, 2),
        bounds AS (SELECT MIN(week) AS first, MAX(week) AS last, MAX(week) - 28 AS learn FROM weekly),
        totals AS (SELECT week, SUM(units) AS units FROM weekly, bounds WHERE week <= learn GROUP BY 1),
        factors AS (
            SELECT month(week) AS month,
                   (SUM(units) * MAX(n))::DOUBLE / (COUNT(*) * MAX(u))::DOUBLE AS factor
            FROM totals, (SELECT COUNT(*) AS n, SUM(units) AS u FROM totals) z GROUP BY 1),
        series AS MATERIALIZED (
            SELECT p.product_id, s.week, row_number() OVER (PARTITION BY p.product_id ORDER BY s.week) AS k,
                   COALESCE(w.units, 0)::DOUBLE AS units, COALESCE(NULLIF(f.factor, 0), 1) AS factor,
                   s.week <= (SELECT learn FROM bounds) AS learned
            FROM shop_product p,
                 (SELECT CAST(unnest(generate_series(first, last, INTERVAL 7 DAY)) AS DATE) AS week FROM bounds) s
            LEFT JOIN weekly w ON w.product_id = p.product_id AND w.week = s.week
            LEFT JOIN factors f ON f.month = month(s.week)),
        starts AS (
            SELECT product_id, COUNT(*) FILTER (WHERE units > 0) / COUNT(*)::DOUBLE AS chance,
                   COALESCE(AVG(units / factor) FILTER (WHERE units > 0), 0) AS size, COUNT(*) AS n
            FROM series WHERE learned GROUP BY 1),
        fold(product_id, k, n, chance, size, squares) AS (
            SELECT product_id, 0::BIGINT, n, chance, size, 0::DOUBLE FROM starts
            UNION ALL
            SELECT fold.product_id, s.k, fold.n,
                   fold.chance + 0.1::DOUBLE * (CASE WHEN s.units > 0 THEN 1 ELSE 0 END - fold.chance),
                   CASE WHEN s.units > 0 THEN fold.size + 0.1::DOUBLE * (s.units / s.factor - fold.size) ELSE fold.size END,
                   fold.squares + (s.units / s.factor - fold.chance * fold.size) * (s.units / s.factor - fold.chance * fold.size)
            FROM fold JOIN series s ON s.product_id = fold.product_id AND s.k = fold.k + 1 AND s.learned),
        fits AS (
            SELECT product_id, n, chance * size AS level, sqrt(squares / n) AS sigma FROM fold WHERE k = n),
        recent AS (
            SELECT s.product_id, SUM(units) / 4 AS mean FROM series s JOIN fits USING (product_id)
            WHERE learned AND k > n - 4 GROUP BY 1),
        held AS (
            SELECT s.product_id, CAST(SUM(units) AS BIGINT) AS units_held_out,
                   round(SUM(level * factor), 6) AS forecast_held_out,
                   round(SUM(abs(units - level * factor)) / COUNT(*), 6) AS mean_error,
                   round(SUM(abs(units - mean)) / COUNT(*), 6) AS mean_error_flat
            FROM series s JOIN fits USING (product_id) JOIN recent USING (product_id) WHERE NOT learned GROUP BY 1)
        SELECT product_id, round(level, 6) AS weekly, round(sigma, 6) AS sigma, units_held_out, forecast_held_out,
               mean_error, mean_error_flat, CAST(ceil(round(level * 2 + 1.65::DOUBLE * sigma * sqrt(2), 6)) AS BIGINT) AS reorder_point,
               on_hand,
               CAST(GREATEST(ceil(round(level * 2 + 1.65::DOUBLE * sigma * sqrt(2), 6)) - on_hand, 0) AS BIGINT) AS suggested_units
        FROM fits JOIN held USING (product_id) JOIN stock USING (product_id)"""
ORACLE["basket_rules"] = """
        , baskets AS (SELECT DISTINCT i.transaction_id, p.category AS item
                      FROM shop_txn_item i JOIN shop_product p ON p.product_id = i.product_id),
        total AS (SELECT COUNT(DISTINCT transaction_id) AS n FROM baskets),
        sets AS MATERIALIZED (
            SELECT items, COUNT(*) AS n FROM (
                SELECT [item] AS items FROM baskets
                UNION ALL SELECT [a.item, b.item] FROM baskets a JOIN baskets b USING (transaction_id) WHERE a.item < b.item
                UNION ALL SELECT [a.item, b.item, c.item] FROM baskets a JOIN baskets b USING (transaction_id)
                    JOIN baskets c USING (transaction_id) WHERE a.item < b.item AND b.item < c.item
                UNION ALL SELECT [a.item, b.item, c.item, d.item] FROM baskets a JOIN baskets b USING (transaction_id)
                    JOIN baskets c USING (transaction_id) JOIN baskets d USING (transaction_id)
                    WHERE a.item < b.item AND b.item < c.item AND c.item < d.item)
            GROUP BY 1 HAVING COUNT(*) >= (SELECT ceil(0.005 * n) FROM total)),
        closed AS (SELECT * FROM sets s WHERE len(items) > 1 AND NOT EXISTS (
            SELECT 1 FROM sets l WHERE len(l.items) = len(s.items) + 1 AND l.n = s.n AND list_has_all(l.items, s.items))),
        rules AS (SELECT items, n, unnest(items) AS also FROM closed)
        SELECT array_to_string(l.items, ' + ') AS items, also, CAST(len(rules.items) AS INT) AS n_items, rules.n AS n_both,
               round(rules.n / l.n::DOUBLE, 6) AS confidence,
               round(rules.n * (SELECT n FROM total)::DOUBLE / (l.n * o.n), 6) AS lift
        FROM rules JOIN sets l ON l.items = list_filter(rules.items, lambda x: x <> also)
        JOIN sets o ON o.items = [also]"""
ORACLE["fd_discovery"] = ORACLE["fd_discovery"].replace("{delivery_flat}", VIEWS["delivery_flat"])
ORACLE["load_published"] = ORACLE["load_counts"].replace(
    "FROM shop_payment", "FROM shop_payment WHERE amount > 0"
)
ORACLE["load_incremental"] = ORACLE["load_published"]
ORACLE["stock_stream"] = ORACLE["stock_cdc_batch"]
ORACLE["fifo_stream"] = ORACLE["fifo_allocation"]


def _needed(sql: str) -> list[str]:
    """The views a query names, directly or through other views."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in VIEWS:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                found.add(name)
                pending.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, sql in ORACLE.items():
        views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _needed(sql))
        if "{shop}" in sql:
            result[name] = sql.replace("{shop}", views)
        else:
            result[name] = f"WITH {views}\n{sql}" if views and not sql.startswith("WITH") else sql
    return result

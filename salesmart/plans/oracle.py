"""Independent DuckDB SQL for each registered query (same column names).

The CTEs restate the table mapping of ``sources.testdata`` in SQL.
"""

from __future__ import annotations

LINES = """lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(ROUND(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS INTEGER) AS unit_price,
         l_shipdate AS ordered_at,
         CAST(l_quantity AS INTEGER)
           * (CAST(ROUND(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS INTEGER)) AS amount,
         CAST(l_shipdate AS DATE) AS order_date
  FROM lineitem)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
         CAST(ROUND(p_retailprice * 100) AS BIGINT) AS unit_price
  FROM part)"""

ORDERS = """ords AS (
  SELECT o_orderkey AS order_id, o_custkey AS product_id, CAST(1 AS INTEGER) AS quantity,
         CAST(ROUND(o_totalprice * 100) AS BIGINT) AS unit_price, o_orderdate AS ordered_at,
         CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount, CAST(o_orderdate AS DATE) AS order_date
  FROM orders)"""

CUSTOMERS = """custs AS (
  SELECT c_custkey AS product_id, c_name AS name, c_mktsegment AS category FROM customer)"""

TIMED = """timed AS (
  SELECT event_id AS order_id, user_id AS product_id, CAST(1 AS INTEGER) AS quantity,
         CAST(ROUND(value * 100) AS BIGINT) AS unit_price, ts AS ordered_at,
         CAST(ROUND(value * 100) AS BIGINT) AS amount, CAST(ts AS DATE) AS order_date
  FROM events)"""

SPARSE = """sparse AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS name,
         CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN '' ELSE p_type END AS category
  FROM part)"""

REQUESTS = """reqs AS (
  SELECT ts AS requested_at,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
         '/' || event_type || '/' AS path,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         user_id AS duration_ms
  FROM events)"""

SECONDS = "'%Y-%m-%d %H:%M:%S'"


def half_up(expr: str, digits: int = 2) -> str:
    """Round a double HALF_UP on its shortest decimal form.

    That is how Spark's round and the dashboard's display rounding treat a
    double (4563.525 -> 4563.53); DuckDB's ROUND on the double itself works on
    the binary value (4563.52499... -> 4563.52).
    """
    return f"CAST(ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BY_PRODUCT = with_(LINES, PRODUCTS) + """
SELECT l.product_id, p.name AS product_name, p.category,
       COUNT(*) AS order_count, CAST(SUM(l.amount) AS BIGINT) AS revenue,
       CAST(SUM(l.quantity) AS BIGINT) AS sold_quantity,
       CAST(SUM(l.amount) AS BIGINT) / COUNT(*) AS average_order_amount
FROM lines l JOIN products p ON l.product_id = p.product_id
GROUP BY l.product_id, p.name, p.category"""

HOURLY = """hourly AS (
  SELECT CAST(hour(ordered_at) AS INTEGER) AS order_hour, COUNT(*) AS order_count,
         CAST(SUM(amount) AS BIGINT) AS revenue
  FROM timed GROUP BY 1),
by_hour AS (
  SELECT order_hour, order_count, revenue,
         CASE WHEN (SELECT SUM(revenue) FROM hourly) > 0
              THEN """ + half_up("revenue / (SELECT CAST(SUM(revenue) AS BIGINT) FROM hourly) * 100") + """
              ELSE 0.0 END AS revenue_share_pct
  FROM hourly)"""

BY_CATEGORY = """by_category AS (
  SELECT p.category, COUNT(*) AS order_count, CAST(SUM(l.amount) AS BIGINT) AS revenue
  FROM lines l JOIN products p ON l.product_id = p.product_id GROUP BY p.category)"""

DASH_PRODUCTS = """bp AS (
  SELECT t.product_id, p.name AS product_name, p.category, COUNT(*) AS order_count,
         CAST(SUM(t.amount) AS BIGINT) AS revenue, CAST(SUM(t.quantity) AS BIGINT) AS sold_quantity,
         CAST(SUM(t.amount) AS BIGINT) / COUNT(*) AS average_order_amount
  FROM timed t JOIN products p ON t.product_id = p.product_id
  GROUP BY t.product_id, p.name, p.category),
dash AS (
  SELECT p.product_id, p.name, p.category, COALESCE(bp.product_name, p.name) AS product_name,
         COALESCE(bp.order_count, 0) AS order_count, COALESCE(bp.revenue, 0) AS revenue,
         COALESCE(bp.sold_quantity, 0) AS sold_quantity, bp.average_order_amount
  FROM products p LEFT JOIN bp ON p.product_id = bp.product_id)"""

SAMPLE = "(SELECT * FROM ords WHERE order_id <= (SELECT MAX(order_id) FROM ords) // 2)"

SQL: dict[str, str] = {
    "q_refined_orders": with_(LINES) + f"""
SELECT order_id, product_id, quantity, unit_price, strftime(ordered_at, {SECONDS}) AS ordered_at,
       amount, CAST(order_date AS VARCHAR) AS order_date
FROM lines""",
    "q_enriched_orders": with_(LINES, PRODUCTS) + f"""
SELECT l.product_id, l.order_id, l.quantity, l.unit_price, strftime(l.ordered_at, {SECONDS}) AS ordered_at,
       l.amount, CAST(l.order_date AS VARCHAR) AS order_date, p.name, p.category
FROM lines l JOIN products p ON l.product_id = p.product_id""",
    "q_sales_by_product": BY_PRODUCT,
    "q_broadcast_join_sales": BY_PRODUCT,
    "q_sales_by_category": with_(LINES, PRODUCTS, BY_CATEGORY) + "SELECT * FROM by_category",
    "q_sales_by_product_in_category": "SELECT * FROM (" + BY_PRODUCT + ") WHERE category = 'ECONOMY'",
    "q_sales_by_day": with_(LINES) + """
SELECT CAST(order_date AS VARCHAR) AS order_date, COUNT(*) AS order_count,
       CAST(SUM(amount) AS BIGINT) AS revenue
FROM lines GROUP BY order_date""",
    "q_sales_by_hour": with_(TIMED, HOURLY) + "SELECT * FROM by_hour",
    "q_total_sales": with_(LINES) + "SELECT CAST(SUM(amount) AS BIGINT) AS total_revenue FROM lines",
    "q_order_count": with_(LINES) + "SELECT COUNT(*) AS order_count FROM lines",
    "q_parsed_requests": with_(REQUESTS) + f"""
SELECT CASE WHEN duration_ms NOT IN (3, 5) THEN strftime(requested_at, {SECONDS}) END AS requested_at,
       CASE WHEN duration_ms = 3 THEN '' ELSE method END AS method, CASE WHEN duration_ms = 3 THEN '' ELSE path END AS path,
       CASE WHEN duration_ms <> 3 THEN status END AS status, CASE WHEN duration_ms <> 3 THEN duration_ms END AS duration_ms,
       CASE WHEN duration_ms NOT IN (3, 5) THEN strftime(requested_at, '%Y-%m-%d') END AS visit_date
FROM reqs""",
    "q_log_roundtrip": with_(REQUESTS) + """
SELECT strftime(requested_at, '%Y-%m-%dT%H:%M:%S') || '+09:00 ' || method || ' ' || path || ' '
       || CAST(status AS VARCHAR) || ' ' || CAST(duration_ms AS VARCHAR) AS value
FROM reqs""",
    "q_page_views": """
SELECT strftime(ts, '%Y-%m-%d') AS visit_date, COUNT(*) AS page_views FROM events GROUP BY 1""",
    "q_order_preview": with_(ORDERS) + """
SELECT order_id, product_id, quantity, amount, CAST(row_number() OVER (ORDER BY order_id DESC) AS INTEGER) AS position
FROM ords ORDER BY order_id DESC LIMIT 10""",
    "q_dashboard_products": with_(TIMED, PRODUCTS, DASH_PRODUCTS) + "SELECT * FROM dash",
    "q_product_totals_full": with_(LINES, CUSTOMERS) + """,
totals AS (
  SELECT product_id, COUNT(*) AS order_count, CAST(SUM(amount) AS BIGINT) AS revenue,
         CAST(SUM(quantity) AS BIGINT) AS sold_quantity
  FROM lines GROUP BY product_id)
SELECT COALESCE(c.product_id, t.product_id) AS product_id, c.name, c.category,
       COALESCE(t.order_count, 0) AS order_count, COALESCE(t.revenue, 0) AS revenue,
       COALESCE(t.sold_quantity, 0) AS sold_quantity,
       CASE WHEN COALESCE(t.order_count, 0) > 0 THEN t.revenue / t.order_count END AS average_order_amount
FROM custs c FULL JOIN totals t ON c.product_id = t.product_id""",
    "q_hour_labels": with_(TIMED.replace("ts AS ordered_at", "CASE WHEN event_id % 9 <> 0 THEN ts END AS ordered_at"), HOURLY) + """
SELECT *, CASE WHEN order_hour IS NULL THEN '시간 정보 없음'
               ELSE printf('%02d:00–%02d:59', order_hour, order_hour) END AS hour_label
FROM by_hour""",
    "q_category_labels": with_(LINES, SPARSE, BY_CATEGORY.replace("JOIN products p", "JOIN sparse p")) + """
SELECT *, CASE WHEN category IS NULL OR category = '' THEN '미분류' ELSE category END AS category_label
FROM by_category""",
    "q_display_names": with_(TIMED, SPARSE, DASH_PRODUCTS.replace("JOIN products p", "JOIN sparse p").replace("FROM products p", "FROM sparse p")) + """
SELECT product_id,
       COALESCE(NULLIF(product_name, ''), NULLIF(name, ''), CAST(product_id AS VARCHAR)) AS display_name,
       order_count,
       CASE WHEN order_count > 0 THEN """ + half_up("average_order_amount") + """ END AS average_shown
FROM dash""",
    "q_menu_kind": with_(PRODUCTS) + """
SELECT product_id, name, category,
       CASE WHEN contains(name, 'blue') OR contains(name, 'red') THEN 'juice'
            WHEN contains(name, 'ring') OR contains(name, 'gear') THEN 'cake'
            WHEN category = 'PROMO' THEN 'bakery'
            WHEN category = 'SMALL' THEN 'drink'
            ELSE 'other' END AS menu_kind
FROM products""",
    "q_sample_orders": with_(ORDERS) + f"""
SELECT order_id, product_id, quantity, unit_price, strftime(ordered_at, {SECONDS}) AS ordered_at,
       amount, CAST(order_date AS VARCHAR) AS order_date
FROM {SAMPLE}""",
    "q_orders_on_day": with_(ORDERS) + f"""
SELECT order_id, product_id, quantity, unit_price, strftime(ordered_at, {SECONDS}) AS ordered_at,
       amount, CAST(order_date AS VARCHAR) AS order_date
FROM ords WHERE order_date = DATE '1995-06-01'""",
    "q_point_lookup": with_(ORDERS) + "SELECT order_id, quantity, amount FROM ords WHERE order_id = 1",
    "q_sample_sales_by_day": with_(ORDERS) + f"""
SELECT CAST(order_date AS VARCHAR) AS order_date, CAST(SUM(amount) AS BIGINT) AS revenue
FROM ords GROUP BY order_date""",
    "q_sample_sales_by_product": with_(ORDERS, CUSTOMERS) + f"""
SELECT s.product_id, c.name AS product_name, COUNT(*) AS order_count, CAST(SUM(s.amount) AS BIGINT) AS revenue
FROM ords s JOIN custs c ON s.product_id = c.product_id
GROUP BY s.product_id, c.name""",
}

KEY_SUMMARY = with_(LINES) + """
SELECT product_id, COUNT(*) AS order_count, CAST(SUM(amount) AS BIGINT) AS revenue,
       CAST(SUM(amount) AS BIGINT) / COUNT(*) AS average_order_amount
FROM lines GROUP BY product_id"""

REVENUE_BY_PRODUCT = with_(LINES) + """
SELECT product_id, CAST(SUM(amount) AS BIGINT) AS revenue FROM lines GROUP BY product_id"""

SPLIT = "DATE '1998-01-01'"
ORDER_COLS = f"""order_id, product_id, quantity, unit_price, strftime(ordered_at, {SECONDS}) AS ordered_at,
       amount, CAST(order_date AS VARCHAR) AS order_date"""
UPDATED = """upd AS (
  SELECT order_id, product_id,
         CASE WHEN order_id = 1 THEN 2 ELSE quantity END AS quantity, unit_price, ordered_at,
         CASE WHEN order_id = 1 THEN unit_price * 2 ELSE amount END AS amount, order_date
  FROM ords)"""

REQS = r"""reqs AS (
  SELECT event_id AS request_id, CAST(user_id AS VARCHAR) AS product_id,
         CASE WHEN event_type = 'view' THEN k
              WHEN event_type = 'click' THEN ' ' || k || ' '
              WHEN event_type = 'purchase' THEN '-' || k
              WHEN event_type = 'signup' THEN k || '00000000'
              ELSE 'x' || k END AS quantity
  FROM (SELECT *, regexp_extract(props, '(\d+)', 1) AS k FROM events)),
menu AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS product_id, CAST(ROUND(s_acctbal * 100) AS BIGINT) AS unit_price
  FROM supplier),
checked AS (
  SELECT r.request_id, r.product_id, r.quantity, m.unit_price, m.product_id IS NOT NULL AS known,
         CASE WHEN regexp_full_match(regexp_replace(r.quantity, '^\s+|\s+$', '', 'g'), '[+-]?[0-9]+(_[0-9]+)*')
              THEN TRY_CAST(replace(regexp_replace(r.quantity, '^\s+|\s+$', '', 'g'), '_', '') AS INTEGER)
              END AS quantity_value
  FROM reqs r LEFT JOIN menu m ON r.product_id = m.product_id),
validated AS (
  SELECT *, reason IS NULL AS accepted FROM (
    SELECT *, CASE WHEN NOT known THEN 'unknown_product'
                   WHEN quantity_value BETWEEN 1 AND 2147483647 THEN NULL
                   ELSE 'bad_quantity' END AS reason
    FROM checked))"""

RECENT = """recent AS (
  SELECT o.product_id, o.order_id, o.quantity, o.unit_price, o.ordered_at, o.amount, o.order_date,
         c.name, c.category
  FROM (SELECT * FROM ords ORDER BY order_id DESC LIMIT 50) o JOIN custs c ON o.product_id = c.product_id)"""
RECENT_COLS = f"""CAST(row_number() OVER (ORDER BY order_id DESC) AS INTEGER) AS position, product_id, order_id, quantity, unit_price, strftime(ordered_at, {SECONDS}) AS ordered_at,
       amount, CAST(order_date AS VARCHAR) AS order_date, name, category"""

ISO = "strftime(ordered_at, '%Y-%m-%dT%H:%M:%S') || '+09:00'"

SQL.update({
    "q_benchmark_sales": with_(LINES) + """
SELECT product_id, CAST(GROUPING(product_id) AS INTEGER) AS is_total, COUNT(*) AS order_count,
       CAST(SUM(amount) AS BIGINT) AS revenue
FROM lines GROUP BY ROLLUP (product_id)""",
    "q_map_reduce_sales": KEY_SUMMARY,
    "q_partition_sizes": with_(LINES) + """
SELECT CAST(order_id % 8 AS INTEGER) AS partition_id, COUNT(*) AS "rows" FROM lines GROUP BY 1""",
    "q_partition_report": with_(LINES) + """
SELECT CAST(product_id % 8 AS INTEGER) AS partition_id, product_id, COUNT(*) AS "rows",
       row_number() OVER (ORDER BY product_id % 8, product_id) AS rank
FROM lines GROUP BY product_id""",
    "q_repartition_sales": REVENUE_BY_PRODUCT,
    "q_coalesce_sales": REVENUE_BY_PRODUCT,
    "q_keyed_partition_sales": with_(LINES) + """
SELECT product_id, CAST(1 AS INTEGER) AS partition_count, COUNT(*) AS order_count,
       CAST(SUM(amount) AS BIGINT) AS revenue
FROM lines GROUP BY product_id""",
    "q_versioned_overwrite": with_(ORDERS) + f"SELECT {ORDER_COLS} FROM ords",
    "q_versioned_append": with_(ORDERS) + f"SELECT {ORDER_COLS} FROM ords",
    "q_versioned_current": with_(ORDERS, UPDATED) + f"SELECT {ORDER_COLS} FROM upd",
    "q_versioned_update_sales": with_(ORDERS, UPDATED) + """
SELECT product_id, CAST(SUM(amount) AS BIGINT) AS revenue FROM upd GROUP BY product_id""",
    "q_versioned_update": with_(ORDERS) + """
SELECT COUNT(*) AS num_rows, COUNT(*) FILTER (WHERE order_id = 1) AS num_updated_rows FROM ords""",
    "q_validate_orders": with_(REQS) + """
SELECT request_id, product_id, quantity, quantity_value, accepted, reason FROM validated""",
    "q_price_snapshot": with_(REQS) + """
SELECT request_id, product_id, quantity_value AS quantity, unit_price,
       quantity_value * unit_price AS amount
FROM validated WHERE accepted""",
    "q_recent_orders": with_(ORDERS, CUSTOMERS, RECENT) + f"SELECT {RECENT_COLS} FROM recent",
    "q_recent_order_totals": with_(ORDERS, CUSTOMERS, RECENT) + """
SELECT COUNT(*) AS order_rows, CAST(SUM(quantity) AS BIGINT) AS quantity_total,
       CAST(SUM(amount) AS BIGINT) AS amount_total
FROM recent""",
    "q_received_order": with_(ORDERS, CUSTOMERS, RECENT) + f"""
SELECT * FROM (SELECT {RECENT_COLS} FROM recent)
WHERE order_id = (SELECT order_id FROM ords ORDER BY order_id DESC LIMIT 1 OFFSET 6)""",
    "q_order_search": with_(ORDERS, CUSTOMERS) + """
SELECT o.order_id, o.product_id, c.name, o.quantity, o.amount
FROM ords o JOIN custs c ON o.product_id = c.product_id
WHERE contains(lower(printf('%04d', o.order_id) || ' ' || CAST(o.order_id AS VARCHAR) || ' ' || c.name), '12')""",
    "q_menu_by_category": with_(PRODUCTS) + """
SELECT product_id, name, category, unit_price, row_number() OVER (ORDER BY product_id) AS rank
FROM products WHERE category = 'ECONOMY'""",
    "q_menu_categories": with_(SPARSE) + """
SELECT category, MIN(product_id) AS first_product_id, row_number() OVER (ORDER BY MIN(product_id), category) AS rank
FROM sparse WHERE category IS NOT NULL AND category <> '' GROUP BY category""",
    "q_export_orders": with_(ORDERS) + f"""
SELECT order_id, product_id, quantity, unit_price, {ISO} AS ordered_at FROM ords""",
    "q_export_products": with_(PRODUCTS) + """
SELECT product_id, name, category, row_number() OVER (ORDER BY product_id) AS rank FROM products""",
    "q_order_events": with_(ORDERS) + f"""
SELECT order_id, to_json({{'event_type': 'order.created', 'order_id': order_id, 'product_id': product_id,
       'quantity': quantity, 'unit_price': unit_price, 'amount': amount, 'ordered_at': {ISO}}})::VARCHAR AS event
FROM ords""",
    "q_order_items_decimal": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
       strftime(l_shipdate, {SECONDS}) AS shipping_limit_date,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS price,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS VARCHAR)
         AS freight_value
FROM lineitem""",
    "q_dashboard_doc": with_(LINES, PRODUCTS, BY_CATEGORY) + """
SELECT 'order_count' AS section, COUNT(*) AS "rows" FROM lines
UNION ALL SELECT 'preview', LEAST(COUNT(*), 10) FROM lines
UNION ALL SELECT 'by_product', COUNT(*) FROM products p
  LEFT JOIN (SELECT DISTINCT l.product_id, p2.name, p2.category FROM lines l
             JOIN products p2 ON l.product_id = p2.product_id) b ON p.product_id = b.product_id
UNION ALL SELECT 'by_day', COUNT(*) FROM (SELECT order_date FROM lines GROUP BY order_date)
UNION ALL SELECT 'page_views', COUNT(*) FROM (SELECT CAST(ts AS DATE) FROM events GROUP BY 1)
UNION ALL SELECT 'by_category', COUNT(*) FROM by_category
UNION ALL SELECT 'by_hour', COUNT(*) FROM (SELECT hour(ordered_at) FROM lines GROUP BY 1)""",
    "q_event_ingest": with_(ORDERS) + f"""
SELECT order_id, CAST(product_id AS VARCHAR) AS product_id, quantity, unit_price,
       strftime(ordered_at, {SECONDS}) AS ordered_at, amount, CAST(order_date AS VARCHAR) AS order_date
FROM ords""",
    "q_batch_products": with_(LINES, PRODUCTS) + """,
bp AS (
  SELECT l.product_id, p.name AS product_name, p.category, COUNT(*) AS order_count,
         CAST(SUM(l.amount) AS BIGINT) AS revenue, CAST(SUM(l.quantity) AS BIGINT) AS sold_quantity,
         CAST(SUM(l.amount) AS BIGINT) / COUNT(*) AS average_order_amount
  FROM lines l JOIN products p ON l.product_id = p.product_id
  GROUP BY l.product_id, p.name, p.category)
SELECT CAST(p.product_id AS VARCHAR) AS product_id, p.name, p.category,
       COALESCE(bp.product_name, p.name) AS product_name,
       COALESCE(bp.order_count, 0) AS order_count, COALESCE(bp.revenue, 0) AS revenue,
       COALESCE(bp.sold_quantity, 0) AS sold_quantity, bp.average_order_amount
FROM products p LEFT JOIN bp ON p.product_id = bp.product_id""",
    "q_refresh_counts": with_(ORDERS) + f"""
SELECT (SELECT COUNT(*) FROM ords WHERE order_date < {SPLIT}) AS before_count,
       (SELECT COUNT(*) FROM ords) AS after_count""",
})

SQL["q_csv_benchmark_sales"] = SQL["q_benchmark_sales"].replace("SELECT product_id,", "SELECT CAST(product_id AS VARCHAR) AS product_id,")
SQL["q_order_event_by_id"] = SQL["q_order_events"] + " WHERE order_id IN (1, -1)"
SQL["q_refresh_products"] = with_(ORDERS, CUSTOMERS) + """
SELECT CAST(c.product_id AS VARCHAR) AS product_id, COUNT(o.order_id) AS order_count,
       CAST(COALESCE(SUM(o.amount), 0) AS BIGINT) AS revenue, CAST(COALESCE(SUM(o.quantity), 0) AS BIGINT) AS sold_quantity
FROM custs c LEFT JOIN ords o ON c.product_id = o.product_id GROUP BY c.product_id"""
SQL["q_dashboard_rows"] = with_(LINES, PRODUCTS, BY_CATEGORY) + """,
all_rows AS (WITH hours AS (SELECT CAST(hour(ordered_at) AS VARCHAR) AS key, COUNT(*) AS order_count, CAST(SUM(amount) AS BIGINT) AS revenue FROM lines GROUP BY 1)
SELECT 'by_product' AS section, CAST(p.product_id AS VARCHAR) AS key, COUNT(l.order_id) AS order_count,
       CAST(COALESCE(SUM(l.amount), 0) AS BIGINT) AS revenue, CAST(COALESCE(SUM(l.quantity), 0) AS BIGINT) AS sold_quantity,
       CAST(NULL AS BIGINT) AS page_views, CAST(NULL AS DOUBLE) AS revenue_share_pct, CAST(NULL AS BIGINT) AS amount
FROM products p LEFT JOIN lines l ON p.product_id = l.product_id GROUP BY p.product_id
UNION ALL SELECT 'by_day', CAST(order_date AS VARCHAR), COUNT(*), CAST(SUM(amount) AS BIGINT), NULL, NULL, NULL, NULL FROM lines GROUP BY order_date
UNION ALL SELECT 'page_views', strftime(ts, '%Y-%m-%d'), NULL, NULL, NULL, COUNT(*), NULL, NULL FROM events GROUP BY 2
UNION ALL SELECT 'by_category', category, order_count, revenue, NULL, NULL, NULL, NULL FROM by_category
UNION ALL SELECT 'by_hour', key, order_count, revenue, NULL, NULL,
  """ + half_up("revenue / (SELECT CAST(SUM(revenue) AS BIGINT) FROM hours) * 100") + """, NULL FROM hours)
SELECT *, row_number() OVER (PARTITION BY section ORDER BY CASE WHEN section = 'by_hour' THEN CAST(key AS INTEGER) END, key) AS position FROM all_rows"""

SQL["q_update_files"] = with_(ORDERS) + """
SELECT COUNT(*) FILTER (WHERE order_id = 1) AS num_updated_rows, COUNT(*) FILTER (WHERE order_id <> 1) AS num_copied_rows,
       COUNT(DISTINCT order_id % 8) AS num_removed_files, COUNT(DISTINCT order_id % 8) AS num_added_files
FROM ords WHERE order_id % 8 IN (SELECT order_id % 8 FROM ords WHERE order_id = 1)"""
SQL["q_load_sequence"] = SQL["q_versioned_append"]
SQL["q_day_table_orders"] = SQL["q_orders_on_day"]
SQL["q_day_table_join"] = with_(ORDERS) + f"""
SELECT {ORDER_COLS} FROM ords WHERE strftime(order_date, '%Y-%m') = '1995-06' AND isodow(order_date) = 1"""
SQL["q_order_search_index"] = SQL["q_order_search"].replace("'12'", "'0012'")
SQL["q_point_lookup_filter"] = SQL["q_point_lookup"]
SQL["q_stored_join"] = SQL["q_enriched_orders"]
SQL["q_section_sizes"] = "SELECT * FROM (" + SQL["q_dashboard_doc"] + ") WHERE section <> 'order_count'"
CHANGED = """changed AS (
  SELECT * REPLACE (CASE WHEN order_id % 777 = 0 THEN quantity * 2 ELSE quantity END AS quantity,
                    CASE WHEN order_id % 777 = 0 THEN amount * 2 ELSE amount END AS amount)
  FROM ords WHERE order_id % 1000 <> 0)"""
SQL["q_incremental_periods"] = with_(ORDERS, CHANGED) + """,
months AS (SELECT strftime(order_date, '%Y-%m') AS month, BOOL_OR(order_id % 1000 = 0 OR order_id % 777 = 0) AS touched,
                  BOOL_OR(order_id % 1000 <> 0) AS stays FROM ords GROUP BY 1)
SELECT (SELECT COUNT(*) FROM ords) AS before_count, (SELECT COUNT(*) FROM changed) AS after_count,
       COUNT(*) FILTER (WHERE touched AND stays) AS changed_periods, COUNT(*) FILTER (WHERE NOT stays) AS vanished_periods FROM months"""
SQL["q_incremental_products"] = with_(ORDERS, CUSTOMERS, CHANGED) + """
SELECT c.product_id, c.name, c.category, c.name AS product_name, COUNT(o.order_id) AS order_count,
       CAST(COALESCE(SUM(o.amount), 0) AS BIGINT) AS revenue, CAST(COALESCE(SUM(o.quantity), 0) AS BIGINT) AS sold_quantity
FROM custs c LEFT JOIN changed o ON c.product_id = o.product_id GROUP BY c.product_id, c.name, c.category"""
SQL["q_quarantined_lines"] = with_(ORDERS, CUSTOMERS, REQUESTS) + f"""
SELECT 'orders' AS source, 'malformed_row' AS reason,
       order_id || ',' || product_id || ',two,' || unit_price || ',' || CASE WHEN order_id % 13 = 0 THEN 'soon' ELSE {ISO} END AS line
FROM ords WHERE order_id % 11 = 0
UNION ALL SELECT 'orders', 'bad_instant', 'soon' FROM ords WHERE order_id % 13 = 0 AND order_id % 11 <> 0
UNION ALL SELECT 'products', 'malformed_row', printf('{{"product_id":"%d","name":"%s"', product_id, name) FROM custs WHERE product_id % 7 = 0
UNION ALL SELECT 'access_log', CASE WHEN duration_ms = 3 THEN 'unmatched_line' ELSE 'bad_instant' END,
       CASE WHEN duration_ms = 3 THEN replace(line, ' ', ';') ELSE 'not-a-time' || substr(line, strpos(line, ' ')) END
FROM (SELECT *, strftime(requested_at, '%Y-%m-%dT%H:%M:%S') || '+09:00 ' || method || ' ' || path || ' ' || status || ' ' || duration_ms AS line FROM reqs)
WHERE duration_ms IN (3, 5)"""
SQL["q_clean_orders"] = with_(ORDERS) + f"""
SELECT order_id, CAST(product_id AS VARCHAR) AS product_id, quantity, unit_price,
       CASE WHEN order_id % 13 <> 0 THEN strftime(ordered_at, {SECONDS}) END AS ordered_at, amount,
       CASE WHEN order_id % 13 <> 0 THEN CAST(order_date AS VARCHAR) END AS order_date
FROM ords WHERE order_id % 11 <> 0"""

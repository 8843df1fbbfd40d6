"""Raw, dirty versions of the retail tables, all text, derived from the test tables.

Each view is one SQL text that Spark and DuckDB read alike. Defects (blank ids, mixed date
layouts, bad numbers, double loads) depend on key arithmetic only. ``seq`` is the load order.
"""

from __future__ import annotations


def text(value: str) -> str:
    return f"CAST({value} AS STRING)"


def two(value: str) -> str:
    return f"lpad({text(value)}, 2, '0')"


def dmy(day: str, sep: str) -> str:
    return f"{two(f'day({day})')} || '{sep}' || {two(f'month({day})')} || '{sep}' || {text(f'year({day})')}"


def clock(minutes: str, seconds: str) -> str:
    hour, minute = f"CAST(floor(({minutes}) / 60) AS INT)", f"({minutes}) % 60"
    return f"{two(hour)} || ':' || {two(minute)} || ':' || {two(seconds)}"


REGISTERED = "CAST(DATE '1995-01-01' + CAST(c_custkey % 640 AS INT) AS DATE)"
ORDERED = "CAST(o_orderdate AS DATE)"
MONEY = "CAST(CAST({0} AS DECIMAL(12,2)) AS STRING)"

CUSTOMER_COLUMNS = f"""
  CASE WHEN c_custkey % 97 = 5 THEN '' WHEN c_custkey % 97 = 6 THEN ' NULL ' ELSE 'C' || {text('c_custkey')} END
    AS customer_id,
  CASE c_custkey % 6 WHEN 0 THEN '  ' || upper(c_name) WHEN 1 THEN lower(c_name) || '  '
    WHEN 2 THEN replace(c_name, '#', '   # ') ELSE c_name END AS customer_name,
  CASE c_custkey % 50 WHEN 0 THEN 'user' || {text('c_custkey')} WHEN 1 THEN 'user' || {text('c_custkey')} || '@'
    WHEN 2 THEN 'n/a' WHEN 3 THEN ' User' || {text('c_custkey')} || '@Example.COM '
    ELSE 'user' || {text('c_custkey')} || '@mail.example.com' END AS email,
  CASE WHEN c_custkey % 16 = 3 THEN 'unknown' WHEN c_custkey % 8 = 0 THEN {dmy(REGISTERED, '-')}
    WHEN c_custkey % 8 = 1 THEN {dmy(REGISTERED, '/')} WHEN c_custkey % 8 = 2 THEN {text(REGISTERED)} || ' 08:30:00'
    ELSE {text(REGISTERED)} END AS registration_date,
  CASE c_custkey % 9 WHEN 0 THEN '  premium ' WHEN 1 THEN 'Vip' WHEN 2 THEN 'gold' WHEN 3 THEN '' ELSE 'REGULAR' END
    AS customer_type"""

PRODUCT_COLUMNS = f"""
  CASE WHEN p_partkey % 101 = 4 THEN '-' ELSE {text('p_partkey')} END AS product_id,
  CASE p_partkey % 7 WHEN 0 THEN '  ' || upper(p_name) WHEN 1 THEN p_name || ' ' WHEN 2 THEN replace(p_name, ' ', '   ')
    WHEN 3 THEN replace(p_name, ' ', '-') ELSE p_name END AS product_name,
  CASE p_partkey % 5 WHEN 0 THEN lower(p_type) WHEN 1 THEN 'non-fiction' ELSE p_type END AS category,
  lower(p_brand) || ' ' AS subcategory,
  CASE p_partkey % 60 WHEN 0 THEN '' WHEN 1 THEN '-5.00' WHEN 2 THEN 'abc' WHEN 3 THEN ' 12.50 '
    ELSE {MONEY.format('p_retailprice')} END AS cost_price"""

ORDER_COLUMNS = f"""
  CASE WHEN o_orderkey % 499 = 1 THEN '' ELSE {text('o_orderkey')} END AS order_id,
  CASE WHEN o_orderkey % 20 = 0 THEN '' WHEN o_orderkey % 20 = 1 THEN 'NULL' WHEN o_orderkey % 200 = 77
    THEN 'C999999999' ELSE 'C' || {text('o_custkey')} END AS customer_id,
  CASE WHEN o_orderkey % 300 = 3 THEN '2099-01-01 00:00:00' WHEN o_orderkey % 300 = 4 THEN 'not a date'
    WHEN o_orderkey % 25 = 0 THEN {dmy(ORDERED, '-')} WHEN o_orderkey % 25 = 1 THEN {text(ORDERED)}
    WHEN o_orderkey % 25 = 2 THEN {dmy(ORDERED, '-')} || ' 10:20:30'
    ELSE {text(ORDERED)} || ' 00:00:00' END AS order_date,
  CASE o_orderkey % 11 WHEN 0 THEN '  delivered ' WHEN 1 THEN 'Shipped' WHEN 2 THEN 'LOST' WHEN 3 THEN 'cancelled'
    WHEN 4 THEN 'RETURNED' WHEN 5 THEN '' ELSE 'PLACED' END AS status,
  CASE o_orderkey % 13 WHEN 0 THEN '' WHEN 1 THEN ' north ' ELSE 'SOUTH' END AS region_code"""

MARK = "(l_orderkey + l_linenumber)"
ITEM_COLUMNS = f"""
  CASE WHEN l_orderkey % 611 = 3 AND l_linenumber = 1 THEN '' ELSE 'I' || {text('l_orderkey')} || '-' ||
    {text('l_linenumber')} || '-' || {text('l_partkey')} || '-' || {text('l_suppkey')} END AS item_id,
  CASE WHEN l_orderkey % 301 = 2 THEN '900000000' WHEN l_orderkey % 303 = 3 THEN '' ELSE {text('l_orderkey')} END
    AS order_id,
  CASE WHEN l_partkey % 401 = 7 THEN 'P-none' ELSE {text('l_partkey')} END AS product_id,
  CASE WHEN {MARK} % 150 = 0 THEN '0' WHEN {MARK} % 150 = 1 THEN 'x' WHEN {MARK} % 150 = 2 THEN '3.0'
    WHEN l_returnflag = 'R' THEN '-' || {text('CAST(l_quantity AS INT)')} ELSE {text('CAST(l_quantity AS INT)')} END
    AS quantity,
  CASE WHEN {MARK} % 170 = 0 THEN ' -1' WHEN {MARK} % 170 = 1 THEN '' ELSE {MONEY.format('l_extendedprice')} END
    AS unit_price,
  CASE WHEN {MARK} % 90 = 0 THEN '150' WHEN {MARK} % 90 = 1 THEN '' WHEN {MARK} % 90 = 2 THEN '-3'
    ELSE CAST(CAST(l_discount * 100 AS DECIMAL(5,2)) AS STRING) END AS discount_percent"""

PICKUP, MINUTES = "(o_orderkey % 1200)", "(o_orderkey % 1200 + 10 + o_orderkey % 83)"

RAW_VIEWS = {
    "raw_customers_v": f"""
SELECT c_custkey * 2 AS seq, {CUSTOMER_COLUMNS} FROM customer
UNION ALL SELECT c_custkey * 2 + 1, {CUSTOMER_COLUMNS} FROM customer WHERE c_custkey % 40 = 7""",
    "raw_products_v": f"""
SELECT p_partkey * 2 AS seq, {PRODUCT_COLUMNS} FROM part
UNION ALL SELECT p_partkey * 2 + 1, {PRODUCT_COLUMNS} FROM part WHERE p_partkey % 45 = 9""",
    "raw_orders_v": f"""
SELECT o_orderkey * 2 AS seq, {ORDER_COLUMNS} FROM orders
UNION ALL SELECT o_orderkey * 2 + 1, {ORDER_COLUMNS} FROM orders WHERE o_orderkey % 70 = 11""",
    "raw_items_v": f"""
SELECT CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 200 AS BIGINT) AS seq, {ITEM_COLUMNS} FROM lineitem
UNION ALL SELECT CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 200 AS BIGINT) + 1, {ITEM_COLUMNS} FROM lineitem
  WHERE l_orderkey % 80 = 9 AND l_linenumber = 2""",
    # Grocery-style feed: orders, order items, customers and deliveries as they land in files.
    "feed_orders_v": f"""
SELECT {text('o_orderkey')} AS order_id,
  CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE {text('o_custkey')} END AS customer_id,
  {text(ORDERED)} || ' ' || {clock('o_orderkey % 1200', 'o_orderkey % 60')} AS order_date,
  ' city-' || {text('o_custkey % 12')} AS city, 'UPI ' AS payment_mode,
  CASE o_orderkey % 6 WHEN 0 THEN ' Returned' WHEN 1 THEN 'cancelled ' ELSE 'delivered' END AS status FROM orders""",
    "feed_items_v": f"""
SELECT 'I' || {text('l_orderkey')} || '-' || {text('l_linenumber')} || '-' || {text('l_partkey')} || '-' ||
    {text('l_suppkey')} || '-' || {MONEY.format('l_extendedprice')} AS item_id,
  {text('l_orderkey')} AS order_id, {text('l_partkey')} AS product_id, p_name AS product_name, p_type AS category,
  {text('CAST(l_quantity AS INT)')} AS qty, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) AS unit_price,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(CAST(l_discount * 100 AS DECIMAL(5,2)) AS STRING) END AS discount_pct
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "feed_customers_v": f"""
SELECT {text('c_custkey')} AS customer_id, ' ' || c_name || ' ' AS name,
  ' User' || {text('c_custkey')} || '@Example.com' AS email, ' 98' || lpad({text('c_custkey')}, 8, '0') AS phone,
  ' city-' || {text('c_custkey % 12')} AS city, {text(REGISTERED)} AS registered_on,
  {text('c_custkey % 900')} AS loyalty_points FROM customer""",
    "feed_deliveries_v": f"""
SELECT 'D' || {text('o_orderkey')} AS delivery_id, {text('o_orderkey')} AS order_id,
  'R' || {text('o_custkey % 90')} AS rider_id,
  {text(ORDERED)} || ' ' || {clock(PICKUP, 'o_orderkey % 7')} AS pickup_time,
  CASE WHEN o_orderkey % 9 = 2 THEN NULL
    ELSE {text(ORDERED)} || ' ' || {clock(MINUTES, 'o_orderkey % 59')} END AS delivery_time,
  ' zone-' || {text('o_custkey % 25')} AS zone, CAST(CAST(o_orderkey % 97 * 0.25 AS DECIMAL(6,2)) AS STRING) AS distance_km,
  CASE WHEN o_orderkey % 5 = 1 THEN 'Failed ' ELSE 'success' END AS status FROM orders""",
}
# The customer dimension as a snapshot file: double loads, late versions, blanks, odd casing.
def dimension_columns(key: str, sales: str, last_order: str, updated: str, home: str = "c_custkey % 7") -> str:
    return f"""
  CASE WHEN c_custkey % 211 = 1 THEN ' ' ELSE {text(key)} END AS customer_id,
  CASE c_custkey % 3 WHEN 0 THEN ' ' || c_name || '  Jr ' ELSE c_name END AS customer_name,
  CASE c_custkey % 5 WHEN 0 THEN '  ' || lower(c_mktsegment) WHEN 1 THEN '' ELSE c_mktsegment END AS segment,
  'United States' AS country,
  CASE WHEN c_custkey % 23 = 4 THEN ' ' ELSE 'new ' || lower(n_name) || '-' || {text(home)} END AS city,
  n_name AS state, lpad({text('c_custkey % 99999')}, 5, '0') AS postal_code,
  CASE WHEN c_custkey % 29 = 6 THEN '' ELSE upper(r_name) END AS region,
  CASE WHEN c_custkey % 41 = 2 THEN 'many' ELSE {text('c_custkey % 40')} END AS total_orders,
  {MONEY.format(sales)} AS total_sales, CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 0.1 AS STRING) AS total_profit,
  {last_order} AS last_order_date,
  CASE WHEN c_custkey % 6 = 5 THEN '' ELSE 'gold ' END AS loyalty_tier,
  CASE WHEN c_custkey % 10 = 9 THEN '' ELSE ' User' || {text('c_custkey')} || '@Example.com' END AS email,
  {updated} AS record_updated_at"""


HOMES = "FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
LAST_ORDER = text("CAST(DATE '2018-01-01' + CAST(c_custkey % 700 AS INT) AS DATE)")
SNAPSHOT_AT, BATCH_AT = "2019-12-31 22:00:00", "2020-01-15 06:30:00"
SNAPSHOT = dimension_columns("c_custkey", "c_acctbal", LAST_ORDER, f"'{SNAPSHOT_AT}'")
CHANGED = dimension_columns("c_custkey", "c_acctbal + 100", "'2020-01-15'", f"'{BATCH_AT}'", "c_custkey % 4")
ADDED = dimension_columns("c_custkey + 10000000", "c_acctbal", "'2020-01-15'", f"'{BATCH_AT}'")
RAW_VIEWS["raw_dimension_v"] = f"""
SELECT {SNAPSHOT} {HOMES}
UNION ALL SELECT {SNAPSHOT} {HOMES} WHERE c_custkey % 19 = 3
UNION ALL SELECT {dimension_columns('c_custkey', 'c_acctbal + 7', LAST_ORDER, "'2019-11-30 22:00:00'")} {HOMES}
  WHERE c_custkey % 31 = 5"""
RAW_VIEWS["raw_feed_v"] = f"""
SELECT {CHANGED} {HOMES} WHERE c_custkey % 7 = 0
UNION ALL SELECT {SNAPSHOT} {HOMES} WHERE c_custkey % 11 = 0 AND c_custkey % 7 <> 0
UNION ALL SELECT {ADDED} {HOMES} WHERE c_custkey % 50 = 0
UNION ALL SELECT {CHANGED} {HOMES} WHERE c_custkey % 77 = 0"""

TABLES_OF = {
    "raw_dimension_v": ["customer", "nation", "region"],
    "raw_feed_v": ["customer", "nation", "region"],
    "raw_customers_v": ["customer"],
    "raw_products_v": ["part"],
    "raw_orders_v": ["orders"],
    "raw_items_v": ["lineitem"],
    "feed_orders_v": ["orders"],
    "feed_items_v": ["lineitem", "part"],
    "feed_customers_v": ["customer"],
    "feed_deliveries_v": ["orders"],
}

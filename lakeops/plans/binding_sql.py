"""The binding views as SQL text, put in front of each query's own SQL."""

from __future__ import annotations

from lakeops.plans.binding import LINE_REVENUE, SHIP_MODE, STATUS
from lakeops.plans.binding_raw import RAW_VIEWS

VIEWS = f"""
customers_v AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 640 AS INT) AS DATE) AS registration_date
  FROM customer),
places_v AS (
  SELECT c_custkey AS buyer_id, n_name AS state, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
products_v AS (
  SELECT p_partkey AS product_id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
         p_type AS category, p_brand AS subcategory, CAST(p_retailprice AS DECIMAL(12,2)) AS cost_price
  FROM part),
orders_v AS (
  SELECT o_orderkey AS order_id, o_custkey AS buyer_id,
         CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         o_orderdate AS order_date, CAST(o_orderdate AS DATE) AS order_day, {STATUS} AS status
  FROM orders),
items_v AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, l_suppkey AS supplier_id,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity,
         {LINE_REVENUE} AS line_revenue
  FROM lineitem),
lines_v AS (
  SELECT i.*, o.buyer_id, o.customer_id, o.order_date, o.order_day, o.status,
         p.product_name, p.category, p.subcategory
  FROM items_v i JOIN orders_v o ON o.order_id = i.order_id JOIN products_v p ON p.product_id = i.product_id),
revenue_v AS (SELECT * FROM lines_v WHERE status <> 'CANCELLED'),
wide_v AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, l_suppkey AS supplier_id,
         CAST(l_shipdate AS DATE) AS ship_date, {SHIP_MODE} AS ship_mode,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS sales, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(CAST(l_discount AS DECIMAL(4,2)) * 5 AS DECIMAL(4,2)) AS discount,
         o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, c_name AS customer_name,
         CASE WHEN l_orderkey % 5 = 0 THEN 'HOUSEHOLD' ELSE c_mktsegment END AS segment,
         n_name AS state, r_name AS region, n_name || '-' || CAST(l_orderkey % 3 AS VARCHAR) AS city,
         p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name, p_type AS category, p_brand AS sub_category,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
              - CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS BIGINT) AS DECIMAL(18,2)) AS profit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey),
catalogue_v AS (
  SELECT p_partkey AS product_id, p_name AS title, p_type AS category,
         CAST(p_retailprice * 1.25 AS DECIMAL(12,2)) AS initial_price,
         '"₹' || regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR),
                                '(\\d)(\\d{{3}}\\.)', '\\1,\\2') || '"' AS final_price,
         CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size * 2 END AS discount,
         CAST(CAST(p_partkey * 7 % 51 AS DECIMAL(4,1)) * 0.1 AS DECIMAL(3,1)) AS rating,
         p_partkey * 37 % 1009 AS ratings_count,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS seller_name
  FROM part),
deliveries_v AS (
  SELECT delivery_id, CAST(order_id AS BIGINT) AS order_id, CAST(pickup_time AS TIMESTAMP) AS pickup_time,
         CAST(delivery_time AS TIMESTAMP) AS delivery_time, lower(trim(status)) AS status
  FROM feed_deliveries_v)
"""
VIEWS = ",".join(f"\n{name} AS ({sql})" for name, sql in RAW_VIEWS.items()) + "," + VIEWS


def with_binding(sql: str) -> str:
    """Put the views before ``sql``; its own WITH clause, if any, continues the list."""
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {VIEWS.strip()},\n{body[5:]}"
    return f"WITH {VIEWS.strip()}\n{body}"

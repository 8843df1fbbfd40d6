"""Registered queries: bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import money
from lakeops.plans import medallion
from lakeops.plans.catalog.retail import avg, pct
from lakeops.plans.registry import query
from lakeops.plans.runner import run_stages, run_together
from lakeops.session import scratch_path
from lakeops.sources import files

LAYERS = """
si AS (SELECT item_id, order_id, product_id, product_name, category, CAST(qty AS INT) AS qty,
              CAST(unit_price AS DECIMAL(10,2)) AS unit_price, CAST(discount_pct AS DECIMAL(5,2)) AS discount_pct,
              CAST(ROUND(CAST(qty AS INT) * CAST(unit_price AS DECIMAL(10,2)) *
                (100 - COALESCE(CAST(discount_pct AS DECIMAL(5,2)), 0)) * 0.01, 2) AS DECIMAL(10,2)) AS net_price,
              CAST(ROUND(CAST(qty AS INT) * CAST(unit_price AS DECIMAL(10,2)) *
                COALESCE(CAST(discount_pct AS DECIMAL(5,2)), 0) * 0.01, 2) AS DECIMAL(10,2)) AS discount_amount
       FROM (SELECT DISTINCT * FROM feed_items_v)),
so AS (SELECT o.order_id, customer_id, CAST(order_date AS TIMESTAMP) AS order_date, trim(city) AS city,
              trim(payment_mode) AS payment_mode, lower(trim(status)) AS status,
              COALESCE(t.total, 0) AS order_total, COALESCE(t.disc, 0) AS total_discount
       FROM feed_orders_v o LEFT JOIN (SELECT order_id, SUM(net_price) AS total, SUM(discount_amount) AS disc
                                       FROM si GROUP BY 1) t ON t.order_id = o.order_id),
sc AS (SELECT customer_id, trim(name) AS name, sha256(lower(trim(email))) AS email_hash,
              sha256(trim(phone)) AS phone_hash, trim(city) AS city, CAST(registered_on AS DATE) AS registered_on,
              CAST(loyalty_points AS INT) AS loyalty_points FROM feed_customers_v),
sd AS (SELECT delivery_id, order_id, rider_id, CAST(pickup_time AS TIMESTAMP) AS pickup_time,
              CAST(delivery_time AS TIMESTAMP) AS delivery_time, trim(zone) AS zone,
              CAST(distance_km AS DOUBLE) AS dist_km, lower(trim(status)) AS status,
              CAST(ROUND(CAST(epoch(CAST(delivery_time AS TIMESTAMP)) - epoch(CAST(pickup_time AS TIMESTAMP))
                AS DECIMAL(20,0)) / 60.0, 2) AS DOUBLE) AS delivery_duration_mins,
              delivery_time IS NULL OR lower(trim(status)) <> 'success' AS is_incomplete FROM feed_deliveries_v),
gd AS (SELECT CAST(order_date AS DATE) AS order_day, city, SUM(order_total) AS s, COUNT(DISTINCT order_id) AS n
       FROM so WHERE status <> 'cancelled' GROUP BY 1, 2),
gp AS (SELECT category, product_id, product_name, CAST(SUM(qty) AS BIGINT) AS total_units_sold,
              COUNT(DISTINCT order_id) AS total_orders,
              CAST(SUM(CASE WHEN status = 'returned' THEN qty ELSE 0 END) AS BIGINT) AS returned_units,
              COUNT(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS returned_orders
       FROM si JOIN (SELECT order_id, status FROM so) USING (order_id) GROUP BY 1, 2, 3),
gz AS (SELECT zone, COUNT(*) AS total_deliveries, COUNT(*) FILTER (status = 'success') AS successful_deliveries,
              COUNT(*) FILTER (status <> 'success') AS failed_deliveries,
              SUM(CASE WHEN status = 'success' THEN CAST(delivery_duration_mins AS DECIMAL(14,2)) END) AS mins,
              COUNT(CASE WHEN status = 'success' THEN delivery_duration_mins END) AS timed,
              SUM(CAST(dist_km AS DECIMAL(14,4))) AS km FROM sd GROUP BY 1),
gc AS (SELECT customer_id, COUNT(DISTINCT order_id) AS n, SUM(order_total) AS s, MAX(order_date) AS last_order_date
       FROM so WHERE customer_id IS NOT NULL AND customer_id <> '' AND status <> 'cancelled' GROUP BY 1)
"""


def layers(body: str) -> str:
    return f"WITH {LAYERS.strip()}\n{body.strip()}"


FEED_VIEWS = {
    "raw_orders": "feed_orders_v",
    "raw_order_items": "feed_items_v",
    "raw_customers": "feed_customers_v",
    "raw_delivery_logs": "feed_deliveries_v",
}


def doubles(df, *names):
    return df.withColumns({name: money.as_double(F.col(name)) for name in names})


def land(t) -> str:
    """Write the feed as files, the way a source system drops them, and return the folder."""
    root = scratch_path(t.spark, "landing")
    tables = {name: t.view(view) for name, view in FEED_VIEWS.items()}
    by_city = tables["raw_orders"].withColumn("part", F.trim("city"))
    run_together(
        [
            lambda: files.csv_options(tables["raw_order_items"].write).csv(f"{root}/order_items"),
            lambda: files.csv_options(by_city.write.partitionBy("part")).csv(f"{root}/orders"),
            lambda: files.csv_options(tables["raw_delivery_logs"].write).csv(f"{root}/delivery"),
            # A few MB a file: many small ones cost more to make, list and open than to read.
            lambda: write_json_arrays(tables["raw_customers"], "customer_id", f"{root}/customers", 20_000),
        ]
    )
    return root


def write_json_arrays(df, key: str, path: str, rows_per_file: int = 500) -> None:
    """Files with one JSON array each, of at most ``rows_per_file`` objects with different keys."""
    place = F.floor(F.col(key).cast("bigint") / rows_per_file).alias("part")
    arrays = df.groupBy(place).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query(
    "g01_bronze_rows",
    """
    SELECT 'raw_orders' AS "table", COUNT(*) AS rows, COUNT(*) AS stamped, 8 AS columns FROM feed_orders_v
    UNION ALL SELECT 'raw_order_items', COUNT(*), COUNT(*), 10 FROM feed_items_v
    UNION ALL SELECT 'raw_customers', COUNT(*), COUNT(*), 9 FROM feed_customers_v
    UNION ALL SELECT 'raw_delivery_logs', COUNT(*), COUNT(*), 10 FROM feed_deliveries_v""",
)
def g01(t):
    whole = None
    for name, df in medallion.bronze(t.spark, land(t)).items():
        stamped = F.col("_ingested_date").isNotNull() & F.col("_source_file").contains(":/")
        row = df.agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(stamped).alias("stamped"),
            F.lit(len(df.columns)).alias("columns"),
        )
        whole = row if whole is None else whole.unionByName(row)
    return whole


@query(
    "g02_silver_order_items",
    layers(
        "SELECT item_id, order_id, product_id, product_name, category, qty, CAST(unit_price AS DOUBLE) AS unit_price,"
        " CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(net_price AS DOUBLE) AS net_price,"
        " CAST(discount_amount AS DOUBLE) AS discount_amount FROM si"
    ),
)
def g02(t):
    items = medallion.silver_order_items(t.landed("feed_items_v"))
    return doubles(items, "unit_price", "discount_pct", "net_price", "discount_amount")


def _orders(t):
    items = medallion.silver_order_items(t.landed("feed_items_v"))
    return medallion.silver_orders(t.landed("feed_orders_v"), items)


def _customers(t):
    return medallion.silver_customers(t.landed("feed_customers_v"))


def _deliveries(t):
    return medallion.silver_deliveries(t.landed("feed_deliveries_v"))


@query(
    "g03_silver_orders",
    layers(
        "SELECT order_id, customer_id, order_date, city, payment_mode, status, CAST(order_total AS DOUBLE) AS order_total,"
        " CAST(total_discount AS DOUBLE) AS total_discount FROM so"
    ),
)
def g03(t):
    return doubles(_orders(t), "order_total", "total_discount")


@query("g04_silver_customers", layers("SELECT * FROM sc"))
def g04(t):
    return _customers(t)


@query("g05_silver_delivery_logs", layers("SELECT * FROM sd"))
def g05(t):
    return _deliveries(t)


DAILY = layers(
    f"SELECT order_day, city, CAST(s AS DOUBLE) AS total_revenue, n AS total_orders, {avg('s', 'n')} AS avg_basket_size FROM gd"
)


@query("g06_daily_revenue_by_city", DAILY)
def g06(t):
    return doubles(medallion.daily_revenue_by_city(_orders(t)), "total_revenue", "avg_basket_size")


RATE = pct("returned_units", "CASE WHEN total_units_sold = 0 THEN 1 ELSE total_units_sold END")


@query("g07_product_return_summary", layers(f"SELECT *, {RATE} AS return_rate_pct FROM gp"))
def g07(t):
    items = medallion.silver_order_items(t.landed("feed_items_v"))
    return medallion.product_return_summary(items, medallion.silver_orders(t.landed("feed_orders_v"), items))


ZONES = f"""
    SELECT zone, total_deliveries, successful_deliveries, failed_deliveries, {avg('mins', 'timed')} AS avg_delivery_time_mins,
           {avg('km', 'total_deliveries')} AS avg_distance_km, {pct('failed_deliveries', 'total_deliveries')} AS failure_rate_pct
    FROM gz"""


@query("g08_delivery_zone_performance", layers(ZONES))
def g08(t):
    return medallion.delivery_zone_performance(_deliveries(t))


SUMMARY = f"""
    SELECT sc.customer_id, name, city, registered_on, loyalty_points, COALESCE(n, 0) AS total_orders,
           CAST(COALESCE(s, 0) AS DOUBLE) AS total_spend, COALESCE({avg('s', 'n')}, 0) AS avg_order_value, last_order_date
    FROM sc LEFT JOIN gc ON gc.customer_id = sc.customer_id"""


@query("g09_customer_summary", layers(SUMMARY))
def g09(t):
    summary = medallion.customer_summary(_customers(t), _orders(t))
    return doubles(summary, "total_spend", "avg_order_value")


@query("g10_serve_daily_revenue", DAILY)
def g10_daily(t):
    served = medallion.serve("daily_revenue_by_city", medallion.daily_revenue_by_city(_orders(t)))
    return doubles(served, "total_revenue", "avg_basket_size")


@query(
    "g10_serve_product_returns",
    layers(
        f"SELECT category, product_id, product_name, total_units_sold, returned_units, {RATE} AS return_rate_pct FROM gp"
    ),
)
def g10_products(t):
    return medallion.serve("product_return_summary", g07(t))


@query("g10_serve_delivery_zones", layers(f"SELECT * EXCLUDE avg_distance_km FROM ({ZONES})"))
def g10_zones(t):
    return medallion.serve("delivery_zone_performance", g08(t))


@query("g10_serve_customers", layers(f"SELECT * EXCLUDE registered_on FROM ({SUMMARY})"))
def g10_customers(t):
    return medallion.serve("customer_summary", g09(t))


@query("s22_pipeline_in_order", DAILY)
def s22(t):
    """All three layers through files, then the first gold table as stored."""
    lake = scratch_path(t.spark, "lake")
    run_stages(medallion.stages(t.spark, land(t), lake))
    stored = files.read_table(t.spark, f"{lake}/gold/daily_revenue_by_city")
    return doubles(stored, "total_revenue", "avg_basket_size")

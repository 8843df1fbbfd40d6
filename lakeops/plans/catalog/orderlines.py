"""Registered queries: order-line analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import money
from lakeops.operators import windows
from lakeops.plans import orderlines as lines
from lakeops.plans.binding import cents
from lakeops.plans.catalog.retail import avg, pct
from lakeops.plans.registry import query
from lakeops.session import stable

CUSTOMERS = "WITH ct AS (SELECT customer_id, customer_name, SUM(sales) AS total FROM wide_v GROUP BY ALL)"


def _orders(t):
    return t.raw("orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS order_date"
    )


def _totals(t):
    return lines.customer_totals(t.wide_items, _orders(t))


def _named(t, df):
    names = t.raw("customer").selectExpr("c_custkey AS customer_id", "c_name AS customer_name")
    return df.join(names, "customer_id")


def _amounts(*names):
    return [money.amount(F.col(name)).alias(name) for name in names]


def _doubles(*names):
    return [money.as_double(F.col(name)).alias(name) for name in names]


@query(
    "d01_large_orders_in_region",
    "SELECT order_id, customer_name, CAST(sales AS DOUBLE) AS sales, region FROM wide_v"
    " WHERE region = 'ASIA' AND sales > 1000 ORDER BY wide_v.sales DESC, order_id, customer_name LIMIT 10",
)
def d01(t):
    found = t.wide("order", "customer", "place").filter((F.col("region") == "ASIA") & (F.col("sales") > 1000_00))
    best = lines.largest(found.select("order_id", "customer_name", "sales", "region"), 10,
                         ["-sales", "order_id", "customer_name"])
    return best.select("order_id", "customer_name", *_amounts("sales"), "region")


@query(
    "d02_category_in_year",
    "SELECT COUNT(*) AS line_count, CAST(SUM(sales) AS DOUBLE) AS total_sales FROM wide_v"
    " WHERE category = 'PROMO' AND order_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
)
def d02(t):
    in_year = F.col("order_date").between(F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date"))
    found = t.wide("order", "product").filter((F.col("category") == "PROMO") & in_year)
    return found.agg(F.count(F.lit(1)).alias("line_count"), money.amount(F.sum("sales")).alias("total_sales"))


@query(
    "d03_discounted_losses",
    """
    SELECT order_id, customer_name, category, sub_category, CAST(discount AS DOUBLE) AS discount,
           CAST(profit AS DOUBLE) AS profit
    FROM wide_v WHERE discount > 0.3 AND profit < 0
    ORDER BY wide_v.discount DESC, wide_v.profit, order_id LIMIT 10""",
)
def d03(t):
    found = t.wide("order", "customer", "product").filter("discount > 0.3 AND profit < 0")
    cols = ["order_id", "customer_name", "category", "sub_category", "discount", "profit"]
    best = lines.largest(found.select(*cols), 10, ["-discount", "profit", "order_id"])
    return best.select(*cols[:4], *_doubles("discount"), *_amounts("profit"))


TOTALS_SQL = f"""CAST(SUM(sales) AS DOUBLE) AS total_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
    {avg('SUM(sales)', 'COUNT(*)')} AS avg_sale, COUNT(*) AS num_lines"""


@query("d04_category_totals", f"SELECT category, {TOTALS_SQL} FROM wide_v GROUP BY 1")
def d04(t):
    return lines.group_totals(t.wide("product"), "category")


@query(
    "d05_region_category_totals",
    "SELECT region, category, CAST(SUM(sales) AS DOUBLE) AS total_sales FROM wide_v GROUP BY 1, 2",
)
def d05(t):
    grouped = lines.group_totals(t.wide("order", "place", "product"), "region", "category")
    return grouped.select("region", "category", "total_sales").orderBy("region", F.col("total_sales").desc())


@query(
    "d06_segment_sales_and_profit",
    "SELECT segment, CAST(SUM(sales) AS DOUBLE) AS total_sales, CAST(SUM(profit) AS DOUBLE) AS total_profit"
    " FROM wide_v GROUP BY 1",
)
def d06(t):
    per_order = t.wide("product").groupBy("order_id").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    return lines.sales_and_profit(per_order.join(t.placed("customer"), "order_id"), "segment")


@query(
    "d07_top_products",
    "SELECT product_name, CAST(SUM(sales) AS DOUBLE) AS total_sales FROM wide_v GROUP BY 1"
    " ORDER BY SUM(sales) DESC, product_name LIMIT 10",
)
def d07(t):
    totals = t.wide_items.groupBy("product_id").agg(F.sum("sales").alias("total_sales"))
    named = totals.join(t.products.select("product_id", "product_name"), "product_id")
    best = lines.largest(named.select("product_name", "total_sales"), 10, ["-total_sales", "product_name"])
    return best.select("product_name", *_amounts("total_sales"))


@query(
    "d08_top_subcategories_by_profit",
    "SELECT sub_category, CAST(SUM(profit) AS DOUBLE) AS total_profit FROM wide_v GROUP BY 1"
    " ORDER BY SUM(profit) DESC, sub_category LIMIT 10",
)
def d08(t):
    totals = t.wide("product").groupBy("sub_category").agg(F.sum("profit").alias("total_profit"))
    return lines.largest(totals, 10, ["-total_profit", "sub_category"]).select("sub_category", *_amounts("total_profit"))


@query(
    "d09_ship_modes",
    f"SELECT ship_mode, COUNT(*) AS num_lines, {avg('SUM(sales)', 'COUNT(*)')} AS avg_sale FROM wide_v GROUP BY 1",
)
def d09(t):
    return lines.group_totals(t.wide_items, "ship_mode").select("ship_mode", "num_lines", "avg_sale")


@query(
    "d10_monthly_trend",
    "SELECT year(order_date) AS yr, month(order_date) AS mo, CAST(SUM(sales) AS DOUBLE) AS total_sales"
    " FROM wide_v GROUP BY 1, 2",
)
def d10(t):
    return lines.monthly_trend(_orders(t), t.wide_items).orderBy("yr", "mo")


@query(
    "d10_best_months",
    "SELECT year(order_date) AS yr, month(order_date) AS mo, CAST(SUM(sales) AS DOUBLE) AS total_sales"
    " FROM wide_v GROUP BY 1, 2 ORDER BY SUM(sales) DESC, yr, mo LIMIT 5",
)
def d10_best(t):
    return lines.largest(lines.monthly_trend(_orders(t), t.wide_items), 5, ["-total_sales", "yr", "mo"])


@query(
    "d11_top_customers_by_spend",
    "SELECT customer_name, CAST(SUM(sales) AS DOUBLE) AS total_spent, COUNT(DISTINCT order_id) AS num_orders"
    " FROM wide_v GROUP BY customer_id, customer_name ORDER BY SUM(sales) DESC, customer_id LIMIT 10",
)
def d11(t):
    best = lines.largest(_totals(t), 10, ["-total", "customer_id"])
    return _named(t, best).select("customer_name", money.amount(F.col("total")).alias("total_spent"), "num_orders")


@query(
    "d12_lines_above_average",
    "SELECT order_id, line_no, product_id, CAST(sales AS DOUBLE) AS sales FROM wide_v WHERE CAST(sales AS DOUBLE) >"
    " (SELECT CAST(SUM(sales) AS DOUBLE) / COUNT(*) FROM wide_v)",
)
def d12(t):
    return lines.above_average_lines(t.wide_items).select("order_id", "line_no", "product_id", *_amounts("sales"))


@query(
    "d13_highest_sale_per_customer",
    "SELECT customer_id, customer_name, order_id, CAST(sales AS DOUBLE) AS sales FROM wide_v w WHERE sales ="
    " (SELECT MAX(x.sales) FROM wide_v x WHERE x.customer_id = w.customer_id)",
)
def d13(t):
    found = _named(t, lines.highest_sale_lines(t.wide_items, _orders(t)))
    return found.select("customer_id", "customer_name", "order_id", *_amounts("sales"))


@query(
    "d14_total_per_customer",
    f"{CUSTOMERS} SELECT customer_id, customer_name, CAST(total AS DOUBLE) AS total_sales FROM ct",
)
def d14(t):
    return _named(t, _totals(t)).select(
        "customer_id", "customer_name", money.amount(F.col("total")).alias("total_sales")
    )


@query(
    "d15_customers_above_average",
    f"{CUSTOMERS} SELECT customer_id, customer_name, CAST(total AS DOUBLE) AS total_sales FROM ct"
    " WHERE CAST(total AS DOUBLE) > (SELECT CAST(SUM(total) AS DOUBLE) / COUNT(*) FROM ct)",
)
def d15(t):
    return _named(t, lines.above_average_customers(_totals(t))).select(
        "customer_id", "customer_name", money.amount(F.col("total")).alias("total_sales")
    )


@query(
    "d16_customer_rank",
    f"{CUSTOMERS} SELECT customer_name, CAST(total AS DOUBLE) AS total_sales,"
    " rank() OVER (ORDER BY total DESC) AS sales_rank FROM ct",
)
def d16(t):
    placed = windows.ranked(stable(_totals(t)), ["-total"], rank="sales_rank")
    return _named(t, placed).select(
        "customer_name", money.amount(F.col("total")).alias("total_sales"), "sales_rank"
    )


@query(
    "d17_line_number_in_customer",
    """
    SELECT customer_id, order_id, line_no, CAST(sales AS DOUBLE) AS sales,
           row_number() OVER (PARTITION BY customer_id
                              ORDER BY w.sales DESC, order_id, line_no, product_id, supplier_id) AS line_no_in_customer
    FROM wide_v w""",
)
def d17(t):
    source = t.wide("order").select("customer_id", "order_id", "line_no", "product_id", "supplier_id", "sales")
    return lines.numbered_lines(source).select(
        "customer_id", "order_id", "line_no", *_amounts("sales"), "line_no_in_customer"
    )


@query(
    "d18_top_3_customers_by_rank",
    f"""{CUSTOMERS}, r AS (SELECT *, rank() OVER (ORDER BY total DESC) AS sales_rank FROM ct)
    SELECT customer_name, CAST(total AS DOUBLE) AS total_sales, sales_rank FROM r WHERE sales_rank <= 3""",
)
def d18(t):
    best = windows.top_by_rank(_totals(t), 3, "-total", "sales_rank")
    return _named(t, best).select(
        "customer_name", money.amount(F.col("total")).alias("total_sales"), "sales_rank"
    )


@query(
    "d19_top_and_bottom_5",
    f"""{CUSTOMERS}
    (SELECT 'top' AS side, customer_name, CAST(total AS DOUBLE) AS total_sales FROM ct
     ORDER BY total DESC, customer_id LIMIT 5)
    UNION ALL
    (SELECT 'bottom', customer_name, CAST(total AS DOUBLE) FROM ct ORDER BY total, customer_id LIMIT 5)""",
)
def d19(t):
    totals = _totals(t)
    top = lines.largest(totals, 5, ["-total", "customer_id"]).withColumn("side", F.lit("top"))
    bottom = lines.largest(totals, 5, ["total", "customer_id"]).withColumn("side", F.lit("bottom"))
    return _named(t, top.unionByName(bottom)).select(
        "side", "customer_name", money.amount(F.col("total")).alias("total_sales")
    )


@query(
    "d20_single_order_customers",
    """
    SELECT customer_name, COUNT(DISTINCT order_id) AS order_count
    FROM wide_v GROUP BY customer_id, customer_name
    HAVING COUNT(DISTINCT order_id) = 1""",
)
def d20(t):
    single = _totals(t).filter("num_orders = 1")
    return _named(t, single).select("customer_name", F.col("num_orders").alias("order_count"))


@query(
    "d21_highest_order_value",
    """
    WITH ov AS (SELECT customer_id, customer_name, order_id, SUM(sales) AS v FROM wide_v GROUP BY ALL)
    SELECT customer_name, CAST(MAX(v) AS DOUBLE) AS highest_order_value FROM ov GROUP BY customer_id, customer_name""",
)
def d21(t):
    return _named(t, _totals(t)).select("customer_name", money.amount(F.col("largest")).alias("highest_order_value"))


@query(
    "d22_region_average_per_category",
    f"SELECT category, {avg('SUM(sales)', 'COUNT(*)')} AS avg_sales FROM wide_v WHERE region = 'EUROPE' GROUP BY 1",
)
def d22(t):
    found = t.wide("order", "place", "product").filter(F.col("region") == "EUROPE")
    return lines.group_totals(found, "category").select("category", F.col("avg_sale").alias("avg_sales"))


SEGMENT_ROWS = (
    "SELECT customer_name, category, CAST(sales AS DOUBLE) AS sales, CAST(discount AS DOUBLE) AS discount FROM wide_v"
    " WHERE discount BETWEEN 0.1 AND 0.3 AND segment = 'BUILDING'"
)


@query("d23_segment_discount_rows", SEGMENT_ROWS)
def d23(t):
    found = t.wide("order", "customer", "product").filter(
        F.col("discount").between(0.1, 0.3) & (F.col("segment") == "BUILDING")
    )
    return found.select("customer_name", "category", *_amounts("sales"), *_doubles("discount"))


@query("d23_segment_discount_count", f"SELECT COUNT(*) AS matching_rows FROM ({SEGMENT_ROWS})")
def d23_count(t):
    return d23(t).agg(F.count(F.lit(1)).alias("matching_rows"))


@query(
    "d24_overall_statistics",
    f"""
    SELECT COUNT(sales) AS orders, CAST(SUM(sales) AS DOUBLE) AS total, {avg('SUM(sales)', 'COUNT(*)')} AS mean,
           CAST(MIN(sales) AS DOUBLE) AS lowest, CAST(MAX(sales) AS DOUBLE) AS highest FROM wide_v""",
)
def d24(t):
    return lines.overall_statistics(t.wide_items)


@query(
    "d25_busy_cities",
    "SELECT city, COUNT(*) AS num_lines FROM wide_v GROUP BY 1 HAVING COUNT(*) > 800",
)
def d25(t):
    per_city = t.weighted_orders("place").groupBy("city").agg(F.sum("num_lines").alias("num_lines"))
    return per_city.filter("num_lines > 800")


@query(
    "d26_state_revenue_after_dedupe",
    """
    WITH f AS (
      SELECT state, CASE WHEN sales > 90000 THEN NULL ELSE sales END AS sales,
             row_number() OVER (PARTITION BY order_id, product_id
                                ORDER BY line_no, supplier_id, w.sales) AS n FROM wide_v w)
    SELECT state, CAST(SUM(COALESCE(sales, 0)) AS DOUBLE) AS total_revenue FROM f WHERE n = 1 GROUP BY 1""",
)
def d26(t):
    source = t.wide_items.select("order_id", "product_id", "line_no", "supplier_id", "sales").withColumn(
        "paid", F.when(F.col("sales") <= 90000_00, F.col("sales"))
    )
    one = lines.keep_one_per(source, ["order_id", "product_id"], ["line_no", "supplier_id", "sales"]).fillna({"paid": 0})
    per_order = one.groupBy("order_id").agg(F.sum("paid").alias("paid"))
    placed = per_order.join(_orders(t), "order_id").join(
        t.places.withColumnRenamed("buyer_id", "customer_id"), "customer_id"
    )
    return placed.groupBy("state").agg(money.amount(F.sum("paid")).alias("total_revenue"))


@query(
    "d27_category_subcategory_metrics",
    f"""SELECT category, sub_category, CAST(SUM(sales) AS DOUBLE) AS total_sales,
    {avg('SUM(sales)', 'COUNT(*)')} AS avg_sale, COUNT(*) AS num_lines FROM wide_v GROUP BY 1, 2""",
)
def d27(t):
    return lines.group_totals(t.wide("product"), "category", "sub_category").drop("total_quantity")


@query(
    "d28_revenue_per_store",
    """
    WITH x AS (
      SELECT l_suppkey AS store_id, l_orderkey, l_partkey,
             CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS price,
             CAST(l_quantity AS BIGINT) AS quantity FROM lineitem)
    SELECT store_id, CAST(SUM(COALESCE(price, 0) * quantity) AS DOUBLE) AS total_revenue
    FROM (SELECT DISTINCT * FROM x) GROUP BY 1""",
)
def d28(t):
    source = t.raw("lineitem").selectExpr(
        "l_suppkey AS store_id", "l_orderkey", "l_partkey",
        f"CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE {cents('l_extendedprice')} END AS price",
        "CAST(l_quantity AS BIGINT) AS quantity",
    )
    # Every row lands twice, as after a double load; the copies must not count.
    return lines.store_revenue(source.unionAll(source), "store_id")


@query(
    "d29_spend_tiers",
    """
    WITH c AS (
      SELECT customer_id, customer_name, SUM(sales) AS total, COUNT(DISTINCT order_id) AS order_count
      FROM wide_v GROUP BY 1, 2),
    q AS (SELECT *, ntile(4) OVER (ORDER BY total DESC, customer_id) AS spend_quartile FROM c)
    SELECT customer_id, customer_name, CAST(total AS DOUBLE) AS total_sales, order_count, spend_quartile,
           CASE spend_quartile WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver' ELSE 'Bronze' END
             AS customer_tier FROM q""",
)
def d29(t):
    return _named(t, lines.spend_tiers(_totals(t))).select(
        "customer_id", "customer_name", money.amount(F.col("total")).alias("total_sales"),
        F.col("num_orders").alias("order_count"), "spend_quartile", "customer_tier",
    )


@query(
    "d30_loss_audit",
    f"""
    SELECT category, sub_category, COUNT(*) AS loss_lines, CAST(SUM(profit) AS DOUBLE) AS loss_amount,
           {avg('SUM(discount)', 'COUNT(*)')} AS avg_discount
    FROM wide_v WHERE profit < 0 GROUP BY 1, 2
    HAVING CAST(SUM(discount) AS DOUBLE) / COUNT(*) > 0.25""",
)
def d30(t):
    return lines.loss_audit(t.wide("product"), 0.25, "category", "sub_category")


@query(
    "d31_top_products_by_popularity",
    """
    SELECT product_id, title, category, CAST(rating AS DOUBLE) AS rating, ratings_count,
           CAST(ROUND(CAST(CAST(rating AS DOUBLE) * ln(1.0 + ratings_count) AS DECIMAL(30,8)), 4) AS DOUBLE) AS popularity
    FROM catalogue_v ORDER BY popularity DESC, product_id LIMIT 10""",
)
def d31(t):
    scored = t.catalogue.withColumn(
        "popularity", money.rounded(F.col("rating").cast("double") * F.log1p("ratings_count"), 4)
    )
    best = lines.largest(scored, 10, ["-popularity", "product_id"])
    return best.select("product_id", "title", "category", *_doubles("rating"), "ratings_count", "popularity")


@query(
    "a26_discount_tier_margins",
    f"""
    SELECT CASE WHEN discount <= 0.1 THEN '0-10%' WHEN discount <= 0.3 THEN '10-30%' ELSE '>30%' END AS discount_tier,
           COUNT(*) AS num_lines, CAST(SUM(sales) AS DOUBLE) AS sales, CAST(SUM(profit) AS DOUBLE) AS profit,
           {pct('SUM(profit)', 'SUM(sales)')} AS margin_percent
    FROM wide_v GROUP BY 1""",
)
def a26(t):
    return lines.discount_tier_margins(t.wide("product"))

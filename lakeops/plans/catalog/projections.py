"""Registered queries: projections, filters, scalar functions, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import dates, money, text
from lakeops.operators import windows
from lakeops.plans.catalog.retail import pct
from lakeops.plans.registry import query


def dec(name: str, kind: str = "decimal(15,2)"):
    return F.col(name).cast(kind)


# --- projections and filters ---------------------------------------------------------------


@query("p01_select_after_filter", "SELECT p_partkey, p_retailprice FROM part WHERE p_type = 'PROMO'")
def p01(t):
    return t.raw("part").filter(F.col("p_type") == "PROMO").select("p_partkey", "p_retailprice")


@query(
    "p02_taxed_price",
    "SELECT p_partkey, CAST(ROUND(CAST(p_retailprice AS DECIMAL(15,2)) * 1.18, 2) AS DOUBLE) AS final_price FROM part",
)
def p02(t):
    taxed = money.with_tax(F.col("p_retailprice"))
    return t.raw("part").select("p_partkey", money.as_double(taxed).alias("final_price"))


@query(
    "p03_derived_product_metrics",
    """
    SELECT product_id, CAST(initial_price - p AS DOUBLE) AS price_difference,
           CAST(ROUND(CAST(CAST(rating AS DOUBLE) * ln(1.0 + ratings_count) AS DECIMAL(30,8)), 4) AS DOUBLE)
             AS popularity_metric,
           CAST(p * ratings_count AS DOUBLE) AS total_amount
    FROM (SELECT *, CAST(regexp_replace(final_price, '["₹,]', '', 'g') AS DECIMAL(18,2)) AS p FROM catalogue_v)""",
)
def p03(t):
    priced = t.catalogue.withColumn("price", text.currency_to_decimal(F.col("final_price")))
    return priced.select(
        "product_id",
        money.as_double(F.col("initial_price") - F.col("price")).alias("price_difference"),
        money.rounded(F.col("rating").cast("double") * F.log1p("ratings_count"), 4).alias("popularity_metric"),
        money.as_double(F.col("price") * F.col("ratings_count")).alias("total_amount"),
    )


@query(
    "p04_rename_and_cast",
    "SELECT p_partkey AS product_id, CAST(p_retailprice AS VARCHAR) IS NOT NULL AS has_price,"
    " CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price FROM part",
)
def p04(t):
    as_text = t.raw("part").select("p_partkey", dec("p_retailprice", "decimal(12,2)").cast("string").alias("price"))
    renamed = as_text.withColumnRenamed("p_partkey", "product_id")
    return renamed.select(
        "product_id", F.col("price").isNotNull().alias("has_price"), F.col("price").try_cast("double").alias("price")
    )


@query("p05_drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def p05(t):
    return t.raw("customer").drop("c_nationkey", "c_acctbal")


@query("p06_equality_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def p06(t):
    return t.raw("orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")


@query(
    "p07_and_filter",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000",
)
def p07(t):
    found = t.raw("orders").filter((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000))
    return found.select("o_orderkey", "o_totalprice")


@query(
    "p08_or_filter",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '2-HIGH'",
)
def p08(t):
    found = t.raw("orders").filter((F.col("o_orderstatus") == "P") | (F.col("o_orderpriority") == "2-HIGH"))
    return found.select("o_orderkey", "o_orderpriority")


@query(
    "p09_between_and_equality",
    "SELECT l_orderkey, l_discount FROM lineitem WHERE l_discount BETWEEN 0.02 AND 0.06 AND l_returnflag = 'A'",
)
def p09(t):
    found = t.raw("lineitem").filter(F.col("l_discount").between(0.02, 0.06) & (F.col("l_returnflag") == "A"))
    return found.select("l_orderkey", "l_discount")


@query(
    "p10_date_range",
    "SELECT order_id, order_day FROM orders_v WHERE order_day BETWEEN DATE '1996-02-01' AND DATE '1996-04-30'",
)
def p10(t):
    first, last = (F.lit(day).cast("date") for day in ("1996-02-01", "1996-04-30"))
    return t.orders.filter(F.col("order_day").between(first, last)).select("order_id", "order_day")


@query(
    "p11_not_null_not_blank",
    "SELECT customer_id, email FROM raw_customers_v WHERE customer_id IS NOT NULL AND trim(email) <> ''",
)
def p11(t):
    present = F.col("customer_id").isNotNull() & (F.trim("email") != "")
    return t.raw_customers.filter(present).select("customer_id", "email")


@query(
    "p13_above_global_average",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_totalprice AS DECIMAL(15,2)) * (SELECT COUNT(*) FROM orders)"
    " > (SELECT SUM(CAST(o_totalprice AS DECIMAL(15,2))) FROM orders)",
)
def p13(t):
    orders = t.raw("orders")
    size = orders.agg(F.count(F.lit(1)).cast("decimal(18,0)")).scalar()
    total = orders.agg(F.sum(dec("o_totalprice"))).scalar()
    return orders.filter(dec("o_totalprice") * size > total).select("o_orderkey", "o_totalprice")


@query(
    "p14_rows_at_group_maximum",
    "SELECT p_partkey, p_brand, p_retailprice FROM part p"
    " WHERE p_retailprice = (SELECT MAX(x.p_retailprice) FROM part x WHERE x.p_brand = p.p_brand)",
)
def p14(t):
    parts = t.raw("part").select("p_partkey", "p_brand", "p_retailprice")
    best = parts.groupBy("p_brand").agg(F.max("p_retailprice").alias("p_retailprice"))
    return parts.join(best, ["p_brand", "p_retailprice"], "left_semi")


@query(
    "p15_groups_above_average_total",
    """
    WITH g AS (SELECT p_brand, SUM(CAST(p_retailprice AS DECIMAL(12,2))) AS total FROM part GROUP BY 1)
    SELECT p_brand, CAST(total AS DOUBLE) AS total FROM g
    WHERE CAST(total AS DOUBLE) > (SELECT CAST(SUM(total) AS DOUBLE) / COUNT(*) FROM g)""",
)
def p15(t):
    totals = t.raw("part").groupBy("p_brand").agg(F.sum(dec("p_retailprice", "decimal(12,2)")).alias("total"))
    mean = totals.agg(F.sum("total").cast("double") / F.count("total")).scalar()
    return totals.select("p_brand", money.as_double(F.col("total")).alias("total")).filter(F.col("total") > mean)


@query(
    "p16_value_bands",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'High' WHEN o_totalprice >= 150000 THEN 'Medium'"
    " ELSE 'Low' END AS value_band FROM orders",
)
def p16(t):
    return t.raw("orders").select(
        "o_orderkey", money.value_band(F.col("o_totalprice"), 300000, 150000).alias("value_band")
    )


TIER_SQL = (
    "CASE WHEN {0} >= 5000 THEN 'PLATINUM' WHEN {0} >= 2500 THEN 'GOLD' WHEN {0} >= 1000 THEN 'SILVER' ELSE 'BRONZE' END"
)


@query("p17_loyalty_tier", f"SELECT c_custkey, {TIER_SQL.format('c_acctbal')} AS loyalty_tier FROM customer")
def p17(t):
    return t.raw("customer").select("c_custkey", money.loyalty_tier(F.col("c_acctbal")).alias("loyalty_tier"))


@query(
    "p18_top_deals",
    "SELECT title, category, CAST(rating AS DOUBLE) AS rating, discount, final_price FROM catalogue_v"
    " WHERE rating >= 4.5 AND discount >= 50",
)
def p18(t):
    found = t.catalogue.filter("rating >= 4.5 AND discount >= 50")
    return found.select("title", "category", dec("rating", "double").alias("rating"), "discount", "final_price")


@query(
    "p19_loss_lines",
    "SELECT order_id, line_no, product_id, CAST(profit AS DOUBLE) AS profit FROM wide_v WHERE discount > 0.3 AND profit < 0",
)
def p19(t):
    found = t.wide("product").filter("discount > 0.3 AND profit < 0")
    return found.select("order_id", "line_no", "product_id", money.amount(F.col("profit")).alias("profit"))


@query(
    "p20_membership_filter",
    """
    WITH b AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY COUNT(*) DESC, p_brand LIMIT 10)
    SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM b)""",
)
def p20(t):
    parts = t.raw("part")
    sizes = parts.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    best = sizes.orderBy(F.col("n").desc(), "p_brand").limit(10)
    return parts.join(best, "p_brand", "left_semi").select("p_partkey", "p_brand")


# --- scalar functions ----------------------------------------------------------------------


def title_sql(name: str) -> str:
    """Upper-case every letter that does not follow a letter."""
    return (
        f"array_to_string(list_transform(range(1, length({name}) + 1), lambda i: CASE WHEN i = 1 OR NOT"
        f" regexp_matches({name}[i - 1], '[A-Za-z]') THEN upper({name}[i]) ELSE lower({name}[i]) END), '')"
    )


@query(
    "f01_trim_case",
    f"SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, lower(c_name) AS lowered, upper(c_name) AS uppered,"
    f" {title_sql('c_mktsegment')} AS titled FROM customer",
)
def f01(t):
    name = F.col("c_name")
    return t.raw("customer").select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.lower(name).alias("lowered"),
        F.upper(name).alias("uppered"),
        F.initcap("c_mktsegment").alias("titled"),
    )


@query(
    "f02_regexp_replace",
    "SELECT doc_id, regexp_replace(text, '[0-9]+', '#', 'g') AS masked FROM documents",
)
def f02(t):
    return t.raw("documents").select("doc_id", F.regexp_replace("text", "[0-9]+", "#").alias("masked"))


@query("f03_regexp_match", "SELECT doc_id, regexp_matches(text, '[A-Za-z0-9]+@[a-z]+') AS has_address FROM documents")
def f03(t):
    return t.raw("documents").select("doc_id", F.col("text").rlike("[A-Za-z0-9]+@[a-z]+").alias("has_address"))


@query(
    "f04_concat_with_nulls",
    "SELECT product_id, concat_ws('|', title, seller_name) AS skipped,"
    " concat_ws('|', title, COALESCE(seller_name, '')) AS kept, title || '/' || category AS joined FROM catalogue_v",
)
def f04(t):
    return t.catalogue.select(
        "product_id",
        F.concat_ws("|", "title", "seller_name").alias("skipped"),
        F.concat_ws("|", "title", F.coalesce("seller_name", F.lit(""))).alias("kept"),
        F.concat("title", F.lit("/"), "category").alias("joined"),
    )


@query("f05_zero_pad", "SELECT c_custkey, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code FROM customer")
def f05(t):
    return t.raw("customer").select("c_custkey", text.zero_pad(F.col("c_custkey") % 100000).alias("postal_code"))


@query(
    "f06_name_slug",
    "SELECT p_partkey, replace(regexp_replace(p_name, '[^a-z ]', '', 'g'), ' ', '.') || '.' || 'senor' AS slug FROM part",
)
def f06(t):
    spiced = F.concat(F.initcap("p_name"), F.lit("  1Señor "))
    return t.raw("part").select("p_partkey", text.name_slug(spiced).alias("slug"))


@query("f07_text_length", "SELECT doc_id, length(text) AS n FROM documents")
def f07(t):
    return t.raw("documents").select("doc_id", F.length("text").cast("bigint").alias("n"))


@query("f08_md5_of_attributes", "SELECT c_custkey, md5(concat_ws('|', c_name, c_mktsegment)) AS h FROM customer")
def f08(t):
    return t.raw("customer").select("c_custkey", F.md5(F.concat_ws("|", "c_name", "c_mktsegment")).alias("h"))


@query("f09_sha256", "SELECT c_custkey, sha256(lower(trim(c_name))) AS h FROM customer")
def f09(t):
    return t.raw("customer").select("c_custkey", money.hashed_email(F.col("c_name")).alias("h"))


@query(
    "f10_date_parts_and_parse",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m') AS month,
           CAST(o_orderdate AS DATE) AS parsed_day, o_orderdate AS parsed_ts FROM orders""",
)
def f10(t):
    written = t.raw("orders").withColumn("w", F.date_format("o_orderdate", "d-M-yyyy"))
    return written.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        dates.month_label(F.col("o_orderdate")).alias("month"),
        F.to_date("w", "d-M-yyyy").alias("parsed_day"),
        dates.parse_date(F.col("w")).alias("parsed_ts"),
    )


@query(
    "f11_month_start_back",
    "SELECT order_id, CAST(date_trunc('month', order_day) - INTERVAL 11 MONTH AS DATE) AS first_month FROM orders_v",
)
def f11(t):
    return t.orders.select("order_id", dates.month_start_back(F.col("order_day"), 11).alias("first_month"))


@query("f12_day_difference", "SELECT order_id, date_diff('day', DATE '1995-01-01', order_day) AS days FROM orders_v")
def f12(t):
    start = F.lit("1995-01-01").cast("date")
    return t.orders.select("order_id", F.datediff("order_day", start).cast("bigint").alias("days"))


@query(
    "f13_month_index",
    "SELECT order_id, (year(order_day) - 1995) * 12 + month(order_day) - 6 AS step FROM orders_v",
)
def f13(t):
    start = F.lit("1995-06-30").cast("date")
    return t.orders.select("order_id", dates.month_index(start, F.col("order_day")).cast("bigint").alias("step"))


@query(
    "f14_minutes_between",
    "SELECT order_id, CAST(ROUND(CAST(epoch(delivery_time) - epoch(pickup_time) AS DECIMAL(20,0)) / 60.0, 2) AS DOUBLE)"
    " AS minutes FROM deliveries_v",
)
def f14(t):
    return t.deliveries.select(
        "order_id", dates.minutes_between(F.col("pickup_time"), F.col("delivery_time")).alias("minutes")
    )


@query("f15_week_label", "SELECT order_id, strftime(order_day, '%Y-W%W') AS week FROM orders_v")
def f15(t):
    return t.orders.select("order_id", dates.week_label(F.col("order_day")).alias("week"))


@query(
    "f16_round_abs_log",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(ROUND(CAST(l_extendedprice AS DECIMAL(15,2)), 0) AS DOUBLE) AS whole,
           abs(quantity) AS units, CAST(ROUND(CAST(ln(1.0 + l_quantity) AS DECIMAL(30,8)), 4) AS DOUBLE) AS log_quantity
    FROM (SELECT *, CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity
          FROM lineitem)""",
)
def f16(t):
    signed = F.expr("CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT)")
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        money.as_double(F.round(dec("l_extendedprice"), 0)).alias("whole"),
        F.abs(signed).alias("units"),
        money.rounded(F.log1p("l_quantity"), 4).alias("log_quantity"),
    )


@query(
    "f17_net_price",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(ROUND(q * p * (100 - COALESCE(d, 0)) * 0.01, 2) AS DOUBLE) AS net_price,
           CAST(ROUND(q * p * COALESCE(d, 0) * 0.01, 2) AS DOUBLE) AS discount_amount
    FROM (SELECT *, CAST(l_quantity AS INT) AS q, CAST(l_extendedprice AS DECIMAL(10,2)) AS p,
                 CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_discount * 100 AS DECIMAL(5,2)) END AS d
          FROM lineitem)""",
)
def f17(t):
    priced = t.raw("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "CAST(l_quantity AS INT) AS q",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS p",
        "CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_discount * 100 AS DECIMAL(5,2)) END AS d",
    )
    parts = F.col("q"), F.col("p"), F.col("d")
    return priced.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        money.as_double(money.net_price(*parts)).alias("net_price"),
        money.as_double(money.discount_amount(*parts)).alias("discount_amount"),
    )


@query(
    "f18_signed_line_revenue",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(ROUND(q * p * (100 - d) * 0.01, 2) AS DOUBLE) AS line_revenue
    FROM (SELECT *, CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(12,0)) AS q,
                 CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount * 100 AS DECIMAL(5,2)) AS d
          FROM lineitem)""",
)
def f18(t):
    quantity = F.expr("CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END")
    price, rate = F.col("l_extendedprice"), F.col("l_discount") * 100
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        money.as_double(money.line_revenue(quantity, price, rate)).alias("line_revenue"),
    )


@query(
    "f19_incomplete_flag",
    "SELECT delivery_id, delivery_time IS NULL OR status <> 'success' AS is_incomplete FROM deliveries_v",
)
def f19(t):
    unfinished = F.col("delivery_time").isNull() | (F.col("status") != "success")
    return t.deliveries.select("delivery_id", F.when(unfinished, True).otherwise(False).alias("is_incomplete"))


@query(
    "f20_percent_change",
    f"SELECT s_suppkey, {pct('(s_acctbal - p)', 'abs(p)', 1)} AS change FROM"
    " (SELECT *, CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE s_acctbal * (s_suppkey % 3 - 1) END AS p FROM supplier)",
)
def f20(t):
    before = F.expr("CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE s_acctbal * (s_suppkey % 3 - 1) END")
    return t.raw("supplier").select("s_suppkey", money.percent_change(F.col("s_acctbal"), before).alias("change"))


@query(
    "f21_cast_with_default",
    "SELECT item_id, seq, COALESCE(TRY_CAST(trim(unit_price) AS DOUBLE), 0) AS unit_price,"
    " COALESCE(CAST(TRY_CAST(trim(quantity) AS DECIMAL(12,2)) AS INT), 0) AS quantity FROM raw_items_v",
)
def f21(t):
    return t.raw_items.select(
        "item_id", "seq",
        F.coalesce(F.trim("unit_price").try_cast("double"), F.lit(0.0)).alias("unit_price"),
        F.coalesce(F.trim("quantity").try_cast("decimal(12,2)").cast("int"), F.lit(0)).alias("quantity"),
    )


# --- sorts, limits, set operations ---------------------------------------------------------


@query("l01_multi_key_sort", "SELECT p_brand, p_type, COUNT(*) AS parts FROM part GROUP BY 1, 2")
def l01(t):
    sizes = t.raw("part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("parts"))
    return sizes.orderBy("p_brand", F.col("parts").desc(), "p_type")


@query(
    "l02_top_and_bottom_n",
    """
    (SELECT 'top' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
    UNION ALL
    (SELECT 'bottom', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""",
)
def l02(t):
    orders = t.raw("orders").select("o_orderkey", "o_totalprice")
    top = orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)
    bottom = orders.orderBy("o_totalprice", "o_orderkey").limit(10)
    return top.select(F.lit("top").alias("side"), "*").unionByName(bottom.select(F.lit("bottom").alias("side"), "*"))


@query(
    "l03_top_by_rank_with_ties",
    "SELECT * FROM (SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS size_rank FROM part) WHERE size_rank <= 3",
)
def l03(t):
    return windows.top_by_rank(t.raw("part").select("p_partkey", "p_size"), 3, "-p_size", "size_rank")


@query(
    "l04_business_order",
    "SELECT o_orderpriority, COUNT(*) AS orders FROM orders GROUP BY 1",
)
def l04(t):
    place = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3)
    sizes = t.raw("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return sizes.orderBy(place, F.col("orders").desc())


@query("u01_distinct", "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem")
def u01(t):
    return t.raw("lineitem").select("l_orderkey", "l_returnflag").distinct()


@query(
    "u02_union_all_by_name",
    "SELECT s_name AS name, s_acctbal AS balance FROM supplier UNION ALL SELECT c_name, c_acctbal FROM customer",
)
def u02(t):
    suppliers = t.raw("supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = t.raw("customer").select(F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"))
    return suppliers.unionByName(customers)


@query(
    "u03_key_set_difference",
    "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
)
def u03(t):
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.raw("orders").select("o_orderkey").distinct().join(lines, "o_orderkey", "left_anti")


@query(
    "u04_key_set_containment",
    """
    SELECT (SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders)) = 0
             AS lines_in_orders,
           (SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)) = 0
             AS orders_in_lines""",
)
def u04(t):
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    orders = t.raw("orders").select(F.col("o_orderkey").alias("k"))
    counted = F.count(F.lit(1)) == 0
    left = lines.join(orders, "k", "left_anti").agg(counted.alias("lines_in_orders"))
    right = orders.join(lines, "k", "left_anti").agg(counted.alias("v")).scalar()
    return left.withColumn("orders_in_lines", right)

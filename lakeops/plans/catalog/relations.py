"""Registered queries: joins, aggregations and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import money
from lakeops.functions.text import currency_to_decimal
from lakeops.operators import stats, windows
from lakeops.plans.catalog.dimension import batch, state
from lakeops.plans.catalog.retail import avg, pct
from lakeops.plans.registry import query
from lakeops.session import stable


def dec(name: str, kind: str = "decimal(15,2)"):
    return F.col(name).cast(kind)


# --- joins ---------------------------------------------------------------------------------


@query("j01_inner_join", "SELECT order_id, line_no, product_id, status, quantity FROM items_v JOIN orders_v USING (order_id)")
def j01(t):
    return t.items.join(t.orders, "order_id").select("order_id", "line_no", "product_id", "status", "quantity")


@query(
    "j02_left_join_with_defaults",
    """
    SELECT customer_id, customer_name, COALESCE(n, 0) AS orders
    FROM customers_v LEFT JOIN (SELECT customer_id, COUNT(*) AS n FROM orders_v WHERE status = 'CANCELLED'
                                AND customer_id IS NOT NULL GROUP BY 1) USING (customer_id)""",
)
def j02(t):
    counts = (
        t.orders.filter("status = 'CANCELLED' AND customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return t.customers.join(counts, "customer_id", "left").select(
        "customer_id", "customer_name", F.coalesce("n", F.lit(0)).alias("orders")
    )


@query(
    "j03_self_join_previous_year",
    """
    WITH m AS (SELECT year(order_day) AS y, month(order_day) AS m, COUNT(*) AS n FROM orders_v GROUP BY 1, 2)
    SELECT a.y, a.m, a.n, b.n AS n_before FROM m a LEFT JOIN m b ON b.y = a.y - 1 AND b.m = a.m""",
)
def j03(t):
    monthly = t.orders.groupBy(
        F.year("order_day").cast("bigint").alias("y"), F.month("order_day").cast("bigint").alias("m")
    ).agg(F.count(F.lit(1)).alias("n"))
    before = monthly.select((F.col("y") + 1).alias("y"), "m", F.col("n").alias("n_before"))
    return monthly.join(before, ["y", "m"], "left")


@query(
    "j04_self_join_with_inequality",
    """
    SELECT a.l_partkey AS part_a, b.l_partkey AS part_b, a.l_orderkey AS order_id
    FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) a
    JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b
      ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey""",
)
def j04(t):
    held = t.raw("lineitem").select("l_orderkey", "l_partkey").distinct()
    left = held.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_a"))
    right = held.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_b"))
    return left.join(right, "order_id").filter("part_a < part_b")


@query(
    "j05_filter_by_one_row_relation",
    "SELECT order_id, order_day FROM orders_v CROSS JOIN (SELECT MAX(order_day) AS last FROM orders_v)"
    " WHERE date_diff('day', order_day, last) <= 30",
)
def j05(t):
    last = t.orders.agg(F.max("order_day")).scalar()
    return t.orders.filter(F.datediff(last, "order_day") <= 30).select("order_id", "order_day")


@query(
    "j06_join_with_small_relation",
    "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey"
    " JOIN region ON n_regionkey = r_regionkey",
)
def j06(t):
    # No hint: the planner broadcasts the small side where its size allows it.
    places = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = t.raw("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "n_name", "r_name")


@query(
    "j07_anti_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def j07(t):
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.raw("orders").join(lines, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query(
    "j08_semi_join",
    "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def j08(t):
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.raw("orders").select("o_orderkey").join(lines, "o_orderkey", "left_semi")


@query(
    "j09_merge_join",
    state(
        """SELECT COALESCE(m.customer_id, f.customer_id) AS k, CAST(CASE WHEN f.customer_id IS NOT NULL THEN f.total_sales
        ELSE m.total_sales END AS DOUBLE) AS v FROM m FULL JOIN f ON m.customer_id = f.customer_id"""
    ),
)
def j09(t):
    """The clean dimension and the clean feed, merged by key."""
    b = batch(t)
    old, new = (
        side.select(F.col("customer_id").alias("k"), money.as_double(F.col("total_sales")).alias("v")).alias(name)
        for name, side in (("a", b.master), ("b", b.feed))
    )
    joined = old.join(new, F.col("a.k") == F.col("b.k"), "full_outer")
    return joined.select(
        F.coalesce("a.k", "b.k").alias("k"),
        F.when(F.col("b.k").isNotNull(), F.col("b.v")).otherwise(F.col("a.v")).alias("v"),
    )


@query(
    "j10_lookup_on_aggregate",
    "SELECT s_name, COUNT(*) AS lines FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name",
)
def j10(t):
    counts = t.raw("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("lines"))
    return counts.join(t.raw("supplier"), "s_suppkey").select("s_name", "lines")


@query(
    "j11_two_roles_of_one_dimension",
    """
    SELECT o_orderkey, a.n_name AS buyer_nation, b.n_name AS seller_nation
    FROM (SELECT o_orderkey, o_custkey, MIN(l_suppkey) AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey
          GROUP BY 1, 2) x
    JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = s
    JOIN nation a ON a.n_nationkey = c_nationkey JOIN nation b ON b.n_nationkey = s_nationkey""",
)
def j11(t):
    seller = t.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("s_suppkey"))
    nation = t.raw("nation").select("n_nationkey", "n_name")
    return (
        t.raw("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
        .join(seller, "o_orderkey")
        .join(t.raw("customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .join(t.raw("supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
        .join(nation.toDF("c_nationkey", "buyer_nation"), "c_nationkey")
        .join(nation.toDF("s_nationkey", "seller_nation"), "s_nationkey")
        .select("o_orderkey", "buyer_nation", "seller_nation")
    )


# --- aggregations --------------------------------------------------------------------------


@query(
    "a01_group_aggregates",
    f"""
    SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS total,
           {avg('SUM(CAST(l_quantity AS BIGINT))', 'COUNT(*)')} AS mean_quantity, COUNT(*) AS rows,
           MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
    FROM lineitem GROUP BY 1, 2""",
)
def a01(t):
    return t.raw("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        money.as_double(F.sum(dec("l_extendedprice"))).alias("total"),
        money.mean(F.sum(dec("l_quantity", "bigint")), F.count(F.lit(1))).alias("mean_quantity"),
        F.count(F.lit(1)).alias("rows"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "a02_global_aggregates",
    f"""
    SELECT COUNT(*) AS orders, CAST(SUM(p) AS DOUBLE) AS total, {avg('SUM(p)', 'COUNT(*)')} AS mean,
           CAST(MIN(p) AS DOUBLE) AS lowest, CAST(MAX(p) AS DOUBLE) AS highest
    FROM (SELECT CAST(o_totalprice AS DECIMAL(15,2)) AS p FROM orders)""",
)
def a02(t):
    price = t.raw("orders").select(dec("o_totalprice").alias("p"))
    return price.agg(
        F.count(F.lit(1)).alias("orders"),
        money.as_double(F.sum("p")).alias("total"),
        money.mean(F.sum("p"), F.count("p")).alias("mean"),
        money.as_double(F.min("p")).alias("lowest"),
        money.as_double(F.max("p")).alias("highest"),
    )


@query("a03_count_distinct", "SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def a03(t):
    return t.raw("lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("orders"))


@query(
    "a04_conditional_sum_and_count",
    "SELECT product_id, CAST(SUM(CASE WHEN quantity < 0 THEN -quantity ELSE 0 END) AS BIGINT) AS returned,"
    " COUNT(CASE WHEN quantity > 0 THEN 1 END) AS sale_lines FROM items_v GROUP BY 1",
)
def a04(t):
    return t.items.groupBy("product_id").agg(
        F.sum(F.when(F.col("quantity") < 0, -F.col("quantity")).otherwise(0)).alias("returned"),
        F.count_if(F.col("quantity") > 0).alias("sale_lines"),
    )


@query(
    "a05_conditional_count_distinct",
    "SELECT product_id, COUNT(DISTINCT CASE WHEN quantity < 0 THEN order_id END) AS returned_orders FROM items_v GROUP BY 1",
)
def a05(t):
    back = F.when(F.col("quantity") < 0, F.col("order_id"))
    return t.items.groupBy("product_id").agg(F.countDistinct(back).alias("returned_orders"))


@query(
    "a06_conditional_average",
    f"SELECT l_suppkey, {avg('SUM(CASE WHEN f THEN q END)', 'COUNT(CASE WHEN f THEN q END)')} AS mean_returned FROM"
    " (SELECT l_suppkey, l_returnflag = 'R' AS f, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY 1",
)
def a06(t):
    back = F.when(F.col("l_returnflag") == "R", dec("l_quantity", "bigint"))
    return t.raw("lineitem").groupBy("l_suppkey").agg(money.mean(F.sum(back), F.count(back)).alias("mean_returned"))


@query(
    "a07_having",
    """
    SELECT customer_id, COUNT(*) AS orders, COUNT(DISTINCT status) AS statuses FROM orders_v
    WHERE customer_id IS NOT NULL GROUP BY 1
    HAVING COUNT(*) > 10 AND COUNT(DISTINCT status) = 3 AND COUNT(*) FILTER (status = 'PLACED') > 2""",
)
def a07(t):
    per_customer = t.orders.filter("customer_id IS NOT NULL").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.countDistinct("status").alias("statuses"),
        F.count_if(F.col("status") == "PLACED").alias("placed"),
    )
    return per_customer.filter("orders > 10 AND statuses = 3 AND placed > 2").drop("placed")


@query(
    "a08_zero_safe_percent",
    f"""
    SELECT product_id, {pct('r', 'CASE WHEN s = 0 THEN 1 ELSE s END')} AS return_rate_pct
    FROM (SELECT product_id, SUM(greatest(-quantity, 0)) AS r, SUM(quantity) AS s FROM items_v GROUP BY 1)""",
)
def a08(t):
    moved = t.items.groupBy("product_id").agg(
        F.sum(F.greatest(-F.col("quantity"), F.lit(0))).alias("r"), F.sum("quantity").alias("s")
    )
    return moved.select("product_id", money.percent_or_zero(F.col("r"), F.col("s")).alias("return_rate_pct"))


@query(
    "a09_percent_of_absolute_units",
    f"SELECT product_id, {pct('SUM(greatest(-quantity, 0))', 'SUM(abs(quantity))')} AS returned_percent"
    " FROM items_v GROUP BY 1",
)
def a09(t):
    back, moved = F.sum(F.greatest(-F.col("quantity"), F.lit(0))), F.sum(F.abs("quantity"))
    return t.items.groupBy("product_id").agg(money.percent(back, moved).alias("returned_percent"))


@query(
    "a10_distinct_text_aggregation",
    "SELECT customer_id, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses FROM orders_v"
    " WHERE customer_id IS NOT NULL GROUP BY 1",
)
def a10(t):
    known = t.orders.filter("customer_id IS NOT NULL")
    return known.groupBy("customer_id").agg(F.array_join(F.sort_array(F.collect_set("status")), ",").alias("statuses"))


@query(
    "a11_pivot_fixed_columns",
    "SELECT l_suppkey, COUNT(*) FILTER (l_returnflag = 'R') AS returned, COUNT(*) FILTER (l_returnflag = 'A') AS accepted,"
    " COUNT(*) FILTER (l_returnflag = 'N') AS open FROM lineitem GROUP BY 1",
)
def a11(t):
    pivoted = t.raw("lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["R", "A", "N"]).agg(F.count(F.lit(1)))
    names = {"R": "returned", "A": "accepted", "N": "open"}
    return pivoted.select("l_suppkey", *[F.coalesce(F.col(k), F.lit(0)).alias(v) for k, v in names.items()])


@query(
    "a12_two_level_aggregation",
    """
    WITH o AS (SELECT customer_id, order_id, SUM(line_revenue) AS v FROM lines_v WHERE customer_id IS NOT NULL GROUP BY 1, 2)
    SELECT customer_id, CAST(MAX(v) AS DOUBLE) AS largest_order, COUNT(*) AS orders FROM o GROUP BY 1""",
)
def a12(t):
    per_order = t.items.groupBy("order_id").agg(F.sum("line_revenue").alias("v"))
    held = per_order.join(t.orders.filter("customer_id IS NOT NULL"), "order_id")
    return held.groupBy("customer_id").agg(
        money.amount(F.max("v")).alias("largest_order"), F.count(F.lit(1)).alias("orders")
    )


@query(
    "a13_month_and_year_groups",
    "SELECT year(order_day) AS yr, month(order_day) AS mo, COUNT(*) AS orders FROM orders_v GROUP BY 1, 2",
)
def a13(t):
    month = F.year("order_day").cast("bigint").alias("yr"), F.month("order_day").cast("bigint").alias("mo")
    return t.orders.groupBy(*month).agg(F.count(F.lit(1)).alias("orders"))


MODE_SQL = """
    SELECT {key}, {cols} FROM (
      SELECT {key}, {cols}, row_number() OVER (PARTITION BY {key} ORDER BY COUNT(*) DESC, {cols}) AS n
      FROM {source} GROUP BY {key}, {cols}) WHERE n = 1"""


@query("a14_mode_per_group", MODE_SQL.format(key="customer_id", cols="segment", source="wide_v"))
def a14(t):
    return stats.most_frequent(t.weighted_orders("customer"), "customer_id", ["segment"], weight="num_lines")


@query("a15_most_frequent_tuple", MODE_SQL.format(key="customer_id", cols="city, state, region", source="wide_v"))
def a15(t):
    return stats.most_frequent(t.weighted_orders("place"), "customer_id", ["city", "state", "region"], weight="num_lines")


@query("a16_value_counts", "SELECT o_orderpriority, COUNT(*) AS rows FROM orders GROUP BY 1")
def a16(t):
    return stats.value_counts(t.raw("orders"), "o_orderpriority")


def describe_sql(name: str, source: str) -> str:
    v = f"CAST({name} AS DOUBLE)"
    r = "CAST(ROUND(CAST({0} AS DECIMAL(30,8)), {1}) AS DOUBLE)"
    return (
        f"SELECT '{name}' AS \"column\", COUNT({name}) AS count, {r.format(f'AVG({v})', 4)} AS mean,"
        f" {r.format(f'stddev_samp({v})', 4)} AS std, MIN({v}) AS min,"
        f" {r.format(f'quantile_cont({v}, 0.25)', 6)} AS q25, {r.format(f'quantile_cont({v}, 0.5)', 6)} AS q50,"
        f" {r.format(f'quantile_cont({v}, 0.75)', 6)} AS q75, MAX({v}) AS max FROM {source}"
    )


@query(
    "a17_describe",
    describe_sql("l_quantity", "lineitem") + " UNION ALL " + describe_sql("l_extendedprice", "lineitem"),
)
def a17(t):
    return stats.describe(t.raw("lineitem"), ["l_quantity", "l_extendedprice"])


SKETCHED = {"q10": 0.1, "q50": 0.5, "q99": 0.99}


@query(
    "a17_quantile_sketches",
    """
    SELECT l_returnflag, q, COUNT(*) AS n, true AS within FROM lineitem, (SELECT unnest(['q10', 'q50', 'q99']) AS q)
    GROUP BY 1, 2""",
)
def a17_sketches(t):
    """Quantiles per flag from sketches kept per ship month, and whether their true ranks are within the stated error."""
    lines = t.raw("lineitem").select("l_returnflag", "l_extendedprice", F.trunc("l_shipdate", "MM").alias("month"))
    states = stable(stats.quantile_states(lines, "l_extendedprice", ["l_returnflag", "month"]))
    found = stats.merged_percentiles(states, SKETCHED, ["l_returnflag"])
    long = found.select(
        "l_returnflag", "n", F.inline(F.array(*[F.struct(F.lit(q).alias("q"), F.lit(share).alias("share"), F.col(q).alias("value"))
                                               for q, share in SKETCHED.items()]))
    )
    # The rank of a value that repeats is a span; the wanted rank lies in it or next to it.
    ranks = lines.join(long, "l_returnflag").groupBy("l_returnflag", "n", "q", "share").agg(
        (F.count_if(F.col("l_extendedprice") < F.col("value")) / F.max("n")).alias("low"),
        (F.count_if(F.col("l_extendedprice") <= F.col("value")) / F.max("n")).alias("high"),
    )
    off = F.greatest(F.col("low") - F.col("share"), F.col("share") - F.col("high"), F.lit(0.0))
    return ranks.select("l_returnflag", "q", "n", (off <= stats.rank_error(stats.SKETCH_SIZE)).alias("within"))


@query(
    "a18_histogram",
    """
    WITH b AS (SELECT MIN(o_totalprice) AS lo, (MAX(o_totalprice) - MIN(o_totalprice)) / 20 AS w FROM orders),
    c AS (SELECT CAST(least(floor((o_totalprice - lo) / w), 19) AS BIGINT) AS bin, COUNT(*) AS n FROM orders, b GROUP BY 1)
    SELECT range AS bin, CAST(ROUND(CAST(lo + range * w AS DECIMAL(30,8)), 6) AS DOUBLE) AS lower,
           CAST(ROUND(CAST(lo + (range + 1) * w AS DECIMAL(30,8)), 6) AS DOUBLE) AS upper, COALESCE(n, 0) AS rows
    FROM range(20) CROSS JOIN b LEFT JOIN c ON c.bin = range""",
)
def a18(t):
    return stats.histogram(t.raw("orders"), "o_totalprice", 20)


@query(
    "a19_box_plot",
    """
    WITH q AS (
      SELECT p_type, quantile_cont(p_retailprice, 0.25) AS a, quantile_cont(p_retailprice, 0.5) AS m,
             quantile_cont(p_retailprice, 0.75) AS b FROM part GROUP BY 1),
    x AS (SELECT *, p_retailprice BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) AS ok FROM part JOIN q USING (p_type))
    SELECT p_type, CAST(ROUND(CAST(a AS DECIMAL(30,8)), 6) AS DOUBLE) AS q1,
           CAST(ROUND(CAST(m AS DECIMAL(30,8)), 6) AS DOUBLE) AS median,
           CAST(ROUND(CAST(b AS DECIMAL(30,8)), 6) AS DOUBLE) AS q3,
           MIN(p_retailprice) FILTER (ok) AS whisker_low, MAX(p_retailprice) FILTER (ok) AS whisker_high,
           COUNT(*) FILTER (NOT ok) AS outliers
    FROM x GROUP BY p_type, a, m, b""",
)
def a19(t):
    return stats.box_plot(t.raw("part"), "p_retailprice", "p_type")


@query(
    "a20_correlation",
    "SELECT CAST(ROUND(CAST(corr(l_quantity, l_extendedprice) AS DECIMAL(30,8)), 6) AS DOUBLE) AS correlation FROM lineitem",
)
def a20(t):
    return stats.correlation(t.raw("lineitem"), "l_quantity", "l_extendedprice")


@query(
    "a21_category_statistics",
    f"""
    SELECT category, {avg('SUM(rating)', 'COUNT(*)')} AS avg_rating, {avg('SUM(d)', 'COUNT(*)')} AS avg_discount,
           {avg('SUM(p)', 'COUNT(*)')} AS avg_price, COUNT(*) AS product_count
    FROM (SELECT *, COALESCE(discount, 0) AS d, CAST(regexp_replace(final_price, '["₹,]', '', 'g') AS DECIMAL(18,2)) AS p
          FROM catalogue_v WHERE rating > 0)
    GROUP BY 1 ORDER BY product_count DESC, category LIMIT 10""",
)
def a21(t):
    rated = t.catalogue.filter("rating > 0").fillna({"discount": 0})
    rated = rated.withColumn("price", currency_to_decimal(F.col("final_price")))
    size = F.count(F.lit(1))
    grouped = rated.groupBy("category").agg(
        money.mean(F.sum("rating"), size).alias("avg_rating"),
        money.mean(F.sum("discount"), size).alias("avg_discount"),
        money.mean(F.sum("price"), size).alias("avg_price"),
        size.alias("product_count"),
    )
    return grouped.orderBy(F.col("product_count").desc(), "category").limit(10)


@query(
    "a22_margin_percent",
    f"SELECT category, {pct('SUM(profit)', 'SUM(sales)', 1)} AS margin_pct FROM wide_v GROUP BY 1",
)
def a22(t):
    margin = money.percent(money.amount(F.sum("profit")), money.amount(F.sum("sales")), 1)
    return t.wide("product").groupBy("category").agg(margin.alias("margin_pct"))


@query(
    "a24_decimal_aggregates",
    """
    SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(10,2))) AS DECIMAL(14,2)) AS total,
           CAST(ROUND(CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) / COUNT(*) AS DECIMAL(30,8)), 2)
                AS DECIMAL(10,2)) AS mean
    FROM orders GROUP BY 1""",
)
def a24(t):
    price = dec("o_totalprice", "decimal(10,2)")
    mean = money.mean(F.sum(price), F.count(F.lit(1))).cast("decimal(10,2)")
    return t.raw("orders").groupBy("o_orderstatus").agg(
        F.sum(price).cast("decimal(14,2)").alias("total"), mean.alias("mean")
    )


@query(
    "a25_keys_with_several_versions",
    "SELECT l_orderkey, COUNT(DISTINCT l_shipdate) AS versions FROM lineitem GROUP BY 1 HAVING COUNT(DISTINCT l_shipdate) > 1",
)
def a25(t):
    versions = t.raw("lineitem").groupBy("l_orderkey").agg(F.countDistinct("l_shipdate").alias("versions"))
    return versions.filter("versions > 1")


# --- window functions ----------------------------------------------------------------------


@query(
    "w01_global_rank",
    "SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS size_rank FROM part",
)
def w01(t):
    return windows.ranked(t.raw("part").select("p_partkey", "p_size"), ["-p_size"], rank="size_rank")


@query(
    "w02_row_number_per_key",
    "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)"
    " AS place FROM orders",
)
def w02(t):
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    placed = windows.ordered_window(orders, ["-o_totalprice", "o_orderkey"], keys=["o_custkey"], row_number="place")
    return placed.drop("o_totalprice")


@query(
    "w03_dense_rank_per_key",
    "SELECT p_partkey, p_brand, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS place FROM part",
)
def w03(t):
    parts = t.raw("part").select("p_partkey", "p_brand", "p_size")
    return windows.ranked(parts, ["-p_size"], keys=["p_brand"], dense_rank="place").drop("p_size")


@query(
    "w04_global_dense_rank_of_counts",
    "SELECT l_partkey, COUNT(*) AS n, dense_rank() OVER (ORDER BY COUNT(*) DESC) AS place FROM lineitem GROUP BY 1",
)
def w04(t):
    counts = t.raw("lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return windows.ranked(stable(counts), ["-n"], dense_rank="place")


@query(
    "w05_global_ntile",
    "SELECT o_orderkey, ntile(7) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS bucket FROM orders",
)
def w05(t):
    orders = t.raw("orders").select("o_orderkey", "o_totalprice")
    return windows.ntile(orders, 7, ["-o_totalprice", "o_orderkey"], "bucket").drop("o_totalprice")


@query(
    "w06_previous_value_per_key",
    "SELECT o_orderkey, o_custkey, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
    " AS previous FROM orders",
)
def w06(t):
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.ordered_window(
        orders, ["o_orderdate", "o_orderkey"], keys=["o_custkey"], previous={"previous": "o_orderdate"}
    ).drop("o_orderdate")


@query(
    "w07_partition_average",
    f"""
    SELECT o_orderkey, o_custkey, {avg('s', 'n')} AS customer_mean FROM orders JOIN (
      SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS s, COUNT(*) AS n FROM orders GROUP BY 1)
    USING (o_custkey)""",
)
def w07(t):
    orders = t.raw("orders")
    means = orders.groupBy("o_custkey").agg(
        money.mean(F.sum(dec("o_totalprice")), F.count(F.lit(1))).alias("customer_mean")
    )
    return orders.select("o_orderkey", "o_custkey").join(means, "o_custkey")


@query(
    "w08_running_sum_per_key",
    """
    SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) OVER (
             PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
    FROM orders""",
)
def w08(t):
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", dec("o_totalprice").alias("v"))
    summed = windows.ordered_window(
        orders, ["o_orderdate", "o_orderkey"], keys=["o_custkey"], running={"running": "v"}
    )
    return summed.select("o_orderkey", "o_custkey", money.as_double(F.col("running")).alias("running"))


@query(
    "w09_running_share",
    f"""
    SELECT s_suppkey, CAST(SUM(v) OVER w AS DOUBLE) AS running, {pct('SUM(v) OVER w', 'SUM(v) OVER ()')} AS share,
           COUNT(*) OVER () AS suppliers
    FROM (SELECT s_suppkey, CAST(s_acctbal AS DECIMAL(15,2)) AS v FROM supplier)
    WINDOW w AS (ORDER BY v DESC, s_suppkey ROWS UNBOUNDED PRECEDING)""",
)
def w09(t):
    balances = t.raw("supplier").select("s_suppkey", dec("s_acctbal").alias("v"))
    summed = windows.ordered_window(balances, ["-v", "s_suppkey"], running={"running": "v"})
    whole = balances.agg(F.sum("v")).scalar()
    people = balances.agg(F.count(F.lit(1))).scalar()
    return summed.select(
        "s_suppkey",
        money.as_double(F.col("running")).alias("running"),
        money.percent(F.col("running"), whole).alias("share"),
        people.alias("suppliers"),
    )


@query(
    "w10_first_and_last_value",
    "SELECT o_custkey, arg_min(o_orderpriority, k) AS first_priority, arg_max(o_orderpriority, k) AS last_priority FROM"
    " (SELECT o_custkey, o_orderpriority, row(o_orderdate, o_orderkey) AS k FROM orders) GROUP BY 1",
)
def w10(t):
    place = F.struct("o_orderdate", "o_orderkey")
    return t.raw("orders").groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", place).alias("first_priority"),
        F.max_by("o_orderpriority", place).alias("last_priority"),
    )


@query(
    "w11_latest_row_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey"
    " ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1",
)
def w11(t):
    row = F.struct("o_orderkey", "o_totalprice")
    last = t.raw("orders").groupBy("o_custkey").agg(F.max_by(row, F.struct("o_orderdate", "o_orderkey")).alias("r"))
    return last.select("o_custkey", "r.o_orderkey", "r.o_totalprice")


@query(
    "w12_surrogate_keys",
    "SELECT c_custkey, 5000 + row_number() OVER (ORDER BY c_name, c_custkey) AS customer_sk FROM customer",
)
def w12(t):
    customers = t.raw("customer").select("c_custkey", "c_name")
    return windows.surrogate_keys(customers, ["c_name", "c_custkey"], "customer_sk", start=5000).drop("c_name")

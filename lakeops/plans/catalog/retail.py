"""Registered queries: retail analytics."""

from __future__ import annotations

from datetime import date

from lakeops.functions import dates
from lakeops.plans import daily, retail
from lakeops.plans.registry import query
from lakeops.session import scratch_path

START, END = date(1998, 3, 1), date(1998, 5, 20)
PERIOD = f"order_day BETWEEN DATE '{START}' AND DATE '{END}'"
BEFORE_START = date(1997, 12, 10)


def pct(part: str, whole: str, places: int = 2) -> str:
    """SQL of :func:`lakeops.functions.money.percent`."""
    return (
        f"CAST(ROUND(CAST(CAST({part} AS DOUBLE) * 100.0 / NULLIF(CAST({whole} AS DOUBLE), 0)"
        f" AS DECIMAL(30,8)), {places}) AS DOUBLE)"
    )


def avg(total: str, count: str, places: int = 2) -> str:
    """SQL of :func:`lakeops.functions.money.mean`."""
    return (
        f"CAST(ROUND(CAST(CAST({total} AS DOUBLE) / NULLIF(CAST({count} AS DOUBLE), 0)"
        f" AS DECIMAL(30,8)), {places}) AS DOUBLE)"
    )


@query(
    "r00_order_lines",
    "SELECT order_id, line_no, product_id, customer_id, order_day, status, product_name, category, quantity,"
    " CAST(line_revenue AS DOUBLE) AS line_revenue FROM lines_v",
)
def r00(t):
    lines = t.order_lines.join(t.products.select("product_id", "product_name", "category"), "product_id")
    return lines.selectExpr(
        "order_id", "line_no", "product_id", "customer_id", "order_day", "status", "product_name", "category",
        "quantity", "CAST(line_revenue AS DOUBLE) / 100 AS line_revenue",
    )


@query(
    "r01_revenue_per_category",
    """
    SELECT category, COUNT(DISTINCT order_id) AS orders, CAST(SUM(quantity) AS BIGINT) AS net_units,
           CAST(SUM(line_revenue) AS DOUBLE) AS total_revenue
    FROM revenue_v GROUP BY category""",
)
def r01(t):
    return retail.revenue_per_category(t.items, t.orders, t.products)


@query(
    "r02_top_10_customers",
    """
    SELECT r.customer_id, customer_name, customer_type, COUNT(DISTINCT order_id) AS orders,
           CAST(SUM(line_revenue) AS DOUBLE) AS total_order_value
    FROM revenue_v r JOIN customers_v c ON c.customer_id = r.customer_id
    GROUP BY ALL ORDER BY SUM(line_revenue) DESC, r.customer_id LIMIT 10""",
)
def r02(t):
    return retail.top_customers(t.items, t.orders, t.customers)


@query(
    "r03_monthly_order_count",
    """
    SELECT strftime(order_day, '%Y-%m') AS order_month, COUNT(*) AS order_count,
           COUNT(DISTINCT customer_id) AS active_customers
    FROM orders_v
    WHERE order_day >= (SELECT date_trunc('month', MAX(order_day)) - INTERVAL 11 MONTH FROM orders_v)
    GROUP BY 1""",
)
def r03(t):
    return retail.monthly_orders(t.orders)


@query(
    "r04_customers_never_delivered",
    """
    SELECT c.customer_id, customer_name, customer_type, COUNT(*) AS orders_placed,
           MAX(order_day) AS last_order_date, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses_seen
    FROM customers_v c JOIN orders_v o ON o.customer_id = c.customer_id
    GROUP BY c.customer_id, customer_name, customer_type
    HAVING COUNT(*) FILTER (status = 'DELIVERED') = 0""",
)
def r04(t):
    return retail.never_delivered(t.orders, t.customers)


@query(
    "r05_products_with_more_returns",
    """
    WITH m AS (
      SELECT product_id, CAST(SUM(greatest(quantity, 0)) AS BIGINT) AS units_purchased,
             CAST(SUM(greatest(-quantity, 0)) AS BIGINT) AS units_returned
      FROM items_v GROUP BY 1)
    SELECT product_id, product_name, category, units_purchased, units_returned,
           units_returned - units_purchased AS excess_returns
    FROM m JOIN products_v USING (product_id) WHERE units_purchased > 0 AND units_returned > units_purchased""",
)
def r05(t):
    return retail.mostly_returned_products(t.items, t.products)


@query(
    "r06_return_rate_per_category",
    f"""
    SELECT category, CAST(SUM(greatest(-quantity, 0)) AS BIGINT) AS units_returned,
           CAST(SUM(abs(quantity)) AS BIGINT) AS units_total,
           {pct('SUM(greatest(-quantity, 0))', 'SUM(abs(quantity))')} AS return_rate_percent
    FROM items_v JOIN products_v USING (product_id) GROUP BY 1""",
)
def r06(t):
    return retail.return_rates(t.items, t.products)


@query(
    "r07_running_total_by_region",
    """
    WITH d AS (
      SELECT region AS region_code, order_day AS order_date, SUM(line_revenue) AS rev
      FROM revenue_v JOIN places_v USING (buyer_id) GROUP BY 1, 2)
    SELECT region_code, order_date, CAST(rev AS DOUBLE) AS daily_revenue,
           CAST(SUM(rev) OVER (PARTITION BY region_code ORDER BY order_date ROWS UNBOUNDED PRECEDING) AS DOUBLE)
             AS running_total
    FROM d""",
)
def r07(t):
    return retail.daily_running_total(t.items, t.orders, t.places)


@query(
    "r08_product_rank_in_category",
    """
    WITH p AS (
      SELECT category, product_id, product_name, SUM(line_revenue) AS total FROM revenue_v GROUP BY ALL)
    SELECT category, product_name, CAST(total AS DOUBLE) AS total_revenue,
           dense_rank() OVER (PARTITION BY category ORDER BY total DESC) AS rank_in_category
    FROM p""",
)
def r08(t):
    return retail.product_ranks(t.items, t.orders, t.products)


@query(
    "r09_customer_order_gaps",
    f"""
    WITH g AS (
      SELECT customer_id, order_day,
             lag(order_day) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS previous_order_date
      FROM orders_v WHERE customer_id IS NOT NULL),
    d AS (SELECT *, date_diff('day', previous_order_date, order_day) AS days_gap FROM g),
    s AS (SELECT customer_id, SUM(days_gap) AS total, COUNT(days_gap) AS n FROM d GROUP BY 1)
    SELECT customer_id, order_day AS order_date, previous_order_date, days_gap,
           {avg('total', 'n', 1)} AS avg_gap_days,
           CASE WHEN n = 0 THEN 'Single Order' WHEN total / n > 30 THEN 'At Risk' ELSE 'Healthy' END AS risk_flag
    FROM d JOIN s USING (customer_id)""",
)
def r09(t):
    return retail.order_gaps(t.orders)


BANDS = """
    WITH m AS (
      SELECT customer_id, strftime(order_day, '%Y-%m') AS order_month, SUM(line_revenue) AS revenue
      FROM revenue_v WHERE customer_id IS NOT NULL GROUP BY ALL)
    SELECT order_month,
           CASE WHEN revenue > 10000 THEN 'High' WHEN revenue >= 5000 THEN 'Medium' ELSE 'Low' END AS value_band,
           COUNT(*) AS customers, CAST(SUM(revenue) AS DOUBLE) AS band_revenue
    FROM m GROUP BY 1, 2"""


@query("r10_monthly_value_bands", BANDS)
def r10(t):
    return retail.in_band_order(retail.monthly_value_bands(t.items, t.orders))


@query(
    "r11_customer_quartiles",
    """
    WITH c AS (
      SELECT customer_id, SUM(line_revenue) AS total FROM revenue_v WHERE customer_id IS NOT NULL GROUP BY 1),
    q AS (SELECT *, ntile(4) OVER (ORDER BY total DESC, customer_id) AS quartile FROM c)
    SELECT customer_id, customer_name, CAST(total AS DOUBLE) AS total_value, CAST(quartile AS BIGINT) AS quartile,
           CASE quartile WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver' ELSE 'Bronze' END
             AS quartile_label
    FROM q JOIN customers_v USING (customer_id)""",
)
def r11(t):
    return retail.customer_quartiles(t.items, t.orders, t.customers)


@query(
    "r12_year_over_year_revenue",
    f"""
    WITH m AS (
      SELECT year(order_day) AS year, month(order_day) AS month, SUM(line_revenue) AS revenue
      FROM revenue_v GROUP BY 1, 2)
    SELECT n.year, n.month, CAST(n.revenue AS DOUBLE) AS revenue, CAST(b.revenue AS DOUBLE) AS prev_year_revenue,
           {pct('(n.revenue - b.revenue)', 'b.revenue')} AS yoy_growth_percent
    FROM m n LEFT JOIN m b ON b.year = n.year - 1 AND b.month = n.month""",
)
def r12(t):
    return retail.year_over_year(t.items, t.orders)


@query(
    "r13_first_last_category",
    """
    WITH e AS (
      SELECT customer_id, arg_min(category, k) AS first_category, arg_max(category, k) AS latest_category
      FROM (SELECT customer_id, category, row(order_date, order_id, line_no, product_id) AS k
            FROM revenue_v WHERE customer_id IS NOT NULL AND quantity > 0) GROUP BY 1)
    SELECT *, CASE WHEN first_category = latest_category THEN 'No' ELSE 'Yes' END AS category_shift FROM e""",
)
def r13(t):
    return retail.category_shift(t.items, t.orders, t.products)


@query(
    "r14_cumulative_revenue_share",
    f"""
    WITH c AS (
      SELECT customer_id, SUM(line_revenue) AS revenue FROM revenue_v WHERE customer_id IS NOT NULL GROUP BY 1),
    w AS (
      SELECT customer_id, revenue, row_number() OVER (ORDER BY revenue DESC, customer_id) AS revenue_rank,
             SUM(revenue) OVER (ORDER BY revenue DESC, customer_id ROWS UNBOUNDED PRECEDING) AS cum,
             SUM(revenue) OVER () AS whole, COUNT(*) OVER () AS people
      FROM c)
    SELECT customer_id, revenue_rank, CAST(revenue AS DOUBLE) AS revenue, CAST(cum AS DOUBLE) AS cumulative_revenue,
           {pct('cum', 'whole')} AS cumulative_percent,
           {pct('revenue_rank', 'people')} AS top_percent_of_customers
    FROM w""",
)
def r14(t):
    return retail.revenue_concentration(t.items, t.orders)


@query(
    "r15_cohort_retention",
    f"""
    WITH a AS (
      SELECT strftime(registration_date, '%Y-%m') AS cohort_month, c.customer_id,
             (year(order_day) - year(registration_date)) * 12 + month(order_day) - month(registration_date) AS step
      FROM customers_v c JOIN orders_v o ON o.customer_id = c.customer_id),
    s AS (SELECT strftime(registration_date, '%Y-%m') AS cohort_month, COUNT(*) AS cohort_size
          FROM customers_v GROUP BY 1),
    m AS (
      SELECT cohort_month, cohort_size,
             COUNT(DISTINCT customer_id) FILTER (step = 0) AS month_0,
             COUNT(DISTINCT customer_id) FILTER (step = 1) AS month_1,
             COUNT(DISTINCT customer_id) FILTER (step = 2) AS month_2,
             COUNT(DISTINCT customer_id) FILTER (step = 3) AS month_3
      FROM s LEFT JOIN a USING (cohort_month) GROUP BY 1, 2)
    SELECT *, {pct('month_1', 'cohort_size', 1)} AS retention_month_1_percent,
           {pct('month_3', 'cohort_size', 1)} AS retention_month_3_percent
    FROM m""",
)
def r15(t):
    return retail.cohort_retention(t.orders, t.customers)


@query(
    "r16_frequently_bought_together",
    """
    WITH b AS (SELECT DISTINCT order_id, product_id FROM revenue_v WHERE quantity > 0),
    p AS (
      SELECT a.product_id AS pa, c.product_id AS pb, COUNT(*) AS n
      FROM b a JOIN b c ON a.order_id = c.order_id AND a.product_id < c.product_id GROUP BY 1, 2 HAVING COUNT(*) > 1)
    SELECT x.product_name AS product_a, y.product_name AS product_b, n AS times_bought_together,
           dense_rank() OVER (ORDER BY n DESC) AS pair_rank
    FROM p JOIN products_v x ON x.product_id = pa JOIN products_v y ON y.product_id = pb
    ORDER BY n DESC, product_a, product_b LIMIT 50""",
)
def r16(t):
    return retail.bought_together(t.items, t.orders, t.products)


@query(
    "r17_period_summary",
    f"""
    SELECT COUNT(DISTINCT order_id) AS orders, CAST(COALESCE(SUM(line_revenue), 0) AS DOUBLE) AS revenue,
           COUNT(DISTINCT customer_id) AS customers
    FROM revenue_v WHERE {PERIOD}""",
)
def r17(t):
    return retail.period_summary(t.items, t.orders, START, END)


def _daily(t) -> str:
    path = scratch_path(t.spark, "daily")
    daily.write_daily(daily.daily_states(t.items, t.orders), path)
    return path


@query(
    "r17_period_from_daily_states",
    f"""
    SELECT CAST(COUNT(DISTINCT order_id) AS BIGINT) AS orders, CAST(COALESCE(SUM(line_revenue), 0) AS DOUBLE) AS revenue,
           COUNT(DISTINCT customer_id) AS customers
    FROM revenue_v WHERE {PERIOD}""",
)
def r17_states(t):
    """The same from one row per day. The sketches hold so few customers exactly; above, their count is an estimate."""
    return daily.summary(daily.read_period(t.spark, _daily(t), START, END))


@query(
    "r19_customers_of_both_periods",
    f"""
    SELECT COUNT(*) FILTER (now) AS customers, COUNT(*) FILTER (before) AS customers_before,
           COUNT(*) FILTER (now AND before) AS customers_of_both
    FROM (SELECT customer_id, bool_or(order_day >= DATE '{START}') AS now, bool_or(order_day < DATE '{START}') AS before
          FROM revenue_v WHERE customer_id IS NOT NULL AND order_day BETWEEN DATE '{BEFORE_START}' AND DATE '{END}'
          GROUP BY 1)""",
)
def r19_both(t):
    path = _daily(t)
    now, before = (daily.read_period(t.spark, path, *span) for span in ((START, END), dates.previous_period(START, END)))
    return daily.customers_of_both(now, before)


def bucket_sql(label: str) -> str:
    return f"""
    SELECT {label} AS bucket, COUNT(DISTINCT order_id) AS orders, CAST(SUM(line_revenue) AS DOUBLE) AS revenue,
           COUNT(DISTINCT customer_id) AS customers
    FROM revenue_v WHERE {PERIOD} GROUP BY 1"""


@query("r18_daily_report", bucket_sql("strftime(order_day, '%Y-%m-%d')"))
def r18_daily(t):
    return retail.period_buckets(t.items, t.orders, START, END, "daily")


@query("r18_weekly_report", bucket_sql("strftime(order_day, '%Y-W%W')"))
def r18_weekly(t):
    return retail.period_buckets(t.items, t.orders, START, END, "weekly")


@query("r18_monthly_report", bucket_sql("strftime(order_day, '%Y-%m')"))
def r18_monthly(t):
    return retail.period_buckets(t.items, t.orders, START, END, "monthly")


@query(
    "r19_period_comparison",
    f"""
    WITH v AS (
      SELECT *, order_day >= DATE '{START}' AS cur FROM revenue_v
      WHERE order_day BETWEEN DATE '{BEFORE_START}' AND DATE '{END}'),
    m AS (
      SELECT 'orders' AS metric, CAST(COUNT(DISTINCT order_id) FILTER (cur) AS DOUBLE) AS this_period,
             CAST(COUNT(DISTINCT order_id) FILTER (NOT cur) AS DOUBLE) AS previous FROM v
      UNION ALL
      SELECT 'revenue', CAST(COALESCE(SUM(line_revenue) FILTER (cur), 0) AS DOUBLE),
             CAST(COALESCE(SUM(line_revenue) FILTER (NOT cur), 0) AS DOUBLE) FROM v
      UNION ALL
      SELECT 'customers', CAST(COUNT(DISTINCT customer_id) FILTER (cur) AS DOUBLE),
             CAST(COUNT(DISTINCT customer_id) FILTER (NOT cur) AS DOUBLE) FROM v)
    SELECT *, {pct('(this_period - previous)', 'abs(previous)', 1)} AS change_percent FROM m""",
)
def r19(t):
    return retail.period_comparison(t.items, t.orders, START, END)


@query(
    "r20_period_top_products",
    f"""
    SELECT product_name, CAST(SUM(quantity) AS BIGINT) AS units, CAST(SUM(line_revenue) AS DOUBLE) AS revenue
    FROM revenue_v WHERE {PERIOD} GROUP BY product_id, product_name
    ORDER BY SUM(line_revenue) DESC, product_id LIMIT 3""",
)
def r20(t):
    return retail.period_top_products(t.items, t.orders, t.products, START, END)


@query(
    "r21_default_period",
    "SELECT CAST(date_trunc('month', MAX(order_day)) AS DATE) AS period_start, MAX(order_day) AS period_end"
    " FROM revenue_v",
)
def r21(t):
    return retail.default_period(t.items, t.orders)


@query(
    "r22_loaded_span",
    "SELECT CAST(SUM(line_revenue) AS DOUBLE) AS net_revenue, MIN(order_day) AS first_day, MAX(order_day) AS last_day"
    " FROM revenue_v",
)
def r22(t):
    return retail.loaded_span(t.items, t.orders)

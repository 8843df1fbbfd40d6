"""Business questions over customers, products, orders and order items.

Inputs follow the retail model: ``orders(order_id, customer_id, order_date, order_day, status)``,
``items(order_id, product_id, line_no, quantity, line_revenue)`` with the revenue in cents, ``products(product_id,
product_name, category)``, ``customers(customer_id, customer_name, customer_type,
registration_date)``. A return is a line with a negative quantity; cancelled orders carry no
revenue; orders without a customer (guest checkout) count everywhere but in customer results.

Lines are summed per order before they meet the orders, so one row per order is shuffled on,
and counting orders needs no distinct. Names are looked up on the finished groups.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions import dates, money
from lakeops.operators import baskets, windows
from lakeops.session import stable

CANCELLED = "CANCELLED"
DELIVERED = "DELIVERED"

# Quartile names, best first.
QUARTILE_LABELS = ["Platinum", "Gold", "Silver", "Bronze"]

# Bucket label per reporting grain.
GRAINS = {
    "daily": lambda day: F.date_format(day, "yyyy-MM-dd"),
    "weekly": dates.week_label,
    "monthly": dates.month_label,
}


def billed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") != CANCELLED)


def order_values(items: DataFrame, orders: DataFrame, ends: bool = False) -> DataFrame:
    """One row per billed order that has lines, with its revenue and net units; with its first and last purchase too, if
    ``ends`` are asked for."""
    totals = items.groupBy("order_id").agg(
        F.sum("line_revenue").alias("revenue"), F.sum("quantity").alias("net_units"), *(_ends() if ends else [])
    )
    return totals.join(billed(orders), "order_id")


def billed_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of billed orders, with nothing of the order itself."""
    return items.join(billed(orders).select("order_id"), "order_id", "left_semi")


def revenue_per_category(items, orders, products) -> DataFrame:
    # Lines meet their products first; one shuffle by order then serves the fold and the filter.
    lines = items.join(products.select("product_id", "category"), "product_id").repartition("order_id")
    per_order = lines.groupBy("order_id", "category").agg(
        F.sum("quantity").alias("units"), F.sum("line_revenue").alias("revenue")
    )
    return per_order.join(billed(orders).select("order_id"), "order_id", "left_semi").groupBy("category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("units").alias("net_units"),
        money.amount(F.sum("revenue")).alias("total_revenue"),
    )


def customer_values(items, orders) -> DataFrame:
    """Billed revenue and order count per known customer."""
    return values_per_customer(order_values(items, orders))


def values_per_customer(values: DataFrame) -> DataFrame:
    """:func:`customer_values` of the :func:`order_values`."""
    return (
        values.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue"))
    )


# A report named ``..._of`` starts at values that are folded already, for jobs that make several reports of them.


def top_customers(items, orders, customers, k: int = 10) -> DataFrame:
    return top_customers_of(customer_values(items, orders), customers, k)


def top_customers_of(per_customer, customers, k: int = 10) -> DataFrame:
    known = customers.select("customer_id", "customer_name", "customer_type")
    best = per_customer.join(known, "customer_id")
    return (
        best.orderBy(F.col("revenue").desc(), "customer_id")
        .limit(k)
        .select(
            "customer_id", "customer_name", "customer_type", "orders",
            money.amount(F.col("revenue")).alias("total_order_value"),
        )
    )


def monthly_orders(orders: DataFrame, months: int = 12) -> DataFrame:
    """Orders and active customers in the last months up to the latest order, cancelled ones included."""
    latest = orders.agg(dates.month_start_back(F.max("order_day"), months - 1)).scalar()
    return (
        orders.filter(F.col("order_day") >= latest)
        .groupBy(dates.month_label(F.col("order_day")).alias("order_month"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.countDistinct("customer_id").alias("active_customers"))
    )


def never_delivered(orders, customers) -> DataFrame:
    """Customers with orders, none of them delivered, and the statuses seen."""
    seen = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders_placed"),
            F.max("order_day").alias("last_order_date"),
            F.array_join(F.sort_array(F.collect_set("status")), ",").alias("statuses_seen"),
            F.count_if(F.col("status") == DELIVERED).alias("delivered"),
        )
        .filter("delivered = 0")
        .drop("delivered")
    )
    return customers.select("customer_id", "customer_name", "customer_type").join(seen, "customer_id")


def _returned() -> Column:
    return F.sum(F.when(F.col("quantity") < 0, -F.col("quantity")).otherwise(0))


def _bought() -> Column:
    return F.sum(F.when(F.col("quantity") > 0, F.col("quantity")).otherwise(0))


def mostly_returned_products(items, products) -> DataFrame:
    """Products returned more than bought, over all lines."""
    return mostly_returned_of(product_moves(items), products)


def product_moves(items) -> DataFrame:
    """Units bought, returned and moved either way per product, over all lines."""
    return items.groupBy("product_id").agg(
        _bought().alias("bought"), _returned().alias("returned"), F.sum(F.abs("quantity")).alias("moved")
    )


def mostly_returned_of(moves, products) -> DataFrame:
    moved = (
        moves.select("product_id", F.col("bought").alias("units_purchased"), F.col("returned").alias("units_returned"))
        .filter("units_purchased > 0 AND units_returned > units_purchased")
        .withColumn("excess_returns", F.expr("units_returned - units_purchased"))
    )
    return products.select("product_id", "product_name", "category").join(moved, "product_id")


def return_rates(items, products) -> DataFrame:
    """Returned units as a share of all units moved, per category."""
    return return_rates_of(product_moves(items), products)


def return_rates_of(moves, products) -> DataFrame:
    rates = (
        moves.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("returned").alias("units_returned"), F.sum("moved").alias("units_total"))
    )
    return rates.withColumn(
        "return_rate_percent", money.percent(F.col("units_returned"), F.col("units_total"))
    )


def daily_running_total(items, orders, places) -> DataFrame:
    """Daily revenue per region and its running sum.

    The window sees one row per region and day, so a partition is as long as the calendar.
    """
    by_buyer = order_values(items, orders).groupBy("buyer_id", "order_day").agg(F.sum("revenue").alias("revenue"))
    daily = (
        by_buyer.join(places.select("buyer_id", F.col("region").alias("region_code")), "buyer_id")
        .groupBy("region_code", F.col("order_day").alias("order_date"))
        .agg(F.sum("revenue").alias("daily_revenue"))
    )
    return _running(daily)


def running_total_of_orders(items, orders) -> DataFrame:
    """The same where each order names its region itself."""
    return running_total_of(order_values(items, orders))


def running_total_of(values) -> DataFrame:
    daily = (
        values.groupBy("region_code", F.col("order_day").alias("order_date"))
        .agg(F.sum("revenue").alias("daily_revenue"))
    )
    return _running(daily)


def _running(daily: DataFrame) -> DataFrame:
    so_far = Window.partitionBy("region_code").orderBy("order_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return daily.select(
        "region_code",
        "order_date",
        money.amount(F.col("daily_revenue")).alias("daily_revenue"),
        money.amount(F.sum("daily_revenue").over(so_far)).alias("running_total"),
    )


def product_ranks(items, orders, products) -> DataFrame:
    totals = billed_lines(items, orders).groupBy("product_id").agg(F.sum("line_revenue").alias("total"))
    named = totals.join(products.select("product_id", "product_name", "category"), "product_id")
    placed = windows.ranked(stable(named), ["-total"], keys=["category"], dense_rank="rank_in_category")
    return placed.select(
        "category", "product_name", money.amount(F.col("total")).alias("total_revenue"), "rank_in_category"
    )


def order_gaps(orders: DataFrame, at_risk_days: int = 30) -> DataFrame:
    """Each order with the customer's previous one, the gap, the mean gap and a risk flag.

    The gaps of a customer add up to last day minus first day, so their mean needs one
    aggregate row per customer and no second window.
    """
    known = orders.filter(F.col("customer_id").isNotNull()).select("customer_id", "order_id", "order_date", "order_day")
    steps = windows.ordered_window(
        known, ["order_date", "order_id"], keys=["customer_id"], previous={"previous_order_date": "order_day"}
    )
    span = known.groupBy("customer_id").agg(
        F.datediff(F.max("order_day"), F.min("order_day")).alias("_days"),
        (F.count(F.lit(1)) - 1).alias("_gaps"),
    )
    span = span.select(
        "customer_id",
        money.mean(F.col("_days"), F.col("_gaps"), 1).alias("avg_gap_days"),
        F.when(F.col("_gaps") == 0, "Single Order")
        .when(F.col("_days") > F.col("_gaps") * at_risk_days, "At Risk")
        .otherwise("Healthy")
        .alias("risk_flag"),
    )
    gaps = steps.select(
        "customer_id",
        F.col("order_day").alias("order_date"),
        "previous_order_date",
        F.datediff("order_day", "previous_order_date").cast("bigint").alias("days_gap"),
    )
    return gaps.join(span, "customer_id")


def monthly_value_bands(items, orders) -> DataFrame:
    return monthly_value_bands_of(order_values(items, orders))


def monthly_value_bands_of(values) -> DataFrame:
    monthly = (
        values.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", dates.month_label(F.col("order_day")).alias("order_month"))
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        monthly.groupBy("order_month", money.value_band(money.amount(F.col("revenue"))).alias("value_band"))
        .agg(F.count(F.lit(1)).alias("customers"), money.amount(F.sum("revenue")).alias("band_revenue"))
    )


def in_band_order(bands: DataFrame) -> DataFrame:
    """Months ascending, bands from high to low."""
    place = F.when(F.col("value_band") == "High", 1).when(F.col("value_band") == "Medium", 2).otherwise(3)
    return bands.orderBy("order_month", place)


def customer_quartiles(items, orders, customers) -> DataFrame:
    return customer_quartiles_of(stable(customer_values(items, orders).select("customer_id", "revenue")), customers)


def customer_quartiles_of(per_customer, customers) -> DataFrame:
    """``per_customer`` is read more than once, so it is a written table; the same goes for the other report of it."""
    totals = per_customer.select("customer_id", F.col("revenue").alias("total"))
    placed = windows.ntile(totals, 4, ["-total", "customer_id"], "quartile")
    label = F.element_at(F.array(*[F.lit(name) for name in QUARTILE_LABELS]), F.col("quartile").cast("int"))
    return placed.join(customers.select("customer_id", "customer_name"), "customer_id").select(
        "customer_id",
        "customer_name",
        money.amount(F.col("total")).alias("total_value"),
        "quartile",
        label.alias("quartile_label"),
    )


def year_over_year(items, orders) -> DataFrame:
    return year_over_year_of(order_values(items, orders))


def year_over_year_of(values) -> DataFrame:
    monthly = (
        values.groupBy(F.year("order_day").alias("year"), F.month("order_day").alias("month"))
        .agg(F.sum("revenue").alias("revenue"))
    )
    before = monthly.select(
        (F.col("year") + 1).alias("year"), "month", F.col("revenue").alias("before")
    )
    return monthly.join(before, ["year", "month"], "left").select(
        F.col("year").cast("bigint").alias("year"),
        F.col("month").cast("bigint").alias("month"),
        money.amount(F.col("revenue")).alias("revenue"),
        money.amount(F.col("before")).alias("prev_year_revenue"),
        money.percent(money.amount(F.col("revenue") - F.col("before")), money.amount(F.col("before"))).alias("yoy_growth_percent"),
    )


def category_shift(items, orders, products) -> DataFrame:
    """Category of the first and of the latest purchase per customer.

    First and last product are folded per order, then per customer; only these two products
    are looked up.
    """
    per_order = items.filter("quantity > 0").groupBy("order_id").agg(*_ends()).join(billed(orders), "order_id")
    return category_shift_of(per_order, products)


def _ends() -> list[Column]:
    """The first and the last line of a group that is a purchase."""
    spot = F.when(F.col("quantity") > 0, F.struct("line_no", "product_id"))
    return [F.min(spot)["product_id"].alias("first_id"), F.max(spot)["product_id"].alias("last_id"), F.max(spot).isNotNull().alias("bought")]


def category_shift_of(per_order, products) -> DataFrame:
    ends = (
        per_order.filter(F.col("customer_id").isNotNull() & F.col("bought"))
        .groupBy("customer_id")
        .agg(
            F.min_by("first_id", F.struct("order_date", "order_id")).alias("first_id"),
            F.max_by("last_id", F.struct("order_date", "order_id")).alias("last_id"),
        )
    )
    named = products.select("product_id", "category")
    first = named.toDF("first_id", "first_category")
    last = named.toDF("last_id", "latest_category")
    return (
        ends.join(first, "first_id")
        .join(last, "last_id")
        .select(
            "customer_id",
            "first_category",
            "latest_category",
            F.when(F.col("first_category") == F.col("latest_category"), "No").otherwise("Yes").alias("category_shift"),
        )
    )


def revenue_concentration(items, orders) -> DataFrame:
    """Customers by revenue with the running share of revenue and of customers."""
    return revenue_concentration_of(stable(customer_values(items, orders).select("customer_id", "revenue")))


def revenue_concentration_of(per_customer) -> DataFrame:
    totals = per_customer.select("customer_id", "revenue")
    placed = windows.ordered_window(
        totals, ["-revenue", "customer_id"], row_number="revenue_rank", running={"cumulative": "revenue"}
    )
    whole = totals.agg(F.sum("revenue")).scalar()
    people = totals.agg(F.count(F.lit(1))).scalar()
    return placed.select(
        "customer_id",
        "revenue_rank",
        money.amount(F.col("revenue")).alias("revenue"),
        money.amount(F.col("cumulative")).alias("cumulative_revenue"),
        money.percent(money.amount(F.col("cumulative")), money.amount(whole)).alias("cumulative_percent"),
        money.percent(F.col("revenue_rank"), people).alias("top_percent_of_customers"),
    )


def cohort_retention(orders, customers, months: int = 4) -> DataFrame:
    """Share of each registration month's customers who order 0..3 months later.

    Orders shrink to one row per customer and month before they meet the customers, so a
    customer with very many orders costs no more than any other.
    """
    cohorts = customers.withColumn("cohort_month", dates.month_label(F.col("registration_date")))
    active = (
        orders.filter(F.col("customer_id").isNotNull())
        .select("customer_id", F.trunc("order_day", "MM").alias("active_month"))
        .distinct()
    )
    counts = (
        active.join(cohorts, "customer_id")
        .withColumn("step", dates.month_index(F.col("registration_date"), F.col("active_month")))
        .filter(F.col("step").between(0, months - 1))
        .groupBy("cohort_month")
        .pivot("step", list(range(months)))
        .agg(F.count(F.lit(1)))
    )
    sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    table = sizes.join(counts, "cohort_month", "left").select(
        "cohort_month",
        "cohort_size",
        *[F.coalesce(F.col(str(m)), F.lit(0)).alias(f"month_{m}") for m in range(months)],
    )
    return table.withColumn(
        "retention_month_1_percent", money.percent(F.col("month_1"), F.col("cohort_size"), 1)
    ).withColumn("retention_month_3_percent", money.percent(F.col("month_3"), F.col("cohort_size"), 1))


def bought_together(items, orders, products, top: int = 50) -> DataFrame:
    """The ``top`` pairs of products bought in the same order more than once."""
    bought = billed_lines(items.filter("quantity > 0"), orders).select("order_id", "product_id")
    # Read twice, and far smaller than what it is counted from.
    pairs = stable(baskets.pair_counts(bought, "order_id", "product_id", at_least=2, top=top))
    # Names decide between equal counts, so every pair level with the last place is named.
    last_place = pairs.orderBy(F.col("times").desc()).limit(top).agg(F.min("times")).scalar()
    names = products.select("product_id", "product_name")
    named = (
        pairs.filter(F.col("times") >= last_place)
        .join(names.toDF("item_a", "product_a"), "item_a")
        .join(names.toDF("item_b", "product_b"), "item_b")
    )
    best = named.orderBy(F.col("times").desc(), "product_a", "product_b").limit(top)
    # Every larger count lies inside the top rows, so ranking these few rows alone is exact.
    place = F.dense_rank().over(Window.orderBy(F.col("times").desc()))
    return best.select(
        "product_a", "product_b", F.col("times").alias("times_bought_together"), place.cast("bigint").alias("pair_rank")
    )


# --- period reports -----------------------------------------------------------------------


def default_period(items, orders) -> DataFrame:
    """From the first of the month of the last billed order day up to that day."""
    last = order_values(items, orders).agg(F.max("order_day").alias("period_end"))
    return last.select(F.trunc("period_end", "MM").alias("period_start"), "period_end")


def resolve_period(items, orders, start: date | None = None, end: date | None = None) -> tuple[date, date]:
    """Fill the missing ends from :func:`default_period`; reject a period that ends before it starts."""
    if start is None or end is None:
        row = default_period(items, orders).first()
        start, end = start or row["period_start"], end or row["period_end"]
    if start > end:
        raise ValueError(f"period starts after it ends: {start} > {end}")
    return start, end


def _in_period(values: DataFrame, start: date, end: date) -> DataFrame:
    return values.filter(F.col("order_day").between(F.lit(start), F.lit(end)))


def _period_orders(orders: DataFrame, start: date, end: date) -> DataFrame:
    return _in_period(orders, start, end)


def period_summary(items, orders, start: date, end: date) -> DataFrame:
    values = order_values(items, _period_orders(orders, start, end))
    return values.agg(
        F.count(F.lit(1)).alias("orders"),
        money.amount(F.coalesce(F.sum("revenue"), F.lit(0))).alias("revenue"),
        F.countDistinct("customer_id").alias("customers"),
    )


def period_buckets(items, orders, start: date, end: date, grain: str) -> DataFrame:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    values = order_values(items, _period_orders(orders, start, end))
    return values.groupBy(GRAINS[grain](F.col("order_day")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("orders"),
        money.amount(F.sum("revenue")).alias("revenue"),
        F.countDistinct("customer_id").alias("customers"),
    )


def period_comparison(items, orders, start: date, end: date) -> DataFrame:
    """Orders, revenue and customers against the previous period of equal length, in one pass."""
    before_start, before_end = dates.previous_period(start, end)
    values = order_values(items, _period_orders(orders, before_start, end))
    now = F.col("order_day") >= F.lit(start)
    both = values.agg(
        F.count_if(now).alias("orders_now"),
        F.count_if(~now).alias("orders_before"),
        F.sum(F.when(now, F.col("revenue"))).alias("revenue_now"),
        F.sum(F.when(~now, F.col("revenue"))).alias("revenue_before"),
        F.countDistinct(F.when(now, F.col("customer_id"))).alias("customers_now"),
        F.countDistinct(F.when(~now, F.col("customer_id"))).alias("customers_before"),
    )
    forms = {"orders": money.as_double, "revenue": money.amount, "customers": money.as_double}
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("metric"),
                    F.coalesce(form(F.col(f"{name}_now")), F.lit(0.0)).alias("this_period"),
                    F.coalesce(form(F.col(f"{name}_before")), F.lit(0.0)).alias("previous"),
                )
                for name, form in forms.items()
            ]
        )
    )
    return both.select(rows).withColumn(
        "change_percent", money.percent_change(F.col("this_period"), F.col("previous"))
    )


def period_top_products(items, orders, products, start: date, end: date, k: int = 3) -> DataFrame:
    lines = billed_lines(items, _period_orders(orders, start, end))
    best = (
        lines.groupBy("product_id")
        .agg(F.sum("quantity").alias("units"), F.sum("line_revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "product_id")
        .limit(k)
    )
    return best.join(products.select("product_id", "product_name"), "product_id").select(
        "product_name", "units", money.amount(F.col("revenue")).alias("revenue")
    )


def loaded_span(items, orders) -> DataFrame:
    """Net revenue and first and last day of what has been loaded."""
    return order_values(items, orders).agg(
        money.amount(F.sum("revenue")).alias("net_revenue"),
        F.min("order_day").alias("first_day"),
        F.max("order_day").alias("last_day"),
    )

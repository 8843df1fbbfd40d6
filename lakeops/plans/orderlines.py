"""Questions over order lines: totals, trends, rankings, thresholds, loss audits.

``lines`` carry the line measures (money in cents) and, where a question needs them, the looked-up columns.
Customer questions take ``lines(order_id, sales, ...)`` and ``orders(order_id, customer_id)``
apart: the lines are summed per order first, so that one row per order meets the orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import money
from lakeops.operators import windows
from lakeops.session import stable


def _total(name: str) -> Column:
    return money.amount(F.sum(name))


def _average(name: str) -> Column:
    return money.mean(money.amount(F.sum(name)), F.count(name))


def largest(lines: DataFrame, k: int, order: list[str]) -> DataFrame:
    """First ``k`` rows in the order given; kept as a top-k, never a full sort."""
    return lines.orderBy(*windows.sort_columns(order)).limit(k)


def group_totals(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy(*keys).agg(
        _total("sales").alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        _average("sales").alias("avg_sale"),
        F.count(F.lit(1)).alias("num_lines"),
    )


def sales_and_profit(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy(*keys).agg(_total("sales").alias("total_sales"), _total("profit").alias("total_profit"))


def monthly_trend(orders: DataFrame, lines: DataFrame) -> DataFrame:
    per_order = lines.groupBy("order_id").agg(F.sum("sales").alias("sales"))
    monthly = per_order.join(orders, "order_id").groupBy(
        F.year("order_date").cast("bigint").alias("yr"), F.month("order_date").cast("bigint").alias("mo")
    )
    return monthly.agg(_total("sales").alias("total_sales"))


def customer_totals(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Spend, orders and largest order per customer."""
    per_order = lines.groupBy("order_id").agg(F.sum("sales").alias("value"))
    return (
        per_order.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("num_orders"), F.max("value").alias("largest"))
    )


def above_average_lines(lines: DataFrame) -> DataFrame:
    mean = lines.agg(money.amount(F.sum("sales")) / F.count("sales")).scalar()
    return lines.filter(money.amount(F.col("sales")) > mean)


def highest_sale_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Each customer's largest line, ties kept.

    The maximum is folded per order and then per customer, and the way back goes over the
    value as well as the key, so only orders that hold a maximum reach the lines again.
    """
    per_order = lines.groupBy("order_id").agg(F.max("sales").alias("best"))
    held = per_order.join(orders.select("order_id", "customer_id"), "order_id")
    best = held.groupBy("customer_id").agg(F.max("best").alias("best"))
    winners = held.join(best, ["customer_id", "best"]).withColumnRenamed("best", "sales")
    return lines.join(winners, ["order_id", "sales"])


def above_average_customers(totals: DataFrame) -> DataFrame:
    mean = totals.agg(money.amount(F.sum("total")) / F.count("total")).scalar()
    return totals.filter(money.amount(F.col("total")) > mean)


def spend_tiers(totals: DataFrame) -> DataFrame:
    placed = windows.ntile(stable(totals), 4, ["-total", "customer_id"], "spend_quartile")
    names = F.array(*[F.lit(name) for name in ("Platinum", "Gold", "Silver", "Bronze")])
    return placed.withColumn("customer_tier", F.element_at(names, F.col("spend_quartile").cast("int")))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines of each customer numbered from the largest sale down."""
    return windows.ordered_window(
        lines,
        ["-sales", "order_id", "line_no", "product_id", "supplier_id"],
        keys=["customer_id"],
        row_number="line_no_in_customer",
    )


def keep_one_per(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in the order given; folded map-side, no window."""
    rest = [name for name in lines.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return lines.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_row.{name}").alias(name) for name in rest])


def overall_statistics(lines: DataFrame) -> DataFrame:
    return lines.agg(
        F.count("sales").alias("orders"),
        _total("sales").alias("total"),
        _average("sales").alias("mean"),
        money.amount(F.min("sales")).alias("lowest"),
        money.amount(F.max("sales")).alias("highest"),
    )


def loss_audit(lines: DataFrame, min_discount: float, *keys: str) -> DataFrame:
    """Loss-making lines per group whose mean discount is above the bound."""
    audited = lines.filter(F.col("profit") < 0).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("loss_lines"),
        _total("profit").alias("loss_amount"),
        F.sum("discount").alias("_discounts"),
    )
    average = F.col("_discounts").cast("double") / F.col("loss_lines")
    return audited.filter(average > min_discount).withColumn("avg_discount", money.rounded(average)).drop("_discounts")


def discount_tier_margins(lines: DataFrame) -> DataFrame:
    """Sales, profit and margin for discounts up to 10 %, up to 30 % and above."""
    tier = F.when(F.col("discount") <= 0.1, "0-10%").when(F.col("discount") <= 0.3, "10-30%").otherwise(">30%")
    return (
        lines.groupBy(tier.alias("discount_tier"))
        .agg(F.count(F.lit(1)).alias("num_lines"), _total("sales").alias("sales"), _total("profit").alias("profit"))
        .withColumn("margin_percent", money.percent(F.col("profit"), F.col("sales")))
    )


def store_revenue(lines: DataFrame, store: str) -> DataFrame:
    """Revenue per store after dropping exact copies and counting missing prices as 0."""
    price = F.coalesce("price", F.lit(0))
    return lines.distinct().groupBy(store).agg(money.amount(F.sum(price * F.col("quantity"))).alias("total_revenue"))

"""One small row of sums and a sketch of customers per day, from which any period is answered.

Sums of orders and revenue are exact. Customers are counted by theta sketches, which merge: the distinct customers of a
period are the union of its days' sketches, and those of two periods their intersection. A sketch holds up to 2 to the
power of ``LOG_ENTRIES`` customers exactly; above that its count has the relative standard error of ``relative_error``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions import money
from lakeops.plans.retail import order_values

LOG_ENTRIES = 12


def relative_error(log_entries: int = LOG_ENTRIES) -> float:
    """Relative standard error of a count above what a sketch holds exactly."""
    return 1 / (2**log_entries - 2) ** 0.5


def daily_states(items: DataFrame, orders: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """``order_day``, ``orders``, ``revenue`` (cents) and ``customers`` (a sketch) of each day with billed orders."""
    return order_values(items, orders).groupBy("order_day").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.theta_sketch_agg("customer_id", log_entries).alias("customers"),
    )


def _month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def write_daily(states: DataFrame, path: str) -> None:
    """The states in a partition per month; months that ``states`` does not have stay as they are."""
    months = states.withColumn("month", _month(F.col("order_day"))).repartition("month")
    months.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def read_period(spark: SparkSession, path: str, start: date, end: date) -> DataFrame:
    """The days of a period; only its months' files are opened."""
    first, last = (day.year * 100 + day.month for day in (start, end))
    days = spark.read.parquet(path).filter(F.col("month").between(first, last))
    return days.filter(F.col("order_day").between(F.lit(start), F.lit(end))).drop("month")


def _union(days: DataFrame, log_entries: int) -> DataFrame:
    return days.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        money.amount(F.coalesce(F.sum("revenue"), F.lit(0))).alias("revenue"),
        F.theta_union_agg("customers", log_entries).alias("_customers"),
    )


def summary(days: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Orders, revenue and distinct customers of some days, in one row."""
    customers = F.coalesce(F.theta_sketch_estimate("_customers"), F.lit(0)).alias("customers")
    return _union(days, log_entries).select("orders", "revenue", customers)


def customers_of_both(days: DataFrame, others: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Distinct customers of two periods, and of both of them."""
    one, two = (_union(part, log_entries).select(F.col("_customers").alias(n)) for part, n in ((days, "a"), (others, "b")))
    pair = one.withColumn("b", two.scalar())
    return pair.select(
        F.theta_sketch_estimate("a").alias("customers"),
        F.theta_sketch_estimate("b").alias("customers_before"),
        F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("customers_of_both"),
    )

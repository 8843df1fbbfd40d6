"""Daily states and quantile sketches: exact where they say so, within the stated error elsewhere, and pruned by month."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import stats
from lakeops.plans import daily


def tables(spark, days: int, customers: int):
    """One order per customer and day, every third customer in the first half of the days only."""
    orders = spark.range(days * customers).select(
        F.col("id").alias("order_id"),
        (F.col("id") % customers).alias("customer_id"),
        F.expr(f"date_add(DATE '2024-01-15', CAST(id DIV {customers} AS INT))").alias("order_day"),
        F.when(F.col("id") % 97 == 0, "CANCELLED").otherwise("PLACED").alias("status"),
    )
    orders = orders.filter(f"customer_id % 3 <> 0 OR order_day < date_add(DATE '2024-01-15', {days // 2})")
    orders = orders.withColumn("customer_id", F.when(F.col("customer_id") != 1, F.col("customer_id")))
    items = orders.select("order_id", F.lit(250).cast("bigint").alias("line_revenue"), F.lit(1).cast("bigint").alias("quantity"))
    return items, orders


def span(first: str, last: str):
    return dt.date.fromisoformat(first), dt.date.fromisoformat(last)


def test_periods_from_days_agree_with_the_orders(spark, tmp_path):
    items, orders = tables(spark, 80, 300)
    path = str(tmp_path / "daily")
    daily.write_daily(daily.daily_states(items, orders), path)
    whole = span("2024-01-20", "2024-03-25")
    for first, last in (whole, span("2024-02-01", "2024-02-01"), span("2030-01-01", "2030-02-01")):
        days = daily.read_period(spark, path, first, last)
        held = orders.filter(F.col("status") != "CANCELLED").filter(F.col("order_day").between(F.lit(first), F.lit(last)))
        want = held.agg(F.count("*"), F.countDistinct("customer_id")).first()
        got = daily.summary(days).first()
        assert (got.orders, got.customers, got.revenue) == (want[0], want[1], want[0] * 2.5)
    early, late = (daily.read_period(spark, path, *s) for s in (span("2024-01-15", "2024-02-10"), span("2024-03-10", "2024-03-30")))
    both = daily.customers_of_both(late, early).first()
    assert both.customers_of_both == both.customers < both.customers_before


def test_a_period_opens_its_months_only(spark, tmp_path):
    items, orders = tables(spark, 200, 20)
    path = str(tmp_path / "daily")
    daily.write_daily(daily.daily_states(items, orders), path)
    files = {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    days = daily.read_period(spark, path, *span("2024-03-10", "2024-04-02"))
    opened = {r[0] for r in days.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 8 and {f.split("month=")[1][:6] for f in opened} == {"202403", "202404"} and len(opened) == 2
    assert "PartitionFilters: [isnotnull(month" in days._jdf.queryExecution().executedPlan().toString()
    # A month written again replaces itself and no other.
    june = orders.filter("month(order_day) = 6 AND day(order_day) <= 3")
    daily.write_daily(daily.daily_states(items, june), path)
    kept = spark.read.parquet(path)
    assert kept.filter("month = 202406").count() == 3 and kept.filter("month = 202405").count() == 31


def test_the_error_of_many_customers_is_near_the_stated_one(spark, tmp_path):
    items, orders = tables(spark, 3, 60_000)
    path = str(tmp_path / "daily")
    daily.write_daily(daily.daily_states(items, orders), path)
    got = daily.summary(daily.read_period(spark, path, *span("2024-01-15", "2024-01-17"))).first()
    true = orders.filter(F.col("status") != "CANCELLED").agg(F.countDistinct("customer_id")).first()[0]
    assert true > 50_000 and abs(got.customers / true - 1) < 4 * daily.relative_error()


@pytest.mark.parametrize("k", [200, 800])
def test_sketched_quantiles_stay_within_the_rank_error(spark, k):
    rows = spark.range(60_000).select(
        (F.col("id") % 7).alias("part"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("key"),
        F.when(F.col("id") % 50 != 0, F.exp(F.col("id") * 7919 % 6007 / 700)).alias("value"),
    )
    wanted = {f"q{p}": p / 100 for p in (1, 25, 50, 75, 99)}
    states = stats.quantile_states(rows, "value", ["key", "part"], k)
    found = {r["key"]: r for r in stats.merged_percentiles(states, wanted, ["key"]).collect()}
    values = {r["key"]: sorted(r["v"]) for r in rows.groupBy("key").agg(F.collect_list("value").alias("v")).collect()}
    assert found.keys() == values.keys()
    for key, held in values.items():
        assert found[key]["n"] == len(held)
        for out, q in wanted.items():
            low = sum(v < found[key][out] for v in held) / len(held)
            high = sum(v <= found[key][out] for v in held) / len(held)
            assert max(low - q, q - high) <= stats.rank_error(k), (key, out)


def test_describe_takes_sketches_too(spark):
    rows = spark.range(5000).select((F.col("id") * 31 % 5000).cast("double").alias("v"), F.lit(None).cast("double").alias("none"))
    exact, approx = ({r["column"]: r for r in stats.describe(rows, ["v", "none"], a).collect()} for a in (None, 800))
    for name in ("count", "mean", "std", "min", "max"):
        assert exact["v"][name] == approx["v"][name]
    for name in ("q25", "q50", "q75"):
        assert abs(exact["v"][name] - approx["v"][name]) <= 5000 * stats.rank_error(800) + 1
    assert approx["none"]["q50"] is None

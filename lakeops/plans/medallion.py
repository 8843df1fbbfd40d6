"""Bronze, silver and gold tables of the grocery feed."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions import dates, money
from lakeops.operators.dedupe import drop_repeats
from lakeops.plans.runner import run_together
from lakeops.sources import files

RAW_TABLES = ["orders", "order_items", "customers", "delivery_logs"]
INGESTED = "_ingested_date"


# --- bronze --------------------------------------------------------------------------------


def bronze(spark: SparkSession, raw_root: str) -> dict[str, DataFrame]:
    """The landed files as they are, all text, with the load day and the source file."""
    tables = {
        name: files.read_csv(spark, f"{raw_root}/{folder}", recursive=True)
        for name, folder in (("orders", "orders"), ("order_items", "order_items"), ("delivery_logs", "delivery"))
    }
    tables["customers"] = files.read_json_array(spark, f"{raw_root}/customers", recursive=True)
    return {f"raw_{name}": files.with_ingest_metadata(df) for name, df in tables.items()}


# --- silver --------------------------------------------------------------------------------


def _stamp(raw: DataFrame) -> list[str]:
    return [INGESTED] if INGESTED in raw.columns else []


def _moment(name: str) -> Column:
    return F.try_to_timestamp(F.col(name)).cast("timestamp_ntz").alias(name)


def _code(name: str) -> Column:
    return F.lower(F.trim(name)).alias(name)


def silver_order_items(raw: DataFrame) -> DataFrame:
    rate = files.resolve_column(raw, "discount_pct", "discount")
    typed = drop_repeats(raw, "item_id").select(
        "item_id", "order_id", "product_id", "product_name", "category",
        F.col("qty").try_cast("int").alias("qty"),
        F.col("unit_price").try_cast("decimal(10,2)").alias("unit_price"),
        rate.try_cast("decimal(5,2)").alias("discount_pct"),
        *_stamp(raw),
    )
    parts = F.col("qty"), F.col("unit_price"), F.col("discount_pct")
    return typed.withColumns(
        {"discount_amount": money.discount_amount(*parts), "net_price": money.net_price(*parts)}
    )


def silver_orders(raw: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with the totals of their items; an order without items has totals of 0."""
    totals = items.groupBy("order_id").agg(
        F.sum(money.in_cents(F.col("net_price"))).alias("_total"),
        F.sum(money.in_cents(F.col("discount_amount"))).alias("_discount"),
    )
    zero = F.lit(0)
    return (
        drop_repeats(raw, "order_id")
        .join(totals, "order_id", "left")
        .select(
            "order_id", "customer_id", _moment("order_date"),
            F.trim("city").alias("city"),
            F.trim("payment_mode").alias("payment_mode"),
            _code("status"),
            money.exact_amount(F.coalesce("_total", zero)).alias("order_total"),
            money.exact_amount(F.coalesce("_discount", zero)).alias("total_discount"),
            *_stamp(raw),
        )
    )


def silver_customers(raw: DataFrame) -> DataFrame:
    """Personal data leaves only as hashes."""
    return drop_repeats(raw, "customer_id").select(
        "customer_id",
        F.trim("name").alias("name"),
        money.hashed_email(F.col("email")).alias("email_hash"),
        money.hashed_phone(F.col("phone")).alias("phone_hash"),
        F.trim("city").alias("city"),
        F.col("registered_on").try_cast("date").alias("registered_on"),
        F.col("loyalty_points").try_cast("int").alias("loyalty_points"),
        *_stamp(raw),
    )


def silver_deliveries(raw: DataFrame) -> DataFrame:
    distance = files.resolve_column(raw, "distance_km", "dist_km")
    typed = drop_repeats(raw, "delivery_id").select(
        "delivery_id", "order_id", "rider_id", _moment("pickup_time"), _moment("delivery_time"),
        F.trim("zone").alias("zone"),
        distance.try_cast("double").alias("dist_km"),
        _code("status"),
        *_stamp(raw),
    )
    unfinished = F.col("delivery_time").isNull() | (F.col("status") != "success")
    return typed.withColumns(
        {
            "delivery_duration_mins": dates.minutes_between(F.col("pickup_time"), F.col("delivery_time")),
            "is_incomplete": F.coalesce(unfinished, F.lit(False)),
        }
    )


def silver(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    items = silver_order_items(tables["raw_order_items"])
    return {
        "order_items": items,
        "orders": silver_orders(tables["raw_orders"], items),
        "customers": silver_customers(tables["raw_customers"]),
        "delivery_logs": silver_deliveries(tables["raw_delivery_logs"]),
    }


# --- gold ----------------------------------------------------------------------------------


def _average(total: Column, count: Column) -> Column:
    return money.mean(total, count).cast("decimal(12,2)")


def daily_revenue_by_city(orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled, per day and city; an order is one row."""
    kept = orders.filter(F.col("status") != "cancelled")
    total, size = F.sum("order_total"), F.count(F.lit(1))
    return kept.groupBy(F.to_date("order_date").alias("order_day"), "city").agg(
        total.cast("decimal(18,2)").alias("total_revenue"),
        size.alias("total_orders"),
        _average(total, size).alias("avg_basket_size"),
    )


def product_return_summary(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Units and orders per product, and what came back; cancelled orders are included.

    Lines fold to one row per product and order, so counting orders needs no distinct. They meet their orders
    first: rows that lie by order are folded where they are, and lines move twice, by order and by product.
    """
    product = ["category", "product_id", "product_name"]
    back = F.coalesce(F.col("status") == "returned", F.lit(False)).alias("_back")
    per_order = (
        items.select(*product, "order_id", "qty")
        .join(orders.select("order_id", back), "order_id")
        .groupBy(*product, "order_id", "_back")
        .agg(F.sum("qty").alias("_units"))
    )
    summary = per_order.groupBy(*product).agg(
        F.sum("_units").alias("total_units_sold"),
        F.count("order_id").alias("total_orders"),
        F.sum(F.when(F.col("_back"), F.col("_units")).otherwise(0)).alias("returned_units"),
        F.count_if("_back").alias("returned_orders"),
    )
    rate = money.percent_or_zero(F.col("returned_units"), F.col("total_units_sold"))
    return summary.withColumn("return_rate_pct", rate)


def delivery_zone_performance(deliveries: DataFrame) -> DataFrame:
    done = F.col("status") == "success"
    # Sums over decimals do not depend on the order in which the rows arrive.
    minutes = F.when(done, F.col("delivery_duration_mins").cast("decimal(14,2)"))
    distance = F.col("dist_km").cast("decimal(14,4)")
    summary = deliveries.groupBy("zone").agg(
        F.count("delivery_id").alias("total_deliveries"),
        F.count_if(done).alias("successful_deliveries"),
        F.count_if(F.col("status") != "success").alias("failed_deliveries"),
        money.mean(F.sum(minutes), F.count(minutes)).alias("avg_delivery_time_mins"),
        money.mean(F.sum(distance), F.count(distance)).alias("avg_distance_km"),
    )
    rate = money.percent_or_zero(F.col("failed_deliveries"), F.col("total_deliveries"))
    return summary.withColumn("failure_rate_pct", rate)


def customer_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All customers; their figures cover the orders that were not cancelled."""
    named = F.col("customer_id").isNotNull() & (F.col("customer_id") != "")
    total, size = F.sum("order_total"), F.count(F.lit(1))
    figures = (
        orders.filter(named & (F.col("status") != "cancelled"))
        .groupBy("customer_id")
        .agg(
            size.alias("_orders"),
            total.cast("decimal(18,2)").alias("_spend"),
            F.max("order_date").alias("last_order_date"),
            _average(total, size).alias("_average"),
        )
    )
    zero = F.lit(0)
    return customers.join(figures, "customer_id", "left").select(
        "customer_id", "name", "city", "registered_on", "loyalty_points",
        F.coalesce("_orders", zero).cast("bigint").alias("total_orders"),
        F.coalesce("_spend", zero).cast("decimal(18,2)").alias("total_spend"),
        F.coalesce("_average", zero).cast("decimal(12,2)").alias("avg_order_value"),
        "last_order_date",
    )


def gold(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "daily_revenue_by_city": daily_revenue_by_city(tables["orders"]),
        "product_return_summary": product_return_summary(tables["order_items"], tables["orders"]),
        "delivery_zone_performance": delivery_zone_performance(tables["delivery_logs"]),
        "customer_summary": customer_summary(tables["customers"], tables["orders"]),
    }


# --- serving -------------------------------------------------------------------------------

# Columns and order in which each gold table is served; a written table keeps no order.
# The columns and the order in which each gold table is served.
SERVED = {
    "daily_revenue_by_city": (
        ["order_day", "city", "total_revenue", "total_orders", "avg_basket_size"], ["-order_day", "city"],
    ),
    "product_return_summary": (
        ["category", "product_id", "product_name", "total_units_sold", "returned_units", "return_rate_pct"],
        ["-return_rate_pct", "-returned_units", "product_id"],
    ),
    "delivery_zone_performance": (
        ["zone", "total_deliveries", "successful_deliveries", "failed_deliveries", "avg_delivery_time_mins",
         "failure_rate_pct"],
        ["-failure_rate_pct", "-total_deliveries", "zone"],
    ),
    "customer_summary": (
        ["customer_id", "name", "city", "loyalty_points", "total_orders", "total_spend", "avg_order_value",
         "last_order_date"],
        ["-total_spend", "customer_id"],
    ),
}


def serve(name: str, table: DataFrame) -> DataFrame:
    columns, order = SERVED[name]
    keys = [F.col(k[1:]).desc() if k.startswith("-") else F.col(k).asc() for k in order]
    return table.select(*columns).orderBy(*keys)


# --- pipeline ------------------------------------------------------------------------------


def stages(spark: SparkSession, raw_root: str, lake_root: str, fmt: str = "delta") -> dict[str, Callable[[], None]]:
    """The three layers as stages; each reads what the one before has written."""

    def load(layer: str, names) -> dict[str, DataFrame]:
        return {name: files.read_table(spark, f"{lake_root}/{layer}/{name}", fmt) for name in names}

    def put(layer: str, name: str, df: DataFrame) -> None:
        files.write_table(df, f"{lake_root}/{layer}/{name}", fmt)

    def save(layer: str, tables: dict[str, DataFrame]) -> None:
        run_together([partial(put, layer, name, df) for name, df in tables.items()])

    def run_silver() -> None:
        raw = load("bronze", [f"raw_{name}" for name in RAW_TABLES])

        def items_and_orders() -> None:
            put("silver", "order_items", silver_order_items(raw["raw_order_items"]))
            items = load("silver", ["order_items"])["order_items"]
            put("silver", "orders", silver_orders(raw["raw_orders"], items))

        run_together(
            [
                items_and_orders,
                lambda: put("silver", "customers", silver_customers(raw["raw_customers"])),
                lambda: put("silver", "delivery_logs", silver_deliveries(raw["raw_delivery_logs"])),
            ]
        )

    return {
        "bronze": lambda: save("bronze", bronze(spark, raw_root)),
        "silver": run_silver,
        "gold": lambda: save("gold", gold(load("silver", RAW_TABLES))),
    }

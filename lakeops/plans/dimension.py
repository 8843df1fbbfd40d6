"""The customer dimension: built from order lines, maintained from feeds, summarised."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import money, text
from lakeops.operators import merge, stats
from lakeops.plans.cleaning import clean_dimension, dimension_report
from lakeops.session import stable
from lakeops.sources import versions

KEY = "customer_id"

# The attributes whose change makes a new version, and the tiers from the top.
TRACKED = [
    "segment", "city", "state", "postal_code", "region", "loyalty_tier", "email",
    "total_orders", "total_sales", "total_profit", "last_order_date",
]
TIERS = ["PLATINUM", "GOLD", "SILVER", "BRONZE"]


def build_dimension(lines: DataFrame, orders: DataFrame, domain: str = "@example.com") -> DataFrame:
    """One row per customer from order lines.

    ``lines(order_id, sales, profit)``, money in cents, are folded per order first; ``orders`` carry the
    customer columns of each order (``customer_id, customer_name, segment, country, city,
    state, postal_code, region, order_date``). Frequencies count lines, so each order weighs
    as many lines as it has.
    """
    per_order = lines.groupBy("order_id").agg(
        F.sum("sales").alias("_sales"), F.sum("profit").alias("_profit"), F.count(F.lit(1)).alias("_lines")
    )
    held = stable(per_order.join(orders, "order_id"))
    totals = held.groupBy(KEY).agg(
        F.min_by("customer_name", F.struct("order_date", "order_id")).alias("customer_name"),
        F.count(F.lit(1)).alias("total_orders"),
        money.amount(F.sum("_sales")).cast("decimal(18,2)").alias("total_sales"),
        money.amount(F.sum("_profit")).cast("decimal(18,2)").alias("total_profit"),
        F.max("order_date").alias("last_order_date"),
    )
    result = totals
    for group in (["segment"], ["country"], ["city", "state", "postal_code", "region"]):
        result = result.join(stats.most_frequent(held, KEY, group, weight="_lines"), KEY)
    return result.withColumns(
        {
            "postal_code": text.zero_pad(F.col("postal_code")),
            "loyalty_tier": money.loyalty_tier(F.col("total_sales")),
            "email": F.concat(text.name_slug(F.col("customer_name")), F.lit(domain)),
        }
    )


@dataclass
class Batch:
    """A snapshot and one change feed, cleaned once and merged on demand."""

    raw_snapshot: DataFrame
    raw_feed: DataFrame
    snapshot_at: str
    batch_at: str

    @cached_property
    def master(self) -> DataFrame:
        return stable(clean_dimension(self.raw_snapshot))

    @cached_property
    def feed(self) -> DataFrame:
        return stable(clean_dimension(self.raw_feed))

    @cached_property
    def changes(self) -> DataFrame:
        hashed = merge.with_hash(self.master, TRACKED)
        return stable(merge.classify_changes(merge.with_hash(self.feed, TRACKED), hashed, KEY))

    @cached_property
    def scd1(self) -> DataFrame:
        """The type 1 table after the batch, with actions."""
        return stable(merge.merge_upsert(self.master, self.feed, KEY))

    @property
    def seed_rows(self) -> DataFrame:
        return merge.seed_scd2(self.master, KEY, TRACKED, self.snapshot_at)

    @cached_property
    def seed(self) -> DataFrame:
        return stable(self.seed_rows)

    @cached_property
    def scd2(self) -> DataFrame:
        """The type 2 table after the batch, with actions."""
        return stable(merge.merge_scd2(self.seed, self.feed, KEY, TRACKED, self.batch_at))


def maintain(batch: Batch, scd1: str, scd2: str) -> None:
    """Write the seeds as version 0 and the merged tables as version 1 below the two folders."""
    versions.write_version(batch.master, scd1, 0, "WRITE")
    versions.write_type2(batch.seed, scd2, 0, "WRITE")
    apply_feed(batch.feed, scd1, scd2, batch.batch_at, 0, "MERGE")


def apply_feed(feed: DataFrame, scd1: str, scd2: str, at: str, version: int, operation: str) -> dict[str, dict[str, int]]:
    """Merge one cleaned feed into ``version`` of both tables and write the next; returns the rows by action."""
    spark = feed.sparkSession
    merged = merge.merge_upsert(versions.read_version(spark, scd1, version), feed, KEY)
    merged, counted = merge.counted_actions(merged)
    two = versions.merge_type2(spark, scd2, feed, KEY, TRACKED, at, version, operation)
    versions.write_version(merged.drop(merge.ACTION), scd1, version + 1, operation)
    return {"scd1": counted(), "scd2": two}


def touched_by_batch(dimension: DataFrame, day: str) -> DataFrame:
    state = F.when(F.col("last_order_date") == F.lit(day).cast("date"), "touched by this batch").otherwise("untouched")
    return dimension.groupBy(state.alias("touched")).agg(F.count(F.lit(1)).alias("customers"))


def feed_preview(feed: DataFrame, master: DataFrame) -> DataFrame:
    """What a raw feed holds: rows, keys, copies, and keys known or new to the master."""
    folded = feed.groupBy(*feed.columns).agg(F.count(F.lit(1)).alias("_n"))
    per_key = folded.groupBy(KEY).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_versions"))
    known = master.select(F.col(KEY).alias("_known")).filter("_known IS NOT NULL").distinct()
    joined = per_key.join(known, F.col(KEY) == F.col("_known"), "left")
    return joined.agg(
        F.sum("_rows").alias("rows"),
        F.count_if(F.col(KEY).isNotNull()).alias("distinct_keys"),
        F.sum(F.col("_rows") - F.col("_versions")).alias("duplicated_rows"),
        (F.sum("_rows") - F.count(F.lit(1))).alias("duplicated_keys"),
        F.sum(F.when(F.col("_known").isNotNull(), F.col("_rows")).otherwise(0)).alias("existing_rows"),
        F.sum(F.when(F.col("_known").isNull(), F.col("_rows")).otherwise(0)).alias("new_rows"),
    )


def reconciliation(batch: Batch) -> DataFrame:
    """Rows and distinct customers at each stage, raw to merged, and what cleaning dropped for which cause."""

    def stage(name: str, df: DataFrame, keyed: bool = True) -> DataFrame:
        keys = F.countDistinct(KEY) if keyed else F.lit(None).cast("bigint")
        return df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"), keys.alias("distinct_customers"))

    bare = F.when(F.trim(KEY) != "", F.trim(KEY)).alias(KEY)
    of = F.col("change_type")
    rows = [
        stage("master.raw", batch.raw_snapshot.select(bare)),
        stage("master.clean", batch.master),
        stage("feed.raw", batch.raw_feed.select(bare)),
        stage("feed.clean", batch.feed),
        *[stage(f"feed.{kind.lower()}", batch.changes.filter(of == kind), False) for kind in ("NEW", "CHANGED", "UNCHANGED")],
        stage("type1.rows", batch.scd1),
        stage("type2.rows", batch.scd2),
        stage("type2.open", batch.scd2.filter(merge.CURRENT), False),
        stage("type2.closed", batch.scd2.filter(~F.col(merge.CURRENT)), False),
        *[_dropped(name, raw) for name, raw in (("master", batch.raw_snapshot), ("feed", batch.raw_feed))],
    ]
    whole = rows[0]
    for row in rows[1:]:
        whole = whole.unionByName(row)
    return whole


def _dropped(name: str, raw: DataFrame) -> DataFrame:
    """Rows that cleaning left out, by cause."""
    causes = dimension_report(raw).filter(F.col("metric").startswith("dropped_"))
    return causes.select(
        F.concat(F.lit(f"{name}."), F.replace("metric", F.lit("dropped_"), F.lit("dropped."))).alias("stage"),
        F.col("value").alias("rows"),
        F.lit(None).cast("bigint").alias("distinct_customers"),
    )


def summary_by_region(dimension: DataFrame) -> DataFrame:
    return (
        dimension.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("total_orders").alias("orders"),
            F.sum("total_sales").alias("_sales"),
            F.sum("total_profit").alias("_profit"),
        )
        .select(
            "region", "customers", "orders",
            money.as_double(F.col("_sales")).alias("sales"),
            money.as_double(F.col("_profit")).alias("profit"),
            money.percent(F.col("_profit"), F.col("_sales"), 1).alias("margin_pct"),
        )
    )


def summary_by_segment(dimension: DataFrame) -> DataFrame:
    total, size = F.sum("total_sales"), F.count(F.lit(1))
    return dimension.groupBy("segment").agg(
        size.alias("customers"), money.as_double(total).alias("sales"), money.mean(total, size).alias("avg_sales")
    )


def summary_by_tier(dimension: DataFrame, order: Sequence[str] = TIERS) -> DataFrame:
    """All tiers in the given order, also those without customers."""
    totals = dimension.groupBy("loyalty_tier").agg(
        F.count(F.lit(1)).alias("customers"), money.as_double(F.sum("total_sales")).alias("sales")
    )
    tiers = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(n).alias("loyalty_tier")) for i, n in enumerate(order)]))
    domain = dimension.sparkSession.range(1).select(tiers.alias("t")).select("t.*")
    return domain.join(totals, "loyalty_tier", "left").orderBy("place").select("loyalty_tier", "customers", "sales")


def top_customers(dimension: DataFrame, k: int = 10) -> DataFrame:
    columns = ["customer_id", "customer_name", "segment", "city", "region", "total_orders", "total_sales", "loyalty_tier"]
    best = dimension.select(*columns).orderBy(F.col("total_sales").desc(), "customer_id").limit(k)
    return best.withColumn("total_sales", money.as_double(F.col("total_sales")))


def overall(dimension: DataFrame) -> DataFrame:
    return dimension.agg(
        F.count(F.lit(1)).alias("customers"),
        money.as_double(F.sum("total_sales")).alias("total_sales"),
        money.as_double(F.sum("total_profit")).alias("total_profit"),
    )


def run_summary(batch: Batch, scd1: str, scd2: str) -> DataFrame:
    """One row that sums up a run, fit to be written as JSON: what came in, what cleaning did, what the merges did, which
    versions the tables have now, and how many checks hold."""
    spark = batch.raw_feed.sparkSession
    cleaned = dimension_report(batch.raw_snapshot).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m")  # one entry per metric
    )
    checks = merge.validate_scd1(batch.master, batch.scd1, batch.feed, batch.changes, KEY).unionByName(
        merge.validate_scd2(batch.seed, batch.scd2.drop(merge.ACTION), batch.changes, batch.scd1, KEY)
    )
    tally = checks.agg(F.struct(F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed")))
    kinds = batch.changes.agg(
        *[F.count_if(F.col("change_type") == kind).alias(kind.lower()) for kind in ("NEW", "CHANGED", "UNCHANGED")]
    )
    one = merge.merge_metrics(batch.scd1, batch.feed).select(F.struct("updated", "inserted", "output_rows"))
    two = batch.scd2.agg(
        F.struct(
            F.count_if(F.col(merge.ACTION) == "updated").alias("versions_closed"),
            F.count_if(F.col(merge.ACTION) == "inserted").alias("rows_inserted"),
            F.count_if(F.col(merge.CURRENT)).alias("current_rows"),
            F.count(F.lit(1)).alias("output_rows"),
        )
    )
    return kinds.select(
        batch.raw_snapshot.agg(F.count(F.lit(1))).scalar().alias("snapshot_rows"),
        batch.raw_feed.agg(F.count(F.lit(1))).scalar().alias("feed_rows"),
        F.struct("new", "changed", "unchanged").alias("changes"),
        one.scalar().alias("scd1"),
        two.scalar().alias("scd2"),
        overall(batch.scd1).select(F.struct("*")).scalar().alias("business"),
        cleaned.scalar().alias("cleaning"),
        tally.scalar().alias("validation"),
        batch.master.agg(F.count(F.lit(1))).scalar().alias("rows_before"),
        F.struct(*[F.lit(versions.latest(spark, root)).alias(n) for n, root in (("scd1", scd1), ("scd2", scd2))]).alias("versions"),
    )

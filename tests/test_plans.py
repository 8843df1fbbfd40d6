"""Physical plans: pushdown, pruning, no Python, no cross joins, no one-task windows over the rows."""

from __future__ import annotations

import re

import pytest
import lakeops.plans.catalog  # noqa: F401  (fills the registry)
from lakeops.operators import windows
from lakeops.plans import medallion
from lakeops.plans.binding import Tables
from lakeops.plans.registry import ENTRIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return Tables(spark, DATA)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in ENTRIES if n[0] in "rdpjalu" and not n.startswith(("p12", "a17", "a19", "r16", "d16", "d17", "d18", "d29"))]


# One query of each kind whose plan comes after steps of its own.
STAGED = [
    "q19_orphans", "q32_column_profile", "q33_profile_compared", "m05_merge_upsert", "m13_validate_scd2", "m14_validate_tables",
    "m15_version_changes", "g03_silver_orders", "g07_product_return_summary", "s15", "w02_row_number_per_key", "f08", "r16",
    "d17_line_number_in_customer", "a17_describe",
]


@pytest.mark.parametrize("name", [n for n in ENTRIES if n.startswith(tuple(STAGED))])
def test_staged_plans_stay_on_the_jvm_and_join_on_keys(tables, name):
    text = plan(ENTRIES[name].build(tables))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_the_return_summary_does_not_store_the_lines_again(tables):
    text = plan(ENTRIES["g07_product_return_summary"].build(tables))
    assert "feed_items_v" in text and "silver-items" not in text and "net_price" not in text


def test_lines_move_by_order_and_by_product_only(spark):
    items = spark.createDataFrame(
        [("c", "p", "tea", "1", 2), ("c", "p", "tea", "1", 3), ("c", "p", "tea", "2", 5), ("c", "p", "tea", "3", 7),
         ("c", "q", None, "1", 1), ("c", "q", None, None, 9), ("c", "q", None, "lost", 9)],
        "category string, product_id string, product_name string, order_id string, qty int",
    )
    orders = spark.createDataFrame([("1", "returned"), ("2", "cancelled"), ("3", None), (None, "returned")], "order_id string, status string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summary = medallion.product_return_summary(items, orders)
        text = plan(summary)
        found = {r.product_id: tuple(r)[3:] for r in summary.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 3  # lines by order, orders, products
    assert found == {"p": (17, 3, 5, 1, 29.41), "q": (1, 1, 1, 1, 100.0)}


def line_exchanges(df) -> int:
    """Shuffles between the scan of the lines and the first aggregate that folds them."""
    depth, count, counts = [], 0, []
    for line in plan(df).split("\n"):
        indent = len(line) - len(line.lstrip(" :+-*("))
        depth = [(d, kind) for d, kind in depth if d < indent]
        if "Exchange hashpartitioning" in line:
            depth.append((indent, "exchange"))
        elif "HashAggregate" in line and "partial_" in line:
            depth.append((indent, "fold"))
        if "FileScan" in line and "lineitem" in line:
            folds = [d for d, kind in depth if kind == "fold"]
            inside = max(folds) if folds else -1
            counts.append(sum(1 for d, kind in depth if kind == "exchange" and d > inside))
    return max(counts, default=count)


@pytest.mark.parametrize(
    "name, most",
    [("r01_revenue_per_category", 2), ("a14_mode_per_group", 0), ("a15_most_frequent_tuple", 0), ("d25_busy_cities", 0),
     ("d06_segment_sales_and_profit", 1)],
)
def test_lines_are_shuffled_no_more_than_their_joins_need(spark, tables, name, most):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert line_exchanges(ENTRIES[name].build(tables)) <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_on_the_jvm_and_join_on_keys(tables, name):
    text = plan(ENTRIES[name].build(tables))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(ENTRIES["p07_and_filter"].build(tables))
    assert "EqualTo(o_orderstatus,O)" in text and "GreaterThan(o_totalprice,100000.0)" in text
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {"o_orderkey", "o_orderstatus", "o_totalprice"}


def test_only_needed_lookups_are_joined(tables):
    text = plan(ENTRIES["r22_loaded_span"].build(tables))
    assert "part.parquet" not in text and "customer.parquet" not in text


def test_lines_are_folded_before_they_meet_the_customers(tables):
    text = plan(ENTRIES["r02_top_10_customers"].build(tables))
    assert "TakeOrderedAndProject" in text and "count(distinct" not in text


def test_windows_over_the_rows_are_partitioned(tables):
    orders = tables.raw("orders").select("o_orderkey", "o_totalprice")
    text = plan(windows.ordered_window(orders, ["-o_totalprice", "o_orderkey"], row_number="n"))
    specs = re.findall(r"windowspecdefinition\(([^,]+),", text)
    assert any(spec.startswith("_slice") for spec in specs)
    # The only window without a partition runs over one row per slice.
    assert all(spec.startswith("_slice") for spec in specs)


def test_pivot_columns_are_fixed_up_front(tables):
    text = plan(ENTRIES["r15_cohort_retention"].build(tables))
    assert "pivotfirst" in text.lower()

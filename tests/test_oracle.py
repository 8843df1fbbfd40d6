"""Registered queries against their SQL on the small test tables.

By default one query of each kind of work runs; LAKEOPS_ALL=1 runs all of them.
"""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import compare
from lakeops.plans.registry import ENTRIES

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()
CORE = [
    "r01", "r03", "r07", "r08", "r09", "r10", "r11", "r12", "r13", "r14", "r15", "r16", "r18_weekly", "r19",
    "d13", "d16", "d17", "d18", "d26", "d30", "q27", "q34", "q39_clean_order_items", "q40", "m01", "m05", "m07",
    "m11", "m15", "g03", "g07", "g08", "a15", "a18", "a19", "s02", "s05", "s18", "w04", "w06",
]
CHOSEN = [n for n in ENTRIES if os.environ.get("LAKEOPS_ALL") or any(n.startswith(c) for c in CORE)]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_sql(spark, con, name):
    verdict = compare(QUERIES[name](spark, DATA), ORACLES[name], con)
    assert verdict.startswith("ok "), verdict


def test_every_query_has_its_sql():
    assert set(ENTRIES) <= set(ORACLES) and len(ENTRIES) > 250


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["category", "orders", "net_units", "total_revenue"]

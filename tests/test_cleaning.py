"""Cleaning rules on small tables with the known edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import dedupe
from lakeops.operators.rules import REASON
from lakeops.plans import cleaning
from lakeops.sources.files import store_below

ORDERS = "seq long, order_id string, customer_id string, order_date string, status string, region_code string"
ITEMS = (
    "seq long, item_id string, order_id string, product_id string, quantity string, unit_price string,"
    " discount_percent string"
)
PRODUCTS = "seq long, product_id string, product_name string, category string, subcategory string, cost_price string"
CUSTOMERS = (
    "seq long, customer_id string, customer_name string, email string, registration_date string, customer_type string"
)


def rows(spark, schema, *values):
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], schema)


@pytest.fixture()
def tables(spark):
    orders = rows(
        spark, ORDERS,
        ("O1", "C1", "2026-01-05 10:00:00", " delivered ", "north"),
        ("O2", "C1", "2027-08-01 23:59:59", "PLACED", "N"),
        ("O3", "NULL", "05-01-2026", "Shipped", ""),
        ("O4", "C9", "2026-01-05", None, "N"),
        ("O1", "C2", "2026-01-06 10:00:00", "PLACED", "N"),
        ("", "C1", "2026-01-06", "PLACED", "N"),
        ("O5", "C1", "someday", "PLACED", "N"),
    )
    products = rows(
        spark, PRODUCTS, ("P1", "  BIG   box", "non-fiction", "x", "9.99"), ("P2", "b", "c", "d", "0"), ("P1", "z", "c", "d", "1")
    )
    return orders, products


def reasons(judged, key):
    return {(r[key], r[REASON]) for r in judged.rows.select(key, REASON).collect()}


def test_orders(tables):
    judged = cleaning.clean_orders(tables[0])
    clean = {r.order_id: r for r in cleaning.published(judged).collect()}
    assert set(clean) == {"O1", "O3"}
    assert clean["O1"].customer_id == "C1" and clean["O1"].status == "DELIVERED"
    assert clean["O3"].order_date == dt.datetime(2026, 1, 5) and clean["O3"].region_code == "UNKNOWN"
    assert clean["O3"].customer_id is None
    kept = {(r.quarantine_reason, r.order_id) for r in judged.quarantine.collect()}
    assert kept == {
        ("order_date:future", "O2"), ("status:unknown", "O4"), ("order_id:repeated", "O1"),
        ("order_id:missing", ""), ("order_date:unreadable", "O5"),
    }
    counts = judged.row_counts().first()
    assert (counts.raw, counts.clean, counts.dropped) == (7, 2, 5)


def test_items_follow_their_orders_and_products(spark, tables):
    orders, products = cleaning.clean_orders(tables[0]).clean, cleaning.clean_products(tables[1]).clean
    items = rows(
        spark, ITEMS,
        ("I1", "O1", "P1", "2", "50.00", "150"),
        ("I2", "ORD404", "P1", "1", "10.00", "0"),
        ("I3", "O2", "P1", "1", "10.00", "0"),
        ("I4", "O1", "P2", "1", "10.00", "0"),
        ("I5", "O1", "P1", "0", "10.00", "0"),
        ("I6", "O1", "P1", "-2", "10.00", "n/a"),
        ("I7", "O1", "P1", "3", "-1", "10"),
        ("I8", "O1", None, "3", "1", "10"),
        ("I1", "O3", "P1", "3", "1", "10"),
    )
    judged = cleaning.clean_order_items(items, orders, products)
    clean = {r.item_id: r for r in cleaning.published(judged).collect()}
    assert set(clean) == {"I1", "I6"}
    assert float(clean["I1"].discount_percent) == 100 and clean["I1"].is_return == 0
    assert float(clean["I6"].discount_percent) == 0 and clean["I6"].is_return == 1 and clean["I6"].quantity == -2
    assert reasons(judged, "item_id") - {("I1", None), ("I6", None)} == {
        ("I2", "order_id:orphan"), ("I3", "order_id:orphan"),
        ("I4", "product_id:orphan"), ("I5", "quantity:zero_or_unreadable"),
        ("I7", "unit_price:not_positive"), ("I8", "parent:missing"),
        ("I1", "item_id:repeated"),
    }
    issues = {r.issue: r.rows for r in judged.issues().collect()}
    assert issues["discount_percent:out_of_range"] == 2 and issues["quantity:return"] == 1
    assert issues["order_id:orphan"] == 2


def test_products_are_recased_and_first_kept(tables):
    judged = cleaning.clean_products(tables[1])
    only = cleaning.published(judged).collect()
    assert [(r.product_name, r.category) for r in only] == [("Big Box", "Non-Fiction")]


def test_customers(spark):
    raw = rows(
        spark, CUSTOMERS,
        ("C1", "ana  lee", "A@B.CO", "2020-01-02", " vip"),
        ("C2", "bo", "nobody", "02/01/2020", ""),
        ("C3", "cy", None, "never", "REGULAR"),
        (" null ", "dee", "d@e.fr", "2020-01-02", "REGULAR"),
    )
    judged = cleaning.clean_customers(raw)
    clean = {r.customer_id: r for r in cleaning.published(judged).collect()}
    assert set(clean) == {"C1", "C2"}
    assert clean["C1"].customer_type == "VIP" and clean["C2"].customer_type == "REGULAR"
    assert clean["C2"].registration_date == dt.date(2020, 1, 2)
    assert [r.customer_id for r in cleaning.invalid_emails(judged.clean).collect()] == ["C2"]


def test_counts_taken_while_rows_are_written_are_those_of_the_rows(spark, tables, tmp_path):
    judged = cleaning.clean_orders(tables[0])
    rows, counts = judged.counted_while_written()
    stored = store_below(spark, str(tmp_path))("orders", rows)
    found = counts()
    assert set(found.issues) == {tuple(r) for r in judged.with_rows(stored).issues().collect()}
    assert found.rows == tuple(judged.with_rows(stored).row_counts().first())


def test_counts_of_no_rows_and_no_count_if_while_rows_are_written(spark, tables, tmp_path):
    judged = cleaning.clean_orders(tables[0].filter("seq < 0"))
    rows, counts = judged.counted_while_written()
    metrics = next(line for line in rows._jdf.queryExecution().analyzed().toString().splitlines() if "CollectMetrics" in line)
    assert "sum(" in metrics and "count_if" not in metrics
    store_below(spark, str(tmp_path))("orders", rows)
    assert (counts().issues, counts().rows) == ([], ("orders", 0, 0, 0))


def test_raw_columns_go_through_one_shuffle_at_most(spark):
    """Also where no table is small enough to be broadcast, and most rows have a flag."""
    items = spark.range(3000).select(
        F.col("id").alias("seq"),
        F.concat(F.lit("I"), F.col("id") % 2900).alias("item_id"),
        F.when(F.col("id") % 3 == 0, "O-hot").otherwise(F.concat(F.lit("O"), F.col("id") % 700)).alias("order_id"),
        F.concat(F.lit("P"), F.col("id") % 50).alias("product_id"),
        F.concat(F.lit("payload"), F.col("id")).alias("payload"),
    )
    orders = spark.range(0, 700, 2).select(F.concat(F.lit("O"), F.col("id")).alias("order_id"))
    products = spark.range(40).select(F.concat(F.lit("P"), F.col("id")).alias("product_id"))
    checks = {"repeats": [("item_id", "late")], "missing": [("order_id", orders, "order_id", "lost"), ("product_id", products, "product_id", "gone")]}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = dedupe.mark_rows(items, "seq", **checks)
        found = {r.seq: (r.late, r.lost, r.gone) for r in marked.collect()}
        plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {
        k: (k >= 2900, k % 3 == 0 or (k % 700) % 2 == 1, k % 50 >= 40) for k in range(3000)
    }
    moved = [at for at, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert sum("payload" in next(x for x in plan[at + 1 :] if "Project" in x or "Scan" in x) for at in moved) == 1


def test_clean_all_reports_and_holds_its_constraints(spark, tables, tmp_path):
    orders, products = tables
    raw = {
        "customers": rows(spark, CUSTOMERS, ("C1", "ana", "a@b.co", "2020-01-02", "VIP")),
        "products": products,
        "orders": orders,
        "order_items": rows(
            spark, ITEMS, ("I1", "O1", "P1", "2", "50.00", "10"), ("I2", "ORD404", "P1", "1", "10.00", "0")
        ),
    }
    done = cleaning.clean_all(raw, store_below(spark, str(tmp_path)))
    issues = {(r.table, r.issue): r.rows for r in done["issues"].collect()}
    assert issues[("order_items", "order_id:never_seen")] == 1
    assert issues[("order_items", "order_id:orphan")] == 1
    names = ("customers", "products", "orders", "order_items")
    suite = cleaning.constraint_violations(*[done[f"clean/{n}"] for n in names])
    assert suite.filter("violations > 0").count() == 0
    assert done["quarantine/order_items"].count() == 1


def test_constraint_suite_finds_what_is_planted(spark):
    customers = spark.createDataFrame([("C1", "a", "2020-01-01", "VIP"), ("C1", "a", None, "GOLD")],
                                      "customer_id string, customer_name string, registration_date string, customer_type string")
    products = spark.createDataFrame([("P1", "a", "b", "c", 0.0)],
                                     "product_id string, product_name string, category string, subcategory string, cost_price double")
    orders = spark.createDataFrame([("O1", "C7", "2020-01-01", "LOST", "N")],
                                   "order_id string, customer_id string, order_date string, status string, region_code string")
    items = spark.createDataFrame([("I1", "O9", "P1", 0, 1.0, 150.0, 2)],
                                  "item_id string, order_id string, product_id string, quantity int, unit_price double, discount_percent double, is_return int")
    found = {
        (r.table, r.constraint): r.violations
        for r in cleaning.constraint_violations(customers, products, orders, items).filter("violations > 0").collect()
    }
    assert found == {
        ("customers", "unique customer_id"): 1, ("customers", "check customer_type"): 1,
        ("customers", "required registration_date"): 1, ("products", "check cost_price"): 1,
        ("orders", "check status"): 1, ("orders", "reference customer_id"): 1, ("order_items", "check quantity"): 1,
        ("order_items", "check discount_percent"): 1, ("order_items", "check is_return"): 1,
        ("order_items", "reference order_id"): 1,
    }


def test_many_null_keys_match_nothing(spark):
    df = spark.range(50).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("seq"))
    assert dedupe.mark_repeats(df, "k", "seq", "again").filter("again").count() == 0
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert dedupe.mark_missing_parent(df, "k", parent, "p", "lost", by="seq").filter("lost").count() == 50


def test_dimension_keeps_the_latest_and_fills_gaps(spark):
    columns = ", ".join(f"{name} string" for name in cleaning.DIMENSION)

    def row(key, sales, updated, email="", segment=" CONSUMER ", tier=""):
        return (key, " Ana  María ", segment, "", "new-york", "NY", "", "east", "x", sales, "1.005", "2020-01-02", tier,
                email, updated)

    raw = spark.createDataFrame(
        [row("1", "10", "2020-01-01 00:00:00"), row("1", "2500", "2020-01-02 00:00:00"), row("1", "9", None),
         row("2", "bad", "2020-01-01 00:00:00", " A@B.co "), row("2", "bad", "2020-01-01 00:00:00", " A@B.co "),
         row(" ", "1", "2020-01-01 00:00:00")],
        columns,
    )
    out = {r.customer_id: r for r in cleaning.clean_dimension(raw).collect()}
    assert set(out) == {"1", "2"}
    one, two = out["1"], out["2"]
    assert (one.customer_name, one.segment, one.city) == ("Ana María", "Consumer", "New-York")
    assert (float(one.total_sales), one.loyalty_tier, one.email) == (2500.0, "GOLD", "ana.maria@unknown.local")
    assert (one.country, one.postal_code, one.total_orders) == ("United States", "00000", 0)
    assert (float(two.total_sales), two.loyalty_tier, two.email) == (0.0, "BRONZE", "a@b.co")
    report = {r.metric: r.value for r in cleaning.dimension_report(raw).collect()}
    assert report["rows_in"] == 6 and report["rows_out"] == 2
    assert (report["dropped_null_key"], report["dropped_exact_duplicates"], report["dropped_duplicate_keys"]) == (1, 1, 2)


def test_blank_to_null_and_tidy_give_the_same_with_and_without_whitespace(spark):
    from lakeops.functions import text

    given = {
        "a": "a", " a ": "a", "a  b": "a b", "a\tb": "a b", "\u00a0x": "\u00a0x", "": None, " ": None, "NULL": None, " n/A\n": None,
        "none": None, "nones": "nones", "-": None, "--": "--", "a\x0b\x0cb": "a b", "NaN ": None, None: None,
    }
    df = spark.createDataFrame([(k, v) for k, v in given.items()], "raw string, expected string")
    found = df.select("raw", "expected", text.blank_to_null(F.col("raw")).alias("clean"), text.tidy(F.col("raw")).alias("tidy"))
    for r in found.collect():
        assert r.clean == r.expected, r
        assert r.tidy == (None if r.raw is None else " ".join(r.raw.replace("\u00a0", "@").split()).replace("@", "\u00a0")), r


def test_rows_move_for_the_one_large_set_of_failing_keys_only(spark):
    """Orphans too many to be broadcast, repeats and products few: raw columns move once, by the order, and no keys beside."""
    items = spark.range(4000).select(
        F.col("id").alias("seq"),
        F.concat(F.lit("I"), F.col("id") % 3999).alias("item_id"),
        F.when(F.col("id") % 10 != 0, F.sha2(F.col("id").cast("string"), 256)).alias("order_id"),
        F.concat(F.lit("P"), F.col("id") % 50).alias("product_id"),
        F.concat(F.lit("payload"), F.col("id")).alias("payload"),
    )
    orders = spark.range(0, 4000, 2).select(F.sha2(F.col("id").cast("string"), 256).alias("order_id"))
    products = spark.range(40).select(F.concat(F.lit("P"), F.col("id")).alias("product_id"))
    checks = {"repeats": [("item_id", "late")], "missing": [("order_id", orders, "order_id", "lost"), ("product_id", products, "product_id", "gone")]}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        marked = dedupe.mark_rows(items, "seq", **checks)
        found = {r.seq: (r.late, r.lost, r.gone) for r in marked.collect()}
        plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {k: (k == 3999, k % 10 == 0 or k % 2 == 1, k % 50 >= 40) for k in range(4000)}
    assert "_d0" not in plan and "_at" in plan and plan.count("BroadcastHashJoin") == 2


def test_where_many_keys_lack_a_parent_the_rows_meet_the_parents(spark, monkeypatch):
    items = spark.range(6000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 10 != 0, F.sha2((F.col("id") % 5000).cast("string"), 256)).alias("order_id"),
    )
    orders = spark.range(0, 5000, 2).select(F.sha2(F.col("id").cast("string"), 256).alias("order_id"))
    orders = orders.unionAll(orders).unionAll(spark.sql("SELECT CAST(NULL AS STRING)"))
    written, labels = dedupe.written, []
    monkeypatch.setattr(dedupe, "written", lambda df, label: labels.append(label) or written(df, label))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit, expected in (("4k", ["parents"]), ("10m", ["missing-parents"])):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        labels.clear()
        try:
            marked = dedupe.mark_rows(items, "seq", [], [("order_id", orders, "order_id", "lost")])
            found = {r.seq: r.lost for r in marked.collect()}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert found == {k: k % 10 == 0 or k % 5000 % 2 == 1 for k in range(6000)} and labels == expected


def test_keys_that_may_repeat_are_found_by_their_digests(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "seq long, k string")
    assert {r.seq for r in dedupe.suspects(df, "k").collect()} == {1, 3}
    assert {(r.k, r.seq) for r in dedupe.drop_repeats(df, "k").collect()} == {("a", 1), ("b", 2)}


def test_orphans_are_counted_on_folded_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    for parents in (["b"], ["a", "b"], []):
        parent = spark.createDataFrame([(p,) for p in parents], "p string")
        assert dedupe.orphan_count(child, "k", parent, "p").first()["rows"] == dedupe.orphans(child, "k", parent, "p").count()


def test_a_landed_table_is_dealt_out_only_where_its_splits_are_uneven(spark, tmp_path):
    from lakeops.plans.binding import dealt

    spark.range(4000).repartition(8).write.parquet(str(tmp_path / "even"))
    spark.range(4000).coalesce(1).write.parquet(str(tmp_path / "one"))
    even, one = (spark.read.parquet(str(tmp_path / name)) for name in ("even", "one"))
    assert dealt(even, 6) is even
    assert dealt(one, 6).rdd.getNumPartitions() == 6 and dealt(one, 6).count() == 4000
    empty = spark.read.schema("id long").parquet(str(tmp_path / "even")).filter("id < 0")
    assert dealt(empty, 6).count() == 0


def test_tables_written_on_the_way_are_zstd(spark, tmp_path):
    import os

    store_below(spark, str(tmp_path))("t", spark.range(9))
    assert any(name.endswith(".zstd.parquet") for name in os.listdir(tmp_path / "t"))

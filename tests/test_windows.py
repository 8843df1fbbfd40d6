"""Distributed windows against Spark's own, with hot keys, ties and nulls."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import windows


@pytest.fixture(scope="module")
def rows(spark):
    """600 rows; a third of them share one key, values tie heavily, some keys and values are null."""
    df = spark.range(600).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 50 == 7, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
        .alias("key"),
        (F.col("id") * 7919 % 13).cast("int").alias("tied"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 101).cast("decimal(10,2)")).alias("amount"),
    )
    return df.cache()


def same(left, right):
    assert left.columns == right.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_number_sum_and_lag_match_plain_windows(many_slices, rows, keys):
    order = ["tied", "id"]
    ours = windows.ordered_window(
        rows, order, keys=keys, row_number="n", running={"total": "amount"}, previous={"before": "amount"}
    )
    w = Window.partitionBy(*keys).orderBy(*windows.sort_columns(order))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = rows.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("n"),
        F.sum("amount").over(whole).alias("total"),
        F.lag("amount").over(w).alias("before"),
    )
    same(ours.select(plain.columns), plain)


def test_hot_key_spans_several_slices(many_slices, stored):
    cuts = {r["key"]: len(r["_cuts"]) for r in windows._cuts(stored, ["key"], ["tied", "id"]).collect()}
    assert cuts["hot"] >= 1 and len(cuts) < 40  # of 41 keys the hot one is cut, and few others


@pytest.fixture(scope="module")
def stored(spark, rows, tmp_path_factory):
    """The rows ten times over as a table, with a column that no window looks at."""
    path = str(tmp_path_factory.mktemp("rows"))
    more = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("copy")).withColumn("id", F.col("id") * 10 + F.col("copy"))
    more.withColumn("payload", F.concat(F.lit("payload"), "id")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def payload_exchanges(df) -> int:
    """Shuffles through which the payload goes, of the plan as it was carried out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    found = 0
    for at, line in enumerate(plan):
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
            child = next(x for x in plan[at + 1 :] if "Project" in x or "Scan" in x or "Exchange" in x)
            found += "payload" in child
    return found


@pytest.mark.parametrize("kind", ["window", "rank"])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_rows_move_once_and_are_not_written(many_slices, stored, keys, kind, monkeypatch):
    written, sizes = windows.written, []

    def watched(df, label, *rest):
        sizes.append((label, df.columns, df.count()))
        return written(df, label, *rest)

    monkeypatch.setattr(windows, "written", watched)
    if kind == "window":
        ours = windows.ordered_window(
            stored, ["tied", "id"], keys=keys, row_number="n", running={"total": "amount"}, previous={"before": "amount"}
        )
    else:
        ours = windows.ranked(stored, ["-tied"], keys=keys, rank="r", dense_rank="d")
    assert {label for label, _, _ in sizes} == {"window-sample", "window-cuts", "window-carries"}
    assert all("payload" not in columns and (rows < 100 or label == "window-sample") for label, columns, rows in sizes)
    assert payload_exchanges(ours) == 1


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_many_slices_give_the_numbers_of_one(many_slices, stored, keys):
    order = ["-amount", "id"]
    ours = windows.ordered_window(stored, order, keys=keys, row_number="n", running={"total": "tied"})
    w = Window.partitionBy(*keys).orderBy(*windows.sort_columns(order))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = stored.select("*", F.row_number().over(w).cast("bigint").alias("n"), F.sum("tied").over(whole).alias("total"))
    same(ours, plain)


def test_a_value_that_holds_half_of_all_rows_is_dealt_out(many_slices, stored):
    df = stored.withColumn("level", F.when(F.col("id") % 2 == 0, 50).when(F.col("id") % 17 != 0, F.col("id") % 100))
    cuts = windows._cuts(df, [], ["level"]).first()["_cuts"]
    assert max(cut["_times"] for cut in cuts if cut["_place"]["level"] == 50) >= 3
    ours = windows.ranked(df, ["level"], rank="r", dense_rank="d")
    w = Window.orderBy(*windows.sort_columns(["level"]))
    plain = df.select("*", F.dense_rank().over(w).cast("bigint").alias("d"), F.rank().over(w).cast("bigint").alias("r"))
    same(ours, plain.select(ours.columns))
    half = windows._carried_ranks(df, ["level"], [], windows._cuts(df, [], ["level"]), True).filter("level = 50")
    assert half.select(windows.SLICE).distinct().count() == 1 and half.select("_part").distinct().count() >= 3


def test_null_keys_and_null_places(many_slices, stored):
    df = stored.withColumn("key", F.when(F.col("id") % 2 == 0, F.col("key"))).withColumn(
        "place", F.when(F.col("id") % 3 > 0, F.col("id") % 500)
    )
    for order in (["place", "id"], ["-place", "-id"]):
        w = Window.partitionBy("key").orderBy(*windows.sort_columns(order))
        ours = windows.ordered_window(df, order, keys=["key"], row_number="n")
        same(ours, df.select("*", F.row_number().over(w).cast("bigint").alias("n")))
        first = order[:1]
        v = Window.partitionBy("key").orderBy(*windows.sort_columns(first))
        same(windows.ranked(df, first, keys=["key"], rank="r"), df.select("*", F.rank().over(v).cast("bigint").alias("r")))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_descending_order(many_slices, rows, keys):
    order = ["-tied", "id"]
    ours = windows.ordered_window(rows, order, keys=keys, row_number="n")
    w = Window.partitionBy(*keys).orderBy(*windows.sort_columns(order))
    same(ours, rows.select("*", F.row_number().over(w).cast("bigint").alias("n")))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_ranks_with_ties(many_slices, rows, keys):
    ours = windows.ranked(rows, ["-tied"], keys=keys, rank="r", dense_rank="d")
    w = Window.partitionBy(*keys).orderBy(F.col("tied").desc())
    plain = rows.select("*", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d"))
    same(ours.select(plain.columns), plain)


@pytest.mark.parametrize("size,buckets", [(600, 4), (10, 4), (3, 4), (1, 4), (7, 7), (600, 1)])
def test_ntile(many_slices, rows, size, buckets):
    some = rows.filter(F.col("id") < size)
    ours = windows.ntile(some, buckets, ["-tied", "id"], "b")
    w = Window.orderBy(F.col("tied").desc(), "id")
    same(ours, some.select("*", F.ntile(buckets).over(w).cast("bigint").alias("b")))


@pytest.mark.parametrize("order", ["-tied", "tied"])
def test_top_by_rank_keeps_ties(many_slices, rows, order):
    ours = windows.top_by_rank(rows, 60, order, "r")
    w = Window.orderBy(*windows.sort_columns([order]))
    same(ours, rows.select("*", F.rank().over(w).cast("bigint").alias("r")).filter("r <= 60"))


def test_surrogate_keys_continue(many_slices, rows):
    keyed = windows.surrogate_keys(rows, ["id"], "sk", start=1000)
    assert keyed.filter(F.col("sk") != F.col("id") + 1001).count() == 0


def test_empty_input(many_slices, rows):
    none = rows.filter("id < 0")
    assert windows.ordered_window(none, ["id"], row_number="n").count() == 0
    assert windows.ranked(none, ["tied"], rank="r").count() == 0


def test_previous_needs_ascending_order(rows):
    with pytest.raises(ValueError):
        windows.ordered_window(rows, ["-id"], previous={"p": "amount"})

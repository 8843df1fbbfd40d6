"""Column functions on the awkward values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeops.functions import dates, money, text


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_tidy_and_nulls(spark):
    assert apply(spark, ["  a \t b\n", None], text.tidy) == ["a b", None]
    tokens = ["", " ", "NULL", "None", "nan", "NA", " n/a ", "-", "--", "x"]
    assert apply(spark, tokens, text.blank_to_null) == [None] * 8 + ["--", "x"]


def test_title_case(spark):
    values = ["non-fiction", "S307 bolt", "o'neil JR", "ÉCOLE élan", None]
    assert apply(spark, values, text.title_case) == ["Non-Fiction", "S307 Bolt", "O'Neil Jr", "École Élan", None]


def test_slug_folds_accents(spark):
    assert apply(spark, ["Ana  María O'Neil ", "Ümit Çelik"], text.name_slug) == ["ana.maria.oneil", "umit.celik"]


def test_email(spark):
    values = ["a@b.co", "a@b", "a@", "@b.co", "a b@c.de", "a@b..co", None, "n/a", " a@b.c.d "]
    assert apply(spark, values, text.email_is_valid) == [True, False, False, False, False, False, False, False, True]


def test_currency_and_numbers(spark):
    assert apply(spark, ['"₹3,995.00"', "₹12", "free", None], text.currency_to_decimal) == [
        Decimal("3995.00"), Decimal("12.00"), None, None,
    ]
    assert apply(spark, [" 7 ", "x", "n/a", "-2.50"], text.number_or_null) == [
        Decimal("7.0000"), None, None, Decimal("-2.5000"),
    ]


def test_dates_first_layout_that_fits(spark):
    values = ["2026-01-05 10:20:30", "2026-1-5", "05-01-2026 01:02:03", "5-1-2026", "05/01/2026", "31/02/2026", "soon", ""]
    day = dt.datetime(2026, 1, 5)
    assert apply(spark, values, dates.parse_date) == [
        dt.datetime(2026, 1, 5, 10, 20, 30), day, dt.datetime(2026, 1, 5, 1, 2, 3), day, day, None, None, None,
    ]


def test_week_label_matches_strftime(spark):
    days = [dt.date(2020, 12, 25) + dt.timedelta(days=i) for i in range(800)]
    assert apply(spark, days, dates.week_label, "date") == [d.strftime("%Y-W%W") for d in days]


def test_month_arithmetic(spark):
    days = [dt.date(2024, 3, 31)]
    assert apply(spark, days, lambda c: dates.month_start_back(c, 11), "date") == [dt.date(2023, 4, 1)]
    assert apply(spark, days, lambda c: dates.month_index(F.lit("2023-12-01").cast("date"), c), "date") == [3]


def test_previous_period():
    first, last = dates.previous_period(dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    assert (first, last) == (dt.date(2024, 1, 30), dt.date(2024, 2, 29))
    with pytest.raises(ValueError):
        dates.previous_period(dt.date(2024, 3, 2), dt.date(2024, 3, 1))


def test_percentages(spark):
    row = spark.range(1).select(
        money.percent(F.lit(1), F.lit(3)).alias("third"),
        money.percent(F.lit(1), F.lit(0)).alias("none"),
        money.percent_or_zero(F.lit(2), F.lit(0)).alias("one"),
        money.percent_change(F.lit(-50), F.lit(-100)).alias("up"),
        money.percent_change(F.lit(5), F.lit(0)).alias("nothing"),
        money.rounded(F.lit(1.005)).alias("half"),
    ).first()
    assert tuple(row) == (33.33, None, 200.0, 50.0, None, 1.01)


def test_signed_revenue(spark):
    df = spark.createDataFrame([(2, 50.0, 100.0), (-2, 50.0, 10.0), (3, 9.99, 0.0)], "q int, p double, d double")
    got = [r[0] for r in df.select(money.line_revenue(F.col("q"), F.col("p"), F.col("d"))).collect()]
    assert got == [Decimal("0.00"), Decimal("-90.00"), Decimal("29.97")]


def test_tiers_and_bands(spark):
    assert apply(spark, [5000.0, 2500.0, 1000.0, 999.99, None], money.loyalty_tier, "double") == [
        "PLATINUM", "GOLD", "SILVER", "BRONZE", "BRONZE",
    ]
    assert apply(spark, [10000.01, 10000.0, 5000.0, 4999.0], money.value_band, "double") == [
        "High", "Medium", "Medium", "Low",
    ]


def test_hash_is_stable_across_numeric_types_and_tells_null_from_empty(spark):
    a = spark.createDataFrame([(1.5, "x")], "v double, s string")
    b = spark.createDataFrame([(Decimal("1.50"), "x")], "v decimal(10,2), s string")
    hashes = [df.select(money.record_hash(df.schema, ["v", "s"])).first()[0] for df in (a, b)]
    assert hashes[0] == hashes[1]
    c = spark.createDataFrame([(1.5, None), (1.5, "")], "v double, s string")
    assert c.select(money.record_hash(c.schema, ["v", "s"])).distinct().count() == 2


def test_prices_with_tax_agree_with_published_ones(spark):
    """Ten base prices and the prices published for them."""
    published = [
        (250.0, 295.0), (120.0, 141.6), (750.0, 885.0), (35.0, 41.3), (100.0, 118.0), (12.5, 14.75), (380.0, 448.4),
        (500.0, 590.0), (1100.0, 1298.0), (70.0, 82.6),
    ]
    rows = spark.createDataFrame(published, "base double, final double")
    got = rows.select("final", money.as_double(money.with_tax(F.col("base"))).alias("got")).collect()
    assert all(r["got"] == r["final"] for r in got)


def test_a_layout_is_tried_only_where_it_may_fit(spark):
    values = ["2024-01-05", "5-1-2024", "05-01-2024 1:02:03", "2024-1-5 10:20:30", "5/1/2024", "not a date", "unknown", "2024-1-2024",
              "0005-1-2024", "-0005-1-5", "005-01-2024", "12345-1-1", "+12345-01-01", "2024-01-05 10:20", "1:2:3", "5-1/2024", "1-1", None]
    layouts = dates.DATE_LAYOUTS
    found = apply(spark, values, lambda c: F.array(*[F.try_to_timestamp(c, F.lit(x)).isNotNull() for x in layouts]))
    tried = apply(spark, values, lambda c: F.array(*[F.coalesce(dates._may_fit(c, x), F.lit(False)) for x in layouts]))
    assert all(may or not fits for row, may_row in zip(found, tried) for fits, may in zip(row, may_row))
    # An ISO day is tried once, and what has the separators of no layout never.
    assert [sum(row) for row in tried[:7]] == [1, 1, 1, 1, 1, 0, 0]
    assert apply(spark, ["5.Jan 2024"], lambda c: dates.parse_clean_date(c, ["d.MMM yyyy"])) == [dt.datetime(2024, 1, 5)]


def test_long_stages_are_not_fused_into_methods_that_are_never_compiled(spark):
    wide = spark.range(9).select(*[F.concat_ws("-", *[F.col("id") + k + j for j in range(20)]).alias(f"c{k}") for k in range(40)])
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert len(wide.collect()) == 9

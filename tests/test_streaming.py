"""The change feed, file by file, with a repeat delivery."""

from __future__ import annotations

from lakeops.operators import merge
from lakeops.plans.cleaning import DIMENSION, clean_dimension
from lakeops.plans.dimension import KEY, TRACKED
from lakeops.sources import versions
from lakeops.sources.files import write_csv
from lakeops.streaming import feed

COLUMNS = ", ".join(f"{name} string" for name in DIMENSION)


def rows(spark, at, *people):
    return spark.createDataFrame(
        [(k, f"Name {k}", "Consumer", "US", city, "NY", "1", "East", "1", "10", "1", "2020-01-01", "GOLD", f"{k}@x.y", at)
         for k, city in people],
        COLUMNS,
    )


def test_feed_files_are_applied_once(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    master = clean_dimension(rows(spark, "2020-01-01 00:00:00", ("a", "rome"), ("b", "oslo")))
    versions.write_version(master, one, 0, "WRITE")
    versions.write_type2(merge.seed_scd2(master, KEY, TRACKED, "2020-01-01 00:00:00"), two, 0, "WRITE")
    inbox = str(tmp_path / "inbox")

    def deliver():
        query = feed.run_feed(spark, inbox, one, two, str(tmp_path / "progress"), files_per_batch=1)
        query.awaitTermination(120)
        assert query.exception() is None

    write_csv(rows(spark, "2020-02-01 00:00:00", ("a", "paris"), ("c", "bonn")).coalesce(1), f"{inbox}/d1")
    deliver()
    write_csv(rows(spark, "2020-03-01 00:00:00", ("c", "bern"), ("b", "oslo")).coalesce(1), f"{inbox}/d2")
    write_csv(rows(spark, "2019-03-01 00:00:00", ("a", "late")).coalesce(1), f"{inbox}/d3")
    deliver()
    deliver()  # nothing new

    def state():
        return versions.latest(spark, one), versions.latest(spark, two)

    assert state() == (3, 3)
    assert {r.customer_id: r.city for r in versions.read_version(spark, one, 3).collect()} == {"a": "Paris", "b": "Oslo", "c": "Bern"}
    rows_2 = versions.read_type2(spark, two, 3)
    assert rows_2.count() == 5 and rows_2.filter("is_current").count() == 3
    assert {r.city for r in rows_2.filter("NOT is_current").collect()} == {"Rome", "Bonn"}

    feed.apply_batch(one, two)(rows(spark, "2020-04-01 00:00:00", ("a", "again")), 0)  # batch 0 again
    assert state() == (3, 3)

    feed.apply_batch(one, two)(rows(spark, None, ("a", "lima"), ("e", "kiev")), 9)  # no record time at all
    assert {r.customer_id: r.city for r in versions.read_version(spark, one, 4).collect()} == {
        "a": "Lima", "b": "Oslo", "c": "Bern", "e": "Kiev",
    }
    assert versions.read_type2(spark, two, 4).filter("is_current").count() == 4

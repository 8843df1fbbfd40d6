"""Gapless numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task numbers together, about.
BUCKET_ROWS = 50_000


def numbered(df: DataFrame, group: list[str], by: list[str], name: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 ... within each group, in an arbitrary but repeatable order.

    Rows are dealt into buckets by a hash of ``by``, so that a group that holds a third of all rows lies in many tasks;
    a bucket starts at the number of rows in the buckets before it. ``df`` is read three times and should be a table.
    """
    buckets = max(1, -(-df.count() // bucket_rows))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*group, "_bucket")
        .count()
        .withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*by)
    return (
        dealt.join(starts, [*group, "_bucket"])
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_start")
    )

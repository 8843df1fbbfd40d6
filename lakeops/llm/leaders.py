"""Candidate pairs from buckets of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import written

#: Members of a bucket that all its others are compared with.
LEADERS = 3


def candidate_pairs(texts: DataFrame, leaders: int = LEADERS) -> DataFrame:
    """The pairs of ``candidates``."""
    return candidates(texts, leaders)[0]


def candidates(texts: DataFrame, leaders: int = LEADERS) -> tuple[DataFrame, DataFrame]:
    """Pairs to compare first, and the bucket members (band, id) that are no leaders and so not yet compared.

    Pairs (a, b), a < b, of ``texts`` (id, bands) that share a band: every member of a bucket with its leaders.

    A bucket that many texts share has as many pairs as leaders times members, not all pairs. Leaders are the members
    with the most bucket mates, as the text that others are edited from has more of them than each of these. A bucket
    of up to ``leaders`` + 1 members has all its pairs. Members in ``unlike`` classes once these pairs are linked must be compared
    with each other, or links are lost.
    """
    members = texts.select("id", F.explode(F.array_distinct("bands")).alias("band"))
    shared = members.groupBy("band").count().filter("count > 1")
    members = written(members.join(shared, "band"), "bucket-members")
    degrees = members.groupBy("id").agg(F.sum("count").alias("degree"))
    left = written(members.join(degrees, "id").select("band", "id", "degree"), "bucket-degrees")
    pairs = []
    for _ in range(leaders):
        best = F.min(F.struct((-F.col("degree")).alias("back"), "id")).alias("best")
        first = written(left.groupBy("band").agg(best).select("band", F.col("best.id").alias("leader")), "leaders")
        led = left.join(first, "band").filter("id <> leader")
        pairs.append(led.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")))
        left = led.drop("leader")
    return reduce(DataFrame.union, pairs).distinct(), left.select("band", "id")


def unlike(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """``rest`` (band, id) with each member's ``label``, of the buckets that have members of different labels.

    An id that ``labels`` (id, label) lacks is alone and its own label.
    """
    named = rest.join(labels, "id", "left").select("band", "id", F.coalesce("label", "id").alias("label"))
    named = written(named, "bucket-labels")
    mixed = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return named.join(mixed.select("band"), "band")

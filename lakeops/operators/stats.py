"""Distribution summaries: percentiles, describe, histogram, box plot, modes, correlation.

Exact percentiles are read off counts per distinct value that are range-partitioned and
numbered, so no task holds all values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.money import rounded
from lakeops.operators.windows import ordered_window
from lakeops.session import stable


#: Size of a quantile sketch: about 0.5 % of rank error.
SKETCH_SIZE = 800


def _level_counts(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Distinct values per group with their count and the number of rows up to them."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return ordered_window(stable(counts), ["_v"], keys=keys, running={"_upto": "_n"})


def _pick(levels: DataFrame, keys: Sequence[str], wanted: Sequence[float]) -> DataFrame:
    """Linear-interpolation percentiles ``_p0, _p1 ..`` per group, from the level counts."""
    keys = list(keys)
    totals = levels.groupBy(*keys).agg(F.max("_upto").alias("_size"))
    if keys:
        same = totals.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_size")
        matched = F.lit(True)
        for k in keys:
            matched = matched & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
        sized = levels.join(same, matched).drop(*[f"_t_{k}" for k in keys])
        size = F.col("_size")
    else:
        sized, size = levels, totals.scalar()

    def at(position: Column) -> Column:
        inside = (F.col("_upto") - F.col("_n") <= position) & (position < F.col("_upto"))
        return F.max(F.when(inside, F.col("_v").cast("double")))

    found, steps = [], []
    for i, q in enumerate(wanted):
        place = (size - 1) * F.lit(float(q))
        found += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}")]
        steps.append(F.max(place - F.floor(place)).alias(f"_f{i}"))
    picked = sized.groupBy(*keys).agg(*found, *steps)
    return picked.select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"_p{i}")
            for i in range(len(wanted))
        ],
    )


def rank_error(k: int) -> float:
    """The rank error, as a share of all values, that a quantile of a sketch of size ``k`` stays below with 99 %."""
    return 2.446 / k**0.9433


def quantile_states(df: DataFrame, value: str, keys: Sequence[str] = (), k: int = SKETCH_SIZE) -> DataFrame:
    """A mergeable sketch of ``value`` per group, in the column ``sketch``: kept per day or partition, it stands for the
    rows in any later ``merged_percentiles``. Null values are left out; a group of nothing else has no sketch."""
    values = df.filter(F.col(value).isNotNull())
    return values.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged_percentiles(states: DataFrame, wanted: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Percentiles ``{out: q}`` and the number of values (``n``) per group, from sketches. Each is one of the values, and
    its rank is off by ``rank_error`` at most."""
    merged = states.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_all"))
    found = [F.kll_sketch_get_quantile_double("_all", F.lit(float(q))).alias(out) for out, q in wanted.items()]
    return merged.select(*keys, F.kll_sketch_get_n_double("_all").alias("n"), *found)


def percentiles(
    df: DataFrame, value: str, wanted: dict[str, float], keys: Sequence[str] = (), approx: int | None = None
) -> DataFrame:
    """Percentiles ``{out: q}`` of ``value``, per group where ``keys`` are given: exact, or with ``approx`` from sketches
    of that size, which moves one sketch per task and group in place of every distinct value."""
    if approx:
        found = merged_percentiles(quantile_states(df, value, keys, approx), wanted, keys).drop("n")
        return found.withColumns({out: rounded(F.col(out), 6) for out in wanted})
    picked = _pick(_level_counts(df, value, keys), keys, list(wanted.values()))
    return picked.select(*keys, *[rounded(F.col(f"_p{i}"), 6).alias(out) for i, out in enumerate(wanted)])


def describe(df: DataFrame, columns: Sequence[str], approx: int | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum, one row per column.

    One pass for the moments of all columns and one for all quartiles; ``approx`` as in ``percentiles``.
    """
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).cast("double").alias("value")) for name in columns]
    long = df.select(F.inline(F.array(*cells)))
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        rounded(F.avg("value"), 4).alias("mean"),
        rounded(F.stddev_samp("value"), 4).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = percentiles(long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"], approx)
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins from the minimum to the maximum; the last bin is closed, empty bins are kept."""
    values = df.select(F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    ends = values.agg(F.struct(F.min("_v").alias("low"), ((F.max("_v") - F.min("_v")) / bins).alias("width"))).scalar()
    low, width = ends["low"], ends["width"]
    place = F.least(F.floor(F.try_divide(F.col("_v") - low, width)), F.lit(bins - 1).cast("bigint"))
    counts = values.groupBy(F.coalesce(place, F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").select(
        "bin",
        rounded(low + F.col("bin") * width, 6).alias("lower"),
        rounded(low + (F.col("bin") + 1) * width, 6).alias("upper"),
        F.coalesce("_n", F.lit(0)).alias("rows"),
    )


def box_plot(df: DataFrame, value: str, key: str) -> DataFrame:
    """Quartiles, whiskers (1.5 times the interquartile range) and outlier count per group.

    Everything is read off the counts per distinct value, so the rows are scanned once.
    """
    levels = stable(_level_counts(df, value, [key]))
    quartiles = _pick(levels, [key], [0.25, 0.5, 0.75]).select(
        F.col(key).alias("_k"), F.col("_p0").alias("q1"), F.col("_p1").alias("median"), F.col("_p2").alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    seen = F.col("_v").cast("double")
    inside = seen.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        levels.join(quartiles, F.col(key).eqNullSafe(F.col("_k")))
        .groupBy(key, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, seen)).alias("whisker_low"),
            F.max(F.when(inside, seen)).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_n"))).alias("outliers"),
        )
        .withColumns({name: rounded(F.col(name), 6) for name in ("q1", "median", "q3")})
    )


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    value = F.corr(F.col(x).cast("double"), F.col(y).cast("double"))
    return df.agg(rounded(value, 6).alias("correlation"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def most_frequent(df: DataFrame, key: str, values: Sequence[str], weight: str | None = None) -> DataFrame:
    """The most frequent combination of ``values`` per key, the smallest one on a tie.

    Rows that already stand for several count by their ``weight``.

    Two aggregations with partial sums: a key with very many rows shrinks to its distinct
    combinations before they meet.
    """
    combo = F.struct(*values)
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.groupBy(key, *values).agg(size.alias("_n"))
    best = counts.groupBy(key).agg(F.min_by(combo, F.struct(-F.col("_n"), combo)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{name}").alias(name) for name in values])

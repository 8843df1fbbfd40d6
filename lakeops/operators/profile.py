"""Column and table profiles, counted in as few passes as possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.money import percent


def _rows_from(wide: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return wide.select(F.inline(F.array(*entries)))


def _is_null(name: str) -> Column:
    return F.col(f"`{name}`").isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` for every column, in one pass."""
    wide = df.agg(*[F.count_if(_is_null(name)).alias(f"_{i}") for i, name in enumerate(df.columns)])
    return _rows_from(
        wide,
        [F.struct(F.lit(n).alias("column"), F.col(f"_{i}").alias("nulls")) for i, n in enumerate(df.columns)],
    )


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, nulls, null percentage and distinct values per column.

    Distinct counts copy each row once per column before the partial aggregation, so texts are counted by two 64-bit
    hashes and do not move themselves; two texts count as one only if both hashes agree. ``approximate`` uses sketches
    of fixed size instead.
    """
    texts = {name for name, kind in df.dtypes if kind == "string"}

    def distinct(name: str) -> Column:
        value = F.col(f"`{name}`")
        if approximate:
            return F.approx_count_distinct(value)
        hashed = F.struct(F.xxhash64(value), F.xxhash64(F.lit("b"), value))
        return F.countDistinct(F.when(value.isNotNull(), hashed) if name in texts else value)

    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(df.columns):
        measures += [F.count_if(_is_null(name)).alias(f"_n{i}"), distinct(name).alias(f"_d{i}")]
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"_n{i}").alias("nulls"),
            percent(F.col(f"_n{i}"), F.col("_rows")).alias("null_pct"),
            F.col(f"_d{i}").alias("distinct"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return _rows_from(df.agg(*measures), entries)


def table_profile(df: DataFrame, key: str) -> DataFrame:
    """``(metric, value)``: rows, copies, repeated and distinct keys, null cells.

    Rows are first folded to distinct rows with a count; everything else follows from these.
    """
    cells = sum((_is_null(name).cast("bigint") for name in df.columns), F.lit(0).cast("bigint"))
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = folded.groupBy(key).agg(
        F.sum("_copies").alias("_rows"),
        F.count(F.lit(1)).alias("_versions"),
        F.sum(cells * F.col("_copies")).alias("_null_cells"),
        *[F.max(_is_null(name)).alias(f"_has{i}") for i, name in enumerate(df.columns) if name != key],
    )
    has_null = [F.max(f"_has{i}") for i, name in enumerate(df.columns) if name != key] + [F.max(F.col(key).isNull())]
    groups = F.count(F.lit(1))
    wide = per_key.agg(
        F.sum("_rows").alias("rows"),
        (F.sum("_rows") - F.sum("_versions")).alias("exact_duplicate_rows"),
        (F.sum("_rows") - groups).alias("duplicate_keys"),
        F.count_if(F.col(key).isNotNull()).alias("distinct_keys"),
        sum((flag.cast("bigint") for flag in has_null), F.lit(0).cast("bigint")).alias("columns_with_nulls"),
        F.sum("_null_cells").alias("null_cells"),
    )
    entries = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in wide.columns]
    return _rows_from(wide, entries)


def compare_profiles(before: DataFrame, after: DataFrame) -> DataFrame:
    """Both table profiles side by side, with the difference."""
    joined = before.withColumnRenamed("value", "before").join(after.withColumnRenamed("value", "after"), "metric")
    return joined.withColumn("delta", F.col("after") - F.col("before"))

"""Versions of a table as plain Parquet folders ``root/version=0``, ``root/version=1`` ..., named by the caller.

A folder is written once and never over: of two writers of one version the second gets Spark's own error that the path
exists. History and differences are queries over the folders, whose numbers Spark reads as a partition column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import merge

#: Rows carry the name of the operation that wrote them; one value per folder costs nothing in Parquet.
OPERATION = "_operation"


def _folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def write_version(df: DataFrame, root: str, version: int, operation: str, partition_by: Sequence[str] = ()) -> None:
    """``df`` as one version; an error where it exists. A version without rows has no line in the history."""
    rows = df.withColumn(OPERATION, F.lit(operation))
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(_folder(root, version))


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(_folder(root, version)).drop(OPERATION)


def latest(spark: SparkSession, root: str) -> int:
    """The highest version with rows; no column of them is read."""
    return spark.read.parquet(root).agg(F.max("version")).first()[0]


def history(spark: SparkSession, root: str) -> DataFrame:
    """``version``, ``operation`` and ``output_rows`` of every version."""
    rows = spark.read.parquet(root).groupBy("version", F.col(OPERATION).alias("operation"))
    return rows.agg(F.count(F.lit(1)).alias("output_rows"))


def diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows in both versions, their difference, and keys only the later one has."""
    added = after.join(before.select(key), key, "left_anti")
    return after.agg(F.count(F.lit(1)).alias("rows_after")).select(
        before.agg(F.count(F.lit(1))).scalar().alias("rows_before"),
        "rows_after",
        added.agg(F.count(F.lit(1))).scalar().alias("keys_added"),
    ).withColumn("row_delta", F.col("rows_after") - F.col("rows_before"))


# --- type 2 tables -------------------------------------------------------------------------
#
# Each version has a partition with its current rows, all of them, and one with the rows that it closed. A row that is
# closed never changes, so the table at version n is the current partition of n and the closed partitions up to n.


def write_type2(rows: DataFrame, root: str, version: int, operation: str) -> None:
    """Current rows, and the rows closed by this version, as two partitions."""
    write_version(rows, root, version, operation, [merge.CURRENT])


def _type2_rows(spark: SparkSession, root: str, wanted: Column) -> DataFrame:
    rows = spark.read.parquet(root).filter(wanted)
    columns = [name for name in rows.columns if name not in (OPERATION, "version", merge.CURRENT)]
    return rows.select(*columns, F.col(merge.CURRENT).cast("boolean").alias(merge.CURRENT))


def _is_current() -> Column:
    """Folder names are text to Spark."""
    return F.col(merge.CURRENT).cast("boolean")


def read_current(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The current rows of a version; no file of a closed row is opened."""
    return _type2_rows(spark, root, _is_current() & (F.col("version") == version))


def read_type2(spark: SparkSession, root: str, version: int) -> DataFrame:
    """All rows of a type 2 table as of a version."""
    closed = ~_is_current() & (F.col("version") <= version)
    return _type2_rows(spark, root, closed | (_is_current() & (F.col("version") == version)))


def history_type2(spark: SparkSession, root: str) -> DataFrame:
    """``version``, ``operation`` and ``output_rows`` of every version of a type 2 table."""
    parts = spark.read.parquet(root).groupBy("version").agg(
        F.first(OPERATION).alias("operation"),
        F.count_if(_is_current()).alias("_current"),
        F.count_if(~_is_current()).alias("_closed"),
    )
    later = parts.select(F.col("version").alias("_v"), F.col("_closed").alias("_c"))  # a row for each version
    rows = parts.join(later, F.col("_v") <= F.col("version")).groupBy("version", "operation", "_current")
    return rows.agg((F.col("_current") + F.sum("_c")).alias("output_rows")).drop("_current")


def merge_type2(
    spark: SparkSession, root: str, feed: DataFrame, key: str, tracked: Sequence[str], at: str, version: int, operation: str
) -> dict[str, int]:
    """Write the version after ``version`` with ``feed`` merged in; returns the rows updated (closed), inserted, copied.

    Only the current partition is read, but for the largest surrogate key, a single column; what is written are the
    current rows and the newly closed ones. The actions are counted while the rows are written.
    """
    current = read_current(spark, root, version)
    last = read_type2(spark, root, version).agg(F.max(merge.SK)).first()[0]
    merged, counted = merge.counted_actions(merge.merge_current(current, feed, key, tracked, at, last))
    write_type2(merged.drop(merge.ACTION), root, version + 1, operation)
    return counted()

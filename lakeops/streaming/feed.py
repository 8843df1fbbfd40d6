"""A change feed that arrives as files, applied batch by batch to the dimension tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators import merge
from lakeops.plans.cleaning import DIMENSION, clean_dimension
from lakeops.plans.dimension import KEY, TRACKED
from lakeops.session import stable
from lakeops.sources import versions

FEED_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in DIMENSION])


def feed_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """New CSV files below the path, all text; files keep arriving in whatever number."""
    return (
        spark.readStream.schema(FEED_SCHEMA)
        .option("header", True)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )


def apply_batch(scd1: str, scd2: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges one batch into both tables.

    The operation names the batch, so a batch that is delivered again after a failure is recognised per table and
    skipped there. The newest record time of the batch is the moment its versions change hands; where no row has one,
    it is the time at which the batch is applied. A row older than what the table holds is late and left out; a row
    without a time is as new as its batch.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        operation = f"FEED {batch_id}"
        spark = rows.sparkSession
        feed = stable(clean_dimension(rows))
        newest, now = feed.agg(F.max("record_updated_at"), F.localtimestamp()).first()
        moment = str(newest or now)
        for root, history, merged_with in (
            (scd1, versions.history, _type_one), (scd2, versions.history_type2, _type_two)
        ):
            done = {row["operation"]: row["version"] for row in history(spark, root).collect()}
            if operation not in done:
                merged_with(spark, root, feed, moment, max(done.values(), default=0), operation)

    return run


def _not_late(feed: DataFrame, current: DataFrame) -> DataFrame:
    """Feed rows at least as new as the current row of their key."""
    held = current.select(F.col(KEY).alias("_k"), F.col("record_updated_at").alias("_held"))
    joined = feed.join(held, F.col(KEY) == F.col("_k"), "left")
    late = F.coalesce(F.col("record_updated_at") < F.col("_held"), F.lit(False))
    return joined.filter(~late).drop("_k", "_held")


def _type_one(spark: SparkSession, root: str, feed: DataFrame, moment: str, version: int, operation: str) -> None:
    current = versions.read_version(spark, root, version)
    merged = merge.merge_upsert(current, _not_late(feed, current), KEY)
    versions.write_version(merged.drop(merge.ACTION), root, version + 1, operation)


def _type_two(spark: SparkSession, root: str, feed: DataFrame, moment: str, version: int, operation: str) -> None:
    newer = _not_late(feed, versions.read_current(spark, root, version))
    versions.merge_type2(spark, root, newer, KEY, TRACKED, moment, version, operation)


def run_feed(
    spark: SparkSession, path: str, scd1: str, scd2: str, progress: str, files_per_batch: int = 100
) -> StreamingQuery:
    """Apply every file that is there and stop; ``progress`` remembers which files were done. ``scd1`` and ``scd2`` are
    folders of versions."""
    return (
        feed_stream(spark, path, files_per_batch)
        .writeStream.foreachBatch(apply_batch(scd1, scd2))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )

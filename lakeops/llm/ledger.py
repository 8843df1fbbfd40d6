"""Work done once per content: address texts by digest, keep results in an append-only table, do only what it lacks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.bits import divided
from lakeops.session import written


def content_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The ledger at ``path``, or None before the first append."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for digest in batch.column(0).to_pylist():
            keep.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(keep, pa.bool_()))


def unseen_contents(contents: DataFrame, known: DataFrame | None) -> DataFrame:
    """One row (digest, text) per digest that ``known`` lacks.

    Only digests meet the known ones. Of the texts, those that a filter of the unseen digests rules out, which are nearly
    all known ones, do not move. Copies go before the shuffle, within each task, so that a text that holds a third of all
    rows arrives once per task; the copies that are left meet in one partition and go there.
    """
    fresh = contents.select("digest", "text")
    if known is not None:
        unseen = fresh.select("digest").distinct().join(known.select("digest"), "digest", "left_anti")
        unseen = written(unseen, "unseen")
        fresh = divided(fresh, "digest", unseen)[1].join(unseen, "digest", "left_semi")
    schema = "digest binary, text string"
    return fresh.mapInArrow(_first_seen, schema).repartition("digest").mapInArrow(_first_seen, schema)


def extend(
    contents: DataFrame, path: str, schema: str, version: str, work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The ledger rows of ``version`` after ``work`` has been done for the contents it lacked.

    ``contents`` has digest and text, ``work`` turns rows of both into rows of ``schema``, which begins with
    ``digest binary, version string``. New rows are appended by one write, which leaves nothing behind if it fails.
    Two jobs that extend one ledger at a time may both append the same content: readers take one row per digest.
    """
    spark = contents.sparkSession
    before = stored(spark, path, schema)
    known = None if before is None else before.filter(F.col("version") == version)
    work(unseen_contents(contents, known)).write.mode("append").parquet(path)
    after = spark.read.schema(schema).parquet(path).filter(F.col("version") == version)
    return after if before is None else after.dropDuplicates(["digest"])

"""File sources and sinks: CSV, JSON, Parquet; headers, metadata, gated copies."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import COMPRESSION


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    infer: bool = False,
    encoding: str = "UTF-8",
    recursive: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes inside fields.

    ``columns`` fixes an all-text schema and saves the scan that finds the header; without it
    the header names the columns, all text unless ``infer`` asks for types.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("recursiveFileLookup", recursive)
        .option("multiLine", multiline)
    )
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def read_json_array(
    spark: SparkSession, path: str, schema: str | None = None, recursive: bool = False
) -> DataFrame:
    """Files that hold one JSON array of flat objects each; one file is one task."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", recursive)
    return (reader.schema(schema) if schema else reader).json(path)


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add the load day and the file each row came from."""
    return df.select("*", F.current_date().alias("_ingested_date"), F.col("_metadata.file_path").alias("_source_file"))


def with_load_order(df: DataFrame, out: str = "seq") -> DataFrame:
    """Add the position of each row in its files, for rules that keep the first occurrence.

    Write the result to a table before use, so that the positions are fixed.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(out))


def normalize_columns(df: DataFrame, lower: bool = True) -> DataFrame:
    """``"Sub-Category "`` -> ``sub_category``."""
    names = [re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_") for name in df.columns]
    return df.toDF(*[name.lower() if lower else name for name in names])


def resolve_column(df: DataFrame, *candidates: str) -> Column:
    """The first of the candidate columns that is present."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of {list(candidates)} among {df.columns}")


def csv_options(writer: DataFrameWriter) -> DataFrameWriter:
    """Header, doubled quotes, and spaces at the ends of values kept as they are."""
    return (
        writer.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_csv(df: DataFrame, path: str) -> None:
    csv_options(df.write.mode("overwrite")).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def table_format(spark: SparkSession, wanted: str) -> str:
    """The wanted table format, or Parquet where the session does not have it.

    Only a missing format falls back; any other failure of a write stays visible.
    """
    try:
        spark.read.format(wanted).load([])
    except Exception as error:  # no path is given, so every format raises; only the reason matters
        if "DATA_SOURCE_NOT_FOUND" in str(error) or "ClassNotFound" in str(error):
            return "parquet"
    return wanted


def write_table(df: DataFrame, path: str, fmt: str = "delta") -> None:
    kind = table_format(df.sparkSession, fmt)
    writer = df.write.option("compression", COMPRESSION) if kind == "parquet" else df.write
    writer.format(kind).mode("overwrite").save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "delta") -> DataFrame:
    return spark.read.format(table_format(spark, fmt)).load(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path holds anything, on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return found is not None and len(found) > 0


def source_metadata(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """File count and bytes below the path; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def describe_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows, columns and column names of a CSV source."""
    df = read_csv(spark, path)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"), F.lit(",".join(df.columns)).alias("names")
    )


def copy_csv(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a CSV source if it is there, with whatever columns it has; tells whether it was."""
    if not exists(spark, source):
        return False
    write_csv(read_csv(spark, source), target)
    return True


def star_split(lines: DataFrame, parts: dict[str, Iterable[str]]) -> dict[str, DataFrame]:
    """Split one wide table into several: the distinct rows of each column list."""
    return {name: lines.select(*columns).distinct() for name, columns in parts.items()}


def query_views(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run SQL text over named DataFrames, visible to this statement only."""
    return spark.sql(sql, **views)


def store_below(spark: SparkSession, root: str):
    """A ``store(name, df)`` that writes Parquet below ``root`` and returns it read back."""

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        write_parquet(df, path)
        return spark.read.schema(df.schema).parquet(path)

    return store

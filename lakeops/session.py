"""Session set-up, the shared scratch folder, and stable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; all of them can be changed on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over several tasks, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every partition of one side turns out this small, hash it and do not sort the other.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # The JVM never compiles a method above 8,000 bytes, so a fused stage of many expressions would be interpreted.
    # Above that, its operators run one after the other, each in methods that are short enough.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Of tables written on the way: about half the bytes of the default codec on these texts, in no more time.
COMPRESSION = "zstd"

# Steps that run side by side share one folder, also where the first of them has to make it.
_NAMING = Lock()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to an existing session."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Let Python tasks import this package where it is not installed on the executors: Spark hands them a copy, as it
    does with --py-files. Nothing to do where PYTHONPATH names its folder."""
    package = os.path.dirname(os.path.abspath(__file__))
    root, context = os.path.dirname(package), spark.sparkContext
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    name = os.path.basename(package) + ".zip"
    if root in on_path or any(os.path.basename(f) == name for f in context.listFiles):
        return spark
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="lakeops-")), name)
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    packed.write(os.path.join(folder, file), os.path.relpath(os.path.join(folder, file), root))
    context.addPyFile(archive)
    return spark


def local_session(app: str = "lakeops", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names in spark.checkpoint.dir.

    Where the session names none, a temporary folder is made and set for a local master only: on a cluster every
    machine would have its own, and what one executor writes there no other can read.
    """
    context = spark.sparkContext
    with _NAMING:
        named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        current = context.getCheckpointDir()
        if not named and not current:
            if not context.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="lakeops-")
        if not current:
            context.setCheckpointDir(named)
    return named or current


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/lakeops/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, apart for each application, for one written table."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove every table this application has written on the way; call it when no result is read any more."""
    spark.range(0).write.mode("overwrite").parquet(_scratch(spark))


def written(df: DataFrame, label: str, row_group_bytes: int | None = None) -> DataFrame:
    """``df`` as a table on shared storage, read back.

    Smaller row groups let more tasks read one file.

    The files tell the planner the true size, so a join broadcasts the table where that is
    below the broadcast threshold, and shuffles it where it is not.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.option("compression", COMPRESSION)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size of a written table is below the threshold at which joins broadcast it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= broadcast_limit(df)


def broadcast_limit(df: DataFrame) -> int:
    """Bytes up to which joins broadcast a table; below 0 where they never do."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage so that several passes read the same rows.

    The table survives the loss of executors and cuts the lineage, so partition ids and other values that depend on the
    layout cannot change between the passes; it is columnar and compressed, and a pass reads the columns it needs.
    """
    return written(df, "stable")

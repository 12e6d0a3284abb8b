"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Facility clock times are TIMESTAMP_NTZ; interval arithmetic on them goes
# through TIMESTAMP, so the session zone must be one without offset changes.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a later step would have used its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The first rows of a key are cut in each task before the shuffle, however many are asked for.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000000",
    # Sessions of a key are merged in each task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session made elsewhere."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder named in ``spark.checkpoint.dir``, which a cluster has to name."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.startswith("local["):
        root = f"file://{_one_machine()}"
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share")
    return f"{_own_folder(spark, root)}/{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession, root: str) -> str:
    return f"{root.rstrip('/')}/wardflow/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application has written to the shared scratch folder.

    To be called when its results are written elsewhere: frames that were read from there can no longer be read.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)).getParent()
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@cache
def _one_machine() -> str:
    """The scratch folder of tests, where driver and executors are one process."""
    return tempfile.mkdtemp(prefix="wardflow-")


def settle(df: DataFrame) -> DataFrame:
    """Write a frame that several later steps read to the shared folder, and read it from there.

    This cuts the lineage and, unlike a cache, survives the loss of executors.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

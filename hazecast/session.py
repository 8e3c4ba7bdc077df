"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. On a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hazecast")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.codegen.maxFields", "400")  # sums of products of all feature pairs
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="hazecast-")
    context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder, deleted when the driver's JVM ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write a large derived table once as Parquet below the shared folder, and read it back."""
    folder = new_folder(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def settle(df: DataFrame) -> DataFrame:
    """Compute a small derived table once, reliably, and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()

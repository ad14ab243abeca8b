"""Session settings shared by the tests, the bench and the command line tools."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the results are checked under."""
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortwise")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("COHORTWISE_DRIVER_MEMORY", memory))
        .config("spark.sql.codegen.hugeMethodLimit", "8000")  # larger methods are never compiled by the JVM
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set (tests, local runs) it is a folder below the session's warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    below = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local[") and below.startswith(("file:", "/")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{below}/_checkpoints"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, for tables that are written and read back."""
    return f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: less space than a checkpoint, which holds plain rows."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder, so that lost executors cost no restart."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)

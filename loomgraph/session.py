"""Session helpers: building a session, shared folders, Python path of workers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def build_session(master: str = "local[*]", app: str = "loomgraph", shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings this library is written for (UTC, AQE)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package, and makes checkpoint() usable.

    The shared folder is the one that the cluster names in spark.checkpoint.dir; only
    where that is unset on a local master (tests, local runs) a folder of our own is taken. On a
    cluster it must be set: executors would not see a folder of the driver.
    """
    context = spark.sparkContext
    paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    if not context.getCheckpointDir():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not re.match(r"local(\[|$)", context.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="loomgraph-")
        context.setCheckpointDir(folder)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see."""
    prepare(spark)
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def spooled(df: DataFrame) -> DataFrame:
    """The same rows from Parquet files in the shared folder: for large tables that are read more than once. The files go when the driver ends."""
    spark = prepare(df.sparkSession)
    folder = f"{shared_dir(spark)}/spooled-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.parquet(folder)

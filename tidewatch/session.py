"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage and staging writes.

    A cluster names it in ``spark.checkpoint.dir``; without it there is no folder
    that all executors see, which is an error. Only in local mode (tests, a
    laptop), where nothing is set, a fresh temporary folder is taken.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if path is None:
        if current is None and not re.match(r"local(\[[^-]*)?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = current or tempfile.mkdtemp(prefix="tidewatch-checkpoint-")
    if current is None:
        sc.setCheckpointDir(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark can reach."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library wrote for itself, on any file system Spark can reach."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def workspace(spark: SparkSession, name: str) -> str:
    """New folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as a columnar table in the shared folder.

    For frames that cost much to compute and are scanned several times: later
    scans read only the columns they need, and a lost executor loses nothing.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Times are UTC throughout. A skewed join may be split even where the split costs a shuffle
# further on: one key can hold a large part of a fact table.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Give the session the settings it lacks; only the time zone is always UTC."""
    given = spark.conf.getAll
    for key, value in SETTINGS.items():
        if key not in given or key == "spark.sql.session.timeZone" and given[key] != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="delaylens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def workspace(spark: SparkSession, name: str) -> str:
    """A new, empty folder in the shared folder, removed when the application ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so every later use sees the same rows."""
    set_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def set_checkpoints(spark: SparkSession) -> None:
    """Let checkpoints, also those of Spark ML, go to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))

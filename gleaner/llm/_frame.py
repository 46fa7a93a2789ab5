"""Helpers on DataFrames that the operators share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Only a local session without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="gleaner-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(frame: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that later steps never compute them again."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The same for many rows: a compressed table in the shared folder, which stays there like a checkpoint."""
    folder = fresh_folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    Spark does so when the driver's garbage is collected, which may otherwise be long after their use. The
    first round frees the handles, the second what they referred to.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name

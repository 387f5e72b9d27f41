"""Intermediate results kept in the cluster's shared folder, so that lost executors re-read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which the driver and all executors share.

    Where none is set, a temporary folder serves a local master; on a cluster that is an error, as
    each executor would write to a disk of its own.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def stored(frame: DataFrame, name: str) -> DataFrame:
    """`frame` as a table in the shared folder: computed once, read by column, of known size.

    Spark takes the table for as small as its files, which are compressed, at times a hundredfold: where its
    rows meet others in a join, that join should be `by_shuffle`.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def by_shuffle(frame: DataFrame) -> DataFrame:
    """`frame` as the side of a join that sorts both: neither is broadcast, whatever the size of its files."""
    return frame.hint("merge")


def checkpointed(frame: DataFrame) -> DataFrame:
    """`frame` with its partitions and their row order fixed."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()

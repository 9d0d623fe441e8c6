"""Keeping an intermediate result as a table in the session's shared folder.

A kept result is computed once and read from files, by any executor; a lost one costs no
recompute. It has a known size on disk, so Spark itself decides whether a join broadcasts it.
Nothing is fetched to the driver, and nothing here depends on a number of rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only where all tasks share a machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="lanewise-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str = "kept") -> str:
    """A new path on storage that all executors share; ``release`` removes it."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def release(spark: SparkSession) -> int:
    """Remove what operators kept in this session; returns the number of folders.

    Call it when the results that were built so far have been written or collected: frames
    that still read a kept table fail afterwards.
    """
    removed = 0
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        removed += bool(files.delete(path, True))
    return removed


def kept(
    df: DataFrame, name: str = "kept", by: Sequence[str] = (), codec: str | None = None
) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, for several uses.

    Rows are put into one folder per value of the columns ``by``, so a filter on these reads
    its own rows only; they have to be columns of few values. Wide tables take a denser
    ``codec`` than the session's.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(folder, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder: unlike ``kept`` this preserves the partitions."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)

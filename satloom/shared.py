"""Cutting lineage where a plan is used again and again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> None:
    """Sees to it that checkpoints go to the folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, a session in one process (as in tests) gets a temporary one; on a cluster that is an error,
    since each machine would write to a disk of its own.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not context._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(root or f"file://{tempfile.mkdtemp(prefix='satloom-')}")


def folder(spark: SparkSession) -> str:
    """A new folder in the shared one; it goes when the session's JVM ends."""
    checkpoint_dir(spark)
    context = spark.sparkContext
    found = f"{context._jsc.sc().getCheckpointDir().get()}/satloom-{uuid.uuid4().hex}"
    path = context._jvm.org.apache.hadoop.fs.Path(found)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return found


def kept(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` computed once, as a table in the shared folder; and its number of rows."""
    at, seen = f"{folder(df.sparkSession)}/rows", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at), seen.get["n"]


def checkpointed(df: DataFrame) -> DataFrame:
    return kept(df)[0]


#: Rows that are sent to every task at most.
MAX_SENT = 50_000


def sent(df: DataFrame) -> DataFrame:
    """``df``, computed once, for the small side of a join: sent to every task where it has MAX_SENT rows at most, else merged.

    Without that the planner goes by the size of files: a table of a million rows that compresses to a few MB is sent to every task and fills its memory there.
    """
    table, n = kept(df)
    return F.broadcast(table) if n <= MAX_SENT else table.hint("merge")


class Scratch:
    """Tables of an iteration in one folder: each is computed once, and goes when what was made of it is kept."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.at, self.paths = spark, folder(spark), {}

    def keep(self, df: DataFrame) -> tuple[DataFrame, int]:
        """``df`` as a table, and its number of rows."""
        path, seen = f"{self.at}/{len(self.paths)}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(found)] = (path, found)
        return found, seen.get["n"]

    def drop(self, *tables: DataFrame) -> None:
        """Deletes ``tables`` (of keep); nothing that is still to be computed may read them."""
        files = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.at).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for df in tables:
            files.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths[id(df)][0]), True)

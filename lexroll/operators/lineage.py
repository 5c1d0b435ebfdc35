"""Cutting lineage through written tables, and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side is broadcast only when a count has shown it to be at most this long and its texts and arrays this large.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 128 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Where the session names none, one set on the context will do; in local mode, where all
    tasks run on this machine, a temporary one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """This application's own folder under the shared one; Hadoop removes it when the application ends."""
    folder = f"{shared_folder(spark)}/run-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the run folder: later plans start from it, and read only the columns they use."""
    path = f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy."""
    return written(df)


def rows_up_to(df: DataFrame, bound: int) -> int | None:
    """The row count if it is at most ``bound``, else None; never counts much further."""
    n = df.limit(bound + 1).count()
    return n if n <= bound else None


def fits_broadcast(df: DataFrame, bound: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has been counted to have few rows and few bytes."""
    rows = rows_up_to(df, bound)
    if rows is None:
        return False
    widths = [
        F.coalesce(F.octet_length(c) if kind in ("string", "binary") else 8 * F.size(c), F.lit(0))
        for c, kind in df.dtypes
        if kind in ("string", "binary") or kind.startswith("array")
    ]
    if not widths:
        return True
    total = df.agg(F.sum(sum(widths[1:], widths[0]).cast("long"))).first()[0]
    return (total or 0) <= most


def broadcast_if_small(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after checking the size; beyond it, leave the join to Spark."""
    return F.broadcast(df) if fits_broadcast(df, bound) else df

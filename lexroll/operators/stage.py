"""Resumable stages: what is pending, merging, order, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from lexroll.functions.text import strip


def is_pending(column: str) -> Column:
    """NULL or empty."""
    return F.coalesce(F.col(column), F.lit("")) == ""


def is_pending_normalised(column: str) -> Column:
    """NULL, or after trimming empty, "nan" or "None"."""
    return F.coalesce(strip(F.col(column).cast("string")), F.lit("")).isin("", "nan", "None")


def split_pending(df: DataFrame, column: str, normalised: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pending, done).  Without the column everything is pending."""
    if column not in df.columns:
        return df, df.where(F.lit(False))
    test = is_pending_normalised(column) if normalised else is_pending(column)
    return df.where(test), df.where(~test)


def merge_stage(done: DataFrame, new: DataFrame) -> DataFrame:
    """Done and newly processed rows together; missing columns are NULL."""
    return done.unionByName(new, allowMissingColumns=True)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``; an aggregate, so copies meet map-side."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in rest])).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last._{c}").alias(c) for c in rest])


def restore_order(df: DataFrame, order: str) -> DataFrame:
    """Sort by the position that was noted at the start; only for a sink."""
    return df.orderBy(order)


def blank_fill(df: DataFrame) -> DataFrame:
    """NULL texts become "", as they are handed to readers outside."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.na.fill("", texts)


def read_snapshot(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A stage's table, read with the schema that it must have."""
    return spark.read.schema(schema).parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """A new snapshot; a path is never read and overwritten in one stage."""
    df.write.mode("errorifexists").parquet(path)


def write_measured(df: DataFrame, path: str, **measures: Column) -> dict[str, object]:
    """Write a new snapshot and return the aggregates named, gathered by the tasks that write it; no second pass."""
    seen = Observation()
    write_snapshot(df.observe(seen, *[c.alias(n) for n, c in measures.items()]), path)
    return seen.get

"""Row numbers that stay distributed when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lexroll.operators.lineage import cut_lineage
from lexroll.operators.skew import join_to_keys

KEY_ROWS = 1_000_000  # more rows of one key than this are not numbered in one task


def row_numbers(df: DataFrame, keys: list[str], order: list[str], out: str, bound: int = KEY_ROWS) -> DataFrame:
    """Number the rows of each key 1, 2, ... in ``order``, which must be unique per key.

    If there are keys and none has more than ``bound`` rows, a window per key does it.
    Otherwise the rows are range-partitioned by key and order, so a hot key is spread over many partitions.
    Each partition numbers its own rows; a key that runs on from earlier partitions adds
    their counts.  Only one key can run on into a partition, so the table of those counts
    has at most one row per partition and is broadcast.
    """
    if keys and (df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) <= bound:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(out, number.cast("long"))
    placed = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    placed = cut_lineage(placed)  # fixes the partition of every row for both uses below
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(*keys, "_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .where(F.col("_before") > 0)
    )
    carried = carried.select(
        *[F.col(c).alias(f"_key_{c}") for c in keys], F.col("_part").alias("_into"), "_before"
    )
    match = F.col("_part") == F.col("_into")
    for c in keys:
        match = match & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    return (
        placed.withColumn("_local", F.row_number().over(inside))
        .join(F.broadcast(carried), match, "left")
        .select(*df.columns, (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("long").alias(out))
    )


def go_on_numbering(
    new: DataFrame, marks: DataFrame, key: str, order: list[str], out: str, bound: int = KEY_ROWS
) -> tuple[DataFrame, DataFrame]:
    """``new`` rows numbered from where their key's mark (key, last) stands, and the marks after them.

    Rows numbered before are not read.  Keys without a mark begin at 1, and marks of keys without new rows stay.
    """
    numbered = cut_lineage(row_numbers(new, [key], order, "_own", bound))
    counts = numbered.groupBy(key).agg(F.count("*").alias("_new"))
    after = counts.join(marks, key, "full").select(
        key, "_new", F.coalesce("last", F.lit(0)).cast("long").alias("_from"),
        (F.coalesce("last", F.lit(0)) + F.coalesce("_new", F.lit(0))).cast("long").alias("last"),
    )
    after = cut_lineage(after)
    begun = join_to_keys(numbered, after.where("_new IS NOT NULL").select(key, "_new", "_from"), key, "_new")
    begun = begun.select(*new.columns, (F.coalesce("_from", F.lit(0)) + F.col("_own")).alias(out))
    return begun, after.select(key, "last")


def running_totals(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Sums of ``value`` up to each row in ``order``, whose values must be distinct; no task sees all rows."""
    placed = cut_lineage(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # of one row per partition
    carried = placed.groupBy("_part").agg(F.sum(value).alias("_sum")).withColumn("_before", F.sum("_sum").over(earlier))
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("_local", F.sum(value).over(inside))
        .join(F.broadcast(carried.select("_part", "_before")), "_part")
        .select(*df.columns, (F.col("_local") + F.coalesce("_before", F.lit(0))).alias(out))
    )

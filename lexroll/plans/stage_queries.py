"""Queries for resumable stages, on events and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.operators import stage
from lexroll.plans.catalog import query, table


def labelled_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a half-finished stage: errors have no label, sign-ups an empty one."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id", "user_id", F.when(kind == "error", None).when(kind == "signup", "").otherwise(kind).alias("true_type")
    )


LABELLED = """labelled AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL
  WHEN event_type = 'signup' THEN '' ELSE event_type END AS true_type FROM events)"""


@query(
    f"""WITH {LABELLED} SELECT event_id, true_type,
CASE WHEN coalesce(true_type, '') = '' THEN 'pending' ELSE 'done' END AS state FROM labelled"""
)
def pending_split(spark: SparkSession, folder: str) -> DataFrame:
    todo, done = stage.split_pending(labelled_events(spark, folder), "true_type")
    both = todo.withColumn("state", F.lit("pending")).unionByName(done.withColumn("state", F.lit("done")))
    return both.select("event_id", "true_type", "state")


@query(
    """SELECT event_id, CASE WHEN event_type IN ('error', 'signup', 'click') THEN 'pending' ELSE 'done' END AS state FROM events"""
)
def pending_split_norm(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "error", " nan ").when(kind == "signup", "  ").when(kind == "click", "None")
        .otherwise(F.concat(F.lit(" "), kind)).alias("sphere_3"),
    )
    todo, done = stage.split_pending(rows, "sphere_3", normalised=True)
    both = todo.withColumn("state", F.lit("pending")).unionByName(done.withColumn("state", F.lit("done")))
    return both.select("event_id", "state")


def merged(spark: SparkSession, folder: str) -> DataFrame:
    todo, done = stage.split_pending(labelled_events(spark, folder), "true_type")
    new = todo.withColumn("true_type", F.lit("other")).withColumn("labeled_by", F.lit("AI"))
    return stage.merge_stage(done, new)


@query(
    f"""WITH {LABELLED} SELECT event_id, user_id, true_type FROM labelled WHERE coalesce(true_type, '') <> ''
UNION ALL BY NAME SELECT event_id, user_id, 'other' AS true_type, 'AI' AS labeled_by FROM labelled
WHERE coalesce(true_type, '') = ''"""
)
def merge_stage(spark: SparkSession, folder: str) -> DataFrame:
    return merged(spark, folder)


@query(
    """SELECT event_id AS row_ord, event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'other' ELSE event_type END AS true_type
FROM events ORDER BY row_ord"""
)
def restore_order(spark: SparkSession, folder: str) -> DataFrame:
    rows = merged(spark, folder).withColumn("row_ord", F.col("event_id"))
    return stage.restore_order(rows.select("row_ord", "event_id", "true_type"), "row_ord")


@query(f"WITH {LABELLED} SELECT event_id, user_id, coalesce(true_type, '') AS true_type FROM labelled")
def blank_fill(spark: SparkSession, folder: str) -> DataFrame:
    return stage.blank_fill(labelled_events(spark, folder))


@query(
    """SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem)
WHERE rn = 1"""
)
def keep_last(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return stage.keep_last(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])

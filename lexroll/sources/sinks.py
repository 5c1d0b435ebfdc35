"""Writing report pages."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.operators.reports import LINE_ORDER

TASK_LINES = 100_000  # lines that a task sorts


def write_documents(lines: DataFrame, path: str) -> None:
    """A folder ``doc_name=<page>`` per page, in UTF-8.

    A page of any length is split by range over tasks; its part files in name order are
    the page.  Lines are counted first: ranges joined by their compressed size would hold many times as much when sorted.
    """
    # a name that cannot be NULL lets the writer keep this order instead of sorting by name
    named = lines.withColumn("doc_name", F.coalesce("doc_name", F.lit("unnamed.md")))
    tasks = max(1, math.ceil(lines.count() / TASK_LINES))
    ordered = named.repartitionByRange(tasks, *LINE_ORDER).sortWithinPartitions(*LINE_ORDER)
    ordered.select("doc_name", "line").write.mode("errorifexists").partitionBy("doc_name").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_name, line) of written pages; a text of several lines comes back as several."""
    return spark.read.schema("line string, doc_name string").text(path).select("doc_name", "line")

"""Queries on sources and sinks.  Files are written by Spark from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.operators import reports
from lexroll.operators.lineage import run_folder
from lexroll.plans.catalog import query, table
from lexroll.plans.registry_queries import LEVEL_PAGES, REGISTRY, registry
from lexroll.sources import sinks, tables


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{uuid.uuid4().hex}/{name}"


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || 'x' ELSE '' END AS c_name,
  'a "' || c_mktsegment || '"; Ltd, b' AS c_mktsegment FROM customer"""
)
def read_table(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with quotes, separators and line breaks in their fields, read with nothing but the path."""
    path = fresh_path(spark, "customer.csv")
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, "\nx").otherwise("")).alias("c_name"),
        F.concat(F.lit('a "'), "c_mktsegment", F.lit('"; Ltd, b')).alias("c_mktsegment"),
    )
    rows.write.csv(path, header=True, sep=";", escape='"', quoteAll=True)
    return tables.read_table(spark, path)


@query(f"WITH {REGISTRY}, pages AS ({LEVEL_PAGES}) SELECT doc_name, unnest(string_split(line, chr(10))) AS line FROM pages")
def document_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Level pages written as text files and read again."""
    path = fresh_path(spark, "pages")
    sinks.write_documents(reports.level_documents(registry(spark, folder)), path)
    return sinks.read_documents(spark, path)

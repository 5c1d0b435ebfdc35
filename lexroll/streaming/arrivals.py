"""Documents that arrive over time: the first stage, resumable.

Cutting sections and items works on one document at a time, so it runs on a stream without
state.  Every run takes the files that no earlier run has taken and then stops; what was
taken is kept in the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lexroll.operators import sections as cut
from lexroll.profile import CleanRules, SectionRules


def take_arrivals(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    rules: SectionRules = SectionRules(),
    cleaning: CleanRules = CleanRules(),
    schema: str = "doc_id long, text string",
) -> StreamingQuery:
    """Append (doc_id, section_no, items, status) of new Parquet files in ``folder``."""
    documents = spark.readStream.schema(schema).parquet(folder)
    lines = documents.select("doc_id", cut.paragraphs_of(F.col("text")).alias("paragraphs"))
    found = cut.with_items(cut.with_sections(lines, "paragraphs", rules), rules, cleaning)
    return (
        found.select("doc_id", "section_no", "items", "status")
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def take_batches(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    work: Callable[[DataFrame], DataFrame],
    schema: str = "doc_id long, text string",
    files: int | None = None,
) -> StreamingQuery:
    """Hand new Parquet files in ``folder`` over to ``work``, at most ``files`` of them at a time, and keep its rows.

    ``work`` may be any batch code, model calls included.  A batch is written under its number, in place of what an
    interrupted attempt has left there, so a batch that is repeated changes nothing.
    """
    documents = spark.readStream.schema(schema)
    if files:
        documents = documents.option("maxFilesPerTrigger", files)
    return (
        documents.parquet(folder)
        .writeStream.foreachBatch(lambda rows, number: write_batch(work(rows), out, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batch(rows: DataFrame, out: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{out}/batch={number}")


def read_batches(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.schema(f"{schema}, batch long").parquet(out).drop("batch")

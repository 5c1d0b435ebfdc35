"""Files and pages are written by as many tasks as their size calls for."""

import glob

from pyspark.sql import functions as F

from lexroll.operators.lineage import run_folder
from lexroll.plans.growing_queries import sections_of_arrivals
from lexroll.sources import sinks


def test_a_long_page_is_sorted_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_LINES", 100)
    lines = spark.range(1000).select(
        F.lit("page.md").alias("doc_name"), F.lit("o").alias("owner"), F.lit(0).alias("part"), F.lit("").alias("key"),
        (999 - F.col("id")).alias("row_ord"), F.lit(0).alias("line_no"), F.concat(F.lit("line "), 999 - F.col("id")).alias("line"),
    )
    sinks.write_documents(lines, str(tmp_path / "pages"))
    files = sorted(glob.glob(str(tmp_path / "pages/*/part-*")))
    assert len(files) >= 5
    assert "".join(open(f).read() for f in files) == "".join(f"line {i}\n" for i in range(1000))


def test_arrivals_are_not_written_by_one_task(spark, tmp_path):
    text = "x " * 50
    spark.range(48).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    known = set(glob.glob(f"{run_folder(spark)}/*/in/*.parquet"))
    sections_of_arrivals(spark, str(tmp_path))
    new = set(glob.glob(f"{run_folder(spark)}/*/in/*.parquet")) - known
    assert len(new) > 3

"""Answers kept across runs, by the digest of what was asked.

A store is a Parquet table (key, answer columns, asked_in), partitioned by the first two digits of the key.  A run reads the
partitions that its keys can lie in and takes out what it needs by a join on the key; the rest is asked and appended.
One store holds answers of one model, or vectors of one encoder: another gets another path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import _parse_datatype_string

from lexroll.operators.lineage import broadcast_if_small, cut_lineage

PART_DIGITS = 2


def part_of(key: str = "_key"):
    """The partition of a digest; the letter keeps Spark from taking it for a number."""
    return F.concat(F.lit("p"), F.substring(key, 1, PART_DIGITS))


@dataclass(frozen=True)
class Store:
    """The table's path, and the name that this run puts on its answers."""

    path: str
    run: str = ""

    def through(self, asked: DataFrame, answer: Callable[[DataFrame], DataFrame], columns: str, good: str) -> DataFrame:
        """Answers to ``asked`` (_key, _rows, …), kept ones first; ``answer`` is called for the others.

        Answers that are not ``good`` go back to the caller but not into the store, so a later run asks again.  A
        run that was cut off after it had appended may append the same answers once more; a key is read once.
        """
        asked = cut_lineage(asked)
        names = [f.name for f in _parse_datatype_string(columns)]
        kept = self.find(asked, columns)
        if kept is None:
            return self._asked(asked, answer, names, good)
        known = cut_lineage(asked.select("_key", "_rows").join(kept, "_key"))
        new = asked.join(broadcast_if_small(known.select("_key")), "_key", "left_anti")
        return known.unionByName(self._asked(new, answer, names, good))

    def find(self, asked: DataFrame, columns: str) -> DataFrame | None:
        """What the store has for the keys asked, each once; None if there is no store yet."""
        spark = asked.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return None
        parts = [r[0] for r in asked.select(part_of()).distinct().collect()]  # 16 to the power of the digits at most
        names = [f.name for f in _parse_datatype_string(columns)]
        table = spark.read.schema(f"_key string, {columns}, asked_in string, part string").parquet(self.path)
        met = table.where(F.col("part").isin(parts)).join(broadcast_if_small(asked.select("_key")), "_key", "left_semi")
        return met.groupBy("_key").agg(F.min_by(F.struct(*names, "asked_in"), "asked_in").alias("_a")).select("_key", "_a.*")

    def _asked(self, new: DataFrame, answer, names: list[str], good: str) -> DataFrame:
        answers = answer(new).withColumn("asked_in", F.lit(self.run))
        fresh = answers.where(good).select("_key", *names, "asked_in", part_of().alias("part"))
        fresh.repartition("part").write.mode("append").partitionBy("part").parquet(self.path)
        return answers.select("_key", "_rows", *names, "asked_in")

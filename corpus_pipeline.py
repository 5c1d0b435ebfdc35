"""From raw documents to tokens: five stages, each a table of what it kept, read again by the next.

``STAGES`` lists the stages as (name, function); each takes (spark, docs, sf_dir).  All but the last return the
columns of ``documents``; the last adds the token count and the digests of ids and decoded text.

Defined cases: null and empty texts are documents of no words; the rules reject them.  Repeated rows are judged alike, and
the near-duplicate stage keeps one of them.  Of a group it keeps a document with the smallest id, null last.  Other columns
are kept, whatever their names; columns named as the last stage's results are replaced by these.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.llm import bpe, common, decontaminate, jaccard, quality_classifier, quality_rules
from lexroll.operators.lineage import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier, learnt from ``labels``, rejects low quality."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_by_quality(docs, quality_classifier.learn_quality(docs, labels))


def sound_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rules reject short and repetitive documents, and hosts that mostly have such."""
    return quality_rules.keep_by_rules(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: 5-word shingles, Jaccard similarity of 0.8 and more."""
    return jaccard.keep_one_of_each(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark windows go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenized_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
    common.text_batches(spark)
    automaton = bpe.load(spark, public_tokenizers.path("byte_bpe_50k.json"))
    found = docs.select(F.struct("*").alias("row"), bpe.digest(F.col("text"), automaton).alias("found"))
    names = {f.name.lower() for f in found.schema["found"].dataType}
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in names]
    return found.select(*kept, "found.*")


STAGES = [
    ("quality classifier", good_documents),
    ("quality rules", sound_documents),
    ("near-duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("tokens", tokenized_documents),
]

# Training, fingerprints and tokens are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

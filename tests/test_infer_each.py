"""Rows whose prompts mostly differ are made once and asked with their row; the answers are those of ``infer``."""

import pytest
from pyspark.sql import functions as F

from lexroll.operators import inference
from lexroll.operators.inference import infer, infer_each
from lexroll.plans import model_queries


@pytest.mark.parametrize("few", [True, False])
def test_same_answers_and_equal_prompts_once(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(inference, "fits_broadcast", lambda df: False)
    prompts = [f"p{i}" for i in range(60)] + ["p1", "p1", None, "", "bad", "odd"]
    df = spark.createDataFrame(list(enumerate(prompts)), "id int, said string")
    seen = spark.sparkContext.accumulator(0)

    def model(texts):
        if "bad" in texts:
            raise ValueError("cannot read this")
        seen.add(len(texts))
        return [f"<{t}>" for t in texts]

    accept = lambda answer: answer != "<odd>"
    listed = lambda found: sorted(tuple(r) for r in found.select("id", "raw", "status", "attempts").collect())
    expected = listed(infer(df.withColumn("prompt", F.col("said")), "prompt", model, accept, backoff=0.0, batch=1))
    asked = seen.value
    found = infer_each(df, F.col("said"), model, accept, backoff=0.0, batch=1, task_prompts=10)
    assert found.columns == ["id", "said", "raw", "status", "attempts"]
    assert listed(found) == expected and len(expected) == len(prompts)
    assert seen.value == 2 * asked == 2 * (60 + 1 + 3)


def test_pairs_are_made_once(spark, monkeypatch):
    made, pairs_of = spark.sparkContext.accumulator(0), model_queries.pairs_of

    def counted(rows):
        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        pairs = pairs_of(rows)
        return pairs.mapInArrow(count, pairs.schema)

    monkeypatch.setattr(model_queries, "pairs_of", counted)
    found = model_queries.infer_pair(spark, "/root/testdata/sf0.001").collect()
    assert made.value == len(found) > 0

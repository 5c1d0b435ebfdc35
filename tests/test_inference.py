import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexroll.operators.inference import HashedWords, TransientModelError, _ask, embed, infer, infer_pairs
from lexroll.operators.labels import pair_prompt, pair_prompts, pair_records


class Flaky:
    """Fails the first ``failures`` calls, then answers in capitals."""

    def __init__(self, failures, error=TransientModelError):
        self.failures, self.error, self.calls = failures, error, 0

    def __call__(self, prompts):
        self.calls += 1
        if self.calls <= self.failures:
            raise self.error("busy")
        return [p.upper() for p in prompts]


def test_retry_policy():
    assert _ask(Flaky(2), "a", None, 3, 0.0) == ("A", "OK", 3)
    assert _ask(Flaky(3), "a", None, 3, 0.0) == (None, "ERROR", 3)
    assert _ask(Flaky(1, ValueError), "a", None, 3, 0.0) == (None, "ERROR", 1)
    model = Flaky(0)
    assert _ask(model, "a", lambda x: model.calls == 2, 3, 0.0) == ("A", "OK", 2)
    assert _ask(Flaky(0), "a", lambda x: False, 3, 0.0) == ("A", "INVALID", 3)


def picky(prompts):
    if any("bad" in p for p in prompts):
        raise ValueError("cannot read this")
    return [f"<{p}>" for p in prompts]


def test_a_failing_row_does_not_stop_the_others(spark):
    df = spark.createDataFrame([(i, "bad" if i == 7 else None if i == 3 else f"p{i % 5}") for i in range(40)], "id int, prompt string")
    rows = {r["id"]: r for r in infer(df, "prompt", picky, backoff=0.0).collect()}
    assert len(rows) == 40
    assert (rows[7]["raw"], rows[7]["status"]) == (None, "ERROR")
    assert rows[3]["raw"] == "<>"
    assert all(rows[i]["raw"] == f"<p{i % 5}>" and rows[i]["attempts"] == 1 for i in range(8, 40))


def test_embedding(spark):
    texts = ["a b", "a b", "", None, "  ", "c"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = {r["id"]: r["v"] for r in embed(df, "text", HashedWords(16), out="v").collect()}
    assert len(rows) == 6 and rows[0] == rows[1] and rows[2] == rows[3] == rows[4] == [0.0] * 16
    assert np.linalg.norm(rows[0]) == pytest.approx(1.0)
    assert np.allclose(rows[5], HashedWords(16)(["c"])[0])


def test_texts_that_cannot_be_encoded_have_no_vector(spark):
    def encode(texts):
        if any("bad" in t for t in texts):
            raise ValueError("no")
        return np.ones((len(texts), 2))

    df = spark.createDataFrame([("x",), ("bad",)], "text string")
    assert {r["text"]: r["embedding"] for r in embed(df, "text", encode).collect()} == {"x": [1.0, 1.0], "bad": None}


@pytest.mark.parametrize("limits", [{}, {"bucket_bytes": 40, "tile_pairs": 3}])
def test_prompts_of_pairs_are_asked_as_if_written(spark, limits):
    """The same answers as for the prompts of ``pair_prompts``; equal records are asked once; no prompt is a column."""
    schema = "row_ord long, function_id string, executor string, type string, sphere string, text string"
    rows = [(i, f"F{i % 7}", f"o{i % 7}", None if i % 7 else "t", None, "é\n" * (i % 7)) for i in range(10)]
    shown = spark.createDataFrame(rows, schema)
    made = [(str(a), str(b)) for a in range(10) for b in range(a + 1, 10)]
    pairs = spark.createDataFrame(made, "id_a string, id_b string")
    model = lambda prompts: [hashlib.md5(p.encode()).hexdigest() for p in prompts]
    expected = infer(pair_prompts(pairs, shown, "row_ord", "Judge.", "function_id"), "prompt", model)
    seen = spark.sparkContext.accumulator(0)

    def counting(prompts):
        seen.add(len(prompts))
        return model(prompts)

    found = infer_pairs(pairs, pair_records(shown, "row_ord", "function_id"), counting, lambda a, b: pair_prompt("Judge.", a, b), **limits)
    listed = lambda df: sorted(tuple(r) for r in df.select("id_a", "id_b", "raw", "status", "attempts").collect())
    assert listed(found) == listed(expected) and len(made) == found.count()
    assert seen.value == len({(rows[int(a)][1], rows[int(b)][1]) for a, b in made})


def test_answers_leave_with_their_pair(spark):
    """More columns of a pair stay with it, repeated pairs are asked once, and nothing is joined after the model was asked."""
    records = spark.createDataFrame([(str(i), f"text {i}") for i in range(6)], "id string, record string")
    pairs = spark.createDataFrame([("0", "1", 7), ("0", "1", 8), ("1", "0", 9), ("2", "9", 1), ("4", "5", 2)], "id_a string, id_b string, n int")
    seen = spark.sparkContext.accumulator(0)

    def model(prompts):
        seen.add(len(prompts))
        return prompts

    found = infer_pairs(pairs, records, model, lambda a, b: f"{a} | {b}", batch=1)
    assert found.columns == ["id_a", "id_b", "n", "raw", "status", "attempts"]
    assert sorted((r["n"], r["raw"]) for r in found.collect()) == [
        (2, "text 4 | text 5"), (7, "text 0 | text 1"), (8, "text 0 | text 1"), (9, "text 1 | text 0"),
    ]
    assert seen.value == 3

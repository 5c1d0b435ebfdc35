"""No task of the near-duplicate stage runs a function twice or two functions, so it needs one Python worker."""

from lexroll.llm import jaccard, simhash


def python_steps(df) -> int:
    """How many functions the plan of ``df`` runs; tables that it reads were planned before."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("ArrowEvalPython") + plan.count("MapInArrow")


def test_one_python_step_between_tables(spark, monkeypatch):
    steps, write = [], jaccard.written
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "another text"), (4, None)], "doc_id int, text string")
    docs = write(docs)
    monkeypatch.setattr(jaccard, "written", lambda df: steps.append(python_steps(df)) or write(df))
    kept = jaccard.keep_one_of_each(docs)
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4}
    assert max(steps) == 1 and python_steps(kept) == 1


def test_fingerprints_are_made_once(spark):
    docs = simhash.written(spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "d e f")], "doc_id int, text string"))
    kept = simhash.keep_one_of_each(docs)
    assert {r.doc_id for r in kept.collect()} == {1, 3}
    assert python_steps(kept) == 1

import pytest

from lexroll.operators import lineage, skew


@pytest.mark.parametrize("small", [True, False])
def test_every_row_meets_its_fact_or_none(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    rows = [(i, "hot") for i in range(50)] + [(100, "cold"), (101, None), (102, None), (103, "unknown")]
    frame = spark.createDataFrame(rows, "id int, k string")
    facts = spark.createDataFrame([("hot", 50, "h"), ("cold", 1, "c"), ("unused", 99, "u")], "k string, n long, said string")
    got = skew.join_to_keys(frame, facts, "k", "n", hot_rows=10)
    assert sorted(got.columns) == ["id", "k", "said"]
    said = {"hot": "h", "cold": "c"}
    assert sorted((r["id"], r["k"], r["said"]) for r in got.select("id", "k", "said").collect()) == sorted((i, k, said.get(k)) for i, k in rows)


def test_too_many_hot_keys_are_refused(spark, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 1)
    facts = spark.createDataFrame([("a", 9), ("b", 9)], "k string, n long")
    with pytest.raises(ValueError, match="hot"):
        skew.join_to_keys(facts.select("k"), facts, "k", "n", hot_rows=1)


def test_a_broadcast_needs_few_rows_and_few_bytes(spark):
    df = spark.createDataFrame([("x" * 100, [1.0, 2.0])] * 10, "t string, v array<double>")
    assert lineage.fits_broadcast(df) and not lineage.fits_broadcast(df, bound=9) and not lineage.fits_broadcast(df, most=1_000)

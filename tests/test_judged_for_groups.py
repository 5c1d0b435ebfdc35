"""Where only groups are asked for, the model is asked about the pairs whose verdict can change them."""

import random

import pytest

from lexroll.operators.closure import group_pairs
from lexroll.operators.inference import HashedWords
from lexroll.plans import stages


def listed(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("share", [1, 100])
@pytest.mark.parametrize("real_of_ten", [1, 4])
def test_groups_are_those_of_all_verdicts(spark, monkeypatch, share, real_of_ten):
    monkeypatch.setattr(stages, "ASKED_FIRST", 1)
    monkeypatch.setattr(stages, "ASKED_TOGETHER", share)
    draw = random.Random(real_of_ten)
    made = [(str(a), str(b)) for a in range(24) for b in range(a + 1, 24) if a % 2 == b % 2 or draw.random() < 0.05]
    verdicts = [(*p, draw.choices(["REAL", "FALSE", "ERROR"], [real_of_ten, 8 - real_of_ten, 2])[0]) for p in made]
    known = spark.createDataFrame(verdicts, "id_a string, id_b string, verdict string")
    pairs = known.select("id_a", "id_b")
    asked = stages._judged_for_groups(pairs, lambda some: some.join(known, ["id_a", "id_b"])).cache()
    assert listed(group_pairs(asked.where("verdict = 'REAL'"))) == listed(group_pairs(known.where("verdict = 'REAL'")))
    assert len(set(listed(asked))) == asked.count() <= len(made)
    if real_of_ten == 4:
        assert asked.count() < len(made) / 2 or share == 100


def test_a_class_goes_with_itself_if_nothing_else_ties_it(spark, monkeypatch):
    monkeypatch.setattr(stages, "ASKED_TOGETHER", 0)
    rows = [("1", "2", "1", "1", "REAL"), ("3", "4", "3", "3", "FALSE"), ("5", "6", "5", "6", "REAL"), ("5", "7", "5", "5", "REAL"), ("8", "9", "8", "9", "FALSE")]
    known = spark.createDataFrame(rows, "id_a string, id_b string, class_a string, class_b string, verdict string")
    asked = stages._judged_for_groups(known.drop("verdict"), lambda some: some.join(known.select("id_a", "id_b", "verdict"), ["id_a", "id_b"]), a="class_a", b="class_b")
    real = {c for r in asked.where("verdict = 'REAL'").collect() for c in (r["class_a"], r["class_b"])}
    assert real == {"1", "5", "6"}
    none = stages._judged_for_groups(known.drop("verdict").limit(0), lambda some: some.join(known.select("id_a", "id_b", "verdict"), ["id_a", "id_b"]))
    assert none.count() == 0 and "verdict" in none.columns


SHOWN = "row_ord long, function_id string, function_text string, executor string, true_type string"


def rows_of(numbers):
    return [(i, f"F{i}", "a b c d e f g h " * 4 + f"w{i % 20}", f"o{i % 3}", "t") for i in numbers]


def counting(spark):
    seen = spark.sparkContext.accumulator(0)

    def model(prompts):
        seen.add(len(prompts))
        return ['{"verdict": "%s"}' % ("real" if hash_of(p) % 3 else "false") for p in prompts]

    return seen, model


def hash_of(text):
    return sum(map(ord, text))


def test_classes_are_asked_where_a_group_can_change(spark, monkeypatch):
    monkeypatch.setattr(stages, "ASKED_TOGETHER", 0)
    monkeypatch.setattr(stages, "ASKED_FIRST", 1)
    rows, found, calls = spark.createDataFrame(rows_of(range(40)), SHOWN), [], []
    for every in (True, False):
        seen, model = counting(spark)
        result = stages.collide_classes(rows, model, HashedWords(), "J", block_cols=("true_type",), threshold=0.9, every_pair=every)
        found.append(listed(result.registry.select("row_ord", "collision_group", "collision_verdict")))
        calls.append(seen.value)
    assert found[0] == found[1] and calls[1] < calls[0] / 2


def test_a_later_run_asks_where_a_group_can_change(spark, monkeypatch):
    monkeypatch.setattr(stages, "ASKED_TOGETHER", 0)
    monkeypatch.setattr(stages, "ASKED_FIRST", 1)
    found, calls = [], []
    for every in (True, False):
        seen, model = counting(spark)
        shape = dict(model=model, encode=HashedWords(), template="J", block_cols=("true_type",), threshold=0.9, every_pair=every)
        first = stages.collide(spark.createDataFrame(rows_of(range(0, 30, 2)), SHOWN), **shape)
        rows = first.registry.unionByName(spark.createDataFrame(rows_of(range(1, 30, 2)), SHOWN), allowMissingColumns=True)
        result = stages.collide(stages.cut_lineage(rows), known=first.pairs, **shape)
        found.append(listed(result.registry.select("row_ord", "collision_group", "collision_verdict")))
        calls.append(seen.value)
    assert found[0] == found[1] and calls[1] < calls[0] / 2

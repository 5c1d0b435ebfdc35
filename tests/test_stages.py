"""The five stages on a small registry, with stand-in models."""

import json
import re

from pyspark.sql import functions as F

from lexroll.operators import stage
from lexroll.operators.inference import HashedWords, TransientModelError
from lexroll.plans import stages


def names(prompts):
    return ["```json\n" + json.dumps({"full_go_name": re.sub(r"^Положение о ", "", p.split("\n")[0]).split(".")[0]}, ensure_ascii=False) + "\n```" for p in prompts]


DOCUMENTS = [
    ("d1", "Положение о Комитет дорог Министерства связи\nГлава 1\n7. Функции:\n1) ведёт учёт дорог;\n2) строит мосты;\nГлава 2\nx"),
    ("d2", "Положение о Агентство мостов\nГлава 1\nФункции\n1) строит мосты\n2) красит мосты\nПоложение о Центр данных\nГлава 1\nнет"),
    ("d3", "ничего"),
]


def types(prompts):
    return ['{"verdict": "Контрольные"}' if "учёт" in p else '{"verdict": "реализационные"}' for p in prompts]


def broken(prompts):
    raise ValueError("down")


def nodes(prompts):
    return ['{"name": "04.5"}' if "мост" in p.rsplit("\n\n", 1)[1] else '{"name": "01.3 Службы"}' for p in prompts]


def verdicts(prompts):
    return ['Here: {"verdict": "real"}' for _ in prompts]


def parsed(spark):
    docs = spark.createDataFrame(DOCUMENTS, "doc string, text string").select("doc", F.split("text", "\n").alias("paragraphs"))
    return stages.parse(docs, names)


def snapshot(spark, df, folder, n):
    """Write a stage's table and go on from the written one, as between real runs."""
    stage.write_snapshot(df, f"{folder}/{n}")
    return stage.read_snapshot(spark, f"{folder}/{n}", df.schema)


def test_from_documents_to_pages(spark, tmp_path):
    result = parsed(spark)
    result = stages.Parsed(snapshot(spark, result.registry, tmp_path, 1), result.rejected, result.nodes)
    rows = result.registry.orderBy("row_ord").collect()
    assert [(r["function_id"], r["function_text"], r["executor"], r["parent_executor"], r["level"]) for r in rows] == [
        ("МС-КД-1", "ведёт учёт дорог", "Комитет дорог Министерства связи МС", "Министерства связи РЕС", "2.1"),
        ("МС-КД-2", "строит мосты", "Комитет дорог Министерства связи МС", "Министерства связи РЕС", "2.1"),
        ("АМ-1", "строит мосты", "Агентство мостов РЕС", "Республика Казахстан", "1.1"),
        ("АМ-2", "красит мосты", "Агентство мостов РЕС", "Республика Казахстан", "1.1"),
    ]
    assert [r["reason"] for r in result.rejected.collect()] == ["HEADER_NOT_FOUND"]

    failed = stages.classify(result.registry, broken, "T{embedding_suggestions}")
    assert {(r["true_type"], r["final_label"], r["labeled_by"]) for r in failed.collect()} == {(None, "ОШИБКА", None)}
    examples = spark.createDataFrame([("строит мосты", "Реализационные")], "ref_text string, ref_label string")
    typed = stages.classify(failed, types, "T{embedding_suggestions}", examples, HashedWords())
    typed = snapshot(spark, typed, tmp_path, 2)
    by_text = {r["function_text"]: r["true_type"] for r in typed.collect()}
    assert by_text == {"ведёт учёт дорог": "Контрольные", "строит мосты": "Реализационные", "красит мосты": "Реализационные"}
    again = stages.classify(typed, broken, "T")  # nothing pending, so the model is not asked
    assert sorted(map(str, again.select(sorted(typed.columns)).collect())) == sorted(map(str, typed.select(sorted(typed.columns)).collect()))

    taxonomy = spark.createDataFrame(
        [(0, "01.3.1 Службы", "общие", ""), (1, "04.5.1 Мосты и дороги", "", "мосты")], "ord int, name string, description string, activities string"
    )
    placed = snapshot(spark, stages.place(typed, taxonomy, nodes, HashedWords(), "N", k=2), tmp_path, 3)
    found = {r["function_text"]: (r["sphere"], r["sphere_3"], r["sphere_status"]) for r in placed.collect()}
    assert found["строит мосты"] == ("04.5.1 Мосты и дороги", "04 Экономические вопросы", "containment")
    assert found["ведёт учёт дорог"] == ("ОШИБКА", "", "invalid")

    known = spark.createDataFrame([], "id_a string, id_b string, verdict string")
    result = stages.collide(placed, verdicts, HashedWords(), "J", known=known, threshold=0.9)
    result = stages.Collided(snapshot(spark, result.registry, tmp_path, 4), result.pairs)
    assert [r["verdict"] for r in result.pairs.collect()] == ["REAL"]
    groups = {(r["function_id"], r["collision_group"], r["collision_verdict"]) for r in result.registry.collect()}
    assert groups == {
        ("МС-КД-1", "NO_COLLISION", "FALSE"), ("МС-КД-2", "COLLISION_1", "REAL"), ("АМ-1", "COLLISION_1", "REAL"), ("АМ-2", "NO_COLLISION", "FALSE"),
    }
    rerun = stages.collide(result.registry, broken, HashedWords(), "J", known=result.pairs, threshold=0.9)
    assert {(r["function_id"], r["collision_group"], r["collision_verdict"]) for r in rerun.registry.collect()} == groups

    pages = {r["doc_name"] for r in stages.report(result.registry).select("doc_name").distinct().collect()}
    assert "collision_COLLISION_1.md" in pages and "level_2.1_functions.md" in pages and len(pages) == 5


def test_a_new_row_meets_the_finished_ones(spark):
    schema = "row_ord long, function_id string, function_text string, executor string, true_type string, sphere_3 string, collision_group string, collision_verdict string"
    rows = [
        (1, "A-1", "строит мосты", "A", "t", "s", "COLLISION_1", "REAL"), (2, "B-1", "строит мосты", "B", "t", "s", "COLLISION_1", "REAL"),
        (3, "C-1", "строит мосты", "C", "t", "s", None, None), (4, "D-1", "строит мосты", "D", "t", "other", "NO_COLLISION", "FALSE"),
        (5, "E-1", "строит мосты", "E", "Общие", "s", "", ""),
    ]
    known = spark.createDataFrame([("1", "2", "REAL"), ("1", "3", "ERROR")], "id_a string, id_b string, verdict string")
    result = stages.collide(spark.createDataFrame(rows, schema), verdicts, HashedWords(), "J", known=known)
    assert {(r["id_a"], r["id_b"]) for r in result.pairs.collect()} == {("1", "2"), ("1", "3"), ("2", "3")}
    assert {r["row_ord"]: r["collision_group"] for r in result.registry.collect()} == {
        1: "COLLISION_1", 2: "COLLISION_1", 3: "COLLISION_1", 4: "NO_COLLISION", 5: "NO_COLLISION",
    }
    silent = stages.collide(spark.createDataFrame(rows, schema), broken, HashedWords(), "J", known=known)
    assert {r["verdict"] for r in silent.pairs.where("id_b = '3'").collect()} == {"ERROR"}
    universal = spark.createDataFrame([("строит мосты",)], "text string")
    none = stages.collide(spark.createDataFrame(rows, schema), verdicts, HashedWords(), "J", universal=universal)
    assert none.pairs.count() == 0


def test_resumable_pieces(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (4, " nan ")], "id int, label string")
    assert [[r["id"] for r in part.orderBy("id").collect()] for part in stage.split_pending(df, "label")] == [[1, 2], [3, 4]]
    assert [[r["id"] for r in part.orderBy("id").collect()] for part in stage.split_pending(df, "label", True)] == [[1, 2, 4], [3]]
    todo, done = stage.split_pending(df, "absent")
    assert (todo.count(), done.count()) == (4, 0)
    last = stage.keep_last(spark.createDataFrame([("a", 1, "old"), ("a", 2, None), ("b", 1, "only")], "k string, at int, v string"), ["k"], ["at"])
    assert {tuple(r) for r in last.collect()} == {("a", 2, None), ("b", 1, "only")}
    stage.write_snapshot(df, str(tmp_path / "s"))
    assert stage.read_snapshot(spark, str(tmp_path / "s"), "id int, label string").count() == 4
    assert [r["label"] for r in stage.blank_fill(df).orderBy("id").collect()] == ["", "", "x", " nan "]


def test_rows_that_cannot_be_encoded_stay_pending(spark):
    """The model isn't asked about them, and no verdict is written."""

    def encode(texts):
        if any("плохо" in t for t in texts):
            raise ValueError("cannot")
        return HashedWords()(texts)

    def nodes_for(prompts):
        assert not any("плохо" in p for p in prompts)
        return nodes(prompts)

    schema = "row_ord long, function_id string, function_text string, executor string, true_type string"
    rows = spark.createDataFrame([(1, "A-1", "плохо", "A", "t"), (2, "B-1", "плохо", "B", "t"), (3, "C-1", "мост", "C", "t")], schema)
    taxonomy = spark.createDataFrame([(0, "04.5.1 Мосты", "мост", "")], "ord int, name string, description string, activities string")
    placed = {r["row_ord"]: r for r in stages.place(rows, taxonomy, nodes_for, encode, "N").collect()}
    assert {placed[i]["sphere"] for i in (1, 2)} == {"ОШИБКА"} and {placed[i]["sphere_3"] for i in (1, 2)} == {""}
    assert placed[3]["sphere"] == "04.5.1 Мосты"
    result = stages.collide(rows, verdicts, encode, "J", block_cols=("true_type",))
    assert {r["row_ord"]: (r["collision_group"], r["collision_verdict"]) for r in result.registry.collect()} == {
        1: (None, None), 2: (None, None), 3: ("NO_COLLISION", "FALSE"),
    }


def test_hints_are_looked_up_once_a_text(spark, monkeypatch):
    """Rows of a few texts, and of equally near examples those of the first label."""
    looked = []
    nearest = stages.similar.nearest
    monkeypatch.setattr(stages.similar, "nearest", lambda df, *a, **k: (looked.append(df.count()), nearest(df, *a, **k))[1])
    rows = [(i, ["a b", "c", None, ""][i % 4]) for i in range(200)]
    examples = spark.createDataFrame([("a b", "y"), ("b a", "x"), ("A B", "z"), ("B a", "x")], "ref_text string, ref_label string")
    prompts = lambda texts: ['{"verdict": "%s"}' % ("Контрольные" if "are: x, y." in t else "Реализационные") for t in texts]
    done = stages.classify(
        spark.createDataFrame(rows, "row_ord long, function_text string"), prompts, "T{embedding_suggestions}", examples, HashedWords(), 0.5
    ).collect()
    assert looked == [3] and len(done) == 200
    assert {(r["function_text"], r["true_type"]) for r in done} == {
        ("a b", "Контрольные"), ("c", "Реализационные"), (None, "Реализационные"), ("", "Реализационные")
    }

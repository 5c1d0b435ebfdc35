import random

import pytest
from pyspark.sql import functions as F

from lexroll.operators import hierarchy

SECTIONS = "ord int, full_name string, main string, parent string"


def nodes_of(spark, rows):
    return hierarchy.build_nodes(spark.createDataFrame(rows, SECTIONS))


def test_nodes(spark):
    nodes = nodes_of(
        spark,
        [
            (1, "Комитет А", "Комитет А", None),
            (2, "Комитет Аа", "Комитет А", "Министерство Б"),
            (3, "Комитет Бб", "Комитет А", "Министерство В"),
            (4, "", "Центр", "Комитет А"),
            (5, "Министерство Б, полное", "Министерство Б", " "),
        ],
    )
    by = {r["name"]: r for r in nodes.collect()}
    assert set(by) == {"Комитет А", "Министерство Б", "Министерство В", "Центр"}
    a = by["Комитет А"]
    assert (a["full_name"], a["parent_name"], a["conflict"], a["children"], a["level"]) == ("Комитет Аа", "Министерство Б", True, 1, "2.1")
    assert by["Министерство Б"]["full_name"] == "Министерство Б, полное" and by["Министерство Б"]["parent_name"] is None
    assert (by["Министерство В"]["full_name"], by["Центр"]["full_name"]) == ("Министерство В", "Центр")
    assert {(r["name"], r["child"]) for r in hierarchy.child_links(nodes).collect()} == {("Министерство Б", "Комитет А"), ("Комитет А", "Центр")}


def test_paths_and_rows(spark):
    rows = [(1, "Комитет дорог", "Комитет дорог", "Министерство Б"), (2, "Центр дорог", "Центр дорог", "Комитет дорог"), (3, "Фонд", "Фонд", "Нет"), (4, "Центр домов", "Центр домов", "Комитет дорог")]
    paths = hierarchy.hierarchy_paths(nodes_of(spark, rows))
    by = {r["name"]: (r["id_prefix"], r["executor"], r["parent_executor"]) for r in paths.collect()}
    assert by["Министерство Б"] == ("МБ", "Министерство Б РЕС", "Республика Казахстан")
    assert by["Комитет дорог"] == ("МБ-КД", "Комитет дорог МБ", "Министерство Б РЕС")
    assert by["Центр дорог"] == ("МБ-КД-ЦД", "Центр дорог КД", "Комитет дорог МБ")
    assert by["Фонд"] == ("Н-Ф", "Фонд Н", "Нет РЕС")
    items = spark.createDataFrame([("Центр дорог", 2, "b"), ("Центр дорог", 1, "a"), ("Центр домов", 1, "c")], "name string, ord int, item string")
    found = {(r["function_id"], r["function_text"], r["level"]) for r in hierarchy.registry_rows(paths, items, ["ord"]).collect()}
    # equal initials below one parent give equal ids; the name of the node tells them apart
    assert found == {("МБ-КД-ЦД-1", "a", "3.1"), ("МБ-КД-ЦД-2", "b", "3.1"), ("МБ-КД-ЦД-1", "c", "3.1")}


def test_cycles_are_cut_and_told(spark):
    rows = [
        (1, "B", "B", "A"), (2, "A", "A", "B"), (3, "T", "T", "A"), (4, "TT", "TT", "T"), (5, "S", "S", "S"),
        (6, "X1", "X1", "X2"), (7, "X2", "X2", "X3"), (8, "X3", "X3", "X1"), (9, "R", "R", None), (10, "Q", "Q", "R"),
    ]
    nodes = nodes_of(spark, rows)
    cycles = {r["name"]: r["cycle"] for r in hierarchy.find_cycles(nodes).collect()}
    assert cycles == {"A": "A", "B": "A", "S": "S", "X1": "X1", "X2": "X1", "X3": "X1"}
    paths = {r["name"]: r["id_prefix"] for r in hierarchy.hierarchy_paths(nodes).collect()}
    assert paths == {
        "A": "A", "B": "A-B", "T": "A-T", "TT": "A-T-TT", "S": "S", "X1": "X1", "X3": "X1-X3", "X2": "X1-X3-X2", "R": "R", "Q": "R-Q",
    }


def test_deep_chain(spark):
    rows = [(i, f"n{i}", f"n{i}", f"n{i-1}" if i else None) for i in range(70)]
    paths = hierarchy.hierarchy_paths(nodes_of(spark, rows))
    assert paths.where("name = 'n69'").first()["id_prefix"].count("-") == 69
    assert hierarchy.find_cycles(nodes_of(spark, rows)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_changed_bodies_are_climbed_again(spark, seed):
    draw = random.Random(seed)
    names = [f"Центр {chr(1040 + i // 5)}{chr(1072 + i % 5)}" for i in range(40)]
    rows = {n: (n, f"{n} полный", draw.choice([*names, None, None, "Вне списка"]), hierarchy_mark(n), "", 0, False, i, 0) for i, n in enumerate(names[:36])}
    schema = "name string, full_name string, parent_name string, abbreviation string, level string, children long, conflict boolean, ord int, as_parent int"
    frame = lambda found: spark.createDataFrame(list(found), schema)
    known = hierarchy.hierarchy_paths(frame(rows.values()))
    for _ in range(seed + 1):
        changed = {}
        for n in draw.sample(names, 5):  # some of them are new
            changed[n] = (n, f"{n} иной", draw.choice([*names, None]), hierarchy_mark(n) + draw.choice(["", "X"]), "", 0, False, names.index(n), 0)
        rows |= changed
        known = hierarchy.update_paths(known, frame(changed.values()))
        wanted = hierarchy.hierarchy_paths(frame(rows.values()))
        assert sorted(map(tuple, known.collect())) == sorted(map(tuple, wanted.select(*known.columns).collect()))


def hierarchy_mark(name):
    return name.split()[1].upper()

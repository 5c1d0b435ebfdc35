"""Tables that grow: groups, numbers, answers; copies judged once; blocks that fail alone."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexroll.operators import closure, inference, ranks, similar, stage
from lexroll.operators.store import Store
from lexroll.plans import stages
from tests.test_closure import components


def grown(groups, links):
    """{id: number} after new links, by the rule."""
    name = lambda x: f"0:{groups[x]:020d}" if x in groups else f"1:{x}"
    found = components([(name(a), name(b)) for a, b in links])
    top = lambda x: found.get(name(x), name(x))
    out = {x: int(top(x)[2:]) for x in groups}
    last = max(groups.values(), default=0)
    fresh = {x for pair in links for x in pair} - set(groups)
    new = sorted({top(x) for x in fresh if top(x).startswith("1:")})
    for x in fresh:
        out[x] = int(top(x)[2:]) if top(x).startswith("0:") else last + 1 + new.index(top(x))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_groups_grow_as_if_closed_at_once(spark, seed):
    draw = random.Random(seed)
    name = lambda: f"n{draw.randrange(120):03d}"
    groups, every = {}, []
    for _ in range(3):
        links = [(a, b) for a, b in ((name(), name()) for _ in range(18)) if a != b]
        every += links
        old = spark.createDataFrame(list(groups.items()), "id string, number long")
        got = {r["id"]: r["number"] for r in closure.grow_groups(old, spark.createDataFrame(links, "id_a string, id_b string")).collect()}
        assert got == grown(groups, links)
        groups = got
    roots = components(every)
    assert set(groups) == set(roots)
    assert len(set(groups.values())) == len(set(roots.values())) == len(set(zip(groups.values(), map(roots.get, groups))))


def test_no_links_change_nothing(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), ("c", 4)], "id string, number long")
    none = spark.createDataFrame([], "id_a string, id_b string")
    assert sorted(map(tuple, closure.grow_groups(old, none).collect())) == [("a", 1), ("b", 1), ("c", 4)]
    new = spark.createDataFrame([("x", "y"), ("z", "z")], "id_a string, id_b string")
    assert sorted(map(tuple, closure.grow_groups(old, new).collect()))[3:] == [("x", 5), ("y", 5)]


@pytest.mark.parametrize("bound", [1_000_000, 5])
def test_numbers_go_on(spark, bound):
    draw = random.Random(4)
    rows = [("hot" if draw.random() < 0.6 else f"k{draw.randrange(9)}", i) for i in range(300)] + [(None, 900), (None, 901)]
    draw.shuffle(rows)
    cut = [150, 400, 1000]
    marks = spark.createDataFrame([("k0", 7), ("idle", 3)], "key string, last long")
    last, got, expected = {"k0": 7, "idle": 3}, {}, {}
    for low, high in zip([0, *cut], cut):
        part = sorted((r for r in rows if low <= r[1] < high), key=lambda r: r[1])
        numbered, marks = ranks.go_on_numbering(spark.createDataFrame(part, "key string, at long"), marks, "key", ["at"], "n", bound)
        got |= {r["at"]: r["n"] for r in numbered.collect()}
        own = Counter()
        for key, at in part:
            own[key] += 1
            expected[at] = (last.get(key, 0) if key is not None else 0) + own[key]
        last |= {k: last.get(k, 0) + n for k, n in own.items() if k is not None}
    assert got == expected
    assert {r["key"]: r["last"] for r in marks.where("key IS NOT NULL").collect()} == last


def test_running_totals(spark):
    draw = random.Random(1)
    rows = [(x, draw.randrange(1, 9)) for x in draw.sample(range(10_000), 500)]
    found = ranks.running_totals(spark.createDataFrame(rows, "x long, n long"), "x", "n", "upto").collect()
    total, expected = 0, {}
    for x, n in sorted(rows):
        total += n
        expected[x] = total
    assert {r["x"]: r["upto"] for r in found} == expected


def say(prompts):
    if any(p.endswith("bad") for p in prompts):
        raise ValueError("cannot")
    return [p.upper() for p in prompts]


def test_store_asks_new_prompts_only(spark, tmp_path):
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "p string")
    run = lambda texts, name, model=say: {
        (r["p"], r["raw"], r["status"], r["asked_in"])
        for r in inference.infer(frame(texts), "p", model, store=Store(f"{tmp_path}/s", name)).collect()
    }
    assert run(["a", "b", "x bad"], "1") == {("a", "A", "OK", "1"), ("b", "B", "OK", "1"), ("x bad", None, "ERROR", "1")}
    other = lambda prompts: [p + "!" for p in prompts]
    assert run(["b", "c", "x bad", "a"], "2", other) == {
        ("a", "A", "OK", "1"), ("b", "B", "OK", "1"), ("c", "c!", "OK", "2"), ("x bad", "x bad!", "OK", "2"),
    }
    kept = spark.read.parquet(f"{tmp_path}/s")
    assert kept.count() == 4 and kept.where("length(part) = 3").count() == 4
    kept.withColumn("asked_in", F.lit("9")).write.mode("append").partitionBy("part").parquet(f"{tmp_path}/s")  # a run cut off
    assert run(["b", "c"], "3") == {("b", "B", "OK", "1"), ("c", "c!", "OK", "2")}
    assert run([], "4") == set()


def test_store_reads_the_partitions_it_needs(spark, tmp_path):
    texts = spark.createDataFrame([(f"t{i}",) for i in range(40)], "p string")
    inference.infer(texts, "p", say, store=Store(f"{tmp_path}/s", "1"))
    asked = texts.limit(1).select(F.sha2("p", 256).alias("_key"))
    plan = Store(f"{tmp_path}/s").find(asked, "raw string")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan or "part#" in plan.split("PartitionFilters: [")[1][:40]


def registry(spark, copies=30):
    rows = [(i, f"F{i}", "words of a copy here", f"o{i % 3}", "t") for i in range(copies)]
    rows += [(100, "F100", "words of a copy there", "o9", "t"), (101, "F101", "quite another thing", "o9", "t"), (102, "F102", "words of a copy here", "o1", "u")]
    return spark.createDataFrame(rows, "row_ord long, function_id string, function_text string, executor string, true_type string")


def test_copies_are_judged_once(spark, tmp_path):
    calls = f"{tmp_path}/calls"
    open(calls, "w").close()

    def judge(prompts):
        with open(calls, "a") as file:
            file.write("x\n" * len(prompts))
        return ['{"verdict": "REAL"}' for _ in prompts]

    result = stages.collide_classes(registry(spark), judge, inference.HashedWords(), "T.", threshold=0.7)
    pairs = sorted((r["class_a"], r["class_b"], r["rows_a"], r["rows_b"], r["verdict"]) for r in result.pairs.collect())
    assert pairs == [("0", "0", 30, 30, "REAL"), ("0", "100", 30, 1, "REAL")]
    assert len(open(calls).read().split()) == 2
    owner = {r["row_ord"]: r["executor"] for r in registry(spark).collect()}
    assert all(owner[int(r["id_a"])] != owner[int(r["id_b"])] for r in result.pairs.collect())
    groups = {r["row_ord"]: r["collision_group"] for r in result.registry.collect()}
    assert {groups[i] for i in [*range(30), 100]} == {"COLLISION_1"} and groups[101] == groups[102] == "NO_COLLISION"
    assert result.members.count() == 33


def test_classes_of_large_blocks(spark):
    draw = random.Random(6)
    base = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(70)]
    rows = []
    for i in range(400):
        k = draw.randrange(70)
        rows.append((i, base[k], f"o{draw.randrange(3)}", f"text {k}", f"b{k % 2}"))
    df = spark.createDataFrame(rows, "id long, vec array<double>, owner string, text string, block string")
    shape = dict(id_col="id", vec_col="vec", owner_col="owner", copy_col="text", block_cols=["block"], threshold=0.5)
    found = similar.near_duplicate_classes(df, **shape)
    tight = similar.near_duplicate_classes(df, **shape, sizes=similar.Sizes(tile=8, max_pivots=4, sample=16))
    listed = lambda classes: sorted((r["class_a"], r["class_b"], r["rows_a"], r["rows_b"], r["id_a"], r["id_b"]) for r in classes.pairs.collect())
    assert listed(found) == listed(tight) and found.pairs.count() > 20
    every = similar.near_duplicate_pairs(df, "id", "vec", "owner", ["block"], 0.5)
    member = {r["id"]: r["class"] for r in found.members.collect()}
    assert {tuple(sorted((member[r["id_a"]], member[r["id_b"]]))) for r in every.collect()} == {
        tuple(sorted((r["class_a"], r["class_b"]))) for r in found.pairs.collect()
    }


def test_failed_blocks(spark):
    rows = [("a", [1.0, 2.0]), ("a", [1.0]), ("b", [1.0, float("nan")]), ("c", [3.0, 4.0]), ("c", None), (None, [float("inf"), 0.0]), ("d", None)]
    sound, failed = similar.sound_blocks(spark.createDataFrame(rows, "block string, vec array<double>"), "vec", ["block", "missing"])
    assert sorted(r["block"] for r in sound.collect()) == ["c", "c", "d"]
    assert {(r["block"], r["n_items"], r["reason"]) for r in failed.collect()} == {
        ("a", 2, "vectors of mixed length"), ("b", 1, "numbers that are not finite"), (None, 1, "numbers that are not finite"),
    }


def test_measures_come_with_the_writing(spark, tmp_path):
    rows = spark.range(100).withColumn("x", F.col("id") % 7)
    seen = stage.write_measured(rows, f"{tmp_path}/t", rows=F.count("*"), most=F.max("x"))
    assert seen == {"rows": 100, "most": 6} and spark.read.parquet(f"{tmp_path}/t").count() == 100

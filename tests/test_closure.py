import random

import pytest
from pyspark.sql import functions as F

from lexroll.operators import closure, similar
from lexroll.operators.ranks import row_numbers
from tests.test_similar import brute_pairs, frame, random_rows


def components(links):
    lead = {}

    def find(x):
        lead.setdefault(x, x)
        while lead[x] != x:
            x = lead[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        lead[max(a, b)] = min(a, b)
    return {x: find(x) for x in lead}


def shapes():
    draw = random.Random(11)
    name = lambda i: f"n{i:05d}"
    chain = list(range(300))
    draw.shuffle(chain)
    yield [(name(a), name(b)) for a, b in zip(chain, chain[1:])]
    yield [(name(0), name(i)) for i in range(1, 200)] + [(name(999), name(i)) for i in range(150, 260)]
    yield [(name(draw.randrange(400)), name(draw.randrange(400))) for _ in range(260)]
    yield [("b", "a"), ("c", "d"), ("b", "c"), ("x", "x")]


@pytest.mark.parametrize("links", list(shapes()), ids=["chain", "hubs", "random", "bridge"])
def test_connected_groups(spark, links):
    df = spark.createDataFrame(links, "id_a string, id_b string").repartition(7)
    found = {r["id"]: r["root"] for r in closure.connected_groups(df).collect()}
    expected = {x: r for x, r in components(links).items() if x != "x"}
    assert found == expected


def test_small_batches_need_rounds(spark):
    links = next(shapes())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame(links, "id_a string, id_b string").repartition(7)
        found = {r["id"]: r["root"] for r in closure.connected_groups(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == components(links)


def test_groups_and_write_back(spark):
    verdicts = spark.createDataFrame(
        [("GO1-1", "GO2-1", "REAL"), ("GO1-1", "GO1-2", "FALSE"), ("A", "B", "REAL")], "id_a string, id_b string, verdict string"
    )
    groups = closure.group_pairs(verdicts.where("verdict = 'REAL'"))
    assert {r["id"]: r["group_id"] for r in groups.collect()} == {
        "A": "COLLISION_1", "B": "COLLISION_1", "GO1-1": "COLLISION_2", "GO2-1": "COLLISION_2",
    }
    rows = spark.createDataFrame([("GO1-1",), ("GO1-2",), ("GO2-1",)], "id string")
    done = {r["id"]: (r["collision_group"], r["collision_verdict"]) for r in closure.write_back(rows, groups, "id").collect()}
    assert done == {"GO1-1": ("COLLISION_2", "REAL"), "GO1-2": ("NO_COLLISION", "FALSE"), "GO2-1": ("COLLISION_2", "REAL")}
    none = closure.group_pairs(verdicts.where("false"))
    assert {r["collision_group"] for r in closure.write_back(rows, none, "id").collect()} == {"NO_COLLISION"}


@pytest.mark.parametrize("tile, threshold", [(8192, 0.9), (30, 0.9), (30, 0.99)])
def test_links_connect_what_pairs_connect(spark, tile, threshold):
    rows = random_rows(seed=21, n=220)
    sizes = similar.Sizes(tile=tile, max_pivots=8)
    links = similar.near_duplicate_links(frame(spark, rows), "id", "vec", "owner", ["block"], threshold, sizes=sizes)
    found = {r["id"]: r["root"] for r in closure.connected_groups(links).collect()}
    assert found == components(brute_pairs(rows, threshold))


def test_row_numbers_with_a_hot_key(spark):
    draw = random.Random(2)
    rows = [("hot" if draw.random() < 0.8 else draw.choice(["a", "b", None]), i) for i in range(3000)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, pos int").repartition(5)
    expected, seen = {}, {}
    for key, pos in sorted(rows, key=lambda r: r[1]):
        seen[key] = seen.get(key, 0) + 1
        expected[key, pos] = seen[key]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for bound in (0, 10**6):
            found = {(r["k"], r["pos"]): r["n"] for r in row_numbers(df, ["k"], ["pos"], "n", bound).collect()}
            every = {r["pos"]: r["n"] for r in row_numbers(df, [], ["pos"], "n", bound).collect()}
            assert found == expected
            assert every == {pos: pos + 1 for _, pos in rows}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

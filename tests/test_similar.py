import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexroll.functions import vectors
from lexroll.operators import similar
from lexroll.operators.similar import Sizes


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, vec array<float>, owner string, block string")


def random_rows(seed=3, n=400, dim=8, copies=0.4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim))
    rows = []
    for i in range(n):
        if rows and draw.random() < copies:
            vec = rows[0][1] if draw.random() < 0.5 else rows[draw.integers(len(rows))][1]  # a hot copy
        else:
            vec = [float(np.float32(x)) for x in centres[draw.integers(12)] + 0.4 * draw.normal(size=dim)]
        block = draw.choice(["hot", "hot", "hot", "cold"]) if draw.random() < 0.9 else None
        owner = f"o{draw.integers(5)}" if draw.random() < 0.95 else None
        rows.append((f"r{i:04d}", vec, owner, None if block is None else str(block)))
    rows[5] = (rows[5][0], [0.0] * dim, "o1", "hot")
    rows[9] = (rows[9][0], [0.0] * dim, "o2", "hot")
    return rows


def brute_pairs(rows, threshold, null_owners_differ=False):
    found = set()
    for i, (a, va, oa, ba) in enumerate(rows):
        for b, vb, ob, bb in rows[i + 1 :]:
            if ba != bb or (oa == ob and not (null_owners_differ and oa is None)):
                continue
            if not null_owners_differ and (oa is None or ob is None):
                continue
            x, y = np.array(va), np.array(vb)
            sim = x @ y / (max(np.linalg.norm(x), 1e-10) * max(np.linalg.norm(y), 1e-10))
            if sim >= threshold - 1e-12:
                found.add((min(a, b), max(a, b)))
    return found


def pairs(df, threshold, sizes=Sizes(), **more):
    found = similar.near_duplicate_pairs(df, "id", "vec", "owner", ["block"], threshold, sizes=sizes, **more)
    rows = [(r["id_a"], r["id_b"]) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("tile, pivots, threshold", [(8192, 256, 0.8), (40, 16, 0.8), (25, 5, 0.95), (40, 16, -0.2)])
def test_pairs_equal_brute_force(spark, tile, pivots, threshold):
    rows = random_rows(n=250)
    assert pairs(frame(spark, rows), threshold, Sizes(tile=tile, max_pivots=pivots, strip=16)) == brute_pairs(rows, threshold)


def test_missing_owners_can_count_as_different(spark):
    rows = random_rows(n=120)
    expected = brute_pairs(rows, 0.8, null_owners_differ=True)
    for tile in (8192, 30):
        assert pairs(frame(spark, rows), 0.8, Sizes(tile=tile), null_owners_differ=True) == expected


@pytest.mark.parametrize("sizes", [Sizes(strip=16), Sizes(tile=30, max_pivots=8)])
def test_fresh_rows_meet_all_rows(spark, sizes):
    rows = random_rows(seed=4, n=200)
    fresh = {r[0] for i, r in enumerate(rows) if i % 4 == 1}
    df = frame(spark, rows).withColumn("new", F.col("id").isin(*fresh))
    expected = {p for p in brute_pairs(rows, 0.8) if fresh & set(p)}
    assert pairs(df, 0.8, sizes, fresh_col="new") == expected


def test_known_case_and_blocks(spark):
    rows = [
        ("GO1-1", [1.0, 0.0, 0.0], "Agency 1", "x"),
        ("GO1-2", [0.5, 0.5, 0.0], "Agency 1", "x"),
        ("GO2-1", [0.9, 0.1, 0.0], "Agency 2", "x"),
    ]
    assert pairs(frame(spark, rows), 0.8) == {("GO1-1", "GO2-1")}
    blocks = [("a", [1.0], "1", None), ("b", [1.0], "2", None), ("c", [1.0], "3", ""), ("d", [1.0], "4", "v0:;"), ("e", [1.0], "5", "n;")]
    assert pairs(frame(spark, blocks), 0.5) == {("a", "b")}
    one_block = similar.near_duplicate_pairs(frame(spark, blocks), "id", "vec", "owner", ["absent"], 0.5)
    assert one_block.count() == 10
    kept = similar.near_duplicate_pairs(frame(spark, rows), "id", "vec", "owner", [], 0.1, exclude=("owner", "Agency 2"))
    assert kept.count() == 0
    missing = [("a", None, "1", "x"), ("b", [1.0], "2", "x")]
    assert pairs(frame(spark, missing), 0.5) == set()


def test_mixed_dimensions_are_refused(spark):
    with pytest.raises(Exception, match="mixed length"):
        pairs(frame(spark, [("a", [1.0], "1", "x"), ("b", [1.0, 2.0], "2", "x")]), 0.5)


@pytest.mark.parametrize("sizes", [Sizes(), Sizes(broadcast_cells=8, sample=32, tile=30, max_pivots=6)])
def test_library_operators(spark, sizes):
    rows = random_rows(seed=8, n=160)
    library = random_rows(seed=9, n=120)
    df = frame(spark, rows)
    lib = frame(spark, library).withColumnRenamed("id", "ref").withColumnRenamed("vec", "ref_vec")
    direction = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-10)
    units = np.array([direction(r[1]) for r in library])
    best = {r[0]: float((units @ direction(r[1])).max()) for r in rows}
    kept = similar.drop_boilerplate(df, lib, "id", "vec", "ref", "ref_vec", 0.9, sizes)
    scored = similar.max_similarity(df, lib, "id", "vec", "ref", "ref_vec", sizes).collect()
    assert len(scored) == len(rows) and all(abs(r["max_sim"] - best[r["id"]]) < 1e-9 for r in scored)
    assert {r["id"] for r in kept.collect()} == {i for i, s in best.items() if s < 0.9}
    hits = similar.nearest(df, lib, 4, "id", "vec", "ref", "ref_vec", sizes=sizes)
    found = {}
    for r in hits.orderBy("id", "rank").collect():
        found.setdefault(r["id"], []).append((r["rank"], r["ref_id"]))
    for name, vec, *_ in rows:
        sims = np.round(units @ direction(vec), 9)
        order = [library[i][0] for i in np.lexsort((np.arange(len(library)), -sims)) if np.any(library[i][1])]
        assert found.get(name, []) == ([] if not np.any(vec) else list(enumerate(order[:4], 1)))


def test_hints(spark):
    df = spark.createDataFrame([("GO1-1", [1.0, 0.0, 0.0]), ("GO1-2", [0.0, 1.0, 0.0]), ("z", [0.0, 0.0, 0.0])], "id string, vec array<double>")
    lib = spark.createDataFrame(
        [("a", [0.9, 0.1, 0.0], "Стратегические"), ("b", [0.0, 0.9, 0.1], "Регулятивные")], "ref string, ref_vec array<double>, label string"
    )
    hits = similar.nearest(df, lib, 3, "id", "vec", "ref", "ref_vec", 0.75).join(lib, F.col("ref") == F.col("ref_id"))
    assert {(r["id"], r["label"]) for r in hits.collect()} == {("GO1-1", "Стратегические"), ("GO1-2", "Регулятивные")}


def test_empty_library_and_disabled_filter(spark):
    df = frame(spark, random_rows(n=20))
    none = df.where("false").withColumnRenamed("id", "ref")
    assert similar.drop_boilerplate(df, none, "id", "vec", "ref", "vec", 0.1).count() == 20
    assert similar.drop_boilerplate(df, df.withColumnRenamed("id", "ref"), "id", "vec", "ref", "vec", None).count() == 20
    assert similar.nearest(df, none, 3, "id", "vec", "ref", "vec").count() == 0


def test_cosine_expression(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = [r["c"] for r in df.select(vectors.cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got == pytest.approx([0.8, 0.0])


def test_block_stats(spark):
    rows = random_rows(n=80)
    df = frame(spark, rows)
    found = similar.near_duplicate_pairs(df, "id", "vec", "owner", ["block"], 0.9)
    stats = {r["block"]: (r["n_items"], r["n_pairs"]) for r in similar.block_stats(df, ["block"], found, "id").collect()}
    block = {r[0]: r[3] for r in rows}
    expected = brute_pairs(rows, 0.9)
    for name in {None, "hot", "cold"}:
        assert stats[name] == (sum(b == name for b in block.values()), sum(block[a] == name for a, _ in expected))
    whole = similar.block_stats(df, ["absent"], found, "id").collect()
    assert [tuple(r) for r in whole] == [(len(rows), found.count())]


SMALL_AND_LARGE = pytest.mark.parametrize("sizes", [Sizes(), Sizes(broadcast_cells=2, sample=8, tile=20, max_pivots=4)])


@SMALL_AND_LARGE
def test_one_meaning_of_zero_threshold_and_repeated_ids(spark, sizes):
    edge = 0.75
    near = [edge - 4e-10, (1 - (edge - 4e-10) ** 2) ** 0.5]  # rounds to the threshold
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.1]), (3, near), (3, near), (3, [0.0, 1.0]), (4, [-1.0, -0.1]), (5, None), (None, [1.0, 0.1])]
    df = spark.createDataFrame(rows, "id int, vec array<double>")
    for zero in ([], [(9, [0.0, 0.0])]):
        lib = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, -1.0]), *zero], "ref int, ref_vec array<double>")
        got = similar.max_similarity(df, lib, "id", "vec", "ref", "ref_vec", sizes).collect()
        first = round(1 / 1.01**0.5, 9)
        low = 0.0 if zero else round(0.1 / 1.01**0.5, 9)
        expected = [(1, 0.0), (2, first), (3, edge), (3, edge), (3, 0.0), (4, max(low, round(0.1 / 1.01**0.5, 9))), (5, None), (None, first)]
        assert sorted(((r["id"], r["max_sim"]) for r in got), key=str) == sorted(expected, key=str)
        kept = similar.drop_boilerplate(df, lib, "id", "vec", "ref", "ref_vec", edge, sizes).collect()
        assert sorted((r["id"] for r in kept), key=str) == [1, 3, 4, 5]
        hits = similar.nearest(df, lib, 2, "id", "vec", "ref", "ref_vec", sizes=sizes).collect()
        assert sorted((r["id"] for r in hits), key=str) == sorted([2, 2, 3, 3, 3, 3, 3, 3, 4, 4, None, None], key=str)


@SMALL_AND_LARGE
def test_copies_reach_a_threshold_of_one(spark, sizes):
    draw = np.random.default_rng(3)
    rows = [(f"{i:03}{x}", v.tolist(), x) for i, v in enumerate(draw.normal(size=(60, 16))) for x in "ab"]
    df = spark.createDataFrame(rows, "id string, vec array<double>, owner string")
    found = similar.near_duplicate_pairs(df, "id", "vec", "owner", [], 1.0, sizes=sizes).collect()
    assert sorted((r["id_a"], r["id_b"], r["sim"]) for r in found) == [(f"{i:03}a", f"{i:03}b", 1.0) for i in range(60)]


def test_heads_settle_most_pairs_without_losing_one():
    draw = np.random.default_rng(12)
    rows = vectors.unit(np.vstack([draw.normal(size=(1500, 64)), np.zeros((2, 64))]))
    near = vectors.unit(rows[:40] + 0.12 * draw.normal(size=(40, 64)))
    rows = np.vstack([rows, near])
    for threshold in (0.5, 0.45, 0.9):
        prefix = similar.pick_prefix(rows[::3], threshold)
        assert prefix.directions.shape[1] < 64
        parts = prefix.parts(rows)
        left = similar.open_pairs(parts, parts, threshold)
        assert left.mean() < 0.1  # compared in full
        sims = rows @ rows.T
        assert not (~left & (np.round(sims, 9) >= threshold)).any()
        a, b, sim = similar._similar(rows, rows, threshold, parts, parts)
        assert set(zip(a.tolist(), b.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(np.round(sims, 9) >= threshold))))
        assert np.allclose(sim, sims[a, b], atol=1e-9)
    decaying = vectors.unit(draw.normal(size=(600, 64)) * 0.8 ** np.arange(64))
    assert similar.pick_prefix(decaying, 0.9).directions.shape[1] <= 24
    assert similar.pick_prefix(rows, -0.5) is None and similar.pick_prefix(rows[:1], 0.5) is None


def test_low_threshold_in_one_large_block(spark):
    draw = np.random.default_rng(13)
    base = draw.normal(size=(300, 32))
    rows = [(f"r{i:03d}", [float(np.float32(x)) for x in v], f"o{i % 4}", "b") for i, v in enumerate(np.vstack([base, base[:60] + 0.9 * draw.normal(size=(60, 32))]))]
    found = similar.near_duplicate_pairs(frame(spark, rows), "id", "vec", "owner", ["none"], 0.5, sizes=Sizes(tile=100, max_pivots=4))
    got = {(r["id_a"], r["id_b"]) for r in found.collect()}
    assert got == brute_pairs(rows, 0.5) and len(got) > 40


def test_large_blocks_that_the_boilerplate_filter_empties(spark):
    counted = frame(spark, random_rows(n=60)).withColumn("block", F.lit("x"))
    assert pairs(counted.where("id < ''"), 0.8, Sizes(tile=20, max_pivots=4), counted=counted) == set()


def test_strips_are_narrow_where_they_are_long():
    for rows, columns, strip in ((0, 5, 512), (1000, 10, 512), (1000, 200_000, 512), (7, 1 << 23, 512)):
        found = similar.strips(rows, columns, strip)
        assert [i for at in found for i in range(rows)[at]] == list(range(rows))
        assert all(at.stop - at.start <= strip and (at.stop - at.start) * columns <= max(similar.STRIP_CELLS, columns) for at in found)


def test_cosines_as_sql_works_them_out():
    draw = np.random.default_rng(7)
    a, b = draw.integers(0, 5, (300, 64)).astype(np.float32), draw.integers(0, 5, (300, 64)).astype(np.float32)
    sql = "SELECT list_cosine_similarity(?::DOUBLE[], ?::DOUBLE[])"
    con = duckdb.connect()
    expected = [con.execute(sql, [x.tolist(), y.tolist()]).fetchone()[0] for x, y in zip(a.astype(float), b.astype(float))]
    assert vectors.plain_cosine(a.astype(float), b.astype(float)).tolist() == expected


@pytest.mark.parametrize("sizes", [Sizes(), Sizes(tile=2, max_pivots=2, broadcast_cells=2, sample=2)])
def test_thresholds_without_rounding(spark, sizes):
    """Just under the threshold, at it and over it; the first is taken for the second if similarities are rounded."""
    at = lambda c: [c, (1.0 - c * c) ** 0.5]
    rows = [("a", [1.0, 0.0], "1", "x"), ("b", at(0.98 - 2e-10), "2", "x"), ("c", at(0.981), "2", "x"), ("d", at(0.5), "2", "x")]
    df = spark.createDataFrame(rows, "id string, vec array<double>, owner string, block string")
    assert pairs(df, 0.98, sizes) == {("a", "b"), ("a", "c")}
    assert pairs(df, 0.98, sizes, rounded=False) == {("a", "c")}
    library = df.where("id = 'a'").union(spark.createDataFrame([("z", at(-0.9), "3", "x")], df.schema)).select("id", "vec")
    for rounded, left in ((True, {"d"}), (False, {"b", "d"})):
        kept = similar.drop_boilerplate(df, library, "id", "vec", "id", "vec", 0.98, sizes, rounded)
        assert {r["id"] for r in kept.collect()} == left
    found = similar.near_duplicate_classes(df, "id", "vec", "owner", "id", ["block"], 0.98, sizes=sizes, rounded=False)
    assert {(r["id_a"], r["id_b"]) for r in found.pairs.collect()} == {("a", "c")}

"""Pairs of rows of large blocks: copies are paired inside the cells, larger groups of copies by a join."""

import numpy as np
import pytest

from lexroll.operators import similar
from lexroll.operators.similar import Sizes, near_duplicate_pairs

SMALL = Sizes(tile=20, max_pivots=4)


def rows_of(spark, crowd):
    draw = np.random.default_rng(3)
    near = draw.normal(size=(12, 6))
    vectors = [near[i % 12] + (0 if i % 3 else 0.05) for i in range(90)] + [near[0]] * crowd + [np.zeros(6)] * 3
    made = [(i, f"o{i % 4}", i % 5 != 0, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return made, spark.createDataFrame(made, "id long, owner string, fresh boolean, vec array<double>")


@pytest.mark.parametrize("crowd", [0, 50])
@pytest.mark.parametrize("fresh", [None, "fresh"])
def test_pairs_are_those_of_one_block(spark, crowd, fresh):
    made, df = rows_of(spark, crowd)
    expected = set()
    for i, a in enumerate(made):
        for b in made[i + 1:]:
            x, y = np.array(a[3]), np.array(b[3])
            length = np.linalg.norm(x) * np.linalg.norm(y)
            if a[1] != b[1] and (fresh is None or a[2] or b[2]) and length and x @ y / length >= 0.9:
                expected.add(tuple(sorted((str(a[0]), str(b[0])))))
    found = near_duplicate_pairs(df, "id", "vec", "owner", [], 0.9, sizes=SMALL, fresh_col=fresh).collect()
    assert len(found) == len(expected) and {(r["id_a"], r["id_b"]) for r in found} == expected


def test_pairs_of_few_copies_are_not_shuffled(spark):
    """The rows leave the cells as pairs: no join or exchange comes after the comparison."""
    _, df = rows_of(spark, 0)
    plan = near_duplicate_pairs(df, "id", "vec", "owner", [], 0.9, sizes=SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan
    assert similar.HELD >= 2


def test_pairs_of_many_copies_are_not_shuffled(spark):
    """Nor do they, if a class has more copies than a row of a cell carries."""
    _, df = rows_of(spark, 8 * similar.HELD)
    plan = near_duplicate_pairs(df, "id", "vec", "owner", [], 0.9, sizes=SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan


def test_cells_are_few_where_angles_tell_little(spark):
    """A row is copied for each cell that it visits, so their number doesn't follow that of the rows."""
    draw = np.random.default_rng(5)
    made = [(str(i), [float(x) for x in v]) for i, v in enumerate(draw.normal(size=(3000, 16)) + 1)]
    df = spark.createDataFrame(made, "id string, vec array<double>")
    pivots = similar.pick_pivots(df, "id", "vec", 256, 2, 0.5, 3000)
    assert len(pivots) <= 32

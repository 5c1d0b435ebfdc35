"""Tiles of large cells: every pair meets once, and rows are copied no more often as cells grow."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexroll.operators.cells import tile_join, tile_stream


def met(left, right):
    return pa.table({"left": [left.num_rows], "right": [right.num_rows]})


@pytest.mark.parametrize("n_left, n_right", [(3000, 3000), (6000, 500), (6000, 6000)])
def test_copies_do_not_grow_with_the_cell(spark, n_left, n_right):
    sides = [spark.range(n).select(F.lit(1).alias("cell"), F.col("id").cast("string").alias("id")) for n in (n_left, n_right)]
    tiles = tile_join(*sides, ["cell"], "id", 40, met, "left long, right long", 8192).collect()
    assert sum(t["left"] * t["right"] for t in tiles) == n_left * n_right
    assert sum(t["left"] + t["right"] for t in tiles) <= 5 * (n_left + n_right)


def test_tiles_stay_within_their_limit(spark):
    side = spark.range(3000).select(F.lit(1).alias("cell"), F.col("id").cast("string").alias("id"))
    tiles = tile_join(side, side, ["cell"], "id", 40, met, "left long, right long", 300).collect()
    assert sum(t["left"] * t["right"] for t in tiles) == 9_000_000
    assert max(max(t) for t in tiles) < 400


@pytest.mark.parametrize("n_left, n_right, most", [(3000, 3000, 8192), (6000, 500, 100), (500, 6000, 700), (30, 20, 8192)])
def test_right_rows_are_held_and_left_rows_pass_by(spark, n_left, n_right, most):
    """Every pair meets once; only the right side is held, and left rows are copied only for it."""
    sides = [spark.range(n).select(F.lit("a/1").alias("block"), F.lit(1).alias("cell"), F.col("id").cast("string").alias("id")) for n in (n_left, n_right)]

    def kernel(right):
        assert right.num_rows <= 1.5 * most
        return lambda left: iter([pa.table({"left": [left.num_rows], "right": [right.num_rows]})])

    tiles = tile_stream(*sides, ["block", "cell"], "id", 40, kernel, "left long, right long", most).collect()
    assert sum(t["left"] * t["right"] for t in tiles) == n_left * n_right
    assert sum(t["left"] for t in tiles) <= n_left * -(-n_right // most)

"""Exact partitioning of vectors for similarity joins.

Vectors are assigned to the nearest of a bounded set of pivots.  A vector ``x`` can have a
partner within the angle ``t`` in cell ``j`` only if

* ``angle(x, p_j) <= radius_j + t``  (triangle inequality), and
* ``x`` is within ``t`` of the half of the sphere that is nearer to ``p_j`` than to the
  pivot of ``x``  (every member of cell ``j`` is in that half).

Both are necessary conditions, so no pair is lost; all other cells need not be visited.
Cells that hold too many rows on one side are cut into salted tiles by ``tile_join``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexroll.functions.vectors import angles, matrix, unit
from lexroll.operators.lineage import broadcast_if_small, cut_lineage

SLACK = 1e-6  # covers the rounding of arccos


@dataclass(frozen=True)
class Cells:
    """Pivots, and the largest angle of a member to the pivot of its cell."""

    pivots: np.ndarray
    radii: np.ndarray


def draw_vectors(df: DataFrame, id_col: str, vec_col: str, count: int) -> np.ndarray:
    """At most ``count`` distinct unit vectors, in hash order of the id: a bounded and
    repeatable draw."""
    drawn = df.select(vec_col).orderBy(F.xxhash64(id_col), F.col(id_col)).limit(count)
    rows = matrix(drawn.toArrow()[vec_col])
    _, first = np.unique(rows, axis=0, return_index=True)
    return unit(rows[np.sort(first)])


MOST_OPEN = 16  # cells that a row may visit on the average


def pick_pivots(df: DataFrame, id_col: str, vec_col: str, most: int, least: int, reach: float, draw: int) -> np.ndarray:
    """``most`` pivots, or fewer, down to ``least``, where angles tell cells apart too poorly to skip half
    of them or to leave a row few of them, since each cell that is visited costs a copy of the row.  Without rows there
    are none."""
    drawn = draw_vectors(df, id_col, vec_col, max(draw, most))
    while len(drawn) and most > least:
        pivots = drawn[:most]
        away = angles(drawn, pivots)
        home = np.argmin(away, axis=1)
        radii = np.zeros(len(pivots))
        np.maximum.at(radii, home, away[np.arange(len(drawn)), home])
        share = open_cells(drawn, np.full(len(drawn), reach), pivots, radii).mean()
        if share <= 0.5 and share * len(pivots) <= MOST_OPEN:
            return pivots
        most //= 2
    return drawn[:least]


def open_cells(rows: np.ndarray, reach: np.ndarray, pivots: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Which cells (columns) may hold a partner of a unit row within its reach."""
    limit = reach[:, None] + SLACK
    cos = np.clip(rows @ pivots.T, -1.0, 1.0)
    home = np.argmax(cos, axis=1)
    apart = np.sqrt(np.maximum(2.0 - 2.0 * (pivots @ pivots.T), 0.0))[home]
    lead = cos[np.arange(len(rows)), home][:, None] - cos
    beyond = np.arcsin(np.clip(lead / np.where(apart < 1e-9, np.inf, apart), 0.0, 1.0))
    return (np.arccos(cos) <= radii[None, :] + limit) & (beyond <= limit)


def with_cell(df: DataFrame, vec_col: str, pivots: np.ndarray) -> DataFrame:
    """Add ``cell`` and the angle ``spread`` to its pivot; only the vector goes to Python."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    @F.arrow_udf("struct<cell:int,spread:double>")
    def nearest_pivot(vectors: pa.Array) -> pa.Array:
        if len(vectors) == 0:
            return pa.array([], pa.struct([("cell", pa.int32()), ("spread", pa.float64())]))
        away = angles(unit(matrix(vectors)), shared.value)
        cell = np.argmin(away, axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(away[np.arange(len(cell)), cell])],
            ["cell", "spread"],
        )

    return df.withColumn("_near", nearest_pivot(F.col(vec_col))).select(
        *df.columns, F.col("_near.cell").alias("cell"), F.col("_near.spread").alias("spread")
    )


def build_cells(df: DataFrame, vec_col: str, pivots: np.ndarray) -> tuple[DataFrame, Cells]:
    """Assign every row of ``df`` to a cell; the result is cut from its lineage."""
    assigned = cut_lineage(with_cell(df, vec_col, pivots))
    radii = np.zeros(len(pivots))
    for row in assigned.groupBy("cell").agg(F.max("spread").alias("r")).collect():
        radii[row["cell"]] = row["r"]
    return assigned.drop("spread"), Cells(pivots, radii)


def reachable(df: DataFrame, vec: Column, reach: Column, cells: Cells) -> Column:
    """ARRAY<INT> of the cells that may hold a partner within the angle ``reach``."""
    shared = df.sparkSession.sparkContext.broadcast((cells.pivots, cells.radii))

    @F.arrow_udf("array<int>")
    def targets(vectors: pa.Array, reaches: pa.Array) -> pa.Array:
        n = len(vectors)
        if n == 0:
            return pa.array([], pa.list_(pa.int32()))
        reaches = reaches.to_numpy(zero_copy_only=False)
        row, cell = np.nonzero(open_cells(unit(matrix(vectors)), reaches, *shared.value))
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cell, pa.int32()))

    return targets(vec, reach)


COPIES = 4  # tasks that a row of a large cell is sent to on the average, where tiles may grow so far


def tile_edge(n_left: Column, n_right: Column, tile: int, most: int) -> Column:
    """Rows a side of a tile: ``tile``, or as many up to ``most`` as keep the copies of rows at ``COPIES``.

    Tiles of t rows copy 2 * n_left * n_right / t rows: with a fixed t, that is the square of the input.
    """
    even = F.ceil(2.0 * n_left * n_right / (COPIES * (n_left + n_right)))
    return F.greatest(F.lit(tile), F.least(F.lit(most), even))


def _in_tiles(
    left: DataFrame, right: DataFrame, keys: list[str], id_col: str, tile: int, lefts: Column, rights: Column, weight: str | None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the parts ``_i`` and ``_j`` of the tiles in which they meet.

    Keys with more than ``tile`` rows on a side are cut into ``lefts`` and ``rights`` salted parts (of ``n_left`` and
    ``n_right``), and each part meets every part of the other side.  Only the keys that need cutting are in the table of parts.
    A row counts ``weight`` times, if that column is named.
    """
    total = F.count("*") if weight is None else F.sum(weight)
    sizes = (
        left.groupBy(keys).agg(total.alias("n_left"))
        .join(right.groupBy(keys).agg(total.alias("n_right")), keys)
        .where((F.col("n_left") > tile) | (F.col("n_right") > tile))
        .select(*keys, lefts.cast("int").alias("_lefts"), rights.cast("int").alias("_rights"))
    )
    parts = broadcast_if_small(cut_lineage(sizes))

    def cut(side: DataFrame, own: str, other: str, own_part: str, other_part: str) -> DataFrame:
        count = F.coalesce(own, F.lit(1))
        opposite = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
        return (
            side.join(parts, keys, "left")
            .withColumn(own_part, F.pmod(F.xxhash64(id_col), count).cast("int"))
            .withColumn(other_part, F.explode(opposite))
            .drop("_lefts", "_rights")
        )

    held = cut(right, "_rights", "_lefts", "_j", "_i")
    return cut(left, "_lefts", "_rights", "_i", "_j"), held.toDF(*held.columns)  # fresh columns: the sides may share a source


def tile_join(
    left: DataFrame, right: DataFrame, keys: list[str], id_col: str, tile: int, kernel, schema: str, most: int = 0,
    weight: str | None = None,
) -> DataFrame:
    """Apply ``kernel(left_rows, right_rows)`` to all pairs of rows with equal keys.

    No task holds more than about ``tile`` rows a side, or ``most`` if rows would be copied often.
    """
    edge = tile_edge(F.col("n_left"), F.col("n_right"), tile, most)
    parts = (F.ceil(F.col(n) / edge) for n in ("n_left", "n_right"))
    lefts, rights = _in_tiles(left, right, keys, id_col, tile, *parts, weight)
    tile_keys = [*keys, "_i", "_j"]
    return lefts.groupBy(tile_keys).cogroup(rights.groupBy(tile_keys)).applyInArrow(kernel, schema)


GATHERED = 50_000  # rows of a result that are handed out together


def gathered(tables: Iterator[pa.Table], rows: int = GATHERED) -> Iterator[pa.RecordBatch]:
    """The rows of many small tables in fewer batches."""
    held, n = [], 0
    for table in tables:
        held.append(table)
        n += table.num_rows
        if n >= rows:
            yield from pa.concat_tables(held).combine_chunks().to_batches(rows)
            held, n = [], 0
    if n:
        yield from pa.concat_tables(held).combine_chunks().to_batches(rows)


TILE_PAIRS = 1 << 34  # pairs of rows that a task compares at most, about


def tile_stream(
    left: DataFrame, right: DataFrame, keys: list[str], id_col: str, tile: int, kernel, schema: str, most: int,
    weight: str | None = None, order: tuple[str, ...] = (),
) -> DataFrame:
    """``tile_join`` for results of any size: ``kernel(right_rows)`` gives a function from some left rows to tables.

    A task holds up to ``most`` right rows; left rows pass by, ordered by ``order``, and results leave as they are found.  So
    left rows are copied only where the right side is too large to be held, and right rows only to share the work.
    ``keys`` have no NULLs; the last of them comes first in the name of a tile, and the first, which may hold any
    characters, last.
    """
    n_left, n_right = F.col("n_left"), F.col("n_right")
    parts_right = F.ceil(n_right / max(tile, most))
    shared = F.least(F.lit(COPIES), F.ceil(n_left / tile))
    parts_left = F.greatest(shared, F.ceil(n_left / TILE_PAIRS * n_right / parts_right))
    lefts, rights = _in_tiles(left, right, keys, id_col, tile, parts_left, parts_right, weight)
    name = F.concat_ws("/", "_i", "_j", *reversed(keys)).alias("_tile")
    sides = [
        side.select(name, F.lit(passing).alias("_passing"), *[c for c in side.columns if c not in (*keys, "_i", "_j")])
        for side, passing in ((lefts, True), (rights, False))
    ]
    rows = sides[0].unionByName(sides[1], allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        current, held, meet = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            names, passing = batch.column("_tile"), batch.column("_passing").to_numpy(zero_copy_only=False)
            codes = names.dictionary_encode().indices.to_numpy()
            cuts = np.nonzero((np.diff(codes) != 0) | (passing[1:] != passing[:-1]))[0] + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(start, stop - start)
                if names[start].as_py() != current:
                    current, held, meet = names[start].as_py(), [], None
                if not passing[start]:
                    held.append(part)
                    continue
                if meet is None and held:
                    meet, held = kernel(pa.Table.from_batches(held)), []
                if meet is not None:
                    yield from meet(pa.Table.from_batches([part]))

    tasks = tile_tasks(left.sparkSession)
    ordered = rows.repartition(tasks, "_tile").sortWithinPartitions("_tile", "_passing", *order)
    return ordered.mapInArrow(lambda batches: gathered(run(batches)), schema)


def tile_tasks(spark: SparkSession) -> int:
    """Tasks among which tiles are dealt.  Their work is not in proportion to their bytes, so they must not be put together."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

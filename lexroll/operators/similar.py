"""Similarity operators on embedding columns: pairs, boilerplate, nearest entries."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, Window

from lexroll.functions.vectors import SIM_DIGITS, matrix, plain_cosine, unit
from lexroll.operators.cells import build_cells, draw_vectors, pick_pivots, reachable, tile_join, tile_stream
from lexroll.operators.lineage import broadcast_if_small, cut_lineage, rows_up_to
from lexroll.operators.skew import join_to_keys
from lexroll.profile import BOILERPLATE_THRESHOLD, PAIR_THRESHOLD


@dataclass(frozen=True)
class Sizes:
    """Physical limits; none of them changes a result."""

    tile: int = 8192  # rows a side that one task compares; up to MOST_PAIRED or MOST_SEARCHED numbers where that saves copies
    strip: int = 512  # rows multiplied at a time inside a task
    max_pivots: int = 256
    broadcast_cells: int = 8_000_000  # numbers in a library that is sent to every task
    sample: int = 4096  # library rows used to bound the search radius of a large library


ROUNDING = 0.5 * 10.0**-SIM_DIGITS
MOST_PAIRED = 1 << 23  # numbers a side of a tile of pairs, which a task holds; its hits leave as they are found
MOST_SEARCHED = 1 << 22  # numbers a side of a tile of a search, which keeps k hits a row
STRIP_CELLS = 1 << 22  # similarities that a task holds at a time, whatever the width of its strips


def strips(rows: int, columns: int, strip: int) -> list[slice]:
    """Runs of at most ``strip`` rows, fewer where each meets so many columns that the product would be large."""
    step = max(1, min(strip, STRIP_CELLS // max(1, columns)))
    return [slice(at, min(at + step, rows)) for at in range(0, rows, step)]


PAIR_SCHEMA = "id_a string, id_b string, sim double"


def block_key(columns: list[str]) -> Column:
    """One unambiguous text per combination of block values, NULL and "" kept apart."""
    if not columns:
        return F.lit("")
    return F.concat(
        *[
            F.when(F.col(c).isNull(), F.lit("n;")).otherwise(
                F.concat(F.lit("v"), F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string"), F.lit(";"))
            )
            for c in columns
        ]
    )


def _items(
    df, id_col, vec_col, owner_col, block_cols, exclude, null_owners_differ, fresh_col=None, copy_col=None
) -> DataFrame:
    """Rows that take part in pairing: block, id, owner, vector and freshness, nothing else."""
    blocks = [c for c in block_cols if c in df.columns]
    if exclude is not None:
        column, label = exclude
        df = df.where(~F.col(column).eqNullSafe(F.lit(label)))
    owner = F.concat(F.lit("o"), F.col(owner_col).cast("string"))
    if null_owners_differ:
        owner = F.coalesce(owner, F.concat(F.lit("n"), F.col(id_col).cast("string")))
    return df.select(
        block_key(blocks).alias("block"),
        F.col(id_col).cast("string").alias("id"),
        owner.alias("owner"),
        F.col(vec_col).alias("vec"),
        (F.lit(True) if fresh_col is None else F.col(fresh_col)).alias("fresh"),
        *([] if copy_col is None else [F.col(copy_col).alias("copy")]),
    ).where(F.col("owner").isNotNull() & F.col("vec").isNotNull())


def _emit(ids_a, ids_b, sims) -> pa.Table:
    a, b = (x if isinstance(x, pa.Array) else pa.array(x, pa.string()) for x in (ids_a, ids_b))
    swap = pc.less(b, a)
    return pa.table(
        {"id_a": pc.if_else(swap, b, a), "id_b": pc.if_else(swap, a, b), "sim": pa.array(sims, pa.float64())}
    )


def _codes(*columns) -> list[np.ndarray]:
    """Whole-number codes shared by several text columns."""
    lengths = [len(c) for c in columns]
    chunks = [chunk for c in columns for chunk in c.chunks]
    merged = pa.chunked_array(chunks, pa.string()).combine_chunks().dictionary_encode().indices
    return np.split(merged.to_numpy(zero_copy_only=False), np.cumsum(lengths)[:-1])


def _flags(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(bool)


def _found(ids_a, ids_b, parts: list[tuple]) -> pa.Table:
    a, b, sim = (np.concatenate(x) for x in zip(*parts)) if parts else ([], [], [])
    return _emit(ids_a[a] if len(a) else [], ids_b[b] if len(b) else [], sim)


CLOSE = 1e-12  # two ways of adding up a similarity differ by less


def _reached(a, b, sim: np.ndarray, threshold: float, rows=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the places ``a`` and ``b`` those whose similarity reaches the threshold, with rounded values.

    The values are rounded before they are compared.  With ``rows``, the vectors of both sides, they are not: those that
    are close to the threshold are then worked out entry after entry.
    """
    rounded = np.round(sim, SIM_DIGITS)
    if rows is not None:
        close = np.abs(sim - threshold) < CLOSE
        sim = np.where(close, 0.0, sim)
        sim[close] = plain_cosine(rows[0][a[close]], rows[1][b[close]])
    keep = (rounded if rows is None else sim) >= threshold
    return a[keep], b[keep], rounded[keep]


def _hits(sims: np.ndarray, threshold: float, rows=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values of the similarities that reach the threshold."""
    a, b = np.nonzero(sims >= threshold - ROUNDING)
    return _reached(a, b, sims[a, b], threshold, rows)


def _scores(units: np.ndarray, others: np.ndarray, sides, exact_at: float | None) -> np.ndarray:
    """Rounded similarities; with ``exact_at`` not rounded, and worked out entry after entry close to it."""
    sims = units @ others.T
    if exact_at is None:
        return np.round(sims, SIM_DIGITS)
    a, b = np.nonzero(np.abs(sims - exact_at) < CLOSE)
    sims[a, b] = plain_cosine(sides[0][a], sides[1][b])
    return sims


@dataclass(frozen=True)
class Prefix:
    """The first directions of a rotation: what two vectors are in them bounds what they are as a whole.

    For unit vectors x and y with heads x' and y' in ``directions``, x.y <= x'.y' + |rest of x| |rest of y| after Cauchy and
    Schwarz.  So most pairs are settled by their heads alone; only the others are compared in full.
    """

    directions: np.ndarray  # width x number of directions

    def parts(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Heads of unit rows, and the lengths of what lies outside the directions."""
        heads = units @ self.directions
        inside = np.einsum("ij,ij->i", heads, heads)
        whole = np.einsum("ij,ij->i", units, units)
        return heads, np.sqrt(np.maximum(whole - inside, 0.0)) + PREFIX_SLACK


PREFIX_SLACK = 1e-7  # covers the rounding of lengths near 0
FEW = 0.1  # share of pairs that may be left over for a full comparison


def open_pairs(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of rows, given by heads and rests, may reach the threshold."""
    return a[0] @ b[0].T + a[1][:, None] * b[1] >= threshold - ROUNDING


def pick_prefix(drawn: np.ndarray, threshold: float) -> Prefix | None:
    """The least number of directions that leave few pairs of the drawn unit rows open; None if it saves no work.

    The directions are those in which half of the rows are longest, in the order of their squared lengths; the other
    half shows how many pairs they leave.  Any directions would be right; these settle the most.
    """
    if len(drawn) < 4:
        return None
    width = drawn.shape[1]
    fitted, drawn = drawn[::2], drawn[1::2]
    order = np.linalg.eigh(fitted.T @ fitted)[1][:, ::-1]
    pairs = np.triu(np.ones((len(drawn), len(drawn)), bool), 1)
    step = max(1, width // 16)
    for count in range(step, width - width // 4 + 1, step):
        prefix = Prefix(np.ascontiguousarray(order[:, :count]))
        parts = prefix.parts(drawn)
        if open_pairs(parts, parts, threshold)[pairs].mean() <= FEW / 2:
            return prefix
    return None


def _similar(a: np.ndarray, b: np.ndarray, threshold: float, heads_a=None, heads_b=None, sides=None):
    """Places and values of the pairs of unit rows that reach the threshold."""
    if heads_a is not None:
        rows, columns = np.nonzero(open_pairs(heads_a, heads_b, threshold))
        if len(rows) <= FEW * len(a) * len(b):
            return _reached(rows, columns, np.einsum("ij,ij->i", a[rows], b[columns]), threshold, sides)
    return _hits(a @ b.T, threshold, sides)


def _angle(threshold: float) -> float:
    """The widest angle at which a rounded similarity reaches the threshold."""
    return math.acos(max(-1.0, min(1.0, threshold - ROUNDING)))


def _pair_kernel(threshold: float, strip: int, rounded: bool = True):
    """Pairs of one table with itself: similar, one fresh, not both wholly of one owner."""

    def kernel(rows: pa.Table) -> pa.Table:
        ids, fresh = rows["id"].to_numpy(), _flags(rows["fresh"])
        low, high = _codes(rows["low"], rows["high"])
        plain = matrix(rows["vec"])
        units = unit(plain)
        new = np.nonzero(fresh)[0]
        parts = []
        for at in strips(len(new), len(ids), strip):
            asked = new[at]
            first = asked[0] if fresh.all() else 0  # earlier rows have met these already
            sims = units[asked] @ units[first:].T
            a, b, sim = _hits(sims, threshold, None if rounded else (plain[asked], plain[first:]))
            a, b = asked[a], b + first
            alike = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
            keep = ((b > a) | ~fresh[b]) & ~alike
            parts.append((a[keep], b[keep], sim[keep]))
        return _found(ids, ids, parts)

    return kernel


def _places(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Whole-number codes of texts, and the texts that they stand for."""
    coded = column.combine_chunks().dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _codes_in(texts: pa.Array, column: pa.ChunkedArray) -> np.ndarray:
    """The codes of other texts by the same list; -1 for those not in it."""
    found = pc.index_in(column.combine_chunks(), value_set=texts)
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)


class _Copies:
    """The rows that the rows of one side stand for."""

    def __init__(self, column: pa.ChunkedArray):
        lists = column.combine_chunks()
        self.counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        held = lists.flatten()
        self.ids, self.owners = held.field("id"), pa.chunked_array([held.field("owner")])
        self.fresh = held.field("fresh").to_numpy(zero_copy_only=False).astype(bool)


def _row_pairs(left: _Copies, right: _Copies, owner_l: np.ndarray, owner_r: np.ndarray, a, b, sim) -> pa.Table:
    """Places and values of pairs of rows as a table of pairs of their copies: one fresh, of different owners."""
    each = left.counts[a] * right.counts[b]
    pair = np.repeat(np.arange(len(a)), each)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
    i, j = left.starts[a][pair] + at // right.counts[b][pair], right.starts[b][pair] + at % right.counts[b][pair]
    keep = (owner_l[i] != owner_r[j]) & (left.fresh[i] | right.fresh[j])
    return _emit(left.ids.take(pa.array(i[keep])), right.ids.take(pa.array(j[keep])), sim[pair[keep]])


def _cross_kernel(threshold: float, strip: int, prefix: Prefix | None = None, rounded: bool = True, by_row: bool = False):
    """As above for fresh rows that came to a cell and the rows at home there; ``by_row`` gives the pairs of their copies."""

    def kernel(right: pa.Table):
        right = right.sort_by("id")
        ids_r = right["id"].combine_chunks()
        names_r = ids_r.to_numpy(zero_copy_only=False)
        low_r, owners = _places(right["low"])
        single_r = pc.equal(right["low"], right["high"]).to_numpy()
        fresh, plain_r = _flags(right["fresh"]), matrix(right["vec"])
        all_fresh, units_r = bool(fresh.all()), unit(plain_r)
        heads_r = None if prefix is None else prefix.parts(units_r)
        if rounded:
            plain_r = None
        if by_row:
            copies_r = _Copies(right["copies"])
            owner_r, row_owners = _places(copies_r.owners)

        def meet(left: pa.Table) -> Iterator[pa.Table]:
            left = left.sort_by([("at_home", "ascending"), ("id", "ascending")])
            ids_l = left["id"].combine_chunks()
            low_l, single_l = _codes_in(owners, left["low"]), pc.equal(left["low"], left["high"]).to_numpy()
            at_home, ahead, plain_l = _flags(left["at_home"]), _flags(left["ahead"]), matrix(left["vec"])
            if by_row:
                copies_l = _Copies(left["copies"])
                owner_l = _codes_in(row_owners, copies_l.owners)
            units_l = unit(plain_l)
            for at in strips(len(ids_l), len(ids_r), strip):
                rows = units_l[at]
                # among rows at home, which meet in both orders, those before the first of them are left to the other order
                first = int(np.searchsorted(names_r, ids_l[at.start].as_py())) if all_fresh and at_home[at].all() else 0
                sides = None if rounded else (plain_l[at], plain_r[first:])
                heads = (None, None) if prefix is None else (prefix.parts(rows), tuple(x[first:] for x in heads_r))
                a, b, sim = _similar(rows, units_r[first:], threshold, *heads, sides)
                a, b = a + at.start, b + first
                alike = single_l[a] & single_r[b] & (low_l[a] == low_r[b])
                a, b, sim = a[~alike], b[~alike], sim[~alike]
                # two fresh rows meet in both cells, or in both orders at home: one meeting counts
                before = pc.less(ids_l.take(pa.array(a)), ids_r.take(pa.array(b))).to_numpy(zero_copy_only=False)
                once = ~fresh[b] | ahead[a] | (at_home[a] & before)
                a, b, sim = a[once], b[once], sim[once]
                if by_row:
                    yield _row_pairs(copies_l, copies_r, owner_l, owner_r, a, b, sim)
                else:
                    yield _emit(ids_l.take(pa.array(a)), ids_r.take(pa.array(b)), sim)

        return meet

    return kernel


@dataclass(frozen=True)
class Blocks:
    """Items in blocks that fit one task, and the larger blocks, of which there are at most
    rows / tile."""

    small: DataFrame
    large: DataFrame | None
    largest: int


def _by_size(items: DataFrame, counted: DataFrame, tile: int) -> Blocks:
    large = counted.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > tile)
    found = large.agg(F.count("*").alias("blocks"), F.max("n").alias("largest")).first()
    if not found["blocks"]:
        return Blocks(items, None, 0)
    large = cut_lineage(large.select("block"))
    return Blocks(items.join(broadcast_if_small(large), "block", "left_anti"), large, found["largest"])


def _pair_blocks(small: DataFrame, threshold: float, sizes: Sizes, rounded: bool = True) -> DataFrame:
    rows = small.select("block", "id", F.col("owner").alias("low"), F.col("owner").alias("high"), "vec", "fresh")
    return rows.groupBy("block").applyInArrow(_pair_kernel(threshold, sizes.strip, rounded), PAIR_SCHEMA)


def _pair_classes(
    classes: DataFrame, largest: int, threshold: float, sizes: Sizes, partly: bool, rounded: bool = True
) -> DataFrame:
    """Similar pairs among the rows of blocks too large for one task."""
    routes = _routes(classes, largest, threshold, sizes, partly)
    if routes is None:
        return classes.sparkSession.createDataFrame([], PAIR_SCHEMA)
    return _meet(routes, threshold, sizes, rounded)


@dataclass(frozen=True)
class Routes:
    """Fresh rows in the cells they visit, and all rows in their own."""

    visits: DataFrame
    homes: DataFrame
    prefix: Prefix | None
    held: int  # rows at home that a task holds


def _routes(
    classes: DataFrame, largest: int, threshold: float, sizes: Sizes, partly: bool, distinct: DataFrame | None = None
) -> Routes | None:
    """Fresh rows visit cells.  If all are fresh, visiting the later cells is enough.  None without rows.

    Pivots are drawn from ``distinct``, if given: the same vectors, each once.
    """
    drawn = classes if distinct is None else distinct
    width = len(drawn.select("vec").first()[0]) if not drawn.isEmpty() else 1
    held = max(sizes.tile, MOST_PAIRED // max(1, width))
    least, most = (int(min(sizes.max_pivots, max(2, n))) for n in (math.ceil(largest / held), 4 * math.ceil(largest / sizes.tile)))
    angle = _angle(threshold)
    pivots = pick_pivots(drawn, "id", "vec", most, least, angle, sizes.sample)
    if not len(pivots):  # blocks may be counted on more rows than are left to pair
        return None
    prefix = pick_prefix(draw_vectors(drawn, "id", "vec", min(sizes.sample, 1024)), threshold)
    assigned, cells = build_cells(classes, "vec", pivots)
    reach = F.lit(angle)
    visits = assigned.where("fresh").withColumn("_target", F.explode(reachable(assigned, F.col("vec"), reach, cells)))
    routed = (
        (visits if partly else visits.where(F.col("_target") >= F.col("cell")))
        .withColumn("at_home", F.col("_target") == F.col("cell"))
        .withColumn("ahead", F.col("_target") > F.col("cell"))
        .withColumn("cell", F.col("_target"))
        .drop("_target")
    )
    return Routes(routed, assigned, prefix, held)


def _meet(routes: Routes, threshold: float, sizes: Sizes, rounded: bool, by_row: bool = False) -> DataFrame:
    kernel = _cross_kernel(threshold, sizes.strip, routes.prefix, rounded, by_row)
    weight, order = "rows" if by_row else None, ("at_home", "id")
    return tile_stream(routes.visits, routes.homes, ["block", "cell"], "id", sizes.tile, kernel, PAIR_SCHEMA, routes.held, weight, order)


def _vector_classes(items: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors of the large blocks, and which rows share a vector.

    A class is one vector within one block.  It is named by its smallest id and keeps its
    smallest and largest owner: equal means that a single owner holds it.  However many
    copies there are, they are one row here.
    """
    held = items.join(broadcast_if_small(large), "block", "left_semi")
    # a 128-bit digest stands for the vector, so that the member table carries no vectors
    held = held.withColumn("digest", F.struct(F.xxhash64("vec"), F.xxhash64(F.lit(1), "vec")))
    classes = cut_lineage(
        held.groupBy("block", "digest").agg(
            F.min("id").alias("id"),
            F.count("*").alias("rows"),
            F.min("owner").alias("low"),
            F.max("owner").alias("high"),
            F.max("fresh").alias("fresh"),
            F.first("vec").alias("vec"),
        )
    )
    # A class may have any share of the rows.
    key = F.struct("block", "digest").alias("_key")
    members = join_to_keys(
        held.select(key, "id", "owner", "fresh"),
        classes.select(key, F.col("rows").alias("_size"), "rows", F.col("id").alias("class")), "_key", "_size",
    )
    return classes, members.select("class", "id", "owner", "fresh", "rows")


def similar_classes(
    items: DataFrame, large: DataFrame, largest: int, threshold: float, sizes: Sizes, partly: bool, rounded: bool = True
):
    """Pairs between distinct vectors of the large blocks, and which rows share a vector."""
    classes, members = _vector_classes(items, large)
    edges = _pair_classes(classes.drop("digest", "rows"), largest, threshold, sizes, partly, rounded)
    return classes, edges, members.drop("rows")


HELD = 32  # copies that a point carries through the cells, about


def _points(classes: DataFrame, members: DataFrame) -> DataFrame:
    """Classes that carry their copies; those of over ``HELD`` copies as several points of the same vector."""
    alone = classes.where("rows = 1").select(
        "block", "id", "rows", "low", "high", "fresh", "vec", F.array(F.struct("id", F.col("low").alias("owner"), "fresh")).alias("copies")
    )
    shares = F.when(F.col("rows") > HELD, F.ceil(2 * F.col("rows") / HELD)).otherwise(1)
    several = members.where("rows > 1").groupBy("class", F.pmod(F.xxhash64("id"), shares).alias("share")).agg(
        F.min("id").alias("id"), F.count("*").alias("rows"), F.min("owner").alias("low"), F.max("owner").alias("high"),
        F.max("fresh").alias("fresh"), F.collect_list(F.struct("id", "owner", "fresh")).alias("copies"),
    )
    shared = classes.where("rows > 1").select("block", F.col("id").alias("class"), "vec")
    return alone.unionByName(several.join(shared, "class").drop("class", "share"))


def _large_pairs(
    items: DataFrame, large: DataFrame, largest: int, threshold: float, sizes: Sizes, partly: bool, rounded: bool
) -> DataFrame:
    """Pairs of rows of the large blocks.

    Classes carry their copies, so pairs leave the cells as pairs of rows and are neither joined nor shuffled, however many
    copies there are.
    """
    classes, members = _vector_classes(items, large)
    points = cut_lineage(_points(classes, members))
    routes = _routes(points, largest, threshold, sizes, partly, classes)
    if routes is None:
        return items.sparkSession.createDataFrame([], PAIR_SCHEMA)
    return _meet(routes, threshold, sizes, rounded, True).unionByName(_copies_alike(points, threshold))


def _copies_alike(points: DataFrame, threshold: float) -> DataFrame:
    """Pairs of copies within classes that carry them."""
    zero = F.when(F.forall("vec", lambda x: x == 0), 0.0).otherwise(1.0)
    shared = points.where("low <> high").select("copies", zero.alias("sim")).where(F.col("sim") >= threshold)
    every = shared.select("sim", "copies", F.explode("copies").alias("x")).select("sim", "x", F.explode("copies").alias("y"))
    wanted = every.where("x.id < y.id AND x.owner <> y.owner AND (x.fresh OR y.fresh)")
    return wanted.select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"), "sim")


def near_duplicate_pairs(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    owner_col: str,
    block_cols: list[str],
    threshold: float = PAIR_THRESHOLD,
    exclude: tuple[str, str] | None = None,
    null_owners_differ: bool = False,
    sizes: Sizes = Sizes(),
    counted: DataFrame | None = None,
    fresh_col: str | None = None,
    rounded: bool = True,
) -> DataFrame:
    """(id_a, id_b, sim): rows of one block and different owners, cosine >= threshold.

    ``id_a < id_b`` as text.  Block columns that do not exist are ignored; without any,
    everything is one block.  NULL block values form a block of their own.  ``exclude`` is
    a (column, label) whose rows stay out.  A block that fits one task is compared there;
    larger ones go through pivot cells, with copies of a vector compared once.  Block sizes
    are counted on ``counted``, if given: a frame that is cheaper to count and lacks none of
    the rows.  With a boolean ``fresh_col`` only pairs with a fresh row are looked for, at a
    cost of fresh rows times all rows.  Similarities are rounded before they are compared with the threshold, unless
    ``rounded`` is false.
    """
    # read several times below; the vectors may have come by joins
    items = cut_lineage(_items(df, id_col, vec_col, owner_col, block_cols, exclude, null_owners_differ, fresh_col))
    if counted is not None:
        counted = counted.select(block_key([c for c in block_cols if c in df.columns]).alias("block"))
    blocks = _by_size(items, items if counted is None else counted, sizes.tile)
    pairs = _pair_blocks(blocks.small, threshold, sizes, rounded)
    if blocks.large is not None:
        pairs = pairs.unionByName(
            _large_pairs(items, blocks.large, blocks.largest, threshold, sizes, fresh_col is not None, rounded)
        )
    return pairs


def sound_blocks(df: DataFrame, vec_col: str, block_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of blocks that can be compared, and the other blocks (block columns, n_items, reason).

    A block fails if its vectors differ in length or hold numbers that aren't finite.  One aggregate over the blocks;
    missing vectors take no part in pairing and fail nothing.
    """
    blocks = [c for c in block_cols if c in df.columns]
    length = F.when(F.col(vec_col).isNotNull(), F.size(vec_col))
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    seen = df.groupBy(block_key(blocks).alias("_block"), *blocks).agg(
        F.count("*").alias("n_items"), F.min(length).alias("_least"), F.max(length).alias("_most"),
        F.bool_and(F.coalesce(finite, F.lit(True))).alias("_finite"),
    )
    reason = F.when(F.col("_least") != F.col("_most"), "vectors of mixed length").when(~F.col("_finite"), "numbers that are not finite")
    failed = cut_lineage(seen.withColumn("reason", reason).where("reason IS NOT NULL").select("_block", *blocks, "n_items", "reason"))
    sound = df.join(broadcast_if_small(failed.select("_block")), block_key(blocks) == F.col("_block"), "left_anti")
    return sound, failed.drop("_block")


def near_duplicate_links(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    owner_col: str,
    block_cols: list[str],
    threshold: float = PAIR_THRESHOLD,
    exclude: tuple[str, str] | None = None,
    null_owners_differ: bool = False,
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """(id_a, id_b): links with the same connected groups as all near-duplicate pairs.

    Copies are tied to their class by one link each instead of being paired with one
    another, so the size follows the rows and not the square of a group of copies.
    That is exact: if a class has two owners, all its members are connected; if two
    similar classes together have two owners, so are all members of both.
    """
    items = _items(df, id_col, vec_col, owner_col, block_cols, exclude, null_owners_differ)
    blocks = _by_size(items, items, sizes.tile)
    pairs = _pair_blocks(blocks.small, threshold, sizes)
    if blocks.large is None:
        return pairs.select("id_a", "id_b")
    classes, edges, members = similar_classes(items, blocks.large, blocks.largest, threshold, sizes, False)
    edges = cut_lineage(edges)
    zero = F.forall("vec", lambda x: x == 0)
    shared = classes.where(
        (F.col("low") != F.col("high")) & (F.when(zero, 0.0).otherwise(1.0) >= threshold)
    ).select(F.col("id").alias("class"))
    touched = edges.select(F.explode(F.array("id_a", "id_b")).alias("class"))
    live = shared.union(touched).distinct()
    ties = members.join(live, "class", "left_semi").where("class <> id")
    return (
        pairs.select("id_a", "id_b")
        .unionByName(edges.select("id_a", "id_b"))
        .unionByName(ties.select(F.col("class").alias("id_a"), F.col("id").alias("id_b")))
    )


@dataclass(frozen=True)
class Classes:
    """``pairs`` (id_a, id_b, class_a, class_b, rows_a, rows_b, sim) of representatives, and ``members`` (class, id)."""

    pairs: DataFrame
    members: DataFrame


def near_duplicate_classes(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    owner_col: str,
    copy_col: str,
    block_cols: list[str],
    threshold: float = PAIR_THRESHOLD,
    exclude: tuple[str, str] | None = None,
    null_owners_differ: bool = False,
    sizes: Sizes = Sizes(),
    rounded: bool = True,
) -> Classes:
    """Near-duplicate pairs with copies taken together.

    Rows of one block with equal ``copy_col`` are a class, named by its smallest id; they must have equal vectors.
    Two classes make one pair, whatever their sizes, if they are similar and two owners are among them; a class with
    two owners makes a pair with itself.  ``id_a < id_b`` are rows of different owners that stand for the classes:
    of each class the first of its least and the last of its greatest owner may do so.
    """
    items = _items(df.where(F.col(copy_col).isNotNull()).withColumn("_copy", F.sha2(F.col(copy_col).cast("string"), 256)),
                   id_col, vec_col, owner_col, block_cols, exclude, null_owners_differ, copy_col="_copy")
    stand = F.struct("owner", "id")
    classes = cut_lineage(
        items.groupBy("block", "copy").agg(
            F.min("id").alias("id"), F.min(stand).alias("least"), F.max(stand).alias("greatest"),
            F.count("*").alias("rows"), F.first("vec").alias("vec"),
        ).select("block", "copy", "id", "rows", "vec", F.col("least.owner").alias("low"), F.col("greatest.owner").alias("high"),
                 F.col("least.id").alias("low_id"), F.col("greatest.id").alias("high_id"), F.lit(True).alias("fresh"))
    )
    points = classes.select("block", "id", "low", "high", "vec", "fresh")
    blocks = _by_size(points, points, sizes.tile)
    pairs = blocks.small.groupBy("block").applyInArrow(_pair_kernel(threshold, sizes.strip, rounded), PAIR_SCHEMA)
    if blocks.large is not None:
        held = cut_lineage(points.join(broadcast_if_small(blocks.large), "block", "left_semi"))
        pairs = pairs.unionByName(_pair_classes(held, blocks.largest, threshold, sizes, False, rounded))
    alone = F.when(F.forall("vec", lambda x: x == 0), 0.0).otherwise(1.0)
    within = classes.where("low <> high").select(F.col("id").alias("id_a"), F.col("id").alias("id_b"), alone.alias("sim"))
    pairs = cut_lineage(pairs.unionByName(within.where(F.col("sim") >= threshold)))
    uses = pairs.select(F.explode(F.array("id_a", "id_b")).alias("id")).groupBy("id").agg(F.count("*").alias("uses"))
    facts = cut_lineage(classes.join(uses, "id").select("id", "uses", "rows", "low", "high", "low_id", "high_id"))
    for side in ("a", "b"):
        own = facts.withColumnsRenamed({c: f"{c}_{side}" for c in facts.columns if c != "uses"})
        pairs = join_to_keys(pairs, own, f"id_{side}", "uses")
    # Not both wholly of one owner, so one of these has two.
    chosen = (
        F.when(F.col("id_a") == F.col("id_b"), F.array("low_id_a", "high_id_a"))
        .when(F.col("low_a") != F.col("low_b"), F.array("low_id_a", "low_id_b"))
        .when(F.col("low_a") != F.col("high_b"), F.array("low_id_a", "high_id_b"))
        .otherwise(F.array("high_id_a", "low_id_b"))
    )
    shown = pairs.select(
        F.array_min(chosen).alias("id_a"), F.array_max(chosen).alias("id_b"), F.col("id_a").alias("class_a"),
        F.col("id_b").alias("class_b"), "rows_a", "rows_b", "sim",
    )
    members = join_to_keys(
        items.select(F.xxhash64("block", "copy").alias("_class"), "id"),
        cut_lineage(classes.select(F.xxhash64("block", "copy").alias("_class"), F.col("id").alias("class"), "rows")), "_class", "rows",
    )
    return Classes(shown, members.select("class", "id"))


def block_stats(df: DataFrame, block_cols: list[str], pairs: DataFrame, id_col: str) -> DataFrame:
    """Rows and candidate pairs per block, blocks without pairs included; without block columns, of all rows."""
    blocks = [c for c in block_cols if c in df.columns]
    items = df.groupBy(block_key(blocks).alias("_block"), *blocks).agg(F.count("*").alias("n_items"))
    owner = df.select(F.col(id_col).cast("string").alias("id_a"), block_key(blocks).alias("_block"))
    found = pairs.select("id_a").join(owner, "id_a").groupBy("_block").agg(F.count("*").alias("n_pairs"))
    joined = items.join(found, "_block", "left").withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0)))
    return joined.select(*blocks, "n_items", "n_pairs")


# --- against a library ------------------------------------------------------------------


def _small_library(library: DataFrame, id_col: str, vec_col: str, sizes: Sizes):
    """(ids, rows) of a library whose size has been checked, else None."""
    first = library.select(vec_col).first()
    width = max(1, len(first[0])) if first else 1
    if rows_up_to(library, sizes.broadcast_cells // width) is None:
        return None
    table = library.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).orderBy("id").toArrow()
    return table["id"].combine_chunks(), matrix(table["vec"])


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best entries of each row; of ties, the lower column."""
    n, m = sims.shape
    if m <= k:
        row, col = np.divmod(np.arange(n * m), m)
    else:
        kth = -np.partition(-sims, k - 1, axis=1)[:, k - 1 : k]
        row, col = np.nonzero(sims >= kth)
    order = np.lexsort((col, -sims[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(n))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], col[keep]


def max_similarity(
    df: DataFrame,
    library: DataFrame,
    id_col: str,
    vec_col: str,
    lib_id: str,
    lib_vec: str,
    sizes: Sizes = Sizes(),
    exact_at: float | None = None,
) -> DataFrame:
    """``df`` with ``max_sim``, its largest cosine to the library, rounded to ``SIM_DIGITS``.

    With ``exact_at`` it is not rounded, and on the side of that number where SQL has it.

    Zero vectors on either side count as cosine 0.  NULL without a library or a vector.
    """
    library = library.where(F.col(lib_vec).isNotNull())
    small = _small_library(library, lib_id, lib_vec, sizes)
    if small is None:
        return _max_of_large(df, library, id_col, vec_col, lib_id, lib_vec, sizes, exact_at)
    if not len(small[0]):
        return df.withColumn("max_sim", F.lit(None).cast("double"))
    shared = df.sparkSession.sparkContext.broadcast(small[1])

    @F.arrow_udf("double")
    def best_of(vectors: pa.Array) -> pa.Array:
        present = pc.is_valid(vectors).to_numpy(zero_copy_only=False)
        rows = vectors.drop_null()
        best = np.full(len(vectors), np.nan)
        if len(rows):
            plain, lib = matrix(rows), unit(shared.value)
            units = unit(plain)
            best[present] = np.concatenate(
                [
                    _scores(units[at], lib, (plain[at], shared.value), exact_at).max(axis=1)
                    for at in strips(len(units), len(lib), sizes.strip)
                ]
            )
        return pa.array(best, mask=~present)

    return df.withColumn("max_sim", best_of(F.col(vec_col)))


def _max_of_large(df, library, id_col, vec_col, lib_id, lib_vec, sizes, exact_at=None) -> DataFrame:
    """As for a small library: the nearest entry with a direction, or 0 where a zero vector takes part."""
    directed = library.where(_has_direction(lib_vec))
    some_zero = not library.where(~_has_direction(lib_vec)).isEmpty()
    rows = df.where(_has_direction(vec_col)).select(id_col, F.col(vec_col).alias("vec"))
    best = _nearest_of_large(rows, directed, 1, id_col, lib_id, lib_vec, None, sizes, exact_at).select(
        F.col("id.key").alias("_key"), F.col("id.digest").alias("_digest"), F.col("sim").alias("_best")
    )
    of_row = F.greatest("_best", F.lit(0.0)) if some_zero else F.col("_best")
    same = F.col(id_col).eqNullSafe(F.col("_key")) & (_digest(F.col(vec_col)) == F.col("_digest"))
    return df.join(best, same, "left").select(
        *df.columns, F.when(F.col(vec_col).isNotNull(), F.coalesce(of_row, F.lit(0.0))).alias("max_sim")
    )


def _has_direction(column: str) -> Column:
    return F.col(column).isNotNull() & F.exists(column, lambda x: x != 0)


def _digest(vector: Column) -> Column:
    """128 bits that stand for a vector."""
    return F.struct(F.xxhash64(vector), F.xxhash64(F.lit(1), vector))


def drop_boilerplate(
    df: DataFrame,
    library: DataFrame,
    id_col: str,
    vec_col: str,
    lib_id: str,
    lib_vec: str,
    threshold: float | None = BOILERPLATE_THRESHOLD,
    sizes: Sizes = Sizes(),
    rounded: bool = True,
) -> DataFrame:
    """Rows whose largest cosine to the library is below the threshold; None keeps all.

    An empty library drops nothing, and neither does a missing vector.  ``rounded`` as for ``near_duplicate_pairs``.
    """
    if threshold is None:
        return df
    scored = max_similarity(df, library, id_col, vec_col, lib_id, lib_vec, sizes, None if rounded else threshold)
    return scored.where(F.col("max_sim").isNull() | (F.col("max_sim") < threshold)).drop("max_sim")


def nearest(
    df: DataFrame,
    library: DataFrame,
    k: int,
    id_col: str,
    vec_col: str,
    lib_id: str,
    lib_vec: str,
    threshold: float | None = None,
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """(id, ref_id, sim, rank): the k most similar library entries of each row.

    Ties go to the lower library id.  Zero vectors have no direction and no neighbours.
    Every row is answered, also where rows share an id.
    ``threshold`` then drops weaker entries among the k.
    """
    rows = df.where(_has_direction(vec_col)).select(id_col, F.col(vec_col).alias("vec"))
    library = library.where(_has_direction(lib_vec))
    small = _small_library(library, lib_id, lib_vec, sizes)
    if small is None:
        found = _nearest_of_large(rows, library, k, id_col, lib_id, lib_vec, threshold, sizes)
        found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("id.copies")))).select(
            F.col("id.key").alias(id_col), "ref_id", "sim", "rank"
        )
    else:
        kind = library.schema[lib_id].dataType.simpleString()
        found = _nearest_of_small(rows, small, k, kind, sizes).select(id_col, "ref_id", "sim", "rank")
    return found if threshold is None else found.where(F.col("sim") >= threshold)


def _nearest_of_small(rows: DataFrame, small, k: int, id_type: str, sizes: Sizes) -> DataFrame:
    """One pass over the rows with the whole library at hand; no shuffle."""
    shared = rows.sparkSession.sparkContext.broadcast(small)

    @F.arrow_udf(f"array<struct<ref_id:{id_type},sim:double>>")
    def best_of(vectors: pa.Array) -> pa.Array:
        ids, lib = shared.value[0], unit(shared.value[1])
        if len(vectors) == 0 or len(ids) == 0:
            kind = pa.struct([("ref_id", ids.type), ("sim", pa.float64())])
            return pa.array([[] for _ in range(len(vectors))], pa.list_(kind))
        units = unit(matrix(vectors))
        cols, vals, counts = [], [], []
        for at in strips(len(units), len(lib), sizes.strip):
            sims = np.round(units[at] @ lib.T, SIM_DIGITS)
            row, col = _best(sims, k)
            cols.append(col), vals.append(sims[row, col])
            counts.append(np.bincount(row, minlength=len(sims)))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        refs = ids.take(pa.array(np.concatenate(cols)))
        entries = pa.StructArray.from_arrays([refs, pa.array(np.concatenate(vals))], ["ref_id", "sim"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)

    hits = rows.withColumn("_best", best_of(F.col("vec"))).drop("vec")
    return hits.select("*", F.posexplode("_best").alias("_rank", "_hit")).select(
        "*", F.col("_hit.ref_id").alias("ref_id"), F.col("_hit.sim").alias("sim"), (F.col("_rank") + 1).alias("rank")
    )


def _nearest_of_large(rows, library, k, id_col, lib_id, lib_vec, threshold, sizes, exact_at=None) -> DataFrame:
    """Two rounds.  A bounded sample gives each row a radius that holds at least k entries;
    then only the cells within that radius are searched, so the answer is exact.

    Rows of equal id and vector are searched once: ``id`` is (key, digest, copies)."""
    rows = rows.groupBy(F.col(id_col).alias("key"), _digest(F.col("vec")).alias("digest")).agg(
        F.first("vec").alias("vec"), F.count("*").alias("copies")
    )
    rows = rows.select(F.struct("key", "digest", "copies").alias("id"), "vec")
    lib = library.select(F.col(lib_id).alias("ref_id"), F.col(lib_vec).alias("vec"))
    sample = draw_vectors(lib, "ref_id", "vec", sizes.sample)
    assigned, cells = build_cells(lib, "vec", sample[: min(sizes.max_pivots, max(2, len(sample) // 16))])
    shared = rows.sparkSession.sparkContext.broadcast(sample)
    ceiling = math.pi if threshold is None else _angle(threshold)

    @F.arrow_udf("double")
    def radius(vectors: pa.Array) -> pa.Array:
        sims = unit(matrix(vectors)) @ shared.value.T if len(vectors) else np.zeros((0, k))
        if sims.shape[1] < k:
            return pa.array(np.full(len(vectors), ceiling))
        kth = -np.partition(-sims, k - 1, axis=1)[:, k - 1]
        return pa.array(np.minimum(ceiling, np.arccos(np.clip(kth - 2 * ROUNDING, -1, 1))))

    seen = cut_lineage(rows.withColumn("reach", radius(F.col("vec"))))
    routed = seen.withColumn("cell", F.explode(reachable(seen, F.col("vec"), F.col("reach"), cells))).select("id", "vec", "cell")
    kind = library.schema[lib_id].dataType.simpleString()
    own = rows.schema["id"].dataType.simpleString()

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table({"id": left["id"].slice(0, 0), "ref_id": right["ref_id"].slice(0, 0), "sim": pa.array([], pa.float64())})
        right = right.sort_by("ref_id")
        plain, lib_plain = matrix(left["vec"]), matrix(right["vec"])
        units, lib_units = unit(plain), unit(lib_plain)
        out_row, out_col, out_sim = [], [], []
        for at in strips(len(units), len(lib_units), sizes.strip):
            sims = _scores(units[at], lib_units, (plain[at], lib_plain), exact_at)
            row, col = _best(sims, k)
            out_row.append(row + at.start), out_col.append(col), out_sim.append(sims[row, col])
        return pa.table(
            {
                "id": left["id"].take(pa.array(np.concatenate(out_row))),
                "ref_id": right["ref_id"].take(pa.array(np.concatenate(out_col))),
                "sim": pa.array(np.concatenate(out_sim)),
            }
        )

    # rows and library entries are salted by the same name
    library_side = assigned.withColumn("id", F.struct("ref_id"))
    most = MOST_SEARCHED // max(1, sample.shape[1])
    partial = tile_join(routed, library_side, ["cell"], "id", sizes.tile, kernel, f"id {own}, ref_id {kind}, sim double", most)
    best = Window.partitionBy("id").orderBy(F.desc("sim"), "ref_id")
    return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

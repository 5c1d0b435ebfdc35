"""Near-duplicates by Jaccard similarity of word shingles: candidates from MinHash bands, each checked exactly.

Texts with the same set of shingles are one row first.  Sets whose SimHash fingerprints are linked by BK-trees within two
bits (``simhash.radius_links``) share a key, their component.  A set also has ``BANDS`` band keys, each over ``ROWS`` minima,
since many similar sets are further apart than that; sets that share a key of either kind are candidates.  Two sets at the least similarity share none with a chance of
(1 - 0.8^5)^56 = 2e-10, more similar ones with less; the keys have a fixed seed.  No pair is linked unless its
exact similarity reaches the least one.

Keys with the same members count once.  The members of a key meet, with their whole sets, in one task, which
hands out a spanning forest of their links, never all pairs.  Keys of over ``TILE_SETS`` sets or ``TILE_SHINGLES``
shingles are cut into parts, each meeting each other one, so that a task is bounded and nothing is left out.

Defined cases: texts without words, null included, are one set; a text of fewer words than a shingle is one
shingle.  Repeated rows share a component.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexroll.llm.common import mark_to_join, per_text, text_batches
from lexroll.llm.simhash import SEED, fingerprint_of, grouped, one_of_each, radius_links
from lexroll.operators.closure import connected_groups
from lexroll.operators.lineage import broadcast_if_small, written
from lexroll.operators.skew import join_to_keys

SHINGLE = 5
SIMILAR = (4, 5)  # the least similarity, as a fraction
ROWS, BANDS = 5, 56
TILE_SETS = 512
TILE_SHINGLES = 1_000_000
COMMON = 16  # shingles of that many sets of a tile are counted by a matrix product
_draw = np.random.default_rng(SEED)
FACTORS = _draw.integers(0, 1 << 64, ROWS * BANDS, np.uint64) | np.uint64(1)
SHIFTS = _draw.integers(0, 1 << 64, ROWS * BANDS, np.uint64)


def shingles_of(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the distinct shingles of one whole text; words are split at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, "<u8")
    hash_of = xxhash.xxh64_intdigest
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.array([hash_of(s, SEED) for s in shingles], "<u8"))


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def mark_of(text: str | None) -> int:
    """A number for the set of shingles; 0 if it is empty."""
    own = shingles_of(text)
    return _signed(xxhash.xxh64_intdigest(own.tobytes(), SEED)) if len(own) else 0


def bands_of(own: np.ndarray) -> list[int]:
    """The band keys of a set."""
    if not len(own):
        return []
    least = np.full(ROWS * BANDS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(own), 256):
        np.minimum(least, (own[at : at + 256, None] * FACTORS + SHIFTS).min(0), out=least)
    bands = least.reshape(BANDS, ROWS)
    return [_signed(xxhash.xxh64_intdigest(band.tobytes(), i)) for i, band in enumerate(bands)]


def _facts(text: str | None) -> dict:
    own = shingles_of(text)
    mark = _signed(xxhash.xxh64_intdigest(own.tobytes(), SEED)) if len(own) else 0
    return {"fp": mark, "size": len(own), "print": fingerprint_of(text), "bands": bands_of(own)}


def _set(text: str | None) -> dict:
    own = shingles_of(text)
    return {"fp": _signed(xxhash.xxh64_intdigest(own.tobytes(), SEED)) if len(own) else 0, "own": own.tobytes()}


marks = per_text(mark_of, "bigint")
facts = per_text(_facts, "struct<fp: bigint, size: int, print: bigint, bands: array<bigint>>")
sets = per_text(_set, "struct<fp: bigint, own: binary>")


def shared_counts(own: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, above the diagonal at least."""
    n = len(own)
    values = np.concatenate(own)
    holder = np.repeat(np.arange(n), [len(s) for s in own])
    order = np.argsort(values, kind="stable")
    holder = holder[order]
    _, code, times = np.unique(values[order], return_inverse=True, return_counts=True)
    shared = np.zeros((n, n), np.int64)
    rare = times[code] < COMMON
    few, few_code = holder[rare], code[rare]
    for apart in range(1, COMMON - 1):
        both = few_code[apart:] == few_code[:-apart]
        if not both.any():
            break
        shared += np.bincount(few[:-apart][both] * n + few[apart:][both], minlength=n * n).reshape(n, n)
    much, much_code = holder[~rare], np.unique(code[~rare], return_inverse=True)[1]
    for first in range(0, int(much_code[-1]) + 1 if len(much_code) else 0, 2048):
        at, to = np.searchsorted(much_code, [first, first + 2048])
        table = np.zeros((n, 2048), np.float32)
        table[much[at:to], much_code[at:to] - first] = 1
        shared += (table @ table.T).astype(np.int64)
    return shared


def tile_links(fps: list[int], own: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that reach the least similarity."""
    sizes = np.array([len(s) for s in own])
    shared = shared_counts(own)
    joint = sizes[:, None] + sizes[None, :] - shared
    lead, links = list(range(len(fps))), []

    def top(x: int) -> int:
        while lead[x] != x:
            lead[x] = lead[lead[x]]
            x = lead[x]
        return x

    for a, b in np.argwhere(np.triu(SIMILAR[1] * shared >= SIMILAR[0] * joint, 1)).tolist():
        x, y = top(a), top(b)
        if x != y:
            lead[max(x, y)] = min(x, y)
            links.append((fps[a], fps[b]))
    return links


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows sorted by tile, the links of each; one tile is held at a time."""
    tile, fps, own = None, [], []

    def ready() -> pa.RecordBatch:
        links = tile_links(fps, own) if len(fps) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        for key, fp, held in zip(*(batch.column(i) for i in range(3))):
            if key.as_py() != tile:
                if len(fps) > 1:
                    yield ready()
                tile, fps, own = key.as_py(), [], []
            fps.append(fp.as_py())
            own.append(np.frombuffer(held.as_py(), "<u8"))
    yield ready()


def print_keys(distinct: DataFrame) -> DataFrame:
    """(fp, size, key): sets whose fingerprints reach one another through BK-trees have the same key.

    Empty sets aren't among them, and neither are sets that are alone.
    """
    full = distinct.where("size > 0")
    prints = written(full.groupBy("print").agg(F.count("*").alias("sets")))
    links = radius_links(prints.select(F.col("print").alias("fp")))
    roots = connected_groups(links, "u", "v").select(F.col("id").alias("print"), "root")
    keyed = prints.join(roots, "print", "left").select("print", "sets", F.coalesce("root", "print").alias("root"))
    found = join_to_keys(full.select("print", "fp", "size"), written(keyed), "print", "sets")
    return found.select("fp", "size", F.xxhash64(F.lit("print"), "root").alias("key"))


def similar_links(
    docs: DataFrame, distinct: DataFrame, text_col: str = "text", tile_sets: int = TILE_SETS, tile_shingles: int = TILE_SHINGLES
) -> DataFrame:
    """(u, v): links between sets whose components are those of all pairs of the least similarity.

    ``distinct`` has a row (fp, size, print, bands) for each set of ``docs``.
    """
    distinct = written(distinct)
    keys = written(distinct.select("fp", "size", F.explode("bands").alias("key")).unionByName(print_keys(distinct)))
    met = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"),
        F.bit_xor("fp").alias("x"), F.bit_xor(F.xxhash64("fp")).alias("y"),
    ).where("n > 1")
    met = written(met.groupBy("n", "shingles", "x", "y").agg(F.min("key").alias("key")))
    parts = F.greatest(F.ceil(F.col("n") / tile_sets), F.ceil(F.col("shingles") / tile_shingles)).cast("int")
    members = keys.join(broadcast_if_small(met.select("key", parts.alias("parts"))), "key")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: (F.col("parts") == 1) | (o != F.col("part")))
    tiles = members.withColumn("part", own).select("key", "fp", "part", F.explode(others).alias("other"))
    tile = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))
    tiles = written(tiles.select(tile.alias("tile"), "fp"))
    wanted = broadcast_if_small(written(tiles.select("fp").distinct()))
    # The mark alone is made first, so that texts without a candidate are not cut a second time.  The others are written
    # between: two functions in one task would take two Python workers, which then stay and fill with later stages' tables.
    marked = docs.select(F.col(text_col).alias("text"), mark_to_join(marks(F.col(text_col))).alias("fp"))
    held = marked.join(wanted, "fp", "left_semi")
    held = written(held.dropDuplicates(["fp"]).select("text"))
    held = written(held.select(sets(F.col("text")).alias("s")).select("s.*"))
    rows = tiles.join(held, "fp").select("tile", "fp", "own").repartition("tile").sortWithinPartitions("tile", "fp")
    return written(rows.mapInArrow(_tiles, "u long, v long"))


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_sets: int = TILE_SETS, tile_shingles: int = TILE_SHINGLES
) -> DataFrame:
    """``docs`` with one row of each component: one with its smallest id; other rows go."""
    text_batches(docs.sparkSession)
    known = written(docs.select(F.col(id_col).alias("doc_id"), facts(F.col(text_col)).alias("f")).select("doc_id", "f.*"))
    marked = known.select("doc_id", "fp")
    distinct = known.groupBy("fp").agg(F.first("size").alias("size"), F.min("print").alias("print"), F.first("bands").alias("bands"))
    found = grouped(marked, similar_links(docs, distinct, text_col, tile_sets, tile_shingles))
    return one_of_each(docs, marked, found, marks, id_col, text_col)

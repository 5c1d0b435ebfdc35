"""Near-duplicates by SimHash: fingerprints of word shingles, linked within a radius by BK-trees.

Fingerprints are first made distinct, so that copies, however many, are one row.  Two fingerprints that
differ in at most r bits agree on one of r + 1 blocks of bits, so each fingerprint goes to r + 1 shards, one
for each block and its value.  A shard of up to ``shard_rows`` fingerprints becomes a BK-tree, whose children
are keyed by their distance to the parent; a search follows only edges within the radius of its own
distance.  A larger shard is dealt again by blocks of the bits that it doesn't yet share.  Every round fixes
a third of the bits left, so after at most five rounds no shard can be larger; nothing is left out.

A shard hands out a spanning forest of its links, at most one row for each member, never all pairs.  Trees
are not sent to all executors at once, for they grow with the input: each goes to one task, together with
its queries, and holds ``shard_rows`` nodes at most.

Defined cases: a text without words, null included, has the fingerprint zero, linked like any other; a text
of fewer words than a shingle is one shingle.  Repeated rows share a component.  A null id never names a
component unless all its ids are null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lexroll.llm.common import mark_to_join, per_text, text_batches
from lexroll.operators.closure import connected_groups
from lexroll.operators.lineage import broadcast_if_small, written
from lexroll.operators.skew import join_to_keys

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD_ROWS = 2_048
LEAST_SHARD = 16  # below, shards could not always be split


def fingerprint_of(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint of one whole text, as a signed number; words are split at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.array([hash_of(s, SEED) for s in shingles], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


fingerprints = per_text(fingerprint_of, "bigint")


class BKTree:
    """Numbers under the Hamming distance; each child hangs on an edge keyed by its distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of all values within ``radius``, by edges that can lead there."""
        values, edges, found = self.values, self.edges, []
        open_nodes = [0] if values else []
        while open_nodes:
            node = open_nodes.pop()
            apart = (values[node] ^ value).bit_count()
            if apart <= radius:
                found.append(node)
            branches = edges[node]
            if len(branches) <= 2 * radius + 1:
                open_nodes += [child for d, child in branches.items() if -radius <= d - apart <= radius]
            else:
                open_nodes += [branches[d] for d in range(apart - radius, apart + radius + 1) if d in branches]
        return found

    def add(self, value: int) -> int:
        """The place of ``value``, new or old."""
        if not self.values:
            self.values.append(value)
            self.edges.append({})
            return 0
        node = 0
        while True:
            apart = (self.values[node] ^ value).bit_count()
            if not apart:
                return node
            child = self.edges[node].get(apart)
            if child is None:
                self.edges[node][apart] = len(self.values)
                self.values.append(value)
                self.edges.append({})
                return len(self.values) - 1
            node = child


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``radius`` among distinct values."""
    tree, lead, links = BKTree(), list(range(len(values))), []

    def top(x: int) -> int:
        while lead[x] != x:
            lead[x] = lead[lead[x]]
            x = lead[x]
        return x

    mask = (1 << BITS) - 1
    for value in values:
        near = tree.near(value & mask, radius)
        own = tree.add(value & mask)
        for other in near:
            a, b = top(own), top(other)
            if a != b:
                lead[max(a, b)] = min(a, b)
                links.append((value, values[other]))
    return links


def _forests(radius: int):
    """For rows sorted by shard, the links of each shard; one shard is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, values, links = None, [], []
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != shard:
                    links += shard_links(values, radius) if len(values) > 1 else []
                    shard, values = key, []
                values.append(value)
            if len(links) > 10_000:
                yield _links(links)
                links = []
        links += shard_links(values, radius) if len(values) > 1 else []
        yield _links(links)

    return run


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(ends, names=["u", "v"])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(free: int, blocks: int) -> list[int]:
    """The bits of ``free`` dealt into ``blocks`` runs of nearly equal length."""
    places = [b for b in range(BITS) if free >> b & 1]
    return [sum(1 << b for b in part) for part in np.array_split(np.array(places, object), blocks)]


def radius_links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` whose components are those of all links in the radius.

    Each round deals all shards that are still too large, whichever bits they share: ``masks`` has those bits for
    each block of the round before, and ``path`` tells its shards apart.  Shards are counted before they are
    gathered, so the rows of a large one never meet in a task.
    """
    shard_rows = max(shard_rows, LEAST_SHARD)
    every = (1 << BITS) - 1
    members = distinct.select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).alias("before"))
    masks = {0: 0}
    links = None
    while masks:
        blocks = {}
        choices = []
        for before, held in masks.items():
            parts = []
            for mask in block_masks(every & ~held, radius + 1):
                block = len(blocks)
                blocks[block] = held | mask
                shard = F.xxhash64("path", F.lit(block), _part_of("fp", mask))
                parts.append(F.struct(F.lit(block).alias("block"), shard.alias("shard")))
            choices.append(F.when(F.col("before") == before, F.array(*parts)))
        dealt = members.select("fp", F.explode(F.coalesce(*choices)).alias("key")).select("fp", "key.*")
        large = written(dealt.groupBy("block", "shard").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows))
        again = sorted(r[0] for r in large.select("block").distinct().collect())  # of a few numbers
        if again:
            marks = broadcast_if_small(large.drop("n"))
            found = dealt.join(marks, ["block", "shard"])
            members = written(found.select("fp", F.col("shard").alias("path"), F.col("block").alias("before")))
            dealt = dealt.join(marks, ["block", "shard"], "left_anti")
        masks = {block: blocks[block] for block in again}
        shards = dealt.select("shard", "fp").repartition("shard").sortWithinPartitions("shard", "fp")
        forest = shards.mapInArrow(_forests(radius), "u long, v long")
        links = forest if links is None else links.unionByName(forest)
    return written(links)


def _part_of(column: str, mask: int) -> Column:
    return F.col(column).bitwiseAND(F.lit(_signed(mask)))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row; ``component_id`` is the smallest id that links reach."""
    text_batches(docs.sparkSession)
    marked = written(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col)).alias("fp")))
    return components(marked, radius, shard_rows)


def components(marked: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows (doc_id, fp) with ``root``, a fingerprint that names their component, and ``component_id``."""
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    return _named(marked, distinct, radius_links(distinct, radius, shard_rows))


def grouped(marked: DataFrame, links: DataFrame) -> DataFrame:
    """The same for given links (u, v) between marks ``fp`` of any kind."""
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    return _named(marked, distinct, links)


def _named(marked: DataFrame, distinct: DataFrame, links: DataFrame) -> DataFrame:
    groups = connected_groups(links, "u", "v")
    groups = groups.select(F.col("id").alias("fp"), "root")
    linked = written(distinct.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    names = written(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members")))
    found = join_to_keys(linked, names, "root", "members").select("fp", "root", "component_id", "rows")
    return join_to_keys(marked, written(found), "fp", "rows")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: one with its smallest id; other rows go.

    Texts are shuffled once, by their row's own key, under which no more than equal rows meet.
    """
    text_batches(docs.sparkSession)
    marked = written(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col)).alias("fp")))
    return one_of_each(docs, marked, components(marked, radius), fingerprints, id_col, text_col)


def one_of_each(
    docs: DataFrame, marked: DataFrame, found: DataFrame, marks: Callable[[Column], Column], id_col: str, text_col: str
) -> DataFrame:
    """``docs`` with one row of each component of ``found``; ``marks`` makes the ``fp`` of a text."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp")
    least = found.groupBy("root").agg(F.min(order).alias("first"))
    chosen = written(least.select(F.col("first.doc_id").alias("id"), F.col("first.fp").alias("fp")))
    again = marked.groupBy("doc_id", "fp").agg(F.count("*").alias("n")).where("n > 1")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("row_id"), mark_to_join(marks(F.col(text_col))).alias("row_fp")
    )
    kept = rows.join(chosen, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_fp") == F.col("fp")), "left_semi")
    if not again.isEmpty():
        kept = kept.dropDuplicates(["row_id", "row_fp"])
    return kept.select("row.*")

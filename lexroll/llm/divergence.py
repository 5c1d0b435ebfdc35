"""Source divergence audit: how far the term shares of a source are from those of the other sources of its language.

Terms are counted in the tasks by length-bucketed packing.  The lower-cased bytes of many texts are cut at once;
a term of up to eight bytes becomes one unsigned 64-bit word and one of up to sixteen two (terms hold no zero
byte, so padding with zeros keeps them apart).  The words are sorted by radix, sixteen bits a pass, and equal runs
are counted; a stable sort leaves documents in order, so the documents of a run are counted with it.  Longer terms
go to buckets by the size of their length, sorted as bytes.  Spark adds the counts up.

A language keeps the terms of at least ``min_docs`` of its documents.  Each source of the language, and the
language itself, gives a kept term the share p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two shares differ by
f = floor((p - q)^2 / (p + q)).  All of this is exact in 64 bits as long as N + 2 V stays under 9 * 10^15.

Pairs of sources are summed up in squares: at most ``TILE`` sources meet as many others over one block of terms, and
only terms that one of them has are visited; the others add one product.  So a task holds a bounded part of the
counts, and work follows the pairs asked for.

Defined cases: null text, language and source count as empty.  Rows are documents; repeated rows count each.  Groups
without terms stay groups, with equal shares for all kept terms.  A language without kept terms has pairs of
value 0 and no terms; one with a single source has no pairs.  Ties are ranked by the item's bytes.  Texts may have
any length; a task holds about twenty times its longest text or ``CHUNK_BYTES``, if these are more.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexroll.llm.common import text_batches
from lexroll.operators.lineage import broadcast_if_small, written
from lexroll.operators.ranks import row_numbers

MIN_DOCS = 10
TOP_TERMS = 10
SCALE_STEPS = 3  # of a factor of 1000 each: shares are counted in parts of 10^9
CHUNK_BYTES = 8 * 1024 * 1024  # texts cut and sorted at a time
TILE = 64  # sources a side
BLOCK_TERMS = 2048  # kept terms of a block, about

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# The bytes of a word that a term of so many bytes fills.
FILLED = np.array([0] + [(1 << 64) - (1 << 8 * (8 - n)) for n in range(1, 9)], np.uint64)

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
COUNTS_ARROW = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def radix_order(digits: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by their digits of 16 bits, the least significant digit first."""
    order = None
    for digit in digits:
        digit = digit if order is None else digit[order]
        if digit.size and (digit[0] != digit).any():
            step = np.argsort(digit, kind="stable")  # a radix sort for 16 bits
            order = step if order is None else order[step]
    return np.arange(digits[0].size) if order is None else order


def _digits(word: np.ndarray) -> list[np.ndarray]:
    return [(word >> np.uint64(shift)).astype(np.uint16) for shift in (0, 16, 32, 48)]


def find_terms(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of the terms in the bytes of texts that start at ``starts``; no term spans two texts."""
    inside = LETTER[data]
    cut = np.zeros(data.size + 1, bool)
    cut[starts] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    at = np.flatnonzero(first)
    return at, np.flatnonzero(last) + 1 - at


def _runs(columns: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted rows: where runs of equal columns begin, their lengths and the number of different documents in each."""
    new = np.ones(doc.size, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    begin = np.flatnonzero(new)
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    return begin, np.diff(begin, append=doc.size), np.add.reduceat(fresh.astype(np.int64), begin)


def count_chunk(data: np.ndarray, starts: np.ndarray, group: np.ndarray) -> Iterator[tuple]:
    """(groups, terms, occurrences, documents) of each bucket for texts in one array of bytes."""
    data = LOWER[data]
    at, size = find_terms(data, starts)
    doc = np.searchsorted(starts, at, "right") - 1
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.ndarray((data.size + 8,), ">u8", buffer=padded, strides=(1,))
    for low, high in ((1, 8), (9, 16)):
        chosen = np.flatnonzero((size >= low) & (size <= high))
        if not chosen.size:
            continue
        here, long, owner = at[chosen], size[chosen], doc[chosen]
        packed = [words[here + 8 * k].astype(np.uint64) & FILLED[np.clip(long - 8 * k, 0, 8)] for k in range(high // 8)]
        of = group[owner].astype(np.uint64)
        order = radix_order([d for w in reversed(packed) for d in _digits(w)] + _digits(of)[:2])
        columns = [c[order] for c in (*packed, of)]
        begin, n, docs = _runs(columns, owner[order])
        letters = np.stack([c[begin] for c in columns[:-1]], 1).astype(">u8").view(np.uint8)
        ends = np.concatenate([[0], np.cumsum((letters != 0).sum(1))]).astype(np.int32)
        terms = pa.StringArray.from_buffers(begin.size, pa.py_buffer(ends), pa.py_buffer(letters[letters != 0]))
        yield columns[-1][begin].astype(np.int64), terms, n, docs
    buckets: dict[int, list] = {}
    raw = data.tobytes()
    for k in np.flatnonzero(size > 16).tolist():
        buckets.setdefault(int(size[k]).bit_length(), []).append((int(group[doc[k]]), raw[at[k] : at[k] + size[k]], int(doc[k])))
    for bucket in buckets.values():
        bucket.sort()
        groups, terms, owners = (np.array(c, object if i == 1 else np.int64) for i, c in enumerate(zip(*bucket)))
        begin, n, docs = _runs([groups, terms], owners)
        yield groups[begin], pa.array([t.decode() for t in terms[begin]], pa.string()), n, docs


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of terms by group for batches of (lang, source, text), no column null."""
    held: list[pa.RecordBatch] = []
    volume = 0
    for batch in batches:
        held.append(batch)
        volume += batch.column(2).nbytes
        if volume >= CHUNK_BYTES:
            yield from _count_held(held)
            held, volume = [], 0
    yield from _count_held(held)


def _count_held(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: dict[tuple[str, str], int] = {}
    groups = [
        names.setdefault(pair, len(names)) for b in batches for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
    ]
    if not groups:
        return
    texts = [_bytes_of(b.column(2)) for b in batches]
    sizes = np.concatenate([s for _, s in texts])
    starts = np.cumsum(sizes) - sizes
    owners = pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.string())
    for group, terms, n, docs in count_chunk(np.concatenate([d for d, _ in texts]), starts, np.array(groups, np.int64)):
        taken = [o.take(pa.array(group)) for o in owners]
        yield pa.RecordBatch.from_arrays([*taken, terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], schema=COUNTS_ARROW)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the size of each."""
    texts = texts.cast(pa.large_string())
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], np.diff(ends)


def share_of(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)) by long division, 1000 at a time."""
    parts = F.greatest(n + 2 * v, F.lit(1).cast("long"))
    left, share = count + 2, F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        share = share * 1000 + _whole(left * 1000, parts)
        left = (left * 1000) % parts
    return share + 1


def _whole(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def difference(p: Column, q: Column) -> Column:
    return _whole((p - q) * (p - q), p + q)


def _square(cells: pa.Table) -> pa.Table:
    """Sums of differences over one block of terms for the pairs of two tiles of sources of a language.

    Rows (source number ``s``, term, share, whole): a term of the source with its share; or no term, the share of
    absent terms, and the number of kept terms in the block.
    """
    source, share, whole = (cells.column(c).to_numpy() for c in ("s", "p", "whole"))
    term = cells.column("term").combine_chunks().dictionary_encode()
    code = term.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    base = code < 0
    sources, absent = source[base], share[base]
    place = np.argsort(sources)
    sources, absent = sources[place], absent[place]
    table = np.repeat(absent[:, None], len(term.dictionary), 1)
    table[np.searchsorted(sources, source[~base]), code[~base]] = share[~base]
    others = int(whole[base].max()) - table.shape[1]
    first, second = cells.column("ta")[0].as_py(), cells.column("tb")[0].as_py()
    a, b, value = [], [], []
    inside = sources // TILE == second
    for k in np.flatnonzero(sources // TILE == first):
        partners = np.flatnonzero(inside & (sources > sources[k]))
        if partners.size:
            f = (table[partners] - table[k]) ** 2 // (table[partners] + table[k])
            rest = (absent[partners] - absent[k]) ** 2 // (absent[partners] + absent[k])
            a.append(np.full(partners.size, sources[k]))
            b.append(sources[partners])
            value.append(f.sum(1) + rest * others)
    found = [np.concatenate(x) if x else np.array([], np.int64) for x in (a, b, value)]
    langs = pa.array([cells.column("lang")[0].as_py()] * len(found[0]), pa.string())
    return pa.table([langs, *(pa.array(x, pa.int64()) for x in found)], names=["lang", "a", "b", "value"])


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and documents that have it."""
    text_batches(docs.sparkSession)
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (lang_col, source_col, text_col)]
    partial = docs.select(*plain).mapInArrow(count_terms, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the other sources of the language by their
    divergence, part ``term`` the terms that set a source off from its language."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    counts = written(term_counts(docs, lang_col, source_col, text_col))
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
    kept = written(kept.where(F.col("docs") >= min_docs).drop("docs"))
    cells = written(counts.drop("docs").join(broadcast_if_small(kept), ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("lang_n"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = docs.select(*names).distinct().join(langs, "lang", "left").join(sizes, ["lang", "source"], "left")
    groups = written(row_numbers(groups.na.fill(0, ["v", "lang_n", "group_n"]), ["lang"], ["source"], "s"))
    shares = cells.join(broadcast_if_small(groups), ["lang", "source"])
    shares = shares.withColumn("p", share_of(F.col("n"), F.col("group_n"), F.col("v")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(shares, kept, groups).withColumn("rank", F.row_number().over(ranked))
    apart = shares.withColumn("q", share_of(F.col("all_n"), F.col("lang_n"), F.col("v"))).where("p > q")
    apart = apart.select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    terms = apart.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns)
    )


def _pairs(shares: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of sources of a language, summed up square by square."""
    blocks = F.greatest(F.ceil(F.max("v") / BLOCK_TERMS), F.lit(1))
    block_of = F.pmod(F.xxhash64("term"), F.col("blocks"))
    sides = groups.groupBy("lang").agg(F.max("s").alias("sources"), blocks.alias("blocks"))
    sides = broadcast_if_small(written(sides))
    whole = kept.join(sides, "lang").groupBy("lang", block_of.alias("block")).agg(F.count("*").alias("whole"))
    filled = shares.join(sides, "lang").select(
        "lang", "sources", (F.col("s") - 1).alias("s"), block_of.alias("block"), "term", "p", F.lit(0).cast("long").alias("whole")
    )
    bases = groups.join(sides, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    bases = bases.join(broadcast_if_small(written(whole)), ["lang", "block"], "left").select(
        "lang", "sources", (F.col("s") - 1).alias("s"), "block", F.lit(None).cast("string").alias("term"),
        share_of(F.lit(0).cast("long"), F.col("group_n"), F.col("v")).alias("p"), F.coalesce("whole", F.lit(0)).alias("whole"),
    )
    tile, tiles = F.floor(F.col("s") / TILE), F.floor((F.col("sources") - 1) / TILE)
    met = filled.unionByName(bases).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles)))
    met = met.select(
        "lang", "block", F.least(tile, "other").alias("ta"), F.greatest(tile, "other").alias("tb"), "s", "term", "p", "whole"
    )
    squares = met.groupBy("lang", "block", "ta", "tb").applyInArrow(_square, "lang string, a bigint, b bigint, value bigint")
    sums = squares.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ends = F.array(F.struct(F.col("a").alias("s"), F.col("b").alias("t")), F.struct(F.col("b").alias("s"), F.col("a").alias("t")))
    sides_of = broadcast_if_small(groups.select("lang", (F.col("s") - 1).alias("s"), "source"))
    both = sums.select("lang", "value", F.explode(ends).alias("e")).select("lang", "value", "e.s", "e.t")
    named = both.join(sides_of, ["lang", "s"]).withColumnRenamed("t", "o")
    others = sides_of.select("lang", F.col("s").alias("o"), F.col("source").alias("item"))
    return named.join(others, ["lang", "o"]).select("lang", "source", "item", "value")

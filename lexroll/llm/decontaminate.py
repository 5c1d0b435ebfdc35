"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with documents.

A window is ``window`` consecutive words of an item, or the whole of a shorter one.  As a set it is its
shingles of ``shingle`` words.  The shingles of all windows are ordered by how often the documents hold them.
A document that contains a window whole holds all of its shingles, so it holds the rarest: with containment
one, the necessary prefix is one shingle long.  Only that one is looked up.  A match bounds the window's place
in the document: shingles before it need as many words before the match, those after it as many behind it
(position and length bounds).  Within these bounds the item-sized run of words is compared with the window.

Documents are read twice without a shuffle, once to count the benchmark's shingles and once to match them.
Only tables that depend on the benchmark are sent to the executors.  A benchmark of over ``slice_words`` words
is matched slice by slice, and what the slices find is added up for each distinct text.

Words are runs of digits, letters a-z after lower-casing A-Z, and all characters beyond ASCII.

Defined cases: null or empty texts have no words and no hits; items without words have no windows.  An item
id that occurs on several rows is one item; a window of an item without an id hits, but names no item.
Repeated rows are judged alike.  Empty tables give no hits.  Other columns are ignored or kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from lexroll.llm.common import per_text, share, shared, text_batches
from lexroll.operators.lineage import written
from lexroll.operators.skew import join_to_keys

WINDOW = 10
SHINGLE = 5
# Words of the benchmark that one slice may hold: a bound on what is broadcast (about 100 bytes a word).
SLICE_WORDS = 2_000_000

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
FOUND = "struct<n_words: bigint, spans: array<struct<at: bigint, end: bigint>>, items: array<string>>"


def words_of(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())


class Windows:
    """The windows of a slice of the benchmark, found by hashes of their shingles."""

    def __init__(self, items: list[tuple[Any, str | None]], window: int = WINDOW, shingle: int = SHINGLE) -> None:
        self.shingle = shingle
        self.names: list[str | None] = []
        places: dict[tuple[bytes, ...], set[int]] = {}
        for name, text in items:
            words = words_of(text)
            self.names.append(None if name is None else str(name))
            for at in range(max(1, len(words) - window + 1) if words else 0):
                places.setdefault(tuple(words[at : at + window]), set()).add(len(self.names) - 1)
        self.windows = list(places)
        self.owners = [sorted(p) for p in places.values()]
        # shingle length -> sorted hashes of the shingles of windows
        self.lengths = sorted({min(shingle, len(w)) for w in self.windows})
        self.known: dict[int, np.ndarray] = {}
        for length in self.lengths:
            own = [self.rolled(self.hashed(list(w)), length) for w in self.windows if min(shingle, len(w)) == length]
            self.known[length] = np.unique(np.concatenate(own))
        self.filters = {length: _filter(known) for length, known in self.known.items()}
        self.prefixes: dict[int, dict[int, list[tuple[int, int]]]] = {}

    @staticmethod
    def hashed(words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)

    @staticmethod
    def rolled(words: np.ndarray, length: int) -> np.ndarray:
        """Hashes of all runs of ``length`` words."""
        n = len(words) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = words[:n].copy()
        for i in range(1, length):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
            out += words[i : i + n]
        return out * np.uint64(0xD6E8FEB86659FD93)

    def hits(self, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the benchmark's shingles of this length among ``words``, and their hashes."""
        hashes = self.rolled(words, length)
        bits = self.filters[length]
        maybe = np.flatnonzero(bits[hashes >> np.uint64(64 - _log(bits))])
        if not len(maybe):
            return maybe, hashes[:0]
        known = self.known[length]
        found = hashes[maybe]
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        same = known[at] == found
        return maybe[same], found[same]

    def count(self, texts: Iterator[str | None]) -> dict[tuple[int, int], int]:
        total: dict[tuple[int, int], int] = {}
        for text in texts:
            words = self.hashed(words_of(text))
            for length in self.lengths:
                found, times = np.unique(self.hits(words, length)[1], return_counts=True)
                for h, n in zip(found.tolist(), times.tolist()):
                    total[length, h] = total.get((length, h), 0) + n
        return total

    def set_prefixes(self, counts: dict[tuple[int, int], int]) -> None:
        """Choose the rarest shingle of each window; equal ones by their hash."""
        for number, window in enumerate(self.windows):
            length = min(self.shingle, len(window))
            hashes = self.rolled(self.hashed(list(window)), length).tolist()
            _, first, offset = min((counts.get((length, h), 0), h, i) for i, h in enumerate(hashes))
            self.prefixes.setdefault(length, {}).setdefault(first, []).append((number, offset))
        self.known = {n: np.array(sorted(p), np.uint64) for n, p in self.prefixes.items()}
        self.filters = {length: _filter(known) for length, known in self.known.items()}

    def find(self, text: str | None) -> dict:
        """Number of words, spans of hit words and names of the items found in one whole text."""
        words = words_of(text)
        hashes = self.hashed(words)
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for length in self.lengths:
            places, found = self.hits(hashes, length)
            for at, h in zip(places.tolist(), found.tolist()):
                for number, offset in self.prefixes[length][h]:
                    window = self.windows[number]
                    start = at - offset
                    if start < 0 or start + len(window) > len(words):
                        continue
                    if tuple(words[start : start + len(window)]) == window:
                        spans.append((start, start + len(window)))
                        items.update(self.owners[number])
        names = sorted({self.names[i] for i in items if self.names[i] is not None})
        return {"n_words": len(words), "spans": [{"at": a, "end": b} for a, b in union_of(spans)], "items": names}


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _log(bits: np.ndarray) -> int:
    return len(bits).bit_length() - 1


def _filter(known: np.ndarray) -> np.ndarray:
    """A table of the hashes' leading bits, some sixteen places for each."""
    log = max(10, min(26, (16 * len(known)).bit_length()))
    bits = np.zeros(1 << log, bool)
    bits[known >> np.uint64(64 - log)] = True
    return bits


def windows_of(
    benchmark: DataFrame, docs: DataFrame, item_col: str, text_col: str, doc_text: str, slice_words: int
) -> list[Broadcast]:
    """The windows with their prefixes, in slices of bounded size; one slice for a benchmark of usual size."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    # A word and its separator take two bytes at least.
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-size // (2 * slice_words)))
    out = []
    for i in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == i)
        windows = Windows([(r["item"], r["text"]) for r in part.collect()])
        if not windows.windows:
            continue
        counting = share(spark, windows)
        counts = docs.select(F.col(doc_text).alias("text")).mapInArrow(_counter(counting), "length int, hash decimal(20,0), n long")
        totals = counts.groupBy("length", "hash").agg(F.sum("n").alias("n")).collect()  # a row a shingle of the slice
        windows.set_prefixes({(r["length"], int(r["hash"])): r["n"] for r in totals})
        out.append(share(spark, windows))
        counting.unpersist()
    return out


def _counter(windows: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(Windows, windows)
        total = own.count(t.as_py() for batch in batches for t in batch.column(0))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int32()),
                pa.array([k[1] for k in keys], pa.decimal128(20, 0)),
                pa.array(total.values(), pa.int64()),
            ],
            names=["length", "hash", "n"],
        )

    return run


def found_in(text: Column, slices: list[Broadcast]) -> Column:
    """What the windows of a single slice find in a text."""
    if not slices:
        return per_text(lambda t: {"n_words": len(words_of(t)), "spans": [], "items": []}, FOUND)(text)
    (windows,) = slices
    return per_text(lambda t: shared(Windows, windows).find(t), FOUND)(text)


def _with_found(docs: DataFrame, text_col: str, slices: list[Broadcast]) -> DataFrame:
    """(row, found) for every row of ``docs``."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    if len(slices) <= 1:
        return rows.withColumn("found", found_in(F.col("text"), slices))
    # The texts hit in any slice, each once, with all that was found in it.
    keyed = docs.select(F.col(text_col).alias("text")).withColumn("digest", F.sha2("text", 256))
    parts = None
    for one in slices:
        hit = keyed.select("digest", found_in(F.col("text"), [one]).alias("found")).where(F.size("found.items") + F.size("found.spans") > 0)
        parts = hit if parts is None else parts.unionByName(hit)
    pieces = written(parts)
    sizes = pieces.groupBy("digest").agg(F.count("*").alias("rows"))
    once = pieces.dropDuplicates(["digest", "found"])
    merged = once.groupBy("digest").agg(
        F.first("found.n_words").alias("n_words"), F.flatten(F.collect_list("found.spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found.items")))).alias("items"),
    )
    joined_spans = per_text(lambda s: [{"at": a, "end": b} for a, b in union_of([(x["at"], x["end"]) for x in s])], "array<struct<at: bigint, end: bigint>>")
    facts = written(
        merged.join(sizes, "digest").select("digest", "rows", F.struct("n_words", joined_spans(F.col("spans")).alias("spans"), "items").alias("hit"))
    )
    none = per_text(lambda t: {"n_words": len(words_of(t)), "spans": [], "items": []}, FOUND)
    marked = rows.withColumn("digest", F.sha2("text", 256))
    return join_to_keys(marked, facts, "digest", "rows").select(
        "row", "text", F.coalesce("hit", none(F.col("text"))).alias("found")
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans) for every row."""
    text_batches(docs.sparkSession)
    slices = windows_of(benchmark, docs, item_col, item_text, text_col, slice_words)
    lean = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = _with_found(lean, "text", slices).select("row.doc_id", "found.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["at"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
        "items", "spans",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    text_batches(docs.sparkSession)
    slices = windows_of(benchmark, docs, item_col, item_text, text_col, slice_words)
    return _with_found(docs, text_col, slices).where(F.size("found.spans") == 0).select("row.*")

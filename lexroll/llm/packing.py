"""Lexical retrieval packing: sequences of a fixed size, filled with documents that share words with one another.

A document is its token ids and an end id.  Full windows of a long document are sequences of their own; what is
left of it, under one window, is a fragment.  Fragments are dealt evenly over the tasks, whatever their language
or source, and lie sorted by ``near`` columns there, so that neighbours have much in common.  A task takes them
shard by shard (``SHARD_TOKENS``).  Each shard has an inverted index of its fragments, weighted after BM25.
The first unused fragment is the seed of a sequence; the index ranks the unused others by the seed's ids, and in
this order those that still fit go in whole.  When none fits, the best of the others is cut: its head fills the
sequence and its rest is the next seed.  What a shard leaves over, less than a window, goes on to the next shard; the
task's last rest is cut into sequences whose lengths are powers of two, which need no padding.

Encoding: texts of plain letters, digits and marks are split and folded here as the tokenizer does, its model spells the
words, and their ids are kept.  Other texts are cut at blanks; a run that is not plain goes to the tokenizer whole.
White space is never part of a token, and no mark composes with it, so runs are independent.  Special tokens' strings in a text are those tokens, as the library has it.

Defined cases: a null text counts as empty; such a document is one end id.  Null ids are kept, repeated rows are packed
each.  Ties in the ranking go by place in the shard, which is fixed by ``near`` columns, ids and tokens.  Texts may have
any length.  An empty table gives no pieces.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from lexroll.llm.bpe import byte_letters
from lexroll.llm.common import PLAIN_LETTERS, Kept, per_text, share, shared, text_batches

WINDOW = 4096
END = (2).to_bytes(4, "little")  # the id after each document
SHARD_TOKENS = 1 << 19  # tokens that one index holds
SHARD_BYTES = 2 * 1024 * 1024  # of text, about the same
TASK_BYTES = 128 * 1024 * 1024  # of text, dealt to one task at most, about
K1, B = 1.2, 0.75
KEPT_WORDS = 400_000
KEPT_RUNS = 50_000

# Fixed: how the vocabulary's library splits folded text.
BLANKS = re.compile("[ \t\n\r]+")
ODD = re.compile(f"[^{PLAIN_LETTERS} \t\n\r]")
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class WordEncoder:
    """Ids of a tokenizer file whose tokens hold no white space; the tokenizer is opened in the task."""

    def __init__(self, model: str) -> None:
        from tokenizers import Tokenizer

        self.model = model
        self.narrow = Tokenizer.from_str(model).get_vocab_size() <= 1 << 16
        self.library = None

    def open(self) -> None:
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.model)
        library.no_truncation()
        library.no_padding()
        self.marks = [t.content for t in library.get_added_tokens_decoder().values()]
        self.letters = {b: c for c, b in byte_letters().items()}
        self.spell = library.model.tokenize
        self.library = library
        self.words = Kept(self._word, KEPT_WORDS)
        self.runs = Kept(self._run, KEPT_RUNS)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, four bytes each, the least first."""
        if self.library is None:
            self.open()
        if ODD.search(text) or any(mark in text for mark in self.marks):
            return b"".join(map(self.runs.__getitem__, BLANKS.split(text)))
        return b"".join(map(self.words.__getitem__, WORD.findall(text.lower())))

    def _run(self, run: str) -> bytes:
        if ODD.search(run) or any(mark in run for mark in self.marks):
            return _four(self.library.encode(run, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, WORD.findall(run.lower())))

    def _word(self, word: str) -> bytes:
        return _four([t.id for t in self.spell(word.encode().decode("latin-1").translate(self.letters))])

    def cut(self, text: str | None) -> dict:
        """Number of ids with the end id, checks of the full windows, and the ids after these."""
        ids = self.encode(text or "") + END
        full = len(ids) // (4 * WINDOW)
        checks = [zlib.crc32(ids[4 * WINDOW * k : 4 * WINDOW * (k + 1)]) for k in range(full)]
        return {"doc_tokens": len(ids) // 4, "windows": checks, "tail": _narrow(ids[4 * WINDOW * full :], self.narrow)}


def _four(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _narrow(ids: bytes, narrow: bool) -> bytes:
    """Two bytes an id are shuffled where the vocabulary allows it."""
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if narrow else ids


class Index:
    """Postings of the ids of fragments, weighted after BM25."""

    def __init__(self, fragments: list[np.ndarray]) -> None:
        sizes = np.array([f.size for f in fragments], np.int64)
        ids = np.concatenate(fragments).astype(np.int64)
        owner = np.repeat(np.arange(len(fragments)), sizes)
        posting, often = np.unique(ids << 32 | owner, return_counts=True)
        self.owner = posting & 0xFFFFFFFF
        self.ids, self.first, self.spread = np.unique(posting >> 32, return_index=True, return_counts=True)
        rarity = np.log(1 + (len(fragments) - self.spread + 0.5) / (self.spread + 0.5))
        slack = K1 * (1 - B + B * sizes / sizes.mean())
        self.weight = np.repeat(rarity, self.spread) * often * (K1 + 1) / (often + slack[self.owner])
        self.count = len(fragments)

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 of every fragment for the distinct ids of ``query``."""
        slots = np.searchsorted(self.ids, np.unique(query))
        first, spread = self.first[slots], self.spread[slots]
        ends = np.cumsum(spread)
        at = np.repeat(first - (ends - spread), spread) + np.arange(ends[-1])
        return np.bincount(self.owner[at], self.weight[at], self.count)


def fill(fragments: list[np.ndarray], window: int = WINDOW) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Full sequences of (fragment, from, to), and the parts left over, less than a window.  All fragments are shorter."""
    sizes = np.array([f.size for f in fragments], np.int64)
    if sizes.sum() < window:
        return [], [(k, 0, int(n)) for k, n in enumerate(sizes)]
    index = Index(fragments)
    begin, unused = np.zeros(sizes.size, np.int64), np.ones(sizes.size, bool)
    full: list[list[tuple[int, int, int]]] = []
    total, seed, lowest = int(sizes.sum()), 0, 0
    while total >= window:
        if not unused[seed]:
            lowest += int(np.argmax(unused[lowest:]))
            seed = lowest
        parts = [(seed, int(begin[seed]), int(sizes[seed]))]
        room = window - int(sizes[seed] - begin[seed])
        unused[seed] = False
        others = np.flatnonzero(unused)
        others = others[np.argsort(-index.scores(fragments[seed])[others], kind="stable")]
        lengths = (sizes - begin)[others]
        skipped, k = -1, 0
        while room:
            fitting = lengths[k:] <= room
            step = int(np.argmax(fitting)) if fitting.size else 0
            if not fitting.size or not fitting[step]:
                break
            if step and skipped < 0:
                skipped = k
            k += step
            other = int(others[k])
            parts.append((other, int(begin[other]), int(sizes[other])))
            unused[other] = False
            room -= int(lengths[k])
            k += 1
        if room:
            seed = int(others[skipped if skipped >= 0 else k])
            parts.append((seed, int(begin[seed]), int(begin[seed]) + room))
            begin[seed] += room
        full.append(parts)
        total -= window
    return full, [(int(k), int(begin[k]), int(sizes[k])) for k in np.flatnonzero(unused)]


def powers(parts: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The same parts as sequences whose lengths are falling powers of two."""
    total = sum(to - start for _, start, to in parts)
    out, waiting = [], parts[::-1]
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            room, sequence = 1 << bit, []
            while room:
                k, start, to = waiting.pop()
                stop = min(to, start + room)
                sequence.append((k, start, stop))
                room -= stop - start
                if stop < to:
                    waiting.append((k, stop, to))
            out.append(sequence)
    return out


def _packer(encoder: Broadcast, schema: pa.Schema, window: int, shard_tokens: int):
    """For rows (doc_id, doc_tokens, windows, tail) in their order, the pieces of all sequences of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        kind = "<u2" if shared(WordEncoder, encoder).narrow else "<u4"
        # Fragments: (doc_id, doc_tokens, place of the first id in the document, ids).
        held: list[tuple] = []
        volume = 0

        def pieces(sequences) -> pa.RecordBatch:
            nonlocal number
            rows = []
            for sequence in sequences:
                offset = 0
                for k, start, to in sequence:
                    doc, tokens, first, ids = held[k]
                    rows.append((doc, first + start, to - start, zlib.crc32(ids[start:to]), tokens, number, offset))
                    offset += to - start
                number += 1
            return _batch(rows, schema)

        for batch in batches:
            rows = []
            for doc, tokens, checks, tail in zip(*(batch.column(k).to_pylist() for k in range(4))):
                for k, check in enumerate(checks):
                    rows.append((doc, k * window, window, check, tokens, number, 0))
                    number += 1
                ids = np.frombuffer(tail, kind).astype("<u4")
                if ids.size:
                    held.append((doc, tokens, len(checks) * window, ids))
                    volume += ids.size
                if volume >= shard_tokens:
                    full, left = fill([h[3] for h in held], window)
                    yield pieces(full)
                    held = [(*held[k][:2], held[k][2] + start, held[k][3][start:to]) for k, start, to in left]
                    volume = sum(h[3].size for h in held)
            yield _batch(rows, schema)
        full, left = fill([h[3] for h in held], window) if held else ([], [])
        yield pieces(full + powers(left))

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def load(spark: SparkSession, path: str) -> Broadcast:
    """The encoder of a tokenizer file, sent to the executors; its size is the vocabulary's."""
    with open(path, encoding="utf-8") as file:
        return share(spark, WordEncoder(file.read()))


def pack(
    docs: DataFrame, encoder: Broadcast, id_col: str = "doc_id", text_col: str = "text", near: tuple[str, ...] = ("lang", "source"),
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of all sequences.

    Tokens are shuffled once and meet in tasks of even size.  Rows lie in an order fixed by what they hold, so a lost
    task gives the same pieces again.
    """
    spark = docs.sparkSession
    text_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text_col)), F.count("*")).first()
    volume = (size[0] or 0) + 4 * size[1]
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, math.ceil(volume / TASK_BYTES), min(usual, math.ceil(volume / SHARD_BYTES)))
    kind = "struct<doc_tokens: bigint, windows: array<bigint>, tail: binary>"
    cut = per_text(lambda t: shared(WordEncoder, encoder).cut(t), kind)
    keys = [F.col(c).cast("string").alias(f"near_{k}") for k, c in enumerate(near)]
    rows = docs.select(F.col(id_col).alias("doc_id"), *keys, cut(F.col(text_col)).alias("c")).select(
        "doc_id", *[f"near_{k}" for k in range(len(near))], "c.*"
    )
    order = [f"near_{k}" for k in range(len(near))] + ["mix", "doc_id", "doc_tokens", "windows", "tail"]
    dealt = rows.repartition(tasks).withColumn("mix", F.xxhash64("doc_id", "tail")).sortWithinPartitions(*order)
    numbers = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType)] + [StructField(n, LongType()) for n in numbers])
    pack_rows = _packer(encoder, to_arrow_schema(schema), WINDOW, shard_tokens)
    return dealt.select("doc_id", "doc_tokens", "windows", "tail").mapInArrow(pack_rows, schema)

"""Packing: every id in one piece, no padding, and the neighbours that BM25 ranks first."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from lexroll.llm import packing
from tests.llm.test_alignment import ODD

FILE = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


def check_pieces(rows, ids, window=packing.WINDOW):
    """Rows as dictionaries against {doc_id: ids}; the lengths of all sequences."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r["doc_id"]].append(r)
        of_sequence[r["sequence_id"]].append(r)
    assert set(of_doc) == set(ids)
    for doc, pieces in of_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = ids[doc][at : at + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc]) and len(part) == r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids[doc])
    lengths = []
    for pieces in of_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and at.bit_count() == 1  # full, or a power of two
        lengths.append(at)
    return lengths


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = entry.queries()["op11_packing"](spark, FOLDER)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    lengths = check_pieces(rows.collect(), {d: library_ids(library, t) for d, t in texts.items()})
    assert sum(n < packing.WINDOW for n in lengths) <= 12 * len(lengths) / 20 + 12


def test_odd_and_random_texts(library):
    encoder = packing.WordEncoder(open(FILE, encoding="utf-8").read())
    draw = np.random.default_rng(3)
    letters = np.array(list("abcdeABÉé ü  ..,'12\n\tŸß-½語_<|>ΣςİIı́"))
    random = ["".join(draw.choice(letters, draw.integers(1, 60))) for _ in range(3000)]
    for text in [t or "" for t in ODD] + random + ["don't CAN'T they'LL ΟΔΟΣ <|startoftext|>x<|endoftext|>", "x" * 500, "odd \x0b line\tend"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library_ids(library, text)[:-1], text


def brute_fill(fragments, window):
    """The rule in plain Python: BM25 by its formula, first-fit in ranked order, the best of the rest is cut."""
    count, mean = len(fragments), sum(map(len, fragments)) / len(fragments)
    spread = Counter(t for f in fragments for t in set(f))
    bags = [Counter(f) for f in fragments]

    def score(query, k):
        slack = packing.K1 * (1 - packing.B + packing.B * len(fragments[k]) / mean)
        return sum(
            math.log(1 + (count - spread[t] + 0.5) / (spread[t] + 0.5)) * bags[k][t] * (packing.K1 + 1) / (bags[k][t] + slack)
            for t in sorted(set(query)) if bags[k][t]
        )

    left = {k: (0, len(f)) for k, f in enumerate(fragments)}
    full, seed = [], None
    while sum(b - a for a, b in left.values()) >= window:
        seed = seed if seed in left else min(left)
        parts = [(seed, *left.pop(seed))]
        room = window - (parts[0][2] - parts[0][1])
        ranked = sorted(left, key=lambda k: (-round(score(fragments[seed], k), 9), k))
        for k in ranked:
            if left[k][1] - left[k][0] <= room:
                parts.append((k, *left.pop(k)))
                room -= parts[-1][2] - parts[-1][1]
        if room:
            seed = next(k for k in ranked if k in left)
            a, b = left[seed]
            parts.append((seed, a, a + room))
            left[seed] = (a + room, b)
        full.append(parts)
    return full, [(k, *left[k]) for k in sorted(left)]


def test_neighbours_by_brute_force():
    draw = np.random.default_rng(8)
    for _ in range(30):
        fragments = [
            (draw.integers(0, 12, draw.integers(1, 60)) + 9 * draw.integers(0, 4)).astype("<u4") for _ in range(draw.integers(1, 40))
        ]
        assert packing.fill(fragments, 64) == brute_fill([f.tolist() for f in fragments], 64)


def test_powers_of_two():
    for total in range(1, 70):
        parts = [(k, 3, 3 + n) for k, n in enumerate((total // 2, total - total // 2)) if n]
        cut = packing.powers(parts)
        lengths = [sum(b - a for _, a, b in s) for s in cut]
        assert sum(lengths) == total and lengths == sorted(set(lengths), reverse=True) and all(n.bit_count() == 1 for n in lengths)
        flat = [(k, x) for s in cut for k, a, b in s for x in range(a, b)]
        assert flat == [(k, x) for k, a, b in parts for x in range(a, b)]


def test_tables_of_other_shapes(spark, library, odd_documents, no_documents):
    encoder = packing.load(spark, FILE)
    assert packing.pack(no_documents, encoder).count() == 0
    docs = odd_documents.withColumn("windows", odd_documents.text).withColumn("mix", odd_documents.text)
    rows = [r.asDict() for r in packing.pack(docs, encoder).collect()]
    assert sum(r["length"] for r in rows) == sum(len(library_ids(library, r["text"])) for r in docs.collect())
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    unlike = packing.pack(docs.select("doc_id", "text"), encoder, near=()).collect()
    assert sum(r["length"] for r in unlike) == sum(r["length"] for r in rows)


def test_long_documents_and_many_copies(spark, library):
    texts = {i: "copy of the same words " * 20 for i in range(300)} | {1000: "one two three four " * 3000, 1001: "", 1002: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    encoder = packing.load(spark, FILE)
    one = packing.pack(docs, encoder, near=(), shard_tokens=10_000)
    check_pieces([r.asDict() for r in one.collect()], {d: library_ids(library, t) for d, t in texts.items()})
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, packing.pack(docs, encoder, near=(), shard_tokens=10_000).collect()))

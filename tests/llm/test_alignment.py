"""Alignment of two tokenizers against the libraries and a plain reading of the definitions."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from lexroll.llm import alignment
from lexroll.llm.bpe import byte_letters

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


@pytest.fixture(scope="module")
def aligner(spark):
    return alignment.load(spark, *FILES)


def brute_tokens(text, libraries):
    """(id, bytes) of both sides, or nothing where bytes get lost."""
    first, second = libraries
    letters = byte_letters()
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if text and all(b"".join(t for _, t in x) == whole for x in (a, b)) else ([], [])


def brute_groups(a, b):
    groups, ends = [], [set(np.cumsum([len(t) for _, t in x]).tolist()) for x in (a, b)]
    both = sorted(ends[0] & ends[1])
    sides = []
    for tokens in (a, b):
        parts, end = {e: [] for e in both}, 0
        for i, t in tokens:
            end += len(t)
            parts[next(e for e in both if e >= end)].append(i)
        sides.append(parts)
    for e in both:
        groups.append((sides[0][e], sides[1][e]))
    return groups


def brute(texts, libraries):
    rows = []
    for text in texts:
        a, b = brute_tokens(text or "", libraries)
        rows.append((len(a), len(b), brute_groups(a, b)))
    links = [Counter((x, y) for left, right in groups for x in left for y in right) for _, _, groups in rows]
    count = Counter(pair for found in links for pair in found)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (n_a, n_b, groups), found in zip(rows, links):
        said = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append((
            n_a, n_b, len(groups), sum(found.values()), sum(t for p, t in found.items() if count[p] == most[p[0]]),
            sum(t * count[p] for p, t in found.items()), hashlib.sha256(said.encode()).hexdigest() if groups else "",
        ))
    return out


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a   b\n\n c", "a\n b", "a \nb", "tab\tb  \t c", "<|endoftext|> and <s>x</s><unk>",
    "▁x y", "x ▁", "Über naïve café ½ ²", "日本語のテキスト と english", "é áb", "\x1c new \x85 line", "a b", "👍🏽 ok 👍",
    "  x", "don't I'll he's", "a" * 300, "----" * 50 + "====" * 9, "zzz qqq" * 40, "\x00 nul\x00", "İstanbul ǅ ß", "1234567 89½",
    "same words same words", "same words same words", "﻿bom", "a​b", "‘q’ “r” — …", "\n", "x\n", "\nx", "x \n", "x\r\ny",
]


def test_odd_texts_as_the_libraries_have_them(spark, aligner, libraries):
    rows = [(i, t, "x") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string")
    got = [tuple(r)[1:] for r in alignment.alignment(docs, aligner).orderBy("doc_id").collect()]
    assert got == brute(ODD, libraries)
    few = [tuple(r)[1:] for r in alignment.alignment(docs, aligner, pair_rows=5).orderBy("doc_id").collect()]
    assert few == got  # the shuffle for pairs beyond the bound


def test_random_texts(spark, aligner, libraries):
    draw = np.random.default_rng(5)
    letters = np.array(list("abcdeABé ü  ..,'1\n\t▁-½語"))
    texts = ["".join(draw.choice(letters, draw.integers(1, 60))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in alignment.alignment(docs, aligner).orderBy("doc_id").collect()]
    assert got == brute(texts, libraries)


def test_query(spark, libraries):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    found = entry.queries()["op12_alignment"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = [tuple(r) for r in found.orderBy("doc_id").collect()]
    assert got == [(d["doc_id"], *r) for d, r in zip(docs, brute([d["text"] for d in docs], libraries))]


def test_large_groups_and_few_kept_windows(libraries, monkeypatch):
    """Groups whose pairs are added up, and windows forgotten again and again, change nothing."""
    texts = [t for t in ODD if t] + ["=" * 37 + "x" * 41 + "日本" * 9, "a b c d e f", "b c"]
    whole = alignment.Aligner(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())
    listed = lambda found: [{k: v if isinstance(v, (int, str)) else list(v) for k, v in r.items()} for r in found]
    wanted = listed(whole.align(texts))
    monkeypatch.setattr(alignment, "MANY_LINKS", 2)
    monkeypatch.setattr(alignment, "KEPT_WINDOWS", 5)
    monkeypatch.setattr(alignment, "KEPT_RUNS", 3)
    small = alignment.Aligner(whole.first, whole.second)
    assert listed([r for t in texts for r in small.align([t])]) == listed(small.align(texts)) == wanted


def test_tables_of_other_shapes(spark, aligner, odd_documents, no_documents):
    assert alignment.alignment(no_documents, aligner).count() == 0
    assert alignment.alignment(odd_documents, aligner).count() == odd_documents.count()

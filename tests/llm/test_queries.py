"""Queries that SQL cannot express, on the smallest tables, against brute force and libraries."""

import hashlib
import html
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import __spark_entry__ as entry
from lexroll.llm import token_counts
from tests.llm.test_pairs import brute_components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rows(spark, name):
    return entry.queries()[name](spark, FOLDER).collect()


def test_token_counts(spark, texts):
    pieces, byte_pieces = token_counts.pieces_of(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_pieces))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.BLANK, prepend_scheme="always", split=True)
    got = {r["doc_id"]: r["n_tokens"] for r in rows(spark, "op4_token_counts")}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_bpe(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows(spark, "op8_bpe"):
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert tuple(r)[1:] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_near_duplicates(spark, texts):
    listed = sorted(texts.items())
    marks, least, _ = brute_components(listed)
    got = sorted(map(tuple, rows(spark, "op10_near_duplicates")))
    assert got == [(i, f"{m:016x}", c) for (i, _), m, c in zip(listed, marks, least)]


def test_main_text(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = rows(spark, "op7_main_text")
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", pages[r["page_id"]], re.S)[1]
        plain = re.sub(r"<[a-z/][^>]*>", " ", re.sub(r"</?b>", "", article))
        assert r["text"] == " ".join(html.unescape(plain).split()) and r["n_chars"] == len(r["text"])


def test_transcripts(spark):
    got = rows(spark, "op3_transcripts")
    turns = {}
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append(r["role"])
    assert len(got) == len(turns)
    assert sum(r["n_right"] for r in got) > 0.9 * sum(r["n_lines"] for r in got)
    assert sum(r["roles"].split(",") == turns[r["conv_id"]] for r in got) > 0.6 * len(got)


def test_quality(spark, texts):
    got = rows(spark, "op2_quality_classifier")
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)

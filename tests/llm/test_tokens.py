import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from lexroll.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = st.one_of(
    st.text(max_size=60), st.text("ab eErt'sll\n\t<|endoftext>1²_", max_size=80),
    st.sampled_from(["a", "=", " ", "ha", "<|endoftext|>", "\n "]).flatmap(lambda x: st.integers(1, 300).map(lambda n: x * n)),
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def automaton():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Automaton(file.read())


def test_bpe_is_the_librarys(library, automaton):
    @settings(max_examples=600, deadline=None)
    @given(TEXTS)
    def same(text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text) == ids
        assert automaton.decode(ids) == library.decode(ids, skip_special_tokens=False) == text

    same()


def test_table_begun_anew(library, automaton, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 7)
    for text in ("unbelievably long-winded antidisestablishmentarianism", "x1" * 90, "naïve Übergröße" * 3):
        assert automaton.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_decode_of_any_ids(library, automaton):
    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(0, 50_256), max_size=20))
    def same(ids):
        assert automaton.decode(ids) == library.decode(ids, skip_special_tokens=False)

    same()


def test_small_automaton():
    """Against the merges applied one after another, leftmost first."""
    letters = {v: k for k, v in bpe.byte_letters().items()}
    merges = [("a", "a"), ("aa", "a"), ("b", "a"), ("a", "b"), ("aa", "ba"), ("ab", "ab")]
    tokens = [letters[b] for b in range(256)] + ["".join(m) for m in merges]
    vocabulary = {t: i for i, t in enumerate(tokens)}
    import json

    own = bpe.Automaton(json.dumps({"added_tokens": [], "model": {"vocab": vocabulary, "merges": merges}}))

    def brute(word):
        parts = list(word)
        while True:
            ranks = [(merges.index((a, b)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in merges]
            if not ranks:
                return [vocabulary[p] for p in parts]
            _, i = min(ranks)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    from itertools import product

    for size in range(9):
        for word in map("".join, product("ab", repeat=size)):
            assert own._word(word.encode()) == own.run([word.encode()])[0].tolist() == brute(word), word


def test_digests(spark, odd_documents, no_documents, library):
    shared = bpe.load(spark, PATH)
    rows = bpe.token_digests(odd_documents, shared).collect()
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    assert len(rows) == 8
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.token_digests(no_documents, shared).count() == 0


def _unigram(pieces, byte_pieces):
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_pieces))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.BLANK, prepend_scheme="always", split=True)
    return library


def test_counts_are_the_librarys():
    pieces, byte_pieces = token_counts.pieces_of(public_tokenizers.path("piece_bpe_32k.model"))
    own, library = token_counts.Unigram(pieces, byte_pieces), _unigram(pieces, byte_pieces)

    @settings(max_examples=500, deadline=None)
    @given(TEXTS)
    def same(text):
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)

    same()


def test_ties_and_unknown_runs():
    pieces = [("<unk>", -5.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0), ("abab", -4.0), ("aba", -3.0)]
    own, library = token_counts.Unigram(pieces, False), _unigram(pieces, False)

    @settings(max_examples=500, deadline=None)
    @given(st.text("abxy ", max_size=20))
    def same(text):
        assert own.count(text) == len(library.encode(text).ids)

    same()


def test_count_odd_rows(spark, odd_documents, no_documents):
    model = token_counts.load(spark, public_tokenizers.path("piece_bpe_32k.model"))
    rows = token_counts.token_counts(odd_documents, model).collect()
    assert len(rows) == 8 and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert token_counts.token_counts(no_documents, model).count() == 0

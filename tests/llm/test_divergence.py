"""Source divergence against its definition in Python's whole numbers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexroll.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(rows, min_docs=10, top=10):
    """rows: (lang, source, text)."""
    counts, spread = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for lang, source, _ in rows}
    for lang, source, text in rows:
        found = terms_of(text)
        counts[lang or "", source or ""].update(found)
        spread[lang or ""].update(set(found))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, n in spread[lang].items() if n >= min_docs)
        whole = Counter()
        for other in (g for g in groups if g[0] == lang):
            whole.update(counts[other])

        def share(bag):
            total = sum(bag[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (bag[t] + 2) // total for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        own, all_of = share(counts[lang, source]), share(whole)
        pairs = []
        for _, other in (g for g in groups if g[0] == lang and g[1] != source):
            q = share(counts[lang, other])
            pairs.append((other, sum(gap(own[t], q[t]) for t in kept)))
        terms = [(t, gap(own[t], all_of[t])) for t in kept if counts[lang, source][t] and own[t] > all_of[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, *item, k) for k, item in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def got(spark, rows, **more):
    docs = spark.createDataFrame([(i, *r, "z", "z") for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, term string, n string")
    return sorted(map(tuple, divergence.divergence(docs, **more).collect()))


def made(n, seed=1):
    draw = np.random.default_rng(seed)
    words = ["a", "Éa", "the", "eightlet", "ninelette", "sixteenlettersxx", "seventeenlettersx", "w" * 40, "語" * 9, "Über", "ÜBER", "x-y", "z1z"]
    chance = draw.dirichlet(np.ones(len(words)), 5)
    rows = []
    for _ in range(n):
        s = int(draw.integers(0, 5))
        lang = [None, "", "en", "fr"][int(draw.integers(0, 4))]
        rows.append((lang, [None, "", "a", "b", "c"][s], " ".join(draw.choice(words, int(draw.integers(0, 30)), p=chance[s]))))
    return rows


def test_by_brute_force(spark):
    rows = made(300) + [("only", "s", "one two"), ("empty", "s", None), ("empty", "t", "")] + [("en", "quiet", None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, min_docs=2) == brute(rows, 2)


def test_squares_of_few_sources_and_terms(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 3)
    rows = made(200, 4)
    assert got(spark, rows, min_docs=3) == brute(rows, 3)


def test_one_source_holds_most_rows(spark):
    rows = made(60, 2) + [("en", "hot", "the same words again")] * 400
    assert got(spark, rows) == brute(rows)


def test_tiles(monkeypatch):
    """Sources of different tiles meet in one square only."""
    import pyarrow as pa

    monkeypatch.setattr(divergence, "TILE", 2)
    shares = {0: {"x": 5, "y": 9}, 1: {"x": 7}, 2: {"z": 8}, 3: {}}
    absent = {0: 2, 1: 3, 2: 4, 3: 5}
    found = {}
    for ta, tb in ((0, 0), (0, 1), (1, 1)):
        sources = [s for s in absent if s // 2 in (ta, tb)]
        cells = [(s, None, absent[s], 4) for s in sources] + [(s, t, p, 0) for s in sources for t, p in shares[s].items()]
        columns = {n: pa.array([c[i] for c in cells]) for i, n in enumerate(("s", "term", "p", "whole"))}
        columns["term"] = columns["term"].cast(pa.string())
        n = len(cells)
        columns |= {"lang": pa.array(["l"] * n), "ta": pa.array([ta] * n), "tb": pa.array([tb] * n)}
        for row in divergence._square(pa.table(columns)).to_pylist():
            assert (row["a"], row["b"]) not in found
            found[row["a"], row["b"]] = row["value"]
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    assert found == {
        (a, b): sum(gap(shares[a].get(t, absent[a]), shares[b].get(t, absent[b])) for t in "xyzu") for a in absent for b in absent if a < b
    }


def test_counts_of_terms():
    texts = ["ab ab Zz", "", "zz" + "é" * 8 + " " + "q" * 100, "q" * 100 + "!" + "q" * 100, "abc"]
    data = "".join(texts).encode()
    sizes = np.array([len(t.encode()) for t in texts])
    rows = []
    for group, terms, n, docs in divergence.count_chunk(np.frombuffer(data, np.uint8), np.cumsum(sizes) - sizes, np.array([0, 0, 0, 0, 1])):
        rows += zip(group.tolist(), terms.to_pylist(), n.tolist(), docs.tolist())
    assert sorted(rows) == sorted([
        (0, "ab", 2, 1), (0, "zz", 1, 1), (0, "zz" + "é" * 8, 1, 1), (0, "q" * 100, 3, 2), (1, "abc", 1, 1),
    ])


def test_order_by_radix():
    draw = np.random.default_rng(0)
    words = draw.integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert (words[divergence.radix_order(divergence._digits(words))] == np.sort(words)).all()


@pytest.mark.parametrize("count, n, v", [(0, 0, 0), (10**13, 3 * 10**13, 10**7), (5, 7, 1), (0, 10**15, 10**9)])
def test_shares_are_exact(spark, count, n, v):
    from pyspark.sql import functions as F

    row = spark.range(1).select(divergence.share_of(*(F.lit(x).cast("long") for x in (count, n, v)))).first()
    assert v == 0 or row[0] == 1 + 10**9 * (count + 2) // (n + 2 * v)


def test_tables_of_other_shapes(spark, odd_documents, no_documents):
    assert divergence.divergence(no_documents).count() == 0
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_documents.collect()]
    assert sorted(map(tuple, divergence.divergence(odd_documents, min_docs=1).collect())) == brute(rows, 1)

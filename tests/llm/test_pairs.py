import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from lexroll.llm import decontaminate as d, simhash as s


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Fingerprint, smallest id and group of each row, by all pairs."""
    marks = [brute_fingerprint(t) for _, t in rows]
    lead = list(range(len(rows)))

    def top(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 2:
                lead[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(top(i), []).append(key)
    names = [min((k for k in least[top(i)] if k is not None), default=None) for i in range(len(rows))]
    return marks, names, [top(i) for i in range(len(rows))]


def test_bk_tree_finds_what_is_near():
    random.seed(4)
    values = [random.getrandbits(10) for _ in range(300)]
    tree = s.BKTree()
    for v in values:
        tree.add(v)
    assert sorted(tree.values) == sorted(set(values))
    for v in range(0, 1024, 7):
        assert sorted(tree.values[i] for i in tree.near(v, 2)) == sorted(x for x in set(values) if (x ^ v).bit_count() <= 2)


@pytest.mark.parametrize("shard_rows", [16, 4096])
def test_links_within_the_radius(spark, shard_rows):
    random.seed(5)
    centres = [random.getrandbits(64) for _ in range(20)]
    values = {c ^ sum(1 << random.randrange(64) for _ in range(random.randrange(3))) for c in centres * 12}
    values |= {centres[0] ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)}
    values = sorted(v & (1 << 64) - 1 for v in values)
    signed = [s._signed(v) for v in values]
    links = s.radius_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, shard_rows).collect()
    mask = (1 << 64) - 1
    assert all(((r["u"] ^ r["v"]) & mask).bit_count() <= 2 for r in links)

    def groups(pairs):
        lead = {v: v for v in values}

        def top(x):
            while lead[x] != x:
                x = lead[x]
            return x

        for a, b in pairs:
            a, b = sorted((top(a), top(b)))
            lead[b] = a
        return [top(v) for v in values]

    every = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 2]
    assert groups(every) == groups((r["u"] & mask, r["v"] & mask) for r in links)


def test_near_duplicates_by_brute_force(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(random.choices(words, k=random.randrange(2, 60))) for _ in range(60)]
    texts += [t.upper() for t in texts[:10]] + [t + " tail" for t in texts[10:40]] + [None, "", " \n", "one", "one two", "ONE"]
    texts += [t for t in texts[:10]]
    rows = [(i * 3 % 97, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "alone here"), (5, texts[1]), (5, texts[1])]
    marks, least, groups = brute_components(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x"))
    got = s.near_duplicates(frame).select("doc_id", s.hex_fingerprint(F.col("fp")).alias("f"), "component_id").collect()
    key = lambda x: tuple(str(y) for y in x)
    assert sorted(map(tuple, got), key=key) == sorted(((k, f"{m:016x}", c) for (k, _), m, c in zip(rows, marks, least)), key=key)
    kept = s.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert kept.count() == len(set(groups))
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(str(name) for name, _ in {(name, group) for name, group in zip(least, groups)})


def test_near_duplicates_of_odd_rows(odd_documents, no_documents):
    got = {(r["doc_id"], r["component_id"]) for r in s.near_duplicates(odd_documents).collect()}
    assert {(1, 1), (2, 1), (3, 1), (5, 5), (7, 5)} <= got
    assert s.near_duplicates(no_documents).count() == 0
    assert s.keep_one_of_each(no_documents).count() == 0


def brute_contamination(text, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    own, hit, names = words(text), set(), set()
    for name, item in items:
        w = words(item)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(own) - size + 1):
                if own[j : j + size] == w[i : i + size]:
                    hit |= set(range(j, j + size))
                    names |= {name} - {None}
    listed = sorted(map(str, names))
    return len(own), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("slice_words", [d.SLICE_WORDS, 20])
def test_contamination_by_brute_force(spark, slice_words):
    random.seed(7)
    words = [f"w{i}" for i in range(12)] + ["Été", "naïve", "X9"]
    make = lambda n: " ".join(random.choices(words, k=n))
    items = [(i, make(n)) for i, n in enumerate([1, 2, 4, 5, 9, 10, 11, 14, 30, 30])] + [(3, make(12)), (None, make(6)), (90, None), (91, "-- ")]
    items += [(100, "a a a a a a a a a a a a a"), (2, items[5][1])]
    texts = [make(random.randrange(0, 80)) for _ in range(40)] + [None, "", "a " * 40, items[8][1].upper().replace(" ", "-- "), items[5][1]]
    texts += [make(20) + " " + items[9][1] + " " + make(5), texts[3], texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit(0))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = d.contamination(docs, benchmark, slice_words=slice_words).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:6] == brute_contamination(texts[r["doc_id"]], items), r["doc_id"]
    kept = d.drop_contaminated(docs, benchmark, slice_words=slice_words)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if not r["contaminated"])


def test_contamination_of_odd_rows(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    got = d.contamination(odd_documents, benchmark).where("contaminated").collect()
    assert sorted(r["doc_id"] for r in got) == [5, 5, 7]
    assert d.contamination(no_documents, benchmark).count() == 0
    assert d.contamination(odd_documents, benchmark.limit(0)).where("contaminated").count() == 0

import random

import pytest

import corpus_pipeline
from lexroll.llm import jaccard as j
from lexroll.llm.simhash import fingerprint_of


def brute_kept(rows):
    """The smallest id of each group linked by a Jaccard similarity of 0.8 over 5-word shingles, by all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    lead = list(range(len(rows)))

    def top(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for i, a in enumerate(sets):
        for k in range(i):
            b = sets[k]
            if a == b or 5 * len(a & b) >= 4 * len(a | b) and a & b:
                lead[top(i)] = top(k)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(key)
    return sorted(min(g) for g in groups.values())


def near_copies():
    random.seed(8)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(25):
        text = random.choices(words, k=random.randrange(30, 200))
        rows.append(" ".join(text))
        for changes in range(1, 7):
            copy = list(text)
            for at in random.sample(range(len(copy)), changes):
                copy[at] = random.choice(words)
            rows.append(" ".join(copy) + random.choice(["", " tail"]))
    rows += [rows[0].upper(), None, "", " \n", "one", "one two", "ONE"]
    random.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("tile_sets", [j.TILE_SETS, 2])
def test_near_copies_by_brute_force(spark, tile_sets):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = j.keep_one_of_each(docs, tile_sets=tile_sets)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept(rows)


def test_stage_of_the_pipeline_by_brute_force(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept(rows)


def test_shared_counts():
    random.seed(9)
    sets = [set(random.sample(range(60), random.randrange(1, 50))) for _ in range(40)]
    got = j.shared_counts([j.np.array(sorted(s), "<u8") for s in sets])
    assert all(got[a, b] == len(sets[a] & sets[b]) for a in range(40) for b in range(a + 1, 40))


def test_odd_rows(odd_documents, no_documents):
    kept = [r["doc_id"] for r in j.keep_one_of_each(odd_documents).collect()]
    assert sorted(map(str, kept)) == ["1", "4", "5", "None"]
    assert j.keep_one_of_each(no_documents).count() == 0


def test_fingerprints_lead_to_candidates_by_themselves(spark, monkeypatch):
    """Without a band key, near copies within two bits of one another are still found, and far ones aren't linked."""
    monkeypatch.setattr(j, "facts", j.per_text(lambda text: {**j._facts(text), "bands": []}, "struct<fp: bigint, size: int, print: bigint, bands: array<bigint>>"))
    random.seed(3)
    words = random.choices([f"w{i}" for i in range(3000)], k=4000)
    other = words[:2000] + ["x"] + words[2000:]
    assert (fingerprint_of(" ".join(words)) ^ fingerprint_of(" ".join(other))).bit_count() <= 2
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(reversed(words))), (4, "")]
    kept = j.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lexroll.llm import quality_classifier as classifier, quality_rules as rules


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=30))
def test_repeated_words_by_brute_force(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    assert rules._repeated(words, 5) == len(covered)


def test_counts_of_a_text():
    assert rules.count_text("a #b\n\na #b\n c$") == {
        "n_words": 5, "word_chars": 8, "n_symbols": 3, "n_dup_lines": 1, "n_repeat_words": 0
    }
    assert rules.count_text(None) == dict.fromkeys(rules.COUNTS, 0)
    assert rules.count_text("x\x1cy z")["n_words"] == 2


def test_prior():
    assert rules._prior(0, 0, 0, 0.0)[0] == 0.0
    p, weight = rules._prior(200, 2, 100, 100 * 100 / 100)  # one host all bad, one all good
    assert p == 0.5 and weight == pytest.approx(0.0, abs=0.01)
    p, weight = rules._prior(200, 2, 100, 2 * 50 * 50 / 100)  # both hosts alike
    assert weight > 1e5


def test_bad_host_goes_and_good_host_stays(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good + f" {i}", "good") for i in range(40)] + [(100 + i, "short", "bad") for i in range(39)]
    rows += [(200, good, "bad"), (201, good, None), (202, "short", None), (203, good, "good"), (203, good, "good")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["kept"] for r in rules.quality_rules(docs).collect()}
    assert all(got[i] for i in range(40)) and not got[200] and got[201] and not got[202]
    kept = rules.keep_by_rules(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 201, 203, 203]


def test_odd_rows(odd_documents, no_documents):
    got = rules.quality_rules(odd_documents).collect()
    assert len(got) == 8 and {r["n_words"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert rules.quality_rules(no_documents).count() == 0
    assert rules.keep_by_rules(no_documents).columns == no_documents.columns


def test_fit_orders_pairs():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 4))
    good = (x[:, 0] - x[:, 2] > -0.8).astype(int)
    ranking = classifier.fit_pairs(x, good, pairs=5_000)
    assert ((x @ np.array(ranking.weights) >= ranking.threshold) == good).mean() > 0.97
    assert classifier.fit_pairs(x, np.ones(300)) == classifier.Ranking((), 0.0)


def test_scores(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(5, 1), (4, 0), (4, 1), (1, 0), (7, None), (None, 1)], "doc_id long, quality int")
    ranking = classifier.learn_quality(odd_documents, labels)
    got = classifier.score_quality(odd_documents, ranking).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    kept = classifier.keep_by_quality(odd_documents, ranking)
    assert kept.columns == odd_documents.columns and kept.count() == sum(r["predicted"] for r in got)
    even = classifier.learn_quality(no_documents, labels)
    assert {r["score"] for r in classifier.score_quality(odd_documents, even).collect()} == {0.5}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.score_quality(docs, classifier.learn_quality(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 80
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95

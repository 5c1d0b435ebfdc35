import zlib

import numpy as np

from lexroll.llm import quality_classifier as classifier


def test_threshold_of_all_labelled_rows(spark):
    draw = np.random.default_rng(3)
    texts = {i: " ".join(draw.choice(["A!", "b", "cc", "Dd.", "7"], 30)) for i in range(400)}
    good = {i: int(t.count("!") < 7) for i, t in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame(list(good.items()), "doc_id long, quality int")
    ranking = classifier.learn_quality(docs, labels, max_rows=40)
    known = [i for i in texts if zlib.crc32(str(i).encode()) % 3 != classifier.HELD_OUT]
    worth = np.sort([np.dot(ranking.weights, classifier.features(texts[i])) for i in known])
    bad = sum(1 - good[i] for i in known)
    assert len(known) > 40 and np.isclose(ranking.threshold, worth[bad - 1 : bad + 1].mean(), rtol=0, atol=1e-12)

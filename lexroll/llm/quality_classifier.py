"""Quality classifier: document scores learnt from preference pairs after Bradley and Terry.

A document's worth is linear in features of its whole text.  A pair of a good and a bad labelled document
says that the first is worth more; the weights minimise the logistic loss over differences of features.
A quantile of the scores of all labelled documents outside the held-out third, at the share of bad labels and
midway between the scores on either side of it, is the threshold: score 0.5 lies there.

Only the fit of the weights uses a sample: at most ``max_rows`` labelled documents outside the held-out third
(those first in the order of a hash of the id) and ``pairs`` pairs of them.  Every document is scored.

Defined cases: a null text counts as empty and has a score like any other.  A document with several labels
counts with the lowest; null labels are left out.  Without labels of both kinds all scores are 0.5.
Repeated rows each get their score.  Other columns are ignored or kept as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lexroll.llm.common import WORD, per_text, text_batches
from lexroll.operators.lineage import broadcast_if_small, rows_up_to, written
from lexroll.operators.ranks import running_totals

MAX_ROWS = 6_000
PAIRS = 60_000
HELD_OUT = 1  # the remainder of crc32(id) modulo 3 that is never learnt from


def features(text: str | None) -> list[float]:
    """Shares and lengths of one whole text; no number grows without bound."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), max(1, len(text))
    lines = [line for line in text.split("\n") if line.strip()]
    distinct = len(set(words))
    letters = sum(map(str.isalpha, words))
    upper = sum(map(str.isupper, words))
    title = sum(map(str.istitle, words))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    symbols = sum(map(text.count, "#*$%&|<>"))
    shares = [
        letters / max(1, n), upper / max(1, n), title / max(1, n), repeats / max(1, n),
        distinct / max(1, n), len(set(lines)) / max(1, len(lines)),
        symbols / chars, text.count("!") / chars, text.count("|") / chars,
        (text.count(".") + text.count(",")) / chars, sum(map(text.count, "0123456789")) / chars,
        sum(map(len, words)) / max(1, n) / 20, math.log1p(n) / 12, math.log1p(n / max(1, len(lines))) / 8,
        math.log1p(max(map(len, words), default=0)) / 8,
    ]
    bounded = [min(1.0, max(0.0, s)) for s in shares]
    return bounded + [math.sqrt(s) for s in bounded] + [float(n == 0), float(s_over(upper, n)), float(s_over(symbols, n))]


def s_over(count: int, words: int) -> bool:
    return 20 * count > words


@dataclass(frozen=True)
class Ranking:
    """Weights of the features and the score that stands for 0.5."""

    weights: tuple[float, ...]
    threshold: float

    def column(self) -> Callable[[Column], Column]:
        weights, threshold = np.array(self.weights), self.threshold

        def score(text: str | None) -> float:
            worth = float(np.dot(weights, features(text))) - threshold if len(weights) else 0.0
            return 1 / (1 + math.exp(-min(40.0, max(-40.0, worth))))

        return per_text(score, "double")


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = 7) -> Ranking:
    """Newton steps on the mean logistic loss of ``pairs`` preference pairs, with a small ridge."""
    ups, downs = np.flatnonzero(good == 1), np.flatnonzero(good != 1)
    if not len(ups) or not len(downs):
        return Ranking((), 0.0)
    draw = np.random.default_rng(seed)
    scale = np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    d = (x[draw.choice(ups, pairs)] - x[draw.choice(downs, pairs)]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # the chance of the wrong order
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w)), d.T @ p / pairs - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    w = w / scale
    ranked = np.sort(x @ w)
    return Ranking(tuple(w), float(ranked[len(downs) - 1 : len(downs) + 1].mean()))


def learn_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_rows: int = MAX_ROWS, pairs: int = PAIRS,
) -> Ranking:
    """The ranking learnt from the labelled documents outside the held-out third."""
    text_batches(docs.sparkSession)
    labelled = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_good"))
    )
    known = labelled.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    chosen = texts.join(F.broadcast(known), "_id")
    rows = (
        chosen.select("_id", "_good", per_text(features, "array<double>")(F.col("_text")).alias("x"))
        .orderBy(F.xxhash64("_id"), "_id", "x").limit(max_rows).collect()
    )
    if not rows:
        return Ranking((), 0.0)
    ranking = fit_pairs(np.array([r["x"] for r in rows]), np.array([r["_good"] for r in rows]), pairs)
    if not ranking.weights or len(rows) < max_rows and rows_up_to(labelled, max_rows) is not None:  # all were fitted
        return ranking
    worth = per_text(lambda text: float(np.dot(ranking.weights, features(text))), "double")
    scored = written(texts.join(broadcast_if_small(written(labelled)), "_id").select("_good", worth(F.col("_text")).alias("worth")))
    return Ranking(ranking.weights, _threshold(scored))


def _threshold(scored: DataFrame) -> float:
    """Midway between the scores on either side of the share of bad labels, from all rows (_good, worth)."""
    bad = scored.where("_good <> 1").count()
    # Equal scores are one row with their number, so none of them can fill a task.
    ranked = running_totals(scored.groupBy("worth").agg(F.count("*").alias("rows")), "worth", "rows", "upto")
    below, above = ranked.agg(*[F.min(F.when(F.col("upto") >= n, F.col("worth"))) for n in (bad, bad + 1)]).first()
    return below if above is None else (below + above) / 2


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == HELD_OUT, F.lit(False))


def score_quality(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    text_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
        ranking.column()(F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_by_quality(docs: DataFrame, ranking: Ranking, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents predicted to be bad."""
    text_batches(docs.sparkSession)
    scored = docs.select(F.struct("*").alias("row"), ranking.column()(F.col(text_col)).alias("score"))
    return scored.where("score >= 0.5").select("row.*")

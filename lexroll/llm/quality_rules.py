"""Quality rules by host: rule failures are added up by host, rates shrunk to the corpus, verdicts joined back.

A document fails by itself when it is short or repeats itself.  A host is rejected when its failure rate,
shrunk by an empirical beta prior, is over a limit; all documents of a rejected host go.

Defined cases: a null text counts as empty (no words, fails by length).  A document without a host is judged
by itself only and does not enter the prior.  Repeated rows count as often as they occur and all stay in the
result.  An empty table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from lexroll.llm.common import WORD, per_text, text_batches
from lexroll.operators.lineage import written
from lexroll.operators.skew import join_to_keys

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A host goes when more than this share of its documents, shrunk to the corpus, fails.
MAX_HOST_RATE = 0.5


def _repeated(words: list[str], width: int) -> int:
    """Words inside windows of ``width`` words that occur twice or more, first occurrences included."""
    if len(words) <= width:
        return 0
    seen = Counter(zip(*(words[i:] for i in range(width))))
    if len(seen) == len(words) - width + 1:
        return 0
    covered = reach = 0
    for at, window in enumerate(zip(*(words[i:] for i in range(width)))):
        if seen[window] > 1:
            covered += at + width - max(at, reach)
            reach = at + width
    return covered


def count_text(text: str | None) -> dict[str, int]:
    """The base counts of one whole text."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(map(text.count, "#*$%&|<>")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": _repeated(words, WINDOW),
    }


def text_fails(text: str | None) -> bool:
    counts = count_text(text)
    return counts["n_words"] < MIN_WORDS or 100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]


base_counts = per_text(count_text, ", ".join(f"{c}: bigint" for c in COUNTS).join(("struct<", ">")))


fails = per_text(text_fails, "boolean")


def base_failed(counts: str) -> Column:
    words, repeats = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n, rate, host_kept) from rows (host, failed).

    With N rows of rate p on k hosts, the hosts' weighted variance has the expectation
    p(1-p) (rho + (1-rho) k/N) for beta-distributed host rates, where 1/rho - 1 is the prior's weight.  That
    gives rho, held to [1e-6, 1], and with it the prior's two counts.
    """
    hosts = judged.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("bad")
    )
    hosts = written(hosts)
    rows, k, bad, squares = hosts.agg(
        F.sum("n"), F.count("*"), F.sum("bad"), F.sum(F.col("bad") * F.col("bad") / F.col("n"))
    ).first()
    p, weight = _prior(rows or 0, k, bad or 0, squares or 0.0)
    rate = (F.col("bad") + F.lit(p * weight)) / (F.col("n") + F.lit(weight))
    return hosts.select("host", "n", rate.alias("host_rate")).withColumn(
        "host_kept", F.col("host_rate") <= max_rate
    )


def _prior(rows: int, k: int, bad: int, squares: float) -> tuple[float, float]:
    """Mean and weight of the prior from the number of rows, hosts and failures and the sum of bad^2 / n."""
    p = bad / rows if rows else 0.0
    base, share = p * (1 - p), k / rows if rows else 1.0
    rho = 1e-6
    if base > 0 and share < 1:
        rho = min(1.0, max(1e-6, (squares / rows - p * p - base * share) / (base * (1 - share))))
    return p, 1 / rho - 1


def with_verdict(judged: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows (host, failed, ...) with ``host_rate`` and ``kept``."""
    joined = join_to_keys(judged, verdicts, "host", "n")
    return joined.withColumn("kept", ~F.col("failed") & F.coalesce("host_kept", F.lit(True))).drop("host_kept")


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and the host's shrunk rate for every row."""
    text_batches(docs.sparkSession)
    counted = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), base_counts(F.col(text_col)).alias("counts")
    )
    judged = written(counted.withColumn("failed", base_failed("counts")))
    out = with_verdict(judged, host_verdicts(judged, max_rate))
    return out.select("doc_id", "counts.*", F.col("failed").alias("base_failed"), "kept", "host_rate")


def keep_by_rules(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """``docs`` without the documents that the rules reject.

    Texts are not shuffled: one pass adds up the hosts, a second one judges each document again beside
    its host's verdict.
    """
    text_batches(docs.sparkSession)
    judged = docs.select(
        F.struct("*").alias("row"), F.col(host_col).alias("host"),
        fails(F.col(text_col)).alias("failed"),
    )
    verdicts = written(host_verdicts(judged.select("host", "failed"), max_rate))
    return with_verdict(judged, verdicts).where("kept").select("row.*")


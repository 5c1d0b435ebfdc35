"""URL filters: wildcard rules packed into bit masks and run over each URL all at once (Shift-And).

A rule is a glob over the canonical URL, the host in lower case followed by the path.  ``*`` stands for any
letters but "/", ``**`` for any letters at all; everything else stands for itself, and a rule describes the
whole URL.  Each rule owns a run of bits, one for its start and one for each letter; a bit is set while the
URL so far fits the rule up to there.  A letter c turns the set D of all rules' bits into
((D << 1) & B[c]) | (D & L[c]): bits move on where their letter is c, and stay where a wildcard takes c in.
The bits fill as many 64-bit words as they need.

URLs of a batch go through the masks side by side; letters are bytes of UTF-8, which changes no match.

Rules carry a verdict and a length; of the named rules that fit, the longest decides, and without one a URL is
blocked if an unnamed rule fits.  A named rule (host, path) is the globs ``host/path**`` and ``*.host/path**``.

Defined cases: a null URL or one without "://" has an empty host and path, fits no named rule and is allowed
unless a glob takes the empty URL in.  Repeated rows are judged alike.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# URLs of over this many bytes go through the masks one at a time, so a batch stays small.
LONG_URL = 4_096

# The unnamed rules: hosts and words of advertisers, gambling, pills and the like.
BLOCKED = (
    "**casino**", "**cheap-pills**", "**spam**", "*.ads-track.*/**", "ads-track.*/**", "**free-bets**",
    "adult-*/**", "*.adult-*/**", "**/wp-login.php**", "**/ads/**",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A rule of the list: ``text`` is its host and path, such as ``example.org/es/``."""

    text: str
    verdict: str

    def globs(self) -> list[str]:
        return [f"{self.text}**", f"*.{self.text}**"]


# Fixed: the named rules.
RULES = (
    Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"), Rule("com/de/", "block"),
)


class Masks:
    """The bits of all globs: where they start and end, move and stay."""

    def __init__(self, globs: list[str]) -> None:
        move: list[tuple[int, int]] = []  # (bit, letter that sets it)
        stay: list[tuple[int, bool]] = []  # (bit, whether "/" keeps it too)
        self.starts, self.ends = 0, []
        bit = 0
        for glob in globs:
            self.starts |= 1 << bit
            data, at = glob.encode(), 0
            while at < len(data):
                if data[at : at + 2] == b"**":
                    stay.append((bit, True))
                    at += 2
                elif data[at : at + 1] == b"*":
                    stay.append((bit, False))
                    at += 1
                else:
                    bit += 1
                    move.append((bit, data[at]))
                    at += 1
            self.ends.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.moves = [sum(1 << b for b, c in set(move) if c == letter) for letter in range(256)]
        anywhere = sum(1 << b for b in {b for b, slash in stay if slash})
        inside = sum(1 << b for b in {b for b, _ in stay})
        self.stays = [anywhere if letter == ord("/") else inside for letter in range(256)]
        self.table_moves, self.table_stays = self._table(self.moves), self._table(self.stays)

    def _table(self, masks: list[int]) -> np.ndarray:
        return np.array([self._split(m) for m in masks], np.uint64)

    def _split(self, mask: int) -> list[int]:
        return [mask >> 64 * i & (1 << 64) - 1 for i in range(self.words)]

    def run_one(self, url: bytes) -> int:
        d, moves, stays = self.starts, self.moves, self.stays
        for c in url:
            d = d << 1 & moves[c] | d & stays[c]
        return d

    def run(self, urls: list[bytes]) -> np.ndarray:
        """For each URL the globs that take it in, as a table of booleans."""
        state = np.tile(np.array(self._split(self.starts), np.uint64), (len(urls), 1))
        sizes = np.array([len(u) for u in urls], np.int64)
        short = [u if len(u) <= LONG_URL else b"" for u in urls]
        letters = np.frombuffer(b"".join(short) + b"\0", np.uint8)
        lengths = np.array([len(u) for u in short], np.int64)
        firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if urls else lengths
        order = np.argsort(-lengths, kind="stable")
        one, high = np.uint64(1), np.uint64(63)
        for at in range(int(lengths.max(initial=0))):
            live = order[: np.searchsorted(-lengths[order], -at, side="left")]
            c = letters[firsts[live] + at]
            d = state[live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> high
            state[live] = moved & self.table_moves[c] | d & self.table_stays[c]
        for i in np.flatnonzero(sizes > LONG_URL).tolist():
            state[i] = self._split(self.run_one(urls[i]))
        return np.stack([state[:, e // 64] >> np.uint64(e % 64) & one for e in self.ends], 1).astype(bool)


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def rule_number(canonical: Column, rules: tuple[Rule, ...], globs: tuple[str, ...]) -> Column:
    """The number of the longest named rule that fits; -1 if only a glob does, -2 if nothing does."""
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), rules[i].text))
    listed = [g for i in ranked for g in rules[i].globs()] + list(globs)

    def batch(urls: pa.Array) -> pa.Array:
        masks = Masks(listed)
        fits = masks.run([u.as_py().encode("utf-8", "surrogatepass") for u in urls])
        named = fits[:, : 2 * len(ranked)].reshape(len(fits), len(ranked), 2).any(2)
        first = named.argmax(1) if ranked else np.zeros(len(fits), int)
        own = np.array(ranked + [0])[first]
        other = np.where(fits[:, 2 * len(ranked) :].any(1), -1, -2)
        return pa.array(np.where(named.any(1), own, other).astype(np.int32))

    return F.arrow_udf(batch, "int")(canonical)


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES,
    globs: tuple[str, ...] = BLOCKED,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row."""
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    found = parts.withColumn("n", rule_number(F.concat("host", "path"), rules, globs))
    pick = [F.col("n") == i for i in range(len(rules))]
    rule = F.coalesce(*(F.when(p, F.lit(r.text)) for p, r in zip(pick, rules)), F.lit(None).cast("string"))
    verdict = F.coalesce(
        *(F.when(p, F.lit(r.verdict)) for p, r in zip(pick, rules)), F.when(F.col("n") == -1, "block"), F.lit("allow")
    )
    return found.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))

"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how usual each pairing is.

Both tokenizers encode a whole text.  A byte offset where a token of each ends is shared; shared ends cut the
tokens into groups, and all tokens of a group are linked with one another.  Anchors are shared ends, verified on
the tokens' bytes, before a token of each side that starts with a space.  They split a document into windows of token
ids; a window's groups and links depend on its ids alone and are kept by the tuple of both sides' ids.

The count of a pair is the number of documents that hold it linked.  Documents send each of their pairs once, with
its number of links.  Pairs of many documents are few, so they are broadcast after a count (``PAIR_ROWS`` at most) and
meet their documents in place; the others meet in a shuffle, where no key has more rows than the least frequent
pair of the broadcast.

Encoding: texts with single blanks between words are cut before each blank, where neither tokenizer has a token across,
and the ids of a run are kept; other texts are encoded whole.  The byte-level vocabulary is run by an encoder that
joins neighbours in the order of the joint tokens' ids, which is the order of its merges; all of its tokens can be
reached by its merges, and tests hold the ids against the file's own library.

Defined cases: null, empty and not faithfully tokenised texts (bytes of the tokens differ from space + text) have no
tokens: zeros and an empty ``groups_sha256``.  Repeated rows are documents of their own.  Ties for the best pair of an id
all count.  Texts may have any length; one without shared ends is a single group, of which each pair of different ids is
kept once.  Null ids are kept.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
from itertools import chain
import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.llm.bpe import byte_letters
from lexroll.llm.common import per_texts, share, shared, text_batches
from lexroll.operators.lineage import written

SPACE = "▁"
KEPT_RUNS = 300_000
JOINED_RUNS = 64
KEPT_WINDOWS = 200_000
LONG_RUN = 64
MANY_LINKS = 1024  # from here on a window's links are kept as different pairs with their numbers
PAIR_ROWS = 500_000
# Marks in a stream of ids: four equal bytes, which ids under 2^20 cannot show, not even across their limits.
BETWEEN_ID, AFTER_ID = 0xFDFDFDFD, 0xFFFFFFFF
BETWEEN, AFTER = struct.pack("<I", BETWEEN_ID), struct.pack("<I", AFTER_ID)
SHIFT = 20  # a pair of ids is one number, the second in the low bits

# Fixed: how the first vocabulary's library splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNEVEN = re.compile(r" (?:\s|\Z)|\A ")
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class Side:
    """Bytes of a vocabulary's tokens, their sizes, and which start with a space."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.spaced = np.array([t.startswith(b" ") for t in tokens], bool)

    def text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _product(left: list[int], right: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs of two lists and how often each occurs."""
    (a, n), (b, m) = (np.unique(np.array(x, np.int64), return_counts=True) for x in (left, right))
    return (a[:, None] << SHIFT | b).ravel(), (n[:, None] * m).ravel()


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    times = np.zeros(pairs.size, np.int64)
    np.add.at(times, place, np.concatenate([t for _, t in parts]))
    return pairs, times


class Aligner:
    """Two tokenizers, opened in the task, and what is kept of their runs and windows."""

    def __init__(self, first: str, second: bytes) -> None:
        """The text of a tokenizers file and the content of a sentence-piece file."""
        self.first, self.second = first, second
        self.parts = None

    def open(self) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        first = Tokenizer.from_str(self.first)
        first.encode_special_tokens = True  # their strings are plain text
        first.no_truncation()
        first.no_padding()
        second = sentencepiece.SentencePieceProcessor(model_proto=self.second)
        letters = byte_letters()
        special = {t.content for t in first.get_added_tokens_decoder().values()}
        tokens = [b""] * first.get_vocab_size()
        for token, i in first.get_vocab().items():
            tokens[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        pieces = [second.id_to_piece(i) for i in range(second.get_piece_size())]
        self.a = Side(tokens)
        self.b = Side([_piece_bytes(p, second.is_byte(i)) for i, p in enumerate(pieces)])
        # A piece with a space after a letter would cross the runs.
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        # The same vocabulary for a quicker encoder: ids of its tokens go by the order of their merges.
        ranks = {token: i for i, token in enumerate(tokens) if first.id_to_token(i) not in special}
        self.quick = tiktoken.Encoding("first", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
        self.runs: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.lossy: set[str] = set()
        self.windows = Windows(self.a, self.b)
        self.parts = first, second

    def _faithful(self, text: str, a: list[int], b: list[int]) -> bool:
        wanted = b" " + text.encode()
        return self.a.text(a) == wanted and self.b.text(b) == wanted

    def _learn(self, runs: list[str]) -> None:
        """Encode new runs, many in a text; each begins with a space and holds no other."""
        if not runs:
            return
        joined = [" ".join(runs[at : at + JOINED_RUNS]) for at in range(0, len(runs), JOINED_RUNS)]
        ids = [chain.from_iterable(map(self.quick, [" " + t for t in joined])), chain.from_iterable(self.parts[1].encode(joined, num_threads=1))]
        ids = [np.fromiter(x, np.int64) for x in ids]
        starts = [np.flatnonzero(side.spaced[x]) for side, x in zip((self.a, self.b), ids)]
        spelt = [(" " + r).encode() for r in runs]
        sizes = list(map(len, spelt))
        sure = all(len(at) == len(runs) for at in starts) and all(
            side.text(x.tolist()) == b"".join(spelt) and np.add.reduceat(side.sizes[x], at).tolist() == sizes
            for side, x, at in zip((self.a, self.b), ids, starts)
        )
        if sure:
            for kept, x, at in zip(self.runs, ids, starts):
                raw, limits = x.astype("<u4").tobytes(), [*(4 * at).tolist(), 4 * x.size]
                kept.update((r, raw[low:high]) for r, low, high in zip(runs, limits, limits[1:]))
            return
        if len(runs) > JOINED_RUNS:  # look for the odd one
            self._learn(runs[: len(runs) // 2])
            self._learn(runs[len(runs) // 2 :])
            return
        for run, b in zip(runs, self.parts[1].encode(runs, num_threads=1)):
            a = self.quick(" " + run)
            self.runs[0][run], self.runs[1][run] = _four(a), _four(b)
            if not self._faithful(run, a, b):
                self.lossy.add(run)

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes] | None]:
        """Both sides' ids of whole texts, four bytes each; None without tokens that spell the text."""
        second, (first_of_run, second_of_run) = self.parts[1], self.runs
        split = [t.split(" ") if t and self.apart and not UNEVEN.search(t) else None for t in texts]
        every = set().union(*filter(None, split))
        new = every.difference(first_of_run)
        if len(first_of_run) + len(new) > KEPT_RUNS:
            first_of_run.clear(), second_of_run.clear(), self.lossy.clear()
            new = every
        new = list(new)
        self._learn(new)
        out: list[tuple[bytes, bytes] | None] = []
        for text, runs in zip(texts, split):
            if not text:
                out.append(None)
                continue
            if runs is None:
                a, b = self.quick(" " + text), second.encode(text, num_threads=1)
                found, sure = (_four(a), _four(b)), self._faithful(text, a, b)
            else:
                found = tuple(b"".join(map(kept.__getitem__, runs)) for kept in self.runs)
                sure = self.lossy.isdisjoint(runs) or self._faithful(text, *(np.frombuffer(x, "<u4").tolist() for x in found))
            out.append(found if sure else None)
        for run in new:
            if len(run) > LONG_RUN:
                del first_of_run[run], second_of_run[run]
        return out

    def align(self, texts: list[str | None]) -> list[dict]:
        if self.parts is None:
            self.open()
        encoded = self.encode(texts)
        found = iter(self.windows.align([e for e in encoded if e is not None]))
        nothing = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "pairs": [], "times": []}
        return [nothing if e is None else next(found) for e in encoded]


class Windows:
    """Alignments of windows, kept by the ids of both sides; windows not met before are aligned many at a time."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        # An id inside a group and at the end of its side.
        self.words = [f"{i}{c}" for i in range(len(a.tokens)) for c in ",|"] + [f"{i}{c}" for i in range(len(b.tokens)) for c in ",;"]
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.facts = np.zeros((4, 0), np.int64)  # groups, links, first of the links kept, their number
        self.links = np.zeros(0, np.int64)
        self.many: dict[int, list] = {}  # links of large groups: different pairs with their numbers
        self.stale = False

    def _keys(self, a: np.ndarray, b: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """For each window between anchors the ids of both sides in bytes, and the place of its last first-side token."""
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        place = np.searchsorted(ends_b, ends_a)
        anchor = ends_b[place] == ends_a
        anchor[:-1] &= self.a.spaced[a[1:]] & np.append(self.b.spaced[b], False)[place[:-1] + 1]
        last_a = np.flatnonzero(anchor)
        last_b = place[last_a]
        # Each window's ids of the first side, a mark, its ids of the second side, another mark.
        stream = np.empty(a.size + b.size + 2 * last_a.size, "<u4")
        before_a, before_b = (np.concatenate([[0], last[:-1] + 1]) for last in (last_a, last_b))
        count_a, count_b = last_a + 1 - before_a, last_b + 1 - before_b
        number = np.arange(last_a.size)
        stream[np.arange(a.size) + np.repeat(before_b + 2 * number, count_a)] = a
        stream[np.arange(b.size) + np.repeat(last_a + 1 + 2 * number + 1, count_b)] = b
        stream[last_a + 1 + before_b + 2 * number] = BETWEEN_ID
        stream[last_a + 1 + last_b + 1 + 2 * number + 1] = AFTER_ID
        return stream[:-1].tobytes().split(AFTER), last_a

    def _learn(self, keys: list[bytes]) -> None:
        sides = [k.split(BETWEEN) for k in keys]
        a, b = (np.frombuffer(b"".join([s[k] for s in sides]), "<u4").astype(np.int64) for k in (0, 1))
        stop_a, stop_b = (np.cumsum([len(s[k]) // 4 for s in sides]) for k in (0, 1))
        # Groups: from one shared end to the next.  A window ends with one.
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        place = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[place] == ends_a)
        last_b = place[last_a]
        first_a, first_b = (np.concatenate([[0], last[:-1] + 1]) for last in (last_a, last_b))
        count_a, count_b = last_a + 1 - first_a, last_b + 1 - first_b
        # The ids of a group's first side and then of its second, as texts with what follows them.
        codes = np.empty(a.size + b.size, np.int64)
        closing_a, closing_b = np.zeros(a.size, np.int64), np.zeros(b.size, np.int64)
        closing_a[last_a] = closing_b[last_b] = 1
        codes[np.arange(a.size) + np.repeat(first_b, count_a)] = 2 * a + closing_a
        codes[np.arange(b.size) + np.repeat(last_a + 1, count_b)] = 2 * (len(self.a.tokens) + b) + closing_b
        words = list(map(self.words.__getitem__, codes.tolist()))
        limits = [0, *(stop_a + stop_b).tolist()]
        self.groups += ["".join(words[low:high])[:-1] for low, high in zip(limits, limits[1:])]
        # All pairs of a group.
        pairs = count_a * count_b
        kept = np.where(pairs < MANY_LINKS, pairs, 0)
        group = np.repeat(np.arange(kept.size), kept)
        inner = np.arange(group.size) - np.repeat(np.cumsum(kept) - kept, kept)
        links = a[first_a[group] + inner // count_b[group]] << SHIFT | b[first_b[group] + inner % count_b[group]]
        # Each window's groups are a run of them.
        first = np.searchsorted(last_a, np.concatenate([[0], stop_a[:-1]]))
        sizes = np.add.reduceat(kept, first)
        start = self.links.size + np.cumsum(sizes) - sizes
        base = len(self.numbers)
        self.facts = np.concatenate([self.facts, np.stack([np.diff(first, append=last_a.size), np.add.reduceat(pairs, first), start, sizes])], 1)
        self.links = np.concatenate([self.links, links])
        for g in np.flatnonzero(pairs >= MANY_LINKS).tolist():
            window = base + int(np.searchsorted(first, g, "right")) - 1
            left, right = a[first_a[g] : last_a[g] + 1], b[first_b[g] : last_b[g] + 1]
            self.many.setdefault(window, []).append(_product(left, right))
        self.numbers.update(zip(keys, range(base, base + len(keys))))

    def align(self, texts: list[tuple[bytes, bytes]]) -> list[dict]:
        """The alignments of texts given by both sides' ids; their tokens spell the same bytes."""
        if not texts:
            return []
        a, b = (np.frombuffer(b"".join([t[k] for t in texts]), "<u4").astype(np.int64) for k in (0, 1))
        count_a, count_b = (np.array([len(t[k]) // 4 for t in texts]) for k in (0, 1))
        # Texts begin with a space on both sides, so their limits are anchors and no window spans two.
        keys, last_a = self._keys(a, b)
        new = set(keys).difference(self.numbers)
        if self.stale or len(self.numbers) + len(new) > KEPT_WINDOWS:
            self.clear()
            new = set(keys)
        if new:
            self._learn(list(new))
            self.stale = max(map(len, new)) > 1024 * LONG_RUN
        windows = np.fromiter(map(self.numbers.__getitem__, keys), np.int64, len(keys))
        stop = np.searchsorted(last_a, np.cumsum(count_a))
        start = np.concatenate([[0], stop[:-1]])
        n_groups, n_links, first, sizes = self.facts[:, windows]
        # Links of all texts, each with its text's number in the high bits.
        owner = np.repeat(np.repeat(np.arange(len(texts)), stop - start), sizes)
        at = np.arange(owner.size) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
        found, times = np.unique(owner << 2 * SHIFT | self.links[at], return_counts=True)
        cut = np.searchsorted(found, np.arange(len(texts) + 1) << 2 * SHIFT).tolist()
        pairs = found & (1 << 2 * SHIFT) - 1
        sums = [np.add.reduceat(x, start).tolist() for x in (n_groups, n_links)]
        numbers, out = windows.tolist(), []
        for k, (low, high) in enumerate(zip(start.tolist(), stop.tolist())):
            own, often = pairs[cut[k] : cut[k + 1]], times[cut[k] : cut[k + 1]]
            many = [m for w in numbers[low:high] if w in self.many for m in self.many[w]] if self.many else []
            if many:
                own, often = _added([(own, often), *many])
            said = ";".join(map(self.groups.__getitem__, numbers[low:high]))
            out.append({
                "n_a": int(count_a[k]), "n_b": int(count_b[k]), "n_groups": sums[0][k], "n_links": sums[1][k],
                "groups_sha256": hashlib.sha256(said.encode()).hexdigest(), "pairs": own, "times": often,
            })
        return out


def _four(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    byte = BYTE_PIECE.fullmatch(piece) if is_byte else None
    return bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode()


def load(spark: SparkSession, first: str, second: str) -> Broadcast:
    """The files of both tokenizers, sent to the executors; their size is the vocabularies'."""
    with open(first, encoding="utf-8") as a, open(second, "rb") as b:
        return share(spark, Aligner(a.read(), b.read()))


ALIGNED = (
    "struct<n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string, "
    "pairs: array<bigint>, times: array<bigint>>"
)


def aligned(docs: DataFrame, aligner: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): different linked pairs of ids, as one number
    each (``first_of``, ``second_of``), with their numbers of links."""
    text_batches(docs.sparkSession)
    found = per_texts(lambda texts: shared(Aligner, aligner).align(texts), ALIGNED)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("d"))
    return rows.select("row", "doc_id", "d.*")


def first_of(pair):
    return F.shiftright(pair, SHIFT)


def second_of(pair):
    return F.col(pair).bitwiseAND((1 << SHIFT) - 1) if isinstance(pair, str) else pair.bitwiseAND((1 << SHIFT) - 1)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best): documents with the pair, and whether no pair of its first id has more."""
    counts = written(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    most = counts.groupBy(first_of("pair").alias("a")).agg(F.max("n").alias("most"))  # of the first vocabulary's size
    return counts.join(F.broadcast(most), first_of("pair") == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(found: DataFrame, facts: DataFrame, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """(row, n_best, count_sum) of the rows that have links."""
    facts = written(facts)
    sizes = facts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("keys")).orderBy("power")
    sizes = sizes.collect()  # at most 63 numbers
    least = 64  # the least power of two from which on pairs are few enough
    while sizes and sizes[-1]["keys"] <= pair_rows:
        last = sizes.pop()
        pair_rows -= last["keys"]
        least = last["power"]
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.pairs", "l.times")
    links = links.withColumnRenamed("pairs", "pair")
    power = F.floor(F.log2("n"))
    usual = F.broadcast(facts.where(power >= least))
    met = links.join(usual, "pair")
    if sizes:
        met = met.unionByName(links.join(usual.select("pair"), "pair", "left_anti").join(facts.where(power < least), "pair"))
    return met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )


def alignment(docs: DataFrame, aligner: Broadcast, id_col: str = "doc_id", text_col: str = "text", pair_rows: int = PAIR_ROWS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    found = written(aligned(docs, aligner, id_col, text_col))
    scores = link_scores(found, pair_counts(found), pair_rows)
    return found.join(scores, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )

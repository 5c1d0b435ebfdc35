"""Byte-level BPE by a tokenization automaton: merges are compiled into a table of transitions.

The automaton reads tokens.  It starts as one state with an arc to itself for every byte, so it accepts every
way to spell a text.  Each merge (a, b), in order, puts a gadget in: where the state after ``a`` still has an
arc ``b``, that arc goes away, every state with an arc ``a`` gets an arc ``ab``, and the state after ``ab``
starts as a copy of the state after ``b``.  What is left accepts each text in one way, its BPE tokens.  The
state depends on the last token only, so a transition is a pair of tokens.  States share their arcs: a state
is held as what its gadget changed, and a transition is looked up through the gadgets that it was copied from
(``allows``), once for each pair that occurs, and kept in a table.

Words are run many at a time over two tables: the tree of the arcs' labels (node and byte to node) and the transitions
(state and token to whether the state has the arc).  The automaton accepts each prefix of a word in one way, so a prefix
has one last token, and this is its state.  Prefix by prefix, of the arcs that end there the one is taken that the
state before it has.  No run has to return.  A long word is run by itself, over the same tables as
dictionaries, along its longest arcs with a way back; places left once are dead for all other runs, so this is linear
too.  Decoding emits the labels of the arcs.

Defined cases: a null text counts as empty: no tokens, the hash of nothing, an empty decoded text.  Repeated
rows are encoded alike.  A word may have any length; work follows it linearly.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from itertools import chain

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexroll.llm.common import per_text, per_texts, share, shared, text_batches

# Fixed: how the vocabulary's library splits a text before the merges.
# (letters, digits and other characters, each with a blank before; white space), in the terms of ``re``.
SPLIT = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# Entries that a Python worker keeps of its words and transitions; both can be worked out again.
KEPT_WORDS = 50_000
KEPT_PAIRS = 250_000
LONG_WORD = 60  # letters, of four bytes at most
LETTERS = 1 << 17  # of texts run together
START = END = -1
ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable Latin-1 for itself, others from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Table:
    """Whole numbers by keys of 0 and more, for many keys at once; found from a key's hash onwards."""

    def __init__(self, room: int) -> None:
        bits = max(4, room.bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        self.count = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 where a key has none."""
        slots = self._slots(keys)
        held = self.keys[slots]
        found = np.where(held == keys, self.values[slots], -1).astype(np.int64)
        todo = np.flatnonzero((held != keys) & (held >= 0))
        while todo.size:
            slots[todo] = slots[todo] + 1 & self.last
            held = self.keys[slots[todo]]
            hit = held == keys[todo]
            found[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return found

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different keys that have no value yet."""
        slots, todo = self._slots(keys), np.arange(keys.size)
        self.count += keys.size
        while todo.size:
            free = todo[self.keys[slots[todo]] < 0]
            self.keys[slots[free]] = keys[free]  # of several for a slot one stays
            placed = self.keys[slots[todo]] == keys[todo]
            self.values[slots[todo[placed]]] = values[todo[placed]]
            todo = todo[~placed]
            slots[todo] = slots[todo] + 1 & self.last


class Automaton:
    """The tokens, the gadgets of the merges and the transitions met so far."""

    def __init__(self, model: str) -> None:
        """``model`` is the text of a tokenizer file."""
        data = json.loads(model)
        letters = byte_letters()
        vocabulary = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.labels: dict[int, bytes] = {
            i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if t not in self.special
        }
        self.labels |= {i: t.encode() for t, i in self.special.items()}
        self.birth = {i: 0 for i, label in self.labels.items() if len(label) == 1}  # time of the gadget
        self.parts: dict[int, tuple[int, int]] = {}
        self.removed: dict[tuple[int, int], int] = {}  # arc of a state -> time of the gadget that took it away
        self.table = Table(2 * KEPT_PAIRS)  # state and token -> whether the state has the arc
        for time, merge in enumerate(data["model"]["merges"], 1):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self._gadget(vocabulary[a], vocabulary[b], vocabulary[a + b], time)
        self.sizes = {i: len(self.labels[i]) for i in self.birth}
        self.longest = max(self.sizes.values(), default=0)
        # The tree of the arcs' labels, and the token that ends at a node.
        tree: dict[int, int] = {}
        ends = {}
        for i in self.birth:
            node = 0
            for byte in self.labels[i]:
                node = tree.setdefault(node << 8 | byte, len(tree) + 1)
            ends[node] = i
        self.tree = Table(2 * len(tree))
        self.tree.put(np.fromiter(tree, np.int64), np.fromiter(tree.values(), np.int64))
        self.ends = np.full(len(tree) + 1, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())
        self.length_of = np.zeros(max(self.labels, default=0) + 1, np.int64)
        self.length_of[list(self.sizes)] = list(self.sizes.values())
        self.odd = _odd_characters()
        # Words met: their ids as decimals, and what the arcs emit.
        self.words: dict[str, str] = {}
        self.emitted: dict[str, bytes] = {}
        # The same two tables for words run by themselves, filled where needed.
        self.nodes: dict = {}
        self.known: dict[int, bool] = {}

    def _gadget(self, a: int, b: int, ab: int, time: int) -> None:
        if a not in self.birth or b not in self.birth or not self.allows(a, b):
            return  # an earlier gadget keeps the pair from standing side by side
        self.removed[a, b] = time
        if ab not in self.birth:
            self.birth[ab], self.parts[ab] = time, (a, b)

    def allows(self, a: int, b: int) -> bool:
        """Whether the state after ``a`` has an arc ``b``.

        If ``a`` is the younger, its state is a copy of the state after its right part, as it was before a's
        gadget; else the arc came with b's gadget to all states that had an arc to b's left part.  The arc
        is there unless one of these was taken away in time.
        """
        birth, parts, removed = self.birth, self.parts, self.removed
        limit = len(self.labels) + 1
        while True:
            if removed.get((a, b), limit) < limit:
                return False
            if birth[a] > birth[b]:
                limit, a = birth[a], parts[a][1]
            elif birth[b]:
                # The gadget itself takes (left, right) away before it adds its arc.
                limit, b = birth[b] + 1, parts[b][0]
            else:
                return True

    def _has(self, pairs: np.ndarray) -> np.ndarray:
        """Whether states have arcs, for pairs state << 20 | token; what the table lacks is worked out and put into it."""
        found = self.table.get(pairs)
        new = np.unique(pairs[found < 0])
        if new.size:
            if self.table.count + new.size > KEPT_PAIRS:
                self.table = Table(max(2 * KEPT_PAIRS, 2 * new.size))
                new = np.unique(pairs)
            self.table.put(new, np.array([self.allows(p >> 20, p & 0xFFFFF) for p in new.tolist()], np.int64))
            found = self.table.get(pairs)
        return found > 0

    def run(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of words one after another, and how many each has; for words under 256 bytes."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        stop = np.cumsum(sizes)
        owner = np.repeat(np.arange(sizes.size), sizes)
        # From every place down the tree: the arcs that the text spells, by their lengths.
        here, node, end = np.arange(data.size), np.zeros(data.size, np.int64), stop[owner]
        arcs, length = [], 0
        while here.size:
            node = self.tree.get(node << 8 | data[here + length])
            length += 1
            on = node >= 0
            here, node, end = here[on], node[on], end[on]
            ending = self.ends[node]
            whole = ending >= 0
            arcs.append((here[whole], ending[whole]))
            on = here + length < end
            here, node, end = here[on], node[on], end[on]
        first, token = (np.concatenate(c) for c in zip(*arcs)) if arcs else (here, here)
        # One slot for each prefix of a word, the empty one included: its last token, which is its state.
        base = stop - sizes + np.arange(sizes.size)
        last = np.full(data.size + sizes.size, START, np.int64)
        before = first + owner[first]
        after = before + self.length_of[token]
        reach = (after - base[owner[first]]).astype(np.uint8)
        order = np.argsort(reach, kind="stable")  # by the prefix's length, shorter arcs first
        before, after, token = before[order], after[order], token[order]
        limits = np.cumsum(np.bincount(reach))
        for low, high in zip(limits, limits[1:]):
            states = last[before[low:high]]
            has = states == START
            has[~has] = self._has(states[~has] << 20 | token[low:high][~has])
            last[after[low:high][has]] = token[low:high][has]
        # The tokens of the words, from their ends.
        at, active = base + sizes, np.flatnonzero(sizes)
        rows, tokens = [], []
        while active.size:
            taken = last[at[active]]
            rows.append(active)
            tokens.append(taken)
            at[active] -= self.length_of[taken]
            active = active[at[active] > base[active]]
        row, found = (np.concatenate(c[::-1]) if c else np.empty(0, np.int64) for c in (rows, tokens))
        return found[np.argsort(row, kind="stable")], np.bincount(row, minlength=sizes.size)

    def _word(self, word: bytes) -> list[int]:
        """A word by itself, longest arcs first, with a way back from places without an arc."""
        out: list[int] = []
        left: list[list[int]] = []  # arcs not tried yet, of each place on the way
        dead: set[int] = set()
        at, state, ways, sizes, known = 0, START, self._arcs(word, 0), self.sizes, self.known
        while at < len(word):
            while ways:
                token = ways.pop()
                end = at + sizes[token]
                if end in dead:
                    continue
                if state != START:
                    key = state << 20 | token
                    if key not in known:
                        if len(known) >= KEPT_PAIRS:
                            known.clear()
                        known[key] = self.allows(state, token)
                    if not known[key]:
                        continue
                out.append(token)
                left.append(ways)
                at, state, ways = end, token, self._arcs(word, end)
                break
            else:
                dead.add(at)
                ways = left.pop()
                at -= sizes[out.pop()]
                state = out[-1] if out else START
        return out

    def _arcs(self, word: bytes, at: int) -> list[int]:
        """The tokens whose labels stand at a place, the longest last."""
        if not self.nodes:
            for i in self.birth:
                node = self.nodes
                for byte in self.labels[i]:
                    node = node.setdefault(byte, {})
                node[END] = i
        node, found = self.nodes, []
        for byte in word[at : at + self.longest]:
            node = node.get(byte)
            if node is None:
                break
            if END in node:
                found.append(node[END])
        return found

    def split_words(self, text: str) -> list[str]:
        low, high = self.odd
        if low.search(text) or (not text.isascii() and ASTRAL.search(text) and high.search(text)):
            from tokenizers.pre_tokenizers import ByteLevel

            pieces = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in pieces]
        return SPLIT.findall(text)

    def _parts(self, text: str) -> list[tuple[str, bool]]:
        """The text between special tokens, and these."""
        if self.special_split is None or not any(map(text.__contains__, self.special)):
            return [(text, False)]
        return [(part, part in self.special) for part in self.special_split.split(text)]

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text; the special tokens' strings in it are those tokens."""
        spelt = self.spell([text])[0][0]
        return list(map(int, spelt.split(","))) if spelt else []

    def spell(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """For whole texts the ids as decimals joined by commas, and the text that they decode to, in bytes."""
        split = []
        for text in texts:
            words: list[str] = []
            for part, special in self._parts(text):
                words += [part] if special else self.split_words(part)
            split.append(words)
        kept, labels = self.words, self.emitted
        new = set(chain.from_iterable(split)).difference(kept)
        if len(kept) + len(new) > KEPT_WORDS:
            kept.clear(), labels.clear()
            new = set(chain.from_iterable(split))
        long = []
        for word in [w for w in new if len(w) > LONG_WORD or w in self.special]:
            # Words never hold a special token's string, so that is one.
            tokens = [self.special[word]] if word in self.special else self._word(word.encode())
            kept[word], labels[word] = ",".join(map(str, tokens)), b"".join(map(self.labels.__getitem__, tokens))
            new.remove(word)
            long.append(word)
        new = list(new)
        tokens, counts = self.run([w.encode() for w in new])
        tokens = tokens.tolist()
        numbers, arcs = list(map(str, tokens)), list(map(self.labels.__getitem__, tokens))
        end = 0
        for word, n in zip(new, counts.tolist()):
            kept[word], labels[word] = ",".join(numbers[end : end + n]), b"".join(arcs[end : end + n])
            end += n
        found = [(",".join(map(kept.__getitem__, words)), b"".join(map(labels.__getitem__, words))) for words in split]
        for word in long:
            del kept[word], labels[word]
        return found

    def decode(self, ids: list[int]) -> str:
        """The labels of the ids' arcs; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")

    def digests(self, texts: list[str | None]) -> list[dict[str, int | str]]:
        """For each text length and hash of the ids and hash of the text decoded from them."""
        return [
            {
                "n_tokens": ids.count(",") + 1 if ids else 0,
                "ids_sha256": hashlib.sha256(ids.encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest(),
            }
            for ids, decoded in self.spell([t or "" for t in texts])
        ]


def _odd_characters() -> tuple[re.Pattern, re.Pattern]:
    """Characters that ``re`` and the splitting library may class differently, in the lower plane and above.

    These are numbers that are no decimal digits, a few separators, and letters or digits newer than the
    tables of this Python, which the library may know or not.  It is asked itself where one occurs.
    """
    letter, digit, blank = (regex.compile(p).match for p in (r"\p{L}", r"\p{N}", r"\s"))
    odd: list[int] = []
    for c in map(chr, chain(range(0xD800), range(0xE000, sys.maxunicode + 1))):
        new = "L" if letter(c) else "N" if digit(c) else "s" if blank(c) else "o"
        own = ("N" if c.isdecimal() else "L") if c.isalnum() else "s" if c.isspace() else "o"
        if new != own or (new in "LN" and unicodedata.category(c) == "Cn"):
            odd.append(ord(c))
    return _class([c for c in odd if c < 0x10000]), _class([c for c in odd if c >= 0x10000])


def _class(codes: list[int]) -> re.Pattern:
    runs: list[list[int]] = []
    for c in codes:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]")


def load(spark: SparkSession, path: str) -> Broadcast:
    """The compiled automaton of a tokenizer file, sent to the executors; its size is the vocabulary's."""
    with open(path, encoding="utf-8") as file:
        return share(spark, Automaton(file.read()))


def encode(text: Column, automaton: Broadcast) -> Column:
    return per_text(lambda t: shared(Automaton, automaton).encode(t or ""), "array<int>")(text)


def decode(ids: Column, automaton: Broadcast) -> Column:
    """The text of an array of ids; null for null."""
    return per_text(lambda x: None if x is None else shared(Automaton, automaton).decode(x), "string")(ids)


def digest(text: Column, automaton: Broadcast) -> Column:
    kind = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"
    return per_texts(lambda texts: shared(Automaton, automaton).digests(texts), kind, LETTERS)(text)


def token_digests(docs: DataFrame, automaton: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row."""
    text_batches(docs.sparkSession)
    digests = digest(F.col(text_col), automaton).alias("d")
    return docs.select(F.col(id_col).alias("doc_id"), digests).select("doc_id", "d.*")

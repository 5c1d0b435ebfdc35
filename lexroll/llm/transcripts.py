"""Transcript parsing: a hidden Markov model over lines recovers who speaks, before canonical rendering.

States are a role at the first line of a turn and the same role further on.  A line shows three things: the
speaker's marker that it starts with, if any; its length class; and whether it asks.  Start, transition and
emission chances are counted over all transcripts with known roles, each count raised by one half.  Viterbi
finds the likeliest states; a turn begins wherever a first-line state stands.  Markers are cut off and turns
rendered in one form.

A long conversation is kept in pieces and parsed as one: the best scores through a piece are a small matrix, matrices of
neighbours are joined step by step, and the states at the pieces' borders are handed back down (``carried``).

Training counts are added up in the tasks and are some hundred numbers, whatever the input.

Defined cases: null and empty transcripts have no turns; blank lines belong to the turn they stand in.  Of equal
paths the one with the first state in the order of ``ROLES`` wins.  Repeated transcripts give equal results.
Untrained, all chances are even but for the markers, which count for their role.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexroll.llm.common import per_text, text_batches
from lexroll.operators.lineage import broadcast_if_small, written
from lexroll.operators.ranks import row_numbers

ROLES = ("system", "user", "assistant")
# Fixed: the words that name a speaker.
SPEAKERS = {
    "system": ("system", "sys", "instructions"),
    "user": ("user", "human", "customer", "prompter", "question", "q"),
    "assistant": ("assistant", "ai", "bot", "agent", "model", "answer", "a"),
}
ROLE_OF = {word: role for role, words in SPEAKERS.items() for word in words}
_WORD = "|".join(sorted(ROLE_OF, key=len, reverse=True))
MARKER = re.compile(
    rf"\s*(?:<\|(?:im_start\|>)?\s*({_WORD})\s*(?:\|>)?\s*|\[({_WORD})\]:?\s*|\*\*({_WORD}):?\*\*:?\s*|#+\s*({_WORD})\s*(?::\s*|$)|({_WORD})\s*:\s*)", re.I
)
STATES = 2 * len(ROLES)  # role i first: 2 i, further on: 2 i + 1
LENGTHS = (0, 40, 120, 300, 700)
# Turn numbers in one piece of a conversation, and rows in one part of a piece.
PIECE_TURNS = 256
PART_ROWS = 512
FAN = 64  # pieces whose scores are joined in a step


def split_marker(line: str) -> tuple[str | None, str]:
    """The role that a line's marker names and the rest of the line."""
    found = MARKER.match(line)
    if not found:
        return None, line
    word = next(g for g in found.groups() if g)
    return ROLE_OF[word.lower()], line[found.end() :]


def observe(line: str) -> tuple[int, int, int]:
    """What the model sees of a line: marker (0: none), length class, whether it asks."""
    role, rest = split_marker(line)
    rest = rest.strip()
    size = sum(len(rest) > limit for limit in LENGTHS)
    return (0 if role is None else 1 + ROLES.index(role)), size, int(rest.endswith("?"))


@dataclass(frozen=True)
class Model:
    """Logarithms of the chances: to start in a state, to go on from one to another, to show a thing."""

    start: np.ndarray
    move: np.ndarray
    shown: tuple[np.ndarray, ...]  # for each thing shown: states x values

    def _emissions(self, lines: list[str]) -> np.ndarray:
        seen = np.array([observe(line) for line in lines])
        return sum(table[:, seen[:, i]].T for i, table in enumerate(self.shown))

    def states(self, lines: list[str], enter: int | None = None, leave: int | None = None) -> list[int]:
        """The likeliest states of the lines of a transcript, or of a piece after state ``enter`` that ends in ``leave``."""
        if not lines:
            return []
        emit = self._emissions(lines)
        score, back = (self.start if enter is None else self.move[enter]) + emit[0], []
        for row in emit[1:]:
            ways = score[:, None] + self.move
            best = ways.argmax(0)
            back.append(best)
            score = ways[best, range(STATES)] + row
        path = [int(score.argmax()) if leave is None else leave]
        for best in reversed(back):
            path.append(int(best[path[-1]]))
        return path[::-1]

    def ways(self, lines: list[str], first: bool) -> np.ndarray:
        """The best scores of a piece from each state before it (rows; all alike for the first piece) to each at its end."""
        emit = self._emissions(lines)
        score = (np.repeat(self.start[None], STATES, 0) if first else self.move) + emit[0]
        for row in emit[1:]:
            score = joined(score, self.move) + row
        return score


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best scores over two pieces, one after the other."""
    return (a[:, :, None] + b[None]).max(1)


def borders(pieces: list[np.ndarray], enter: int, leave: int) -> list[tuple[int, int]]:
    """The states before and at the end of each piece on the likeliest way from ``enter`` to ``leave``."""
    scores = [pieces[0][enter]]
    for piece in pieces[1:]:
        scores.append((scores[-1][:, None] + piece).max(0))
    ends = [leave]
    for score, piece in zip(scores[-2::-1], pieces[:0:-1]):
        ends.append(int((score + piece[:, ends[-1]]).argmax()))
    ends = ends[::-1]
    return list(zip([enter, *ends], ends))


def model_from(counts: dict[tuple[str, int, int], int], weight: float = 0.5) -> Model:
    """The model of counts (kind, state, value) -> times; ``weight`` is added to each."""
    sizes = {"start": (1, STATES), "move": (STATES, STATES), "marker": (STATES, 1 + len(ROLES)), "size": (STATES, len(LENGTHS) + 1), "asks": (STATES, 2)}
    tables = {kind: np.full(shape, weight) for kind, shape in sizes.items()}
    for (kind, i, j), n in counts.items():
        tables[kind][i, j] += n
    for state in range(STATES):  # what a marker says holds without training too
        tables["marker"][state, 1 + state // 2] += weight * (4 if state % 2 == 0 else 0)
        tables["marker"][state, 0] += weight * 4
        for other in range(STATES):  # a line further on follows a line of its own turn
            if other % 2 and other // 2 != state // 2:
                tables["move"][state, other] = 1e-9
    tables["start"][0, 1::2] = 1e-9
    logs = {k: np.log(t / t.sum(1, keepdims=True)) for k, t in tables.items()}
    return Model(logs["start"][0], logs["move"], (logs["marker"], logs["size"], logs["asks"]))


def lines_of(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def turns_of(text: str | None, model: Model, enter: int | None = None, leave: int | None = None) -> list[tuple[str, str, bool]]:
    """(role, text, goes_on) of the turns of one whole transcript, or of a piece between two states; ``goes_on`` tells
    that the turn began in the piece before."""
    turns: list[tuple[str, list[str], bool]] = []
    lines = lines_of(text) if enter is None else (text or "").split("\n")
    for line, state in zip(lines, model.states(lines, enter, leave)):
        if state % 2 == 0 or not turns:
            turns.append((ROLES[state // 2], [], state % 2 == 1))
            role, rest = split_marker(line)
            line = rest if role == ROLES[state // 2] and state % 2 == 0 else line
        turns[-1][1].append(line)
    return [(role, "\n".join(own).strip(), goes_on) for role, own, goes_on in turns]


def known_states(turns: list[tuple[str, str]]) -> list[tuple[str, int]]:
    """(line, state) of turns (role, text as shown) whose roles are known."""
    out = []
    for role, text in turns:
        state = 2 * ROLES.index(role)
        out += [(line, state + (i > 0)) for i, line in enumerate((text or "").split("\n"))]
    return out


def count_known(lines: list[tuple[str, int]], counts: Counter, previous: int | None = None) -> None:
    """Count what lines of known states show; ``previous`` is the state before them, if they are no start."""
    for line, state in lines:
        for kind, value in zip(("marker", "size", "asks"), observe(line)):
            counts[kind, state, value] += 1
        counts[("start", 0, state) if previous is None else ("move", previous, state)] += 1
        previous = state


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for turns, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            last = known_states([(before["role"], before["shown"])])[-1][1] if before else None
            count_known(known_states([(t["role"], t["shown"]) for t in turns]), counts, last)
    keys = list(counts)
    columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], names=["kind", "i", "j", "n"])


def learn_model(known: DataFrame, turns_col: str = "turns", before_col: str = "before") -> Model:
    """The model counted over all transcripts with known turns, arrays of (role, shown); ``before`` has the turn before."""
    text_batches(known.sparkSession)
    before = F.col(before_col) if before_col in known.columns else F.lit(None).cast("struct<role: string, shown: string>")
    counts = known.select(turns_col, before).mapInArrow(_counter, "kind string, i int, j int, n long")
    rows = counts.groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).collect()  # as many as the tables have cells
    return model_from({(r["kind"], r["i"], r["j"]): r["n"] for r in rows})


def parse(text: Column, model: Model, enter: Column | None = None, leave: Column | None = None) -> Column:
    """The turns of a transcript: array of (role, text, goes_on)."""
    nothing = F.lit(None).cast("int")
    piece = F.struct(text.alias("text"), (nothing if enter is None else enter).alias("enter"), (nothing if leave is None else leave).alias("leave"))
    found = lambda p: [{"role": r, "text": x, "goes_on": g} for r, x, g in turns_of(p["text"], model, p["enter"], p["leave"])]
    return per_text(found, "array<struct<role: string, text: string, goes_on: boolean>>")(piece)


def rendered(turns: Column) -> Column:
    """Turns in one form: a line ``<|role|>``, unless the turn goes on from the piece before, then the text."""
    head = lambda t: F.when(t["goes_on"], "").otherwise(F.concat(F.lit("<|"), t["role"], F.lit("|>\n")))
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), t["text"], F.lit("\n"))), "")


def parse_transcripts(transcripts: DataFrame, model: Model, id_cols: tuple[str, ...] = ("conv_id",), text_col: str = "text") -> DataFrame:
    """The ids, ``turns`` and ``rendered`` for every row."""
    text_batches(transcripts.sparkSession)
    parsed = transcripts.select(*id_cols, parse(F.col(text_col), model).alias("turns"))
    return parsed.withColumn("rendered", rendered(F.col("turns")))


def logs_of(conversations: DataFrame) -> DataFrame:
    """Chat logs (conv_id, piece, part, turns, text) of a table of turns (conv_id, turn, role, text).

    Each conversation is written in one of five styles, and a sixth of the turns after the first lack their
    marker, by hashes of ids.  A conversation is one transcript, whatever its length, kept in pieces of ``PIECE_TURNS`` turn
    numbers and parts of ``PART_ROWS`` rows in their order, so no row and no group grows with the table.  ``seq``
    numbers a conversation's pieces, and ``before`` has the turn before a piece; ``carried`` hands states over.  Rows
    without a conversation or turn number are logs of their own; repeated rows are kept, next to one another.
    Roles unknown to the model are the user's.
    """
    role = F.when(F.col("role").isin(*ROLES), F.col("role")).otherwise("user")
    rows = conversations.select("conv_id", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    lost = rows.where(alone).withColumn("piece", F.coalesce(F.floor(F.col("turn") / PIECE_TURNS), F.lit(0)))
    lost = lost.withColumn("part", F.xxhash64("turn", "role", "text"))
    placed = rows.where(~alone).withColumn("piece", F.floor(F.col("turn") / PIECE_TURNS))
    placed = row_numbers(placed, ["conv_id", "piece"], ["turn", "role", "text"], "n", 8 * PART_ROWS)
    rows = placed.withColumn("part", F.floor((F.col("n") - 1) / PART_ROWS)).drop("n").unionByName(lost)
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    name = F.initcap("role")
    other = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise("System")
    marker = (
        F.when(style == 0, F.concat(name, F.lit(": "))).when(style == 1, F.concat(other, F.lit(": ")))
        .when(style == 2, F.concat(F.lit("### "), name, F.lit(":\n"))).when(style == 3, F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
        .otherwise(F.concat(F.lit("["), F.upper("role"), F.lit("] ")))
    )
    bare = (F.col("turn") > 0) & (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)) == 0)
    shown = rows.withColumn("shown", F.when(F.coalesce(bare, F.lit(False)), F.col("text")).otherwise(F.concat(marker, "text")))
    logs = shown.groupBy("conv_id", "piece", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "shown"))).alias("turns"))
    logs = written(logs.withColumn("text", F.array_join(F.transform("turns", lambda t: t["shown"]), "\n")))
    alone = F.col("conv_id").isNull() | F.exists("turns", lambda t: t["turn"].isNull())
    keys = logs.where(~alone).select("conv_id", "piece", "part", F.element_at("turns", -1).alias("last"))
    numbered = written(row_numbers(keys, ["conv_id"], ["piece", "part"], "seq"))
    before = F.struct(F.col("last.role").alias("role"), F.col("last.shown").alias("shown"))
    ends = numbered.select("conv_id", (F.col("seq") + 1).alias("seq"), before.alias("before"))
    known = numbered.drop("last").join(ends, ["conv_id", "seq"], "left")
    return logs.join(known, ["conv_id", "piece", "part"], "left").withColumn("seq", F.coalesce("seq", F.lit(1)).cast("long"))


def carried(logs: DataFrame, model: Model) -> DataFrame:
    """``logs`` with the states ``enter`` before and ``leave`` at the end of each piece of a longer conversation.

    The best scores through a piece, from each state before it to each at its end, are a small matrix; those of pieces one
    after another are joined, ``FAN`` at a time, until one is left for the whole conversation.  Its likeliest end is then
    handed down, step by step, to the borders of all pieces.  This is Viterbi's path over the whole; of equal paths
    sums in another order may prefer another one.  Single pieces have no borders.
    """
    more = broadcast_if_small(written(logs.where("conv_id IS NOT NULL AND seq > 1").select("conv_id").distinct()))
    pieces = logs.join(more, "conv_id", "left_semi")
    through = lambda p: model.ways((p["text"] or "").split("\n"), p["seq"] == 1).ravel().tolist()
    base = pieces.select("conv_id", (F.col("seq") - 1).alias("k"), per_text(through, "array<double>")(F.struct("text", "seq")).alias("m"))
    square = lambda m: np.array(m).reshape(STATES, STATES)

    def join_all(found: list) -> list[float]:
        whole = square(found[0])
        for m in found[1:]:
            whole = joined(whole, square(m))
        return whole.ravel().tolist()

    levels = []
    level = written(base)
    while (level.agg(F.max("k")).first()[0] or 0) > 0:
        up = F.floor(F.col("k") / FAN).alias("k")
        own = level.groupBy("conv_id", up).agg(F.sort_array(F.collect_list(F.struct("k", "m"))).alias("found"))
        own = written(own.select("conv_id", "k", F.transform("found", lambda f: f["m"]).alias("found")))
        levels.append(own)
        level = written(own.select("conv_id", "k", per_text(join_all, "array<double>")(F.col("found")).alias("m")))
    if not levels:
        return logs.withColumn("enter", F.lit(None).cast("int")).withColumn("leave", F.lit(None).cast("int"))
    # The first piece does not look at the state before it, so any will do.
    leave = per_text(lambda m: int(square(m)[0].argmax()), "int")(F.col("m"))
    known = level.select("conv_id", "k", F.lit(0).alias("enter"), leave.alias("leave"))
    split = lambda p: [{"enter": a, "leave": b} for a, b in borders([square(m) for m in p["found"]], p["enter"], p["leave"])]
    for own in reversed(levels):
        asked = own.join(known, ["conv_id", "k"])
        ends = per_text(split, "array<struct<enter: int, leave: int>>")(F.struct("found", "enter", "leave"))
        handed = asked.select("conv_id", (F.col("k") * FAN).alias("k"), F.posexplode(ends).alias("i", "b"))
        known = written(handed.select("conv_id", (F.col("k") + F.col("i")).alias("k"), "b.enter", "b.leave"))
    found = known.select("conv_id", (F.col("k") + 1).alias("seq"), "enter", "leave")
    return logs.join(found, ["conv_id", "seq"], "left")


def right_lines(turns: list[dict], model: Model, enter: int | None = None, leave: int | None = None) -> dict:
    """Of the lines of known turns, how many there are and how many the model gives their role."""
    lines = known_states([(t["role"], t["shown"]) for t in turns or []])
    found = model.states([line for line, _ in lines], enter, leave)
    return {"n_lines": len(lines), "n_right": sum(a // 2 == b // 2 for a, (_, b) in zip(found, lines))}

"""Token counts under a unigram vocabulary, without building the tokens.

Aho-Corasick enumerates the pieces that end at each letter of a word.  Going through the letters, dynamic
programming carries the best score of the text so far and the number of pieces that reach it.  Ties and
unknown letters follow the tokenizer: of equal scores the piece that starts first stays, a letter that is no
piece itself scores ten less than the least piece, and counts as its bytes where the vocabulary has byte
pieces; otherwise a run of such letters is one piece.  (Such a run is never a piece itself: with a negative
least score the piece would have won.)

Texts are split before each blank, a blank is the letter U+2581, and one stands before the text.

Defined cases: null and empty texts have no tokens.  Repeated rows count alike.  Words may have any length;
work follows it.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict

import ahocorasick
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.llm.common import per_text, share, shared, text_batches

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 100_000
LONG_WORD = 64


class Unigram:
    """Pieces with their scores; ``byte_pieces`` tells that unknown letters are spelt in bytes."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool = True) -> None:
        self.matches = ahocorasick.Automaton()
        # The last of equal pieces counts, as in a table of pieces.
        for piece, score in pieces:
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.letters = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        self.words: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        if not self.letters.issuperset(word):
            return self._count_with_unknown(word)
        best, count = [0.0] * (len(word) + 1), [0] * (len(word) + 1)
        last = -1
        # By ascending end, the longest piece first; it starts first, and only a better one takes its place.
        for end, (size, own) in self.matches.iter(word):
            start = end + 1 - size
            score = best[start] + own
            if end != last or score > best[end + 1]:
                best[end + 1] = score
                count[end + 1] = count[start] + 1
                last = end
        return count[-1]

    def _count_with_unknown(self, word: str) -> int:
        ends: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for end, piece in self.matches.iter(word):
            ends[end + 1].append(piece)
        best, count, open_run = [0.0], [0], [False]
        for end in range(1, len(word) + 1):
            score = pieces = None
            run = False
            # The longest piece starts first, and only a better one takes its place.
            for size, own in sorted(ends[end], reverse=True):
                if score is None or own + best[end - size] > score:
                    score, pieces = own + best[end - size], count[end - size] + 1
            letter = word[end - 1]
            if letter not in self.letters and (score is None or self.unknown + best[end - 1] > score):
                score = self.unknown + best[end - 1]
                if self.byte_pieces:
                    pieces = count[end - 1] + len(letter.encode("utf-8", "surrogatepass"))
                else:
                    run, pieces = True, count[end - 1] + (not open_run[end - 1])
            best.append(score)
            count.append(pieces)
            open_run.append(run)
        return count[-1]

    def count(self, text: str | None) -> int:
        """The number of tokens of a whole text."""
        if not text:
            return 0
        text = text.replace(" ", BLANK)
        words = SPLIT.findall(text if text.startswith(BLANK) else BLANK + text)
        kept = self.words
        new = set(words).difference(kept)
        if len(kept) + len(new) > KEPT_WORDS:
            kept.clear()
            new = set(words)
        for word in new:
            kept[word] = self.count_word(word)
        total = sum(map(kept.__getitem__, words))
        for word in new:
            if len(word) > LONG_WORD:
                del kept[word]
        return total


SPLIT = re.compile(f"{BLANK}[^{BLANK}]*")


def load(spark: SparkSession, path: str) -> Broadcast:
    """The pieces of a sentence-piece file, scored as the file says, sent to the executors."""
    return share(spark, Unigram(*pieces_of(path)))


def pieces_of(path: str) -> tuple[list[tuple[str, float]], bool]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in numbers]
    return pieces, sum(map(model.is_byte, numbers)) == 256


def token_counts(docs: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) for every row."""
    text_batches(docs.sparkSession)
    counted = per_text(lambda t: shared(Unigram, model).count(t), "bigint")
    return docs.select(F.col(id_col).alias("doc_id"), counted(F.col(text_col)).alias("n_tokens"))

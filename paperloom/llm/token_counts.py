"""Token counts under a unigram vocabulary: a Viterbi that carries counts only.

An Aho-Corasick automaton lists every piece that occurs in a stretch of text. Dynamic
programming over its places keeps the best score and how many pieces it took; no
segmentation is built. The rules are those of unigram tokenizers: of equal scores the
one found first wins, that is the one whose last piece is longest; an unknown character
costs ten less than the worst piece, and counts as its UTF-8 bytes if the vocabulary
has byte pieces, else neighbouring ones as one.

White space becomes the mark U+2581 and one is put in front. No piece of the vocabulary
has a mark after another character, so every run of marks starts a stretch of its own
and stretches are counted once per batch of texts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Stretches whose counts a task remembers.
REMEMBERED = 300_000
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_STRETCH = re.compile(f"{MARK}*[^{MARK}]*")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; ``bytes_known`` if every byte is a piece."""

    pieces: dict[str, float]
    bytes_known: bool

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Pieces and scores of a SentencePiece file; control, unknown and byte pieces match no text."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = {
            model.id_to_piece(i): float(model.get_score(i))
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        }
        return cls(plain, sum(model.is_byte(i) for i in ids) == 256)

    def separable(self) -> bool:
        return not any(MARK in p.lstrip(MARK) for p in self.pieces)


class Counter:
    """Counts tokens of texts under one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_known = vocabulary.bytes_known
        self.separable = vocabulary.separable()
        self.unknown = min(vocabulary.pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        self.known = bool(vocabulary.pieces)
        self.single = frozenset(p for p in vocabulary.pieces if len(p) == 1)
        self.seen: dict[str, int] = {}

    def stretch(self, text: str) -> int:
        """Pieces of the best segmentation of ``text``."""
        n = len(text)
        if self.single.issuperset(text):  # no unknown characters; of matches with one end the longest comes first
            tops, pieces = [0.0] + [-math.inf] * n, [0] * (n + 1)
            for end, (size, score) in self.automaton.iter(text):
                total = tops[end + 1 - size] + score
                if total > tops[end + 1]:
                    tops[end + 1], pieces[end + 1] = total, pieces[end + 1 - size] + 1
            return pieces[n]
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        if self.known:
            for end, piece in self.automaton.iter(text):
                ending[end + 1].append(piece)
        best, count, loose = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for at in range(1, n + 1):
            top, pieces, open_end = None, 0, False
            matches = ending[at]
            for size, score in sorted(matches, reverse=True):  # the longest first: its place was reached first
                total = best[at - size] + score
                if top is None or total > top:
                    top, pieces, open_end = total, count[at - size] + 1, False
            if not matches or matches[0][0] != 1 and all(size != 1 for size, _ in matches):
                total = best[at - 1] + self.unknown
                if top is None or total > top:
                    if self.bytes_known:
                        more = len(text[at - 1].encode("utf-8", "surrogatepass"))
                    else:
                        more = 0 if loose[at - 1] else 1
                    top, pieces, open_end = total, count[at - 1] + more, True
            best[at], count[at], loose[at] = top, pieces, open_end
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if not self.separable:
            return self.stretch(marked)
        total, seen = 0, self.seen
        for part in _STRETCH.findall(marked):
            if part:
                found = seen.get(part)
                if found is None:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    found = seen[part] = self.stretch(part)
                total += found
        return total


def token_counts(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``doc_id, n_tokens`` for each row of ``docs``, the whole text counted.

    Null and empty texts have no tokens. Null ids pass through, repeated rows repeat,
    an empty table gives no rows, and other columns are ignored. ``model`` must be
    readable on every executor.
    """
    source = docs.select("doc_id", "text")

    def run(batches):
        counter = Counter(Vocabulary.load(model))
        for batch in batches:
            counts = [counter.count(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens long")

"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic
programming keeps the best score and the number of pieces per position, without the pieces.

The scores are those that the vocabulary file stores. Tie rule of unigram tokenizers: candidates
for a position come in order of their start and only a strictly better score replaces one, so the
longest piece wins a tie. A character without a piece of its own scores the lowest score less 10;
it counts as its bytes where the vocabulary has all byte pieces, else a run of such characters is
one unknown.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

SPACE = "▁"      # stands for a blank, and opens every text that is not empty
UNKNOWN_PENALTY = 10.0
SEGMENTS = 400_000    # counted segments a worker remembers
_COUNTERS: dict[str, Counter] = {}


class Counter:
    """Counts of one vocabulary: a list of (piece, score), and whether it has all byte pieces."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool) -> None:
        self.bytes = byte_pieces
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.finder = ahocorasick.Automaton()
        for piece, score in pieces:
            self.finder.add_word(piece, (len(piece), score))
        self.finder.make_automaton()
        # a text may be cut before a blank that follows another character if no piece spans this
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p, _ in pieces)
        self.known: dict[str, tuple[int, bool, bool]] = {}

    def segment(self, text: str) -> tuple[int, bool, bool]:
        """Pieces on the best path, and whether it begins and ends with an unknown character.
        `best[e]` is (score, pieces, unknown) of the best path to e."""
        n, floor = len(text), float("-inf")
        best: list[tuple[float, int, bool]] = [(0.0, 0, False)] + [(floor, 0, False)] * n
        opens, at = False, 0
        single = [False] * n

        def unknown(e: int) -> None:  # the candidate with the latest start, so it comes last
            nonlocal opens
            score, pieces, after = best[e - 1]
            if not single[e - 1] and score + self.unknown > best[e][0]:
                size = len(text[e - 1].encode("utf-8", "replace")) if self.bytes else int(not after)
                best[e] = score + self.unknown, pieces + size, True

        for end, (size, score) in self.finder.iter(text):  # per end, the longest piece first
            end += 1
            while at < end - 1:
                at += 1
                unknown(at)
            before = best[end - size]
            if size == 1:
                single[end - 1] = True
            if before[0] + score > best[end][0]:
                best[end] = before[0] + score, before[1] + 1, False
        while at < n:
            at += 1
            unknown(at)
        if not self.bytes and n:
            opens = self._opens(text)
        return best[n][1], opens, best[n][2]

    def _opens(self, text: str) -> bool:
        """A segment opens with an unknown character if no piece is a prefix of it."""
        return not any(end + 1 == size for end, (size, _) in self.finder.iter(text))

    def count(self, text: str | None) -> int:
        """Pieces of one whole text; null and empty texts have none."""
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.cuts:
            return self.segment(marked)[0]
        total, after, known = 0, False, self.known
        for part in segments(marked):
            found = known.get(part)
            if found is None:
                found = self.segment(part)
                if len(part) <= 64:
                    if len(known) >= SEGMENTS:
                        known.clear()
                    known[part] = found
            total += found[0] - (after and found[1] and not self.bytes)
            after = found[2]
        return total


def segments(marked: str) -> list[str]:
    """Cuts before every blank that follows another character."""
    out, lead = [], ""
    for word in marked.split(SPACE)[1:]:
        lead += SPACE
        if word:
            out.append(lead + word)
            lead = ""
    return out + ([lead] if lead else [])


def vocabulary(model: bytes) -> tuple[list[tuple[str, float]], bool]:
    """Pieces and scores of a stored model, without control, unknown and byte pieces."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = range(m.get_piece_size())
    plain = [k for k in ids if not (m.is_control(k) or m.is_unknown(k) or m.is_byte(k))]
    return ([(m.id_to_piece(k), m.get_score(k)) for k in plain],
            sum(map(m.is_byte, ids)) == 256)


def counter(model: bytes) -> Counter:
    key = hashlib.sha256(model).hexdigest()
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(*vocabulary(model))
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """`key`, `n_tokens` and `n_chars` of every row's whole text; null and empty texts count 0.

    One row per input row, in the scan's own partitions; repeated rows and null keys stay, other
    columns are not read. A worker's memory follows the longest text without a blank.
    """
    with open(path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, under 1 MB

    @pandas_udf("bigint")
    def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = counter(model.value)
        for texts in parts:
            yield pd.Series([counts.count(t) for t in texts], dtype="int64")

    body = docs[f"`{text}`"]
    return docs.select(docs[f"`{key}`"].alias(key), tokens(body).alias("n_tokens"),
                       F.coalesce(F.char_length(body), F.lit(0)).cast("bigint").alias("n_chars"))

"""Byte-level BPE by prefix dynamic programming.

Every prefix of a piece has one valid last token, so a piece's encoding is an array with that token
for each prefix. A token is valid after another when merging the two byte strings by rank keeps
their border. The array makes appends exact (go on where it ends) and lets an edit be re-encoded
from its place until the array meets its old values again.

`encode` and `decode` are the DataFrame operators; `Encoded` is one text that grows or is edited.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.batches import keep, slices

PIECES = 600_000      # encoded pieces a worker remembers
PAIRS = 1_000_000     # judged token pairs a worker remembers
NEVER = 1 << 60


def read_ranks(path: str) -> bytes:
    """The rank file as it is; it is a bounded vocabulary (under 1 MB), not data."""
    with open(path, "rb") as f:
        return f.read()


class Table:
    """Ranks of byte strings with the prefix encoding of pieces."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.ranks = {base64.b64decode(k): int(v)
                      for k, v in (line.split() for line in ranks.splitlines() if line)}
        self.bytes = {v: k for k, v in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.split = regex.compile(pattern).finditer
        self.cut = regex.compile(pattern).findall
        self.finder = ahocorasick.Automaton()
        for key, rank in self.ranks.items():
            self.finder.add_word(key.decode("latin-1"), (rank, len(key)))
        self.finder.make_automaton()
        self.trees: dict[int, tuple[int, int] | None] = {}
        self.left: dict[int, list[int]] = {}
        self.right: dict[int, list[int]] = {}
        self.judged: dict[int, bool] = {}
        self.known = Known(self)

    def tree(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of this token's bytes joins; a byte has itself twice.
        None if its bytes never merge to it."""
        if token not in self.trees:
            parts = [bytes([b]) for b in self.bytes[token]]
            last = (token, token) if len(parts) == 1 else None
            while len(parts) > 1:
                rank, at = min((self.ranks.get(parts[k] + parts[k + 1], NEVER), k)
                               for k in range(len(parts) - 1))
                if rank == NEVER:
                    last = None
                    break
                last = self.ranks[parts[at]], self.ranks[parts[at + 1]]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.trees[token] = last
        return self.trees[token]

    def spine(self, token: int, side: int) -> list[int]:
        """The tokens at one border of a token while it is merged, from its byte to itself."""
        chain = [token]
        while len(self.bytes[chain[-1]]) > 1:
            chain.append(self.tree(chain[-1])[side])
        return chain[::-1]

    def fits(self, a: int, b: int) -> bool:
        """Whether b can start a piece (a is -1) or follow a: whether the border between two tokens survives the merges: no merge across it comes
        before the next merge on its left (which wins a tie) or after it (which loses one)."""
        if self.tree(b) is None:
            return False
        if a < 0:
            return True
        xs = self.right.get(a) or self.right.setdefault(a, self.spine(a, 1))
        ys = self.left.get(b) or self.left.setdefault(b, self.spine(b, 0))
        i = j = 0
        while True:
            across = self.ranks.get(self.bytes[xs[i]] + self.bytes[ys[j]], NEVER)
            before = xs[i + 1] if i + 1 < len(xs) else NEVER
            after = ys[j + 1] if j + 1 < len(ys) else NEVER
            if across < before and across <= after:
                return False
            if before == after == NEVER:
                return True
            if before <= after:
                i += 1
            else:
                j += 1

    def prefixes(self, piece: bytes, last: list[int | None] | None = None) -> list[int | None]:
        """The last token of every prefix of a piece, at the prefix's length. `last` holds those of
        a beginning that is already encoded; only the rest is computed."""
        last = last or [None]
        done = len(last) - 1
        last += [None] * (len(piece) - done)
        start = max(0, done - self.longest + 1)
        judged = self.judged
        for end, (token, size) in self.finder.iter(piece[start:].decode("latin-1")):
            end += start + 1
            if end > done and last[end] is None:
                a = last[end - size] if end > size else -1
                pair = (a + 1) << 32 | token
                good = judged.get(pair)
                if good is None:
                    if len(judged) >= PAIRS:
                        judged.clear()
                    good = judged[pair] = self.fits(a, token)
                if good:
                    last[end] = token
        return last

    def walk(self, last: list[int | None]) -> list[int]:
        """The tokens of a piece, read backwards from its array."""
        at, out = len(last) - 1, []
        while at:
            out.append(last[at])
            at -= len(self.bytes[last[at]])
        return out[::-1]

    def piece(self, text: str) -> list[int]:
        """The ids of one match of the pattern; a match that is itself a token is that token."""
        raw = text.encode()
        whole = self.ranks.get(raw)
        return [whole] if whole is not None else self.walk(self.prefixes(raw))

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.cut(text)))


class Known(dict):
    """Pieces that a worker has encoded, as 32-bit ids; forgotten when there are too many."""

    def __init__(self, table: Table) -> None:
        self.table = table

    def __missing__(self, text: str) -> bytes:
        ids = array("i", self.table.piece(text)).tobytes()
        if len(text) <= 64:
            if len(self) >= PIECES:
                self.clear()
            self[text] = ids
        return ids


class Encoded:
    """One text with its ids, kept exact while it grows or is edited.

    Pieces that an edit cannot reach keep their ids; inside the piece that is appended to, the
    prefix array goes on where it ended.
    """

    def __init__(self, table: Table, text: str = "") -> None:
        self.table, self.text = table, ""
        self.ends: list[int] = []
        self.pieces: list[list[int]] = []
        self.encoded = 0  # pieces that were encoded so far, reused ones not counted
        self.tail: tuple[bytes, list[int | None]] = (b"", [None])
        self.replace(0, 0, text)

    def ids(self) -> list[int]:
        return [x for p in self.pieces for x in p]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Replaces text[start:end]. Matching depends on the text to the right of a border alone,
        so all is as before left of the last border that the edit cannot influence, and again from
        the first new border that is an old one behind the edit."""
        old, text = self.text, self.text[:start] + new + self.text[end:]
        reach = start
        while reach and old[reach - 1].isspace():  # a match of spaces looks to the end of the run
            reach -= 1
        keep = sum(1 for e in self.ends if e < reach)
        keep = max(0, keep - 1)
        at = self.ends[keep - 1] if keep else 0
        shift = len(text) - len(old)
        later = {e + shift: k for k, e in enumerate(self.ends) if e >= end}
        ends, pieces, rest = self.ends[:keep], self.pieces[:keep], len(self.ends)
        for match in self.table.split(text, at):
            if match.start() in later and match.start() >= start + len(new):
                rest = later[match.start()] + 1
                break
            ends.append(match.end())
            pieces.append(self._piece(match[0]))
        self.ends = ends + [e + shift for e in self.ends[rest:]]
        self.pieces = pieces + self.pieces[rest:]
        self.text = text

    def _piece(self, text: str) -> list[int]:
        self.encoded += 1
        raw, (before, last) = text.encode(), self.tail
        last = self.table.prefixes(raw, list(last) if raw.startswith(before) else None)
        self.tail = raw, last
        whole = self.table.ranks.get(raw)
        return [whole] if whole is not None else self.table.walk(last)


def table(ranks: bytes, pattern: str) -> Table:
    """The table of a rank file, built once in each worker until other operators use that."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    return keep(f"bpe {key}", lambda: Table(ranks, pattern))


def _column(docs: DataFrame, name: str) -> F.Column:
    return docs[f"`{name}`"]


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """`key` and `ids` (array of token ids) of every row's whole text; a null text is empty.

    One row per input row: repeated rows and null keys stay; other columns are not read. Texts are
    encoded in the scan's own partitions, without a shuffle. A worker's memory follows the longest
    text of its slice, a piece longer than any limit is encoded by the same array.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(path))
    rows = docs.select(_column(docs, key).alias("key"),
                       F.coalesce(_column(docs, text), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField(key, rows.schema["key"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = table(ranks.value, pattern)
        for batch in slices(batches):
            ids = [bpe.encode(value) for value in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]) // 4
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                             pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), lists], [key, "ids"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id",
           ids: str = "ids") -> DataFrame:
    """`encoded` with `decoded` (binary), the bytes of its ids; null ids have no bytes. An id
    outside the vocabulary is an error, not a gap."""
    spark = encoded.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(path))
    kept = encoded.select(_column(encoded, key).alias("key"), _column(encoded, ids).alias("ids"))
    schema = T.StructType([T.StructField(key, kept.schema["key"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table(ranks.value, pattern).bytes
        words = [known[k] for k in range(len(known))] if len(known) == max(known) + 1 else known
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                lists = part.column("ids")
                ends = np.cumsum(pa.compute.fill_null(
                    pa.compute.list_value_length(lists), 0).to_numpy()).tolist()
                parts = [words[k] for k in lists.flatten().to_numpy().tolist()]
                texts = [b"".join(parts[a:b]) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("ids"), pa.array(texts, pa.binary())],
                    [key, "ids", "decoded"])

    return kept.mapInArrow(run, schema)

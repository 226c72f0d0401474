import random

import pytest
from tokenizers import Tokenizer, models

from playmart.llm import queries, tokencount as C
from tests.conftest import tuples
from tests.llm.conftest import AWKWARD

PATH = queries.tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as f:
        return C.vocabulary(f.read())


def library(pieces, byte_pieces):
    low = min(s for _, s in pieces)
    extra = [(f"<0x{k:02X}>", low) for k in range(256)] if byte_pieces else []
    return Tokenizer(models.Unigram([("<unk>", 0.0)] + extra + pieces, 0, byte_fallback=byte_pieces))


def marked(text):
    return "▁" + text.replace(" ", "▁") if text else ""


def small(pieces):
    """A vocabulary whose equal scores make ties everywhere, with a piece across a blank."""
    return [("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0),
            ("▁a", -3.0), ("c", -1.0), ("b▁a", -3.0), ("▁▁", -4.0)]


@pytest.mark.parametrize("byte_pieces", [True, False])
@pytest.mark.parametrize("kind", ["file", "ties"])
def test_counts_equal_the_library(pieces, byte_pieces, kind):
    vocabulary = pieces[0] if kind == "file" else small(pieces)
    counter, tokenizer = C.Counter(vocabulary, byte_pieces), library(vocabulary, byte_pieces)
    assert counter.cuts == (kind == "file")
    rng = random.Random(5)
    parts = ["a", "b", "ab", " ", "  ", "\n", "é", "日本", "龘", "the", "ing", "1", "🤣", "c", "\t"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert counter.count(text) == len(tokenizer.encode(marked(text)).ids), text


def test_rows(spark, docs, pieces):
    tokenizer = library(pieces[0], True)
    df = docs(AWKWARD).withColumnRenamed("lang", "n_tokens")
    got = sorted(tuples(C.count_tokens(df, PATH)), key=str)
    want = [(i, len(tokenizer.encode(marked(t or "")).ids), len(t or "")) for i, t in AWKWARD]
    assert got == sorted(want, key=str)
    assert C.count_tokens(docs([]), PATH).count() == 0

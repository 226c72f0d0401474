import base64
import random

import public_tokenizers
import pytest
import tiktoken

from playmart.llm import bpe, queries
from tests.conftest import tuples
from tests.llm.conftest import AWKWARD

PATH, PATTERN = queries.bpe_settings()


@pytest.fixture(scope="module")
def table():
    return bpe.table(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def reference(table):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table.ranks, special_tokens={})


PARTS = ["a", "b", " ", "  ", "\n", "é", "ß", "日本", "the", " the", "ing", "'s", "1", "!!", "🤣",
         "aaaa", " " * 9, "\t\n", "Ⅷ", "​", "<|endoftext|>"]


def test_every_prefix_has_the_token_of_the_merged_text(table, reference):
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        assert bpe.Encoded(table, text).ids() == reference.encode_ordinary(text)
    for text in ("ab" * 20_000, " " * 5_000 + "x", "\n" * 3_000):
        ids = bpe.np.frombuffer(table.encode(text), bpe.np.int32).tolist()
        assert ids == reference.encode_ordinary(text)


def test_tokens_of_the_vocabulary_encode_as_the_library_does(table, reference):
    for token in random.Random(2).sample(sorted(table.bytes), 3000):
        raw = table.bytes[token]
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        assert bpe.Encoded(table, text).ids() == reference.encode_ordinary(text)


def test_appends_and_edits_equal_a_new_encoding(table, reference):
    rng = random.Random(3)
    for _ in range(300):
        e = bpe.Encoded(table, "".join(rng.choice(PARTS) for _ in range(20)))
        for _ in range(5):
            i = rng.randint(0, len(e.text))
            j = min(len(e.text), i + rng.randint(0, 5))
            e.replace(i, j, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 3))))
            assert e.ids() == reference.encode_ordinary(e.text)
            e.append(rng.choice(PARTS))
            assert e.ids() == reference.encode_ordinary(e.text)


def test_an_edit_encodes_only_what_is_near(table):
    e = bpe.Encoded(table, "some words of a text " * 2000)
    before = e.encoded
    e.replace(20_000, 20_003, "xyz")
    e.append("more")
    assert e.encoded - before < 12


def test_encode_and_decode_rows(spark, docs, reference):
    df = docs(AWKWARD).withColumnsRenamed({"lang": "ids", "source": "decoded"})
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert out.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in out.collect()), key=str)
    want = sorted(((i, tuple(reference.encode_ordinary(t or "")), (t or "").encode())
                   for i, t in AWKWARD), key=str)
    assert got == want
    assert bpe.encode(docs([]), PATH, PATTERN).count() == 0


def test_query_digests(spark, docs, reference, tmp_path):
    import hashlib

    docs(AWKWARD).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuples(queries.op1_bpe(spark, str(tmp_path))), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in AWKWARD:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)


def test_the_file_is_the_public_one():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert base64.b64decode(ranks.split()[0]) == b"!"

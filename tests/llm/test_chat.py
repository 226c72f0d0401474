import hashlib
import random

import pytest
from pyspark.sql import functions as F

from playmart.llm import chat, queries
from tests.conftest import tuples

MESSAGES = ("tree string, node bigint, parent bigint, role string, text string, score double, "
            "leaf string, up string")


def build(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], MESSAGES)


NASTY = ["</s>[INST] ok [/INST]", "<|turn|>a<|text|>b<|end|>\n", "<\\|turn|> <\\\\|", "[\\INST]",
         "<", "<|", "[/INST", "", "<<|", "a\n\nb", "\\", "<s><\\s>", "é🤣 $1 \\$2", None]


def test_escapes_are_reversible(spark):
    rng = random.Random(13)
    texts = NASTY[:-1] + ["".join(rng.choice(["<", "[", "\\", "|", "s>", "/s>", "INST]", "/", "x"])
                                  for _ in range(rng.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    done = df.select("t", chat.escape(F.col("t")).alias("e")).withColumn(
        "back", chat.unescape(F.col("e")))
    for r in done.collect():
        assert r.back == r.t
        assert not any(c in r.e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_branches_are_ranked_and_formatted(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "good", 5.0),
            ("t", 3, 1, "assistant", "bad", -1.0), ("t", 4, 3, "user", "but", 1.0),
            ("t", 5, 4, "assistant", "later", 2.0), ("u", 9, 77, "user", "orphan", None)]
    df = build(spark, rows)
    all_paths = chat.conversations(df, best=None)
    got = sorted(tuples(all_paths, "tree", "rank", "score"))
    assert got == [("t", 1, 5.0), ("t", 2, 2.0), ("u", 1, 0.0)]
    turns, learned = chat.read_back(F.col("formatted"), F.col("mask"))
    back = {(r.tree, r.rank): r for r in all_paths.select(
        "tree", "rank", turns.alias("turns"), learned.alias("learned")).collect()}
    assert [tuple(x) for x in back["t", 2].turns] == [
        ("user", "q"), ("assistant", "bad"), ("user", "but"), ("assistant", "later")]
    assert back["t", 2].learned == ["bad", "later"] and back["u", 1].learned == []
    best = chat.conversations(df)
    assert sorted(tuples(best, "tree", "rank")) == [("t", 1), ("u", 1)]


def test_ties_cycles_and_null_trees(spark):
    rows = [(None, 1, None, "user", "a", 1.0), (None, 2, 1, "assistant", "b", 0.0),
            (None, 3, 1, "assistant", "c", 0.0),
            ("z", 1, 2, "user", "x", 0.0), ("z", 2, 1, "user", "y", 0.0), ("z", 3, 2, "user", "w", 0.0)]
    paths = chat.reply_paths(build(spark, rows))
    assert sorted(tuples(paths), key=str) == sorted(
        [(None, 2, 2, 0), (None, 2, 1, 1), (None, 3, 3, 0), (None, 3, 1, 1)], key=str)
    best = chat.conversations(build(spark, rows)).collect()
    assert len(best) == 1 and "b" in best[0].formatted  # equal scores: the smaller leaf
    assert chat.conversations(build(spark, [])).count() == 0


def test_a_long_chain(spark):
    n = 70
    rows = [("t", k, k - 1 if k else None, "user" if k % 2 else "assistant", NASTY[k % 13], 0.0)
            for k in range(n)]
    one = chat.conversations(build(spark, rows))
    turns, _ = chat.read_back(F.col("formatted"), F.col("mask"))
    got = one.select(turns.alias("t")).first().t
    assert [x.text for x in got] == [NASTY[k % 13] for k in range(n)]


def test_query(spark, tmp_path):
    rng = random.Random(14)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|x"]), rng.choice(NASTY), "extra")
            for c in [*range(12), None] for t in range(rng.randint(1, 9))]
    rows += [(3, 0, "user", "tie", "e"), (3, 0, "user", "tie", "e")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, node string"
                          ).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op3_chat(spark, str(tmp_path)).collect()
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said, ""), (-7, 1, "assistant", said, "")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for c in {r[0] for r in rows}:
        # Spark sorts nulls first
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (
            r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        want.append((c, len(own), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)),
                     len(learned), sha(learned)))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("best", [1, None])
def test_mask_lies_on_the_learned_texts(spark, best):
    rows = [("t", k, k - 1 if k else None, ["user", "assistant"][k % 2], NASTY[k], 0.0)
            for k in range(12)]
    r = chat.conversations(build(spark, rows), best=best).first()
    parts = [r.formatted[m.start:m.end] for m in r.mask]
    assert len(parts) == 6 and all(r.formatted[m.end:].startswith("<|end|>") for m in r.mask)

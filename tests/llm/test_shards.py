import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from playmart.llm import queries, shards as K
from tests.conftest import tuples
from tests.llm.conftest import AWKWARD, DOCS


def corpus(spark, rng, n=1500):
    rows = [(k if rng.random() < 0.95 else None, "x" * rng.randrange(400), rng.choice(["en", "de", None]),
             "hot" if k % 3 else f"s{k % 7}", rng.randrange(400)) for k in range(n)]
    rows += [(7, "same text", "en", "hot", 9)] * (n // 2)  # one repeated row, a third of all
    return spark.createDataFrame(rows, DOCS), rows


def test_query_balances_bytes_and_numbers_slots(spark, tmp_path):
    df, rows = corpus(spark, random.Random(17))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op4_kd_shards(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == sorted(
        ((r[0], len(r[1]) + 1, zlib.crc32(r[1].encode())) for r in rows), key=str)
    held, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert (r.law, r.grown_shard) == ("bytes", None)
        held[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert sorted(held) == list(range(16))
    groups = Counter()
    for r in got:
        groups[r["size"], r.text_crc32] += r["size"]
    assert max(held.values()) - min(held.values()) <= 2 * max(groups.values())
    assert len({(r["size"], r.text_crc32, r.shard) for r in got}) == len(groups)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_any_number_of_shards(spark, shards):
    df, _ = corpus(spark, random.Random(18), 400)
    sums = [r[0] for r in K.kd_shards(df, ["n_chars", "lang"], shards=shards).groupBy("shard").agg(
        F.sum("size")).select("sum(size)").collect()]
    groups = df.groupBy("text").agg(F.sum(F.length("text") + 1).alias("b")).agg(F.max("b")).first()[0]
    assert len(sums) == shards and max(sums) - min(sums) <= 2 * groups


def brute(points, dims, spans, shards):
    """Shards of points (weight, tie, *dims) by a recursive k-d split; `spans` of all rows."""
    out = {}

    def split(node, first, parts):
        if parts == 1 or not node:
            out.update({p[1]: first for p in node})
            return
        wide = [(max(p[2 + k] for p in node) - min(p[2 + k] for p in node)) / (spans[k] or 1)
                for k in range(dims)]
        axis = wide.index(max(wide))
        total, run, sides, left = sum(p[0] for p in node), 0, ([], []), parts // 2
        for p in sorted(node, key=lambda p: (p[2 + axis], p[1])):
            run += p[0]
            sides[(2 * run - p[0]) * parts > 2 * total * left].append(p)
        split(sides[0], first, left)
        split(sides[1], first + left, parts - left)

    split(points, 0, shards)
    return out


@pytest.mark.parametrize("shards", [5, 16])
def test_shards_equal_a_recursive_split(spark, shards):
    rng = random.Random(shards)
    rows = [(k, f"text {rng.randrange(150)} " + "x" * rng.randrange(3), "en", "s",
             rng.randrange(1000)) for k in range(400)]
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    points = []
    for text, held in groups.items():
        size, least = len(text) + 1, min(held)
        points.append((size * len(held), (zlib.crc32(text.encode()), size), least[4], least[0]))
    spans = [max(r[c] for r in rows) - min(r[c] for r in rows) for c in (4, 0)]
    want = brute(points, 2, spans, shards)
    got = K.kd_shards(spark.createDataFrame(rows, DOCS), ["n_chars", "doc_id"], shards=shards)
    assert {(r.doc_id, r.shard) for r in got.collect()} == {
        (r[0], want[zlib.crc32(r[1].encode()), len(r[1]) + 1]) for r in rows}


def test_a_group_larger_than_a_shard_is_cut_into_balanced_pieces(spark):
    rows = [(k, "one text of many rows", "en", "s", 1) for k in range(900)]
    rows += [(1000 + k, f"other {k}" * 3, "en", "s", k) for k in range(300)]
    got = K.kd_shards(spark.createDataFrame(rows, DOCS), ["n_chars", "doc_id"], shards=8)
    sums = [r[0] for r in got.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert got.count() == 1200 and len(sums) == 8
    assert max(sums) - min(sums) <= sum(sums) / 8 / 4


def test_leaves_follow_the_target_and_the_widest_dimension(spark):
    df = spark.range(64).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("y"), 9).alias("text"),
        (F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    out = K.kd_shards(df, ["a", "b"], target_bytes=40)
    assert out.groupBy("shard").count().select("count").distinct().collect() == [(4,)]
    # each leaf is a small box of both dimensions
    boxes = out.join(df, "doc_id").groupBy("shard").agg(
        (F.max("a") - F.min("a")).alias("w"), (F.max("b") - F.min("b")).alias("h"))
    assert boxes.where("w > 1 OR h > 1").count() == 0


def test_awkward_and_empty_tables(spark, docs, tmp_path):
    df = docs(AWKWARD).withColumnsRenamed({"lang": "first", "source": "size"})
    out = K.kd_shards(df, ["first", "n_chars"], shards=4)
    assert out.count() == len(AWKWARD)
    assert K.kd_shards(docs([]), ["n_chars"], shards=16).count() == 0
    assert K.kd_shards(docs([]), ["n_chars"], target_bytes=10).count() == 0


def test_written_shards_hold_every_row_once(spark, docs, tmp_path):
    rows = [(k, f"text {k}") for k in range(40)] + [(None, "no id"), (1, "text 1"), (1, "other"),
                                                    (None, None), (None, None)]
    df = docs(rows).withColumn("_rid", F.lit("mine")).withColumn("shard", F.lit("old"))
    K.write_shards(df, str(tmp_path / "out"), ["doc_id"], shards=4)
    read = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(tuples(read, "doc_id", "text"), key=str) == sorted(rows, key=str)
    assert set(read.columns) == set(df.columns)
    assert sorted(tuples(read, "doc_id", "text", "shard"), key=str) == sorted(tuples(
        K.kd_shards(df, ["doc_id"], shards=4).withColumnRenamed("text_crc32", "c").join(
            df.drop("shard").select(F.col("doc_id").alias("i"), "text", F.crc32(F.coalesce(
                "text", F.lit("")).cast("binary")).alias("d")).distinct(),
            F.expr("doc_id <=> i and c = d")), "doc_id", "text", "shard"), key=str)

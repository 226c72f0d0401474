import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from playmart.llm import trie
from tests.conftest import tuples

DDL = "conv_id bigint, turn bigint, role string, text string"


def brute(sequences):
    """Nodes over {conv: sequence of (role, text)}."""
    nodes, kids, saved, leaves = {}, defaultdict(list), {}, {}
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            nodes.setdefault(sequences[c][:d], []).append(c)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * len(p[-1][1]) if p else 0
        saved[p] = own + sum(saved[k] for k in kids[p])
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
    ends = lambda p: ",".join(str(c) for c in nodes[p] if len(sequences[c]) == len(p))
    return sorted((nodes[p][0], len(p), nodes[p[:-1]][0] if p else None, len(nodes[p]), len(kids[p]),
                   leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
                  for p in nodes)


def spliced(convs, group=100, most=6):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = tuple(convs.get(c - c % group, ())[:h]) + tuple(turns[h:])
    return out


def said(convs):
    return [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]


def nodes_of(df):
    return sorted(tuples(trie.prefix_trie(df)), key=lambda r: (r[0], r[1]))


def made(rng, n, words):
    convs = {}
    for c in range(n):
        start = [("user", "hello there"), ("assistant", "hi")][:rng.randrange(3)]
        convs[c] = start + [(rng.choice("ua"), rng.choice(words)) for _ in range(rng.randrange(7))]
    return {c: t for c, t in convs.items() if t}


@pytest.mark.parametrize("shards", [1, 4, 37])
def test_nodes_equal_brute_force_over_any_number_of_shards(spark, shards):
    rng = random.Random(shards)
    convs = made(rng, 300, ["yes", "no", "é日本", ""])
    convs[900] = [("u", f"turn {k}") for k in range(150)]           # one long path
    convs.update({c: [("u", "same"), ("a", "same")] for c in range(1000, 1100)})  # copies
    df = trie.conversations(spark.createDataFrame(said(convs), DDL))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        assert nodes_of(df) == brute({c: tuple(t) for c, t in convs.items()})
        assert nodes_of(trie.rebuilt(df)) == brute(spliced(convs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shared_prefixes_deeper_than_a_shard(spark):
    """All sequences begin alike, so every shard has the same upper nodes."""
    start = [("u", f"line {k}") for k in range(40)]
    convs = {c: start[:c % 41] + [("a", str(c))] * (c % 3) for c in range(1, 200)}
    convs = {c: t for c, t in convs.items() if t}
    df = trie.conversations(spark.createDataFrame(said(convs), DDL))
    assert nodes_of(df) == brute({c: tuple(t) for c, t in convs.items()})


def test_nulls_ties_repeats_empty_tables_and_other_columns(spark):
    rows = [(1, None, "b", "first"), (1, 0, None, "x"), (1, 1, "u", None), (2, 5, "", "x"),
            (2, 5, "", "x"), (None, 0, "u", "nobody"), (3, 7, "u", "y" * 100_000)]
    df = spark.createDataFrame([r + (9, "t") for r in rows], DDL + ", t int, node string")
    convs = {1: (("b", "first"), ("", "x"), ("u", "")), 2: (("", "x"), ("", "x")),
             3: (("u", "y" * 100_000),)}
    assert nodes_of(trie.conversations(df)) == brute(convs)
    assert nodes_of(trie.conversations(df.limit(0))) == []
    # a turnless conversation: all of its turns were replaced by those of a missing one
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 3)
    df = spark.createDataFrame([(lone, 0, "u", "a"), (lone, 1, "u", "b")], DDL)
    assert nodes_of(trie.rebuilt(trie.conversations(df))) == brute({lone: ()})


def test_ties_of_a_turn_number_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 0, "u", x) for x in "abcdef"]
    one = nodes_of(trie.conversations(spark.createDataFrame(rows, DDL)))
    assert one == nodes_of(trie.conversations(spark.createDataFrame(rows[::-1], DDL)))


def test_double_array_holds_its_sequences_and_no_others():
    rng = random.Random(5)
    for codes in (1, 3, 500):
        found = sorted({tuple(rng.randrange(1, codes + 1) for _ in range(rng.randrange(9)))
                        for _ in range(400)})
        packed = trie.DoubleArray([np.array(s, np.int64) for s in found])
        prefixes = {s[:d] for s in found for d in range(len(s) + 1)}
        slots = {p: packed.walk(np.array(p, np.int64))[-1] for p in prefixes}
        assert len(set(slots.values())) == len(prefixes)
        for p in list(prefixes)[:300]:
            for c in range(1, min(codes, 60) + 2):
                if p + (c,) not in prefixes:
                    with pytest.raises(KeyError):
                        packed.walk(np.array(p + (c,), np.int64))


def test_arrays_stay_dense():
    rng = random.Random(6)
    found = sorted({tuple(rng.randrange(1, 2000) for _ in range(6)) for _ in range(3000)})
    packed = trie.DoubleArray([np.array(s, np.int64) for s in found])
    nodes = len({s[:d] for s in found for d in range(7)})
    assert len(packed.check) < 4 * nodes


def test_digests_of_many_members_stream(spark):
    ids = list(range(0, 20_000, 2)) + [-5]
    df = spark.createDataFrame([("x", c) for c in ids] + [("y", 1)], "node string, c bigint")
    want = hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert dict(tuples(trie.member_digests(df))) == {
        "x": want, "y": hashlib.sha256(b"1").hexdigest()}

"""Prefix trie of conversations, packed as double arrays.

Distinct turn sequences, in their order, are dealt to shards of neighbouring prefixes. A shard
numbers its turns densely, packs its trie into the arrays BASE and CHECK (the child of node s by
turn t is BASE[s] + t, if CHECK there is s), and walks its sequences through them to count at every
node. As shards are ranges of the order, only the nodes on the way to a shard's first and last
sequence can lie in other shards too. These few are merged over all shards, and what a merged node
was counted more than once for is taken off its ancestors.

Nodes are named by a hash of their path, turns by a hash of role and text, so texts stay behind.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmart.session import scratch_path

SHARD_TURNS = 200_000   # turns of a shard, about
TRIES = 256             # places that a node's children are tried at before the arrays grow
IDS = 4096              # member ids that are joined to one piece
NODE = ("shard int, node string, parent string, depth bigint, least bigint, parent_least bigint, "
        "n bigint, children bigint, leaves bigint, saved bigint, chars bigint, first boolean, "
        "last boolean, parent_open boolean")


class DoubleArray:
    """A trie over sequences of codes from 1, given in order and each once."""

    def __init__(self, sequences: list[np.ndarray]):
        parent, code = [-1], [0]
        path, before = [0], np.zeros(0, np.int64)
        for now in sequences:
            short = min(len(before), len(now))
            differ = np.flatnonzero(before[:short] != now[:short])
            shared = int(differ[0]) if len(differ) else short
            del path[shared + 1:]
            for c in now[shared:].tolist():
                parent.append(path[-1])
                code.append(c)
                path.append(len(parent) - 1)
            before = now
        self._pack(np.array(parent), np.array(code, np.int64))

    def _pack(self, parent: np.ndarray, code: np.ndarray) -> None:
        size = 2 * len(parent) + int(code.max(initial=0)) + 2
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.check[0] = 0                       # the root is its own parent
        order = np.argsort(parent[1:], kind="stable") + 1
        tops, starts, counts = np.unique(parent[order], return_index=True, return_counts=True)
        groups = {int(t): order[a:a + n] for t, a, n in zip(tops, starts, counts)}
        slot = np.zeros(len(parent), np.int64)
        # nodes with most children first, whose gaps the others fill; a parent has its own slot first
        wide = [t for t, g in groups.items() if len(g) > 1]
        bases = {}
        free = _Free(self)
        for t in sorted(wide, key=lambda t: -len(groups[t])):
            bases[t] = free.place(code[groups[t]])
        for t, g in groups.items():
            if len(g) == 1:
                bases[t] = free.place(code[g])
        for t in sorted(groups):                # parents come before their children
            kids = groups[t]
            slot[kids] = bases[t] + code[kids]
            self.base[slot[t]] = bases[t]
            self.check[slot[kids]] = slot[t]

    def grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))

    def walk(self, sequence: np.ndarray) -> list[int]:
        """The slots from the root to the node of a sequence in the trie."""
        slots, now = [0], 0
        for c in sequence.tolist():
            to = int(self.base[now]) + c
            if to >= len(self.check) or self.check[to] != now:
                raise KeyError(c)
            slots.append(to)
            now = to
        return slots


class _Free:
    """Free places of the arrays, taken from the front."""

    TAKEN = -2

    def __init__(self, trie: DoubleArray):
        self.trie, self.front, self.end = trie, 1, 1

    def place(self, codes: np.ndarray) -> int:
        """A base with free places for all codes, which are taken. It may be negative."""
        check, least = self.trie.check, int(codes.min())
        at = self.front
        for _ in range(TRIES):
            while at < len(check) and check[at] != -1:
                at += 1
            places = at - least + codes
            self.trie.grow(int(places.max()) + 1)
            check = self.trie.check
            if (check[places] == -1).all():
                break
            at += 1
        else:                                   # behind all that is taken
            at = max(self.end, at)
            places = at - least + codes
            self.trie.grow(int(places.max()) + 1)
            check = self.trie.check
        check[places] = self.TAKEN
        self.end = max(self.end, int(places.max()) + 1)
        while self.front < len(check) and check[self.front] != -1:
            self.front += 1
        return at - least


def count_nodes(shard: int, turns: list[list[str]], chars: list[list[int]], n: np.ndarray,
                least: np.ndarray) -> dict[str, list]:
    """The nodes of a shard's sequences, which are in order, with all that the shard knows of them:
    members, their smallest id, children, leaves and saved characters below."""
    names = {t: i for i, t in enumerate(dict.fromkeys(itertools.chain.from_iterable(turns)), 1)}
    size = np.zeros(len(names) + 1, np.int64)
    coded = []
    for keys, lengths in zip(turns, chars):
        codes = np.array([names[k] for k in keys], np.int64)
        size[codes] = lengths
        coded.append(codes)
    # dense ids follow the first meeting, so siblings keep the order of their sequences
    trie = DoubleArray(coded)
    slots = len(trie.check)
    members, smallest = np.zeros(slots, np.int64), np.full(slots, np.iinfo(np.int64).max)
    depth = np.zeros(slots, np.int64)
    last_turn, path_hash = np.zeros(slots, np.int64), {0: hashlib.sha256()}
    first, last, before = set(), [0], [0]
    for number, codes in enumerate(coded):
        path = trie.walk(codes)
        members[path] += n[number]
        smallest[path] = np.minimum(smallest[path], least[number])
        shared = 0
        while shared < min(len(before), len(path)) and before[shared] == path[shared]:
            shared += 1
        for d in range(max(shared, 1), len(path)):
            digest = path_hash[path[d - 1]].copy()
            digest.update(turns[number][d - 1].encode("ascii"))
            path_hash[path[d]] = digest
            depth[path[d]], last_turn[path[d]] = d, codes[d - 1]
        if number == 0:
            first = set(path)
        before = last = path
    open_ = first | set(last)
    used = np.array(sorted(path_hash), np.int64)
    up = trie.check[used]
    length = size[last_turn]
    saved = np.where(members > 0, (members - 1) * length, 0)
    children = np.bincount(up[used != 0], minlength=slots)
    leaves = np.zeros(slots, np.int64)
    leaves[used] = children[used] == 0
    deepest = used[np.argsort(-depth[used], kind="stable")]
    for d, level in itertools.groupby(deepest.tolist(), key=lambda s: depth[s]):
        if d:  # children before their parents
            level = np.array(list(level))
            np.add.at(saved, trie.check[level], saved[level])
            np.add.at(leaves, trie.check[level], leaves[level])
    text = {s: path_hash[s].hexdigest() for s in used.tolist()}
    top = [None if s == 0 else int(trie.check[s]) for s in used.tolist()]
    last = set(last)
    return {
        "shard": [shard] * len(used), "node": [text[s] for s in used.tolist()],
        "parent": [None if t is None else text[t] for t in top], "depth": depth[used].tolist(),
        "least": smallest[used].tolist(),
        "parent_least": [None if t is None else int(smallest[t]) for t in top],
        "n": members[used].tolist(), "children": children[used].tolist(),
        "leaves": leaves[used].tolist(), "saved": saved[used].tolist(),
        "chars": length[used].tolist(), "first": [s in first for s in used.tolist()],
        "last": [s in last for s in used.tolist()],
        "parent_open": [t in open_ if t is not None else False for t in top],
    }


def conversations(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """`c`, and its `turns` in order: structs of `turn`, `t` (a hash of role and text) and `chars`.

    A null turn number comes first, turns of one number go by their hash. A null role or text counts
    as empty. Rows without a conversation are left out.
    """
    role, text = (F.coalesce(rows[f"`{c}`"].cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    said = rows.select(rows[f"`{key}`"].alias("c"), F.struct(
        rows["`turn`"].alias("turn"), name.alias("t"),
        F.char_length(text).cast("bigint").alias("chars")).alias("said")).where("c IS NOT NULL")
    return said.groupBy("c").agg(F.sort_array(F.collect_list("said")).alias("turns"))


def rebuilt(convs: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Every conversation c, begun with the first h turns of conversation c - c % `group` instead of
    its own first h; h is crc32 of c in decimal, modulo `most`."""
    heads = convs.where(F.col("c") % group == 0).select(
        F.col("c").alias("head"), F.slice("turns", 1, most - 1).alias("opening"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % most).cast("int")
    joined = convs.withColumn("head", F.col("c") - F.col("c") % group).join(heads, "head", "left")
    none = F.filter("turns", lambda t: F.lit(False))
    return joined.withColumn("h", h).select("c", F.concat(
        F.slice(F.coalesce("opening", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def count_shards(sequences: DataFrame, shards: int) -> DataFrame:
    """The nodes of all shards; a shard is a range of the distinct sequences, in their order."""
    # checkpointed, so that shards stay what they are if an executor is lost
    dealt = sequences.repartitionByRange(shards, "seq").withColumn(
        "shard", F.spark_partition_id()).checkpoint()
    names = [c.strip().split(" ")[0] for c in NODE.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        seqs = table.column("seq").to_pylist()
        order = sorted(range(len(seqs)), key=seqs.__getitem__)
        found = count_nodes(
            table.column("shard")[0].as_py(), [seqs[i] for i in order],
            [table.column("chars")[i].as_py() for i in order],
            table.column("n").to_numpy()[order], table.column("least").to_numpy()[order])
        kinds = {"shard": pa.int32(), "first": pa.bool_(), "last": pa.bool_(),
                 "parent_open": pa.bool_(), "node": pa.string(), "parent": pa.string()}
        out = pa.table({c: pa.array(found[c], kinds.get(c, pa.int64())) for c in names})
        yield from out.to_batches(max_chunksize=10_000)

    return dealt.mapInArrow(run, NODE)


def merged(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes on the borders of shards merged over all shards, and which shard has which.

    A node in k shards was counted as k nodes: its parent has k - 1 children too many, it and its
    ancestors k - 1 times its text too much to save, and a leaf for each shard in which nothing
    followed. Of all border paths that show such a node one hands this on to the ancestors.
    """
    open_ = nodes.where("first OR last")
    local = F.sum((F.col("children") == 0).cast("bigint"))
    total = open_.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"),
        F.first("chars").alias("chars"), F.min("least").alias("least"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
        F.count(F.lit(1)).alias("k"), local.alias("ends")).checkpoint()
    paths = open_.select("shard", "node", F.explode(F.filter(F.array(
        F.when(F.col("first"), 0), F.when(F.col("last"), 1)), lambda s: s.isNotNull())
    ).alias("side")).join(total.select("node", "depth", "chars", "k", "ends"), "node")
    own = F.struct("shard", "side")
    first = paths.where("k > 1").groupBy("node").agg(F.min(own).alias("from"))
    hands = (F.col("k") > 1) & (own == F.col("from"))
    given = paths.join(first, "node", "left").select(
        "node", "shard", "side", "depth",
        F.when(hands, (F.col("k") - 1) * F.col("chars")).otherwise(0).alias("more"),
        F.when(hands, F.col("ends")).otherwise(0).alias("less"))
    # a path is one conversation's way from the root
    below = Window.partitionBy("shard", "side").orderBy(F.col("depth").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    change = given.select("node", F.sum("more").over(below).alias("more"),
                          F.sum("less").over(below).alias("less")).groupBy("node").agg(
        F.sum("more").alias("more"), F.sum("less").alias("less"))
    twice = total.where("k > 1 AND parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.sum(F.col("k") - 1).alias("twice"))
    zero = F.lit(0).cast("bigint")
    whole = total.join(change, "node").join(twice, "node", "left").select(
        "node", "parent", "depth", "least", "n",
        (F.col("children") - F.coalesce("twice", zero)).alias("children"),
        (F.col("leaves") - F.col("less")).alias("leaves"),
        (F.col("saved") + F.col("more")).alias("saved")).checkpoint()
    return whole, open_.select("shard", "node")


def member_digests(members: DataFrame) -> DataFrame:
    """`node` and the SHA-256 of its members' ids in decimal, ascending and joined by commas.

    Ranges of the sorted members are joined to pieces by many tasks; a node's pieces then stream
    through one hash, which holds one piece at a time however many members there are.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((n, c) for b in batches
                for n, c in zip(b.column("node").to_pylist(), b.column("c").to_pylist()))
        for node, group in itertools.groupby(rows, key=lambda r: r[0]):
            while ids := [c for _, c in itertools.islice(group, IDS)]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])],
                    ["node", "c", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((n, i) for b in batches
                for n, i in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()))
        for node, group in itertools.groupby(rows, key=lambda r: r[0]):
            digest = hashlib.sha256(next(group)[1].encode("ascii"))
            for _, ids in group:
                digest.update(b"," + ids.encode("ascii"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([node]), pa.array([digest.hexdigest()])], ["node", "ends"])

    cut = members.repartitionByRange("node", "c").sortWithinPartitions("node", "c").mapInArrow(
        pieces, "node string, c bigint, ids string")
    return cut.repartition("node").sortWithinPartitions("node", "c").mapInArrow(
        digests, "node string, ends string")


def prefix_trie(sequences: DataFrame, key: str = "conv_id") -> DataFrame:
    """All nodes of the trie over the `turns` of every `c`, see `conversations`.

    One row a node: `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`,
    `n_leaves`, `saved_tokens` and `ends_sha256`. Equal sequences are one path that is walked once.
    Repeated rows are turns like others; a conversation without turns ends at the root; an empty
    table has no node.
    """
    spark = sequences.sparkSession
    path = scratch_path(spark, "sequences")
    sequences.select("c", F.col("turns")["t"].alias("seq"), F.col("turns")["chars"].alias("chars")).withColumn(
        "node", F.sha2(F.array_join("seq", ""), 256)).write.parquet(path)
    kept = spark.read.parquet(path)
    distinct = kept.groupBy("node", "seq").agg(
        F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"),
        F.min("c").alias("least")).drop("node")
    turns = kept.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    at = scratch_path(spark, "nodes")
    count_shards(distinct, shards).write.parquet(at)
    nodes = spark.read.parquet(at)
    whole, seen = merged(nodes)

    up = whole.select(F.col("node").alias("parent"), F.col("least").alias("parent_least"))
    border = whole.join(up, "parent", "left").select(
        "node", "least", "depth", "parent_least", "n", "children", "leaves", "saved")
    inner = nodes.where("NOT first AND NOT last")
    # the children of one node in one shard are what a parent's row is joined to
    known = seen.join(whole.select("node", F.col("least").alias("merged")), "node").select(
        "shard", F.col("node").alias("parent"), "merged")
    beside = inner.where("parent_open").join(known, ["shard", "parent"]).withColumn(
        "parent_least", F.col("merged"))
    columns = border.columns
    every = border.unionAll(inner.where("NOT parent_open").select(*columns)).unionAll(
        beside.select(*columns))
    ends = member_digests(kept.select("node", "c"))
    return every.join(ends, "node", "left").select(
        F.col("least").alias(key), "depth", F.col("parent_least").alias(f"parent_{key}"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))

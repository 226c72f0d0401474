"""SimHash near-duplicates with deletion-variant signatures.

Two fingerprints at most `max_bits` apart are cut into so few segments that one segment differs by
one bit at most. Every segment value is indexed once per position with that position as a wildcard;
values that share such a signature meet, their fingerprints are joined by equality on the values,
and all bits verify the pairs.

A value of many fingerprints (over `CROWD`) would pair each with each. Those fingerprints go to an
exact index that needs no pairs: every fingerprint within one bit of a point is grouped under it,
and two fingerprints at most two bits apart have such a point in common. A group holds at most one
member per bit and one more, whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.batches import let_go, slices
from playmart.llm.components import apart, components, join_apart, stored

SEED = 42
BITS = 64
CROWD = 8      # members up to which those of a segment value, or of a shingle, are paired
MARKS = 1 << 18
BITMAP = 1 << 24   # marks of hashes that are looked for
BLOCK = 1 << 21    # hashes of the texts that are compared in one task, about
PAIRS = 1 << 13    # pairs that are compared in one task, about
LEADERS = 2    # members of a crowded shingle, picked by hash, that all others are compared with
SLACK = 1e-9   # for rounding in bounds, which may only let more pairs through
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of `words` words, repeats included; of the whole sequence if it is
    shorter. Words are lower-cased (A-Z only) and split at the six ASCII blanks."""
    parts = (text or "").encode("utf-8", "replace").translate(UPPER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(parts) - words + 1].tolist()
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist())],
                    np.uint64)


def majority(hashes: np.ndarray) -> np.ndarray:
    """The 64 bits, highest first, that are set in over half of the hashes; none for no hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            seen = np.bincount(part[:, k], minlength=256)
            ones[8 * k:8 * k + 8] += seen @ _BYTE_BITS
    return 2 * ones > len(hashes)


def fingerprint(hashes: np.ndarray) -> int:
    return int.from_bytes(np.packbits(majority(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """`key` and `bits` (the fingerprint as a signed 64-bit integer), one row per input row."""
    rows = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("text"))
    schema = T.StructType([T.StructField(key, rows.schema["key"].dataType),
                           T.StructField("bits", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in slices(batches):
            found = [fingerprint(shingle_hashes(t, words))
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.array(found, np.uint64).view(np.int64))],
                [key, "bits"])

    return rows.mapInArrow(run, schema)


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def segments(bits: Column, max_bits: int) -> Column:
    """A fingerprint cut into as few segments as let one differ by one bit at most."""
    count = max_bits // 2 + 1
    size = -(-BITS // count)
    mask = F.lit(signed((1 << size) - 1))
    return F.array(*[F.shiftrightunsigned(bits, s * size).bitwiseAND(mask) for s in range(count)])


def neighbours(groups: DataFrame, width: int) -> DataFrame:
    """Pairs (`segment`, `v`, `w`) of segment values that differ in one bit.

    `groups` has each (segment, value) once. A value's signatures are its bits with one of them as
    a wildcard; two values that share a signature differ in that bit, so a signature never has more
    than two values, however many fingerprints share these.
    """
    # each row becomes `width`, so they are dealt out over all tasks first
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = groups.select("segment", "value").repartition(tasks).select(
        "segment", "value", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("k")).select(
        (F.col("segment") * 64 + F.col("k")).cast("smallint").alias("place"),
        F.expr("value & ~shiftleft(1L, k)").alias("rest"), "value")
    met = index.groupBy("place", "rest").agg(F.min("value").alias("v"), F.max("value").alias("w"))
    return met.where("v <> w").select(
        F.floor(F.col("place") / 64).cast("int").alias("segment"), "v", "w")


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join exactly the groups that pairs at most
    `max_bits` (1 or 2) apart join. `prints` has one row per value of `bits`.

    Such a pair has a segment of equal values or of neighbours. Members of small values are paired
    and verified. Members of a crowded value and of its neighbours go to the exact index instead:
    each is listed under all points at most one bit away, and two of them at most two bits apart
    have such a point in common.
    """
    if max_bits not in (1, 2):
        raise ValueError("the index without pairs holds for one or two bits")
    width = -(-BITS // (max_bits // 2 + 1))
    cut = prints.select("bits", F.posexplode(segments(F.col("bits"), max_bits)).alias(
        "segment", "value"))
    value = ["segment", "value"]
    groups = cut.groupBy(*value).agg(F.count(F.lit(1)).alias("n")).checkpoint()
    near = neighbours(groups, width).checkpoint()
    small = cut.join(groups.where(F.col("n") <= CROWD), value).groupBy(*value).agg(
        F.array_sort(F.collect_list("bits")).alias("all")).checkpoint()
    same = small.where("size(all) > 1").select(F.posexplode("all").alias("at", "a"), "all").select(
        "a", F.explode(F.expr("slice(all, at + 2, size(all))")).alias("b"))
    side = lambda name, list_name: small.select(
        "segment", F.col("value").alias(name), F.col("all").alias(list_name))
    across = near.join(side("v", "x"), ["segment", "v"]).join(
        side("w", "y"), ["segment", "w"]).select(F.explode("x").alias("a"), "y").select(
        "a", F.explode("y").alias("b"))
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    found = same.unionAll(across).where(differ <= max_bits)

    crowded = groups.where(F.col("n") > CROWD).select(*value)
    beside = near.select("segment", F.col("v").alias("value"), F.col("w").alias("o")).unionAll(
        near.select("segment", "w", "v")).join(
        crowded.withColumnRenamed("value", "o"), ["segment", "o"]).select(*value)
    wide = cut.join(crowded.unionAll(beside).distinct(), value, "left_semi").select(
        "bits").distinct()
    points = F.array(F.col("bits"), *[F.col("bits").bitwiseXOR(F.lit(signed(1 << k)))
                                      for k in range(BITS)])
    around = wide.select("bits", F.explode(points).alias("point"))
    # a point has 65 fingerprints at most, itself and one for each bit
    stars = around.groupBy("point").agg(F.array_sort(F.collect_list("bits")).alias("all"))
    starred = stars.where("size(all) > 1").select(
        F.col("all")[0].alias("a"), F.explode(F.expr("slice(all, 2, 64)")).alias("b"))
    # with one segment no value has two fingerprints, so none is crowded
    return found.unionAll(starred).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """`key`, `fingerprint` (16 hexadecimal digits) and `component_id`, the smallest key that is
    reachable over fingerprints at most `max_bits` apart. One row per input row.

    Null and empty texts have no words and the fingerprint zero, and link like any other. Repeated
    rows get the same group; a null key gets the group of its text and never names one, so a group
    of null keys alone has a null component. Equal fingerprints are one entry of the index, so
    copies never pair; only distinct fingerprints are linked.
    """
    rows = fingerprints(docs, words, key, text).checkpoint()
    prints = rows.groupBy("bits").agg(F.min(key).alias("least")).checkpoint()
    group = components(links(prints.select("bits"), max_bits))  # bits, root
    named = prints.join(group, "bits", "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root"))
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.join(best, "root").select("bits", "component_id")
    return rows.join(by_print, "bits").select(
        key, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def needed(size: int, similarity: float) -> int:
    """One more than may be missing from a set of `size` in a similar one: two similar texts have
    one of so many first hashes in common, whatever the order of hashes."""
    return size - math.ceil(similarity * size - SLACK) + 1


def listed_size(size: int, similarity: float) -> int:
    """How many first hashes a text lists: more than needed, as crowded ones do not count."""
    least = needed(size, similarity)
    return min(size, least + least // 2 + CROWD)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes in order; a single zero for a text without words."""
    found = np.unique(shingle_hashes(text, words).view(np.int64))
    return found if len(found) else np.zeros(1, np.int64)


TOKEN, SIZE, LAST, PRINT = 0, 1, 2, 3   # kinds of the rows (kind, key, value) that a text gives


def token_rows(rows: DataFrame, words: int, similarity: float, within: np.ndarray | None = None
               ) -> DataFrame:
    """For each `id`: (TOKEN, hash, id) of its first hashes, (SIZE, id, size of its set),
    (LAST, id, last hash listed) and (PRINT, id, fingerprint of its set). With a bitmap `within`, only hashes whose mark is set, and no
    other rows. A task gives each id once; copies in other tasks give the same rows again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        done: set[int] = set()
        for batch in slices(batches):
            kinds, keys, values = [], [], []
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if i in done:
                    continue
                done.add(i)
                found = shingle_set(text, words)
                some = found[:listed_size(len(found), similarity)]
                if within is None:
                    bits = signed(fingerprint(found.view(np.uint64)))
                    kinds.append(np.repeat([TOKEN, SIZE, LAST, PRINT], [len(some), 1, 1, 1]))
                    keys.append(np.concatenate((some, [i, i, i])))
                    values.append(np.concatenate((np.full(len(some), i),
                                                  [len(found), some[-1], bits])))
                else:
                    some = some[marked(some, within)]
                    kinds.append(np.full(len(some), TOKEN))
                    keys.append(some)
                    values.append(np.full(len(some), i))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(kinds).astype(np.int8)),
                     pa.array(np.concatenate(keys).astype(np.int64)),
                     pa.array(np.concatenate(values).astype(np.int64))], ["kind", "key", "value"])

    return rows.select("id", "text").mapInArrow(run, "kind byte, key bigint, value bigint")


def marked(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = hashes & (BITMAP - 1)
    return (bitmap[bit >> 5] >> (bit & 31)) & 1 == 1


def bitmap_of(tokens: DataFrame) -> np.ndarray:
    """Which marks (lowest bits) the hashes `token` have: half a million numbers at most, whatever
    the number of hashes."""
    bit = F.col("token").bitwiseAND(F.lit(BITMAP - 1))
    words = tokens.groupBy(F.shiftright(bit, 5).alias("word")).agg(F.bit_or(F.expr(
        "shiftleft(1L, cast(token & 31 as int))")).alias("bits")).toArrow()
    out = np.zeros(BITMAP >> 5, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def counted(cut: DataFrame, *by: str) -> DataFrame:
    """`n`: how many rows of `cut` have the same `by`. One shuffle, which later groups share."""
    return cut.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*by)))


def small_pairs(shared: DataFrame) -> DataFrame:
    """All pairs (a, b) of ids that share `o` tokens of up to `CROWD` rows, one or more."""
    few = shared.where(F.col("n") <= CROWD).groupBy("token").agg(
        F.array_sort(F.collect_list("id")).alias("all"))
    return few.select(F.posexplode("all").alias("at", "a"), "all").select(
        "a", F.explode(F.expr("slice(all, at + 2, size(all))")).alias("b")).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("o"))


def homes(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """`id`, `degree` and `home` of all texts in pairs: a text's home is shared with its smallest
    partner, so texts of one group mostly meet there. Homes over `BLOCK` hashes or `PAIRS` pairs are
    split."""
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("o")).unionAll(
        pairs.select(F.col("b").alias("id"), F.col("a").alias("o")))
    nodes = both.groupBy("id").agg(F.min("o").alias("o"), F.count(F.lit(1)).alias("degree")).join(
        sizes, "id").select("id", "degree", "size", F.least("id", "o").alias("label"))
    parts = nodes.groupBy("label").agg(F.ceil(F.greatest(
        F.sum("size") / F.lit(BLOCK), F.sum("degree") / F.lit(2 * PAIRS))).alias("parts")).select(
        F.col("label").alias("l"), "parts")
    return nodes.join(parts, apart(F.col("label")) == apart(F.col("l"))).select(
        "id", "degree", F.xxhash64("label", F.pmod(F.xxhash64("id"), "parts")).alias("home"))


def verified(pairs: DataFrame, rows: DataFrame, sizes: DataFrame, words: int, similarity: float
             ) -> DataFrame:
    """The pairs whose whole sets are similar; texts whose sizes alone forbid it are not compared.

    Pairs are dealt to blocks, and a block gets the text of each id that its pairs name once. A pair
    goes to the home of its text with fewer partners, so a text with many partners is sent to their
    homes, once to each, and no block has to hold all of its partners.
    """
    spark = rows.sparkSession
    side = lambda c, *names: sizes.select(
        F.col("id").alias(c), *[F.col(n).alias(f"{n}_{c}") for n in names])
    near = pairs.join(side("a", "size"), "a").join(side("b", "size"), "b").where(
        F.least("size_a", "size_b") >= F.lit(similarity) * F.greatest("size_a", "size_b") - SLACK
    ).select("a", "b")
    near = stored(near, "pairs")
    home = stored(homes(near, sizes), "homes")
    at = lambda c: home.select(F.col("id").alias(c), *[
        F.col(n).alias(f"{n}_{c}") for n in ("degree", "home")])
    weight = home.join(sizes, "id").agg(F.sum("size")).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-weight // BLOCK))
    block = F.pmod(F.when(F.col("degree_a") <= F.col("degree_b"), F.col("home_a")).otherwise(
        F.col("home_b")), F.lit(blocks))
    dealt = stored(near.join(at("a"), "a").join(at("b"), "b").select(
        "a", "b", block.alias("block")), "blocks")
    need = stored(dealt.select("block", F.explode(F.array("a", "b")).alias("id")).distinct(),
                  "texts")
    sent = texts_of(rows, need).join(need, "id").select("block", "id", "text")

    def check(texts: pa.Table, asked: pa.Table) -> pa.Table:
        let_go()
        body = dict(zip(texts.column("id").to_pylist(), texts.column("text").to_pylist()))
        sets: dict[int, np.ndarray] = {}
        found = []
        for a, b in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist()):
            for i in (a, b):
                if i not in sets:
                    sets[i] = shingle_set(body.pop(i), words)
            x, y = sorted((sets[a], sets[b]), key=len)
            places = np.searchsorted(y, x)
            shared = int((y[np.minimum(places, len(y) - 1)] == x).sum())
            if shared >= similarity * (len(x) + len(y) - shared):
                found.append((a, b))
        return pa.table({c: pa.array([f[k] for f in found], pa.int64())
                         for k, c in enumerate("ab")})

    return stored(sent.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(
        check, "a bigint, b bigint"), "similar")


def texts_of(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """`id` and `text`, once, of the texts that `asked` names, and of a few more. Only those are
    shuffled whose mark is asked for."""
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    marks = asked.select(mark.alias("mark")).distinct()
    return rows.withColumn("mark", mark).join(F.broadcast(marks), "mark").select(
        "id", "text").dropDuplicates(["id"])


def rare_first(sets: DataFrame, similarity: float) -> DataFrame:
    """`id`, `size`, `token` and its place `at` among the hashes that would be listed if hashes of
    few of the `sets` came first. Hashes that no other set has come before all others and have no
    row, so texts without enough common hashes have none. `rare` is how many hashes of the text at
    most `CROWD` sets have, `weight` how many sets have each of its hashes, in all."""
    tokens = sets.select("id", F.size("set").alias("size"), F.explode("set").alias("token"))
    common = counted(tokens, "token").where("n > 1").groupBy("id", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "token"))).alias("all"),
        (F.col("size") - F.count(F.when(F.col("n") > CROWD, True))).alias("rare"),
        F.sum("n").alias("weight"))
    spare = (F.size("all") - F.ceil(F.col("size") * similarity - SLACK) + 1).cast("int")
    return common.withColumn("spare", spare).where("spare > 0").select(
        "id", "size", F.posexplode(F.slice("all", F.lit(1), F.col("spare"))).alias("k", "t"),
        (F.col("size") - F.size("all")).alias("own"), "rare", "weight").select(
        "id", "size", F.col("t.token").alias("token"), (F.col("own") + F.col("k")).alias("at"),
        "rare", "weight")


def crowded_links(crowd: DataFrame, found: DataFrame, check, similarity: float) -> DataFrame:
    """Further edges between texts that share tokens of many texts: the rows of `crowd` have `id`,
    `size`, `token`, `at`, `rare` and `weight`. A few members of each token are compared with all of
    its members; then every pair is compared that no verified edges, `found` among them, join yet and
    that sizes and places do not forbid. `check` gives the similar ones of pairs.

    Two edited copies of one text are less similar to each other than to that text. So the members
    that hold least that is rare and most that is common come first: they join what can be joined by
    one text, and only the texts too far from all others are left to meet the rest.
    """
    tops = [F.min_by("id", F.struct("rare", -F.col("size"), "id")),
            F.max_by("id", F.struct("weight", "id")),
            *[F.min_by("id", F.xxhash64("id", F.lit(k))) for k in range(LEADERS)]]
    tops = crowd.groupBy("token").agg(F.array_distinct(F.array(*tops)).alias("tops"))
    stars = join_apart(crowd.select("id", "token"), tops, "token").groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_set("tops"))).alias("tops")).select(
        "id", F.explode("tops").alias("top")).where("id <> top").select(
        F.least("id", "top").alias("a"), F.greatest("id", "top").alias("b"))
    known = found.unionAll(check(stars.distinct()))
    # a pair counts at the first token that both have, where the bound by places is widest
    listed = crowd.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "token")))["token"
                                                                         ].alias("listed"))
    rooted = stored(crowd.select("id", "size", "token", "at").join(listed, "id").join(
        components(known).withColumnRenamed("bits", "id"), "id", "left").withColumn(
        "root", F.coalesce("root", "id")), "crowd")
    # the members outside of a token's largest group meet all members of other groups
    groups = rooted.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    main = groups.groupBy("token").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    minor = join_apart(rooted, main, "token").where("root <> main").select("token", "main", *[
        F.col(c).alias(f"_{c}") for c in ("id", "size", "at", "listed", "root")])
    overlap = F.lit(similarity / (1 + similarity)) * (F.col("size") + F.col("_size")) - SLACK
    ahead = F.least(F.col("size") - F.col("at"), F.col("_size") - F.col("_at"))
    rest = minor.join(rooted, "token").where(
        (F.col("root") != F.col("_root")) & ((F.col("root") == F.col("main")) | (
            F.col("_id") < F.col("id"))) & (ahead >= overlap) & (
            F.array_intersect("listed", "_listed")[0] == F.col("token"))).select(
        F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()
    return known.unionAll(check(rest))


def read_sets(rows: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """`id` and shingle `set` of the texts whose `id` is in `asked`; those texts alone are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in slices(batches):
            lists = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lists, pa.list_(pa.int64()))], ["id", "set"])

    return stored(texts_of(rows, asked).join(asked, "id").mapInArrow(
        run, "id bigint, set array<bigint>"), "sets")


def print_pairs(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (a, b) of ids whose fingerprints the signatures link: of each fingerprint its smallest
    `id` with all others, and over each link the smallest ids of both. `prints` has `id`, `bits`."""
    least = stored(prints.groupBy("bits").agg(F.min("id").alias("least")), "prints")
    equal = join_apart(prints, least, "bits").where("id <> least").select("id", "least")
    end = lambda c: least.select(F.col("bits").alias(c), F.col("least").alias(f"id_{c}"))
    near = links(least.select("bits"), max_bits).join(end("a"), "a").join(end("b"), "b").select(
        F.col("id_a").alias("id"), F.col("id_b").alias("least"))
    return equal.unionAll(near).select(
        F.least("id", "least").alias("a"), F.greatest("id", "least").alias("b")).distinct()


def unjoined(pairs: DataFrame, group: DataFrame) -> DataFrame:
    """The pairs (a, b) that `group` (`id`, `root`) does not join already."""
    end = lambda c: group.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}"))
    return pairs.join(end("a"), "a", "left").join(end("b"), "b", "left").where(
        "root_a IS NULL OR root_b IS NULL OR root_a <> root_b").select("a", "b")


def similar_links(rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """Edges (a, b) between `id`s of texts that join exactly the groups that all pairs join whose
    sets of `words`-word shingles have a Jaccard similarity of `similarity` or more. `rows` has
    `id` and `text`, copies too; equal ids have equal texts.

    SimHash comes first: fingerprints of the sets meet by deletion-variant signatures (`links`), and
    pairs that verify as similar join their texts. An exact check follows, as similar texts may
    differ in more bits: it compares only texts that are not joined yet.

    There, similar texts share one of their first hashes in any order of all hashes: here that of the
    values, with the crowded ones (listed by over `CROWD` texts) behind all others. Each text lists
    more hashes than needed, so most have enough that are not crowded, and texts that share one of
    those are compared. The others are dense: all their hashes that are not crowded meet the lists
    of the former, and among themselves they are listed with rare hashes first. There only texts
    that consist of common hashes nearly throughout meet in large groups (`crowded_links`).

    The listed hashes are shuffled once and those that no other text lists end there. What is kept
    beside them are sizes, counts and pairs; whole texts are read again to verify.
    """
    cut = token_rows(rows, words, similarity).repartition("kind", "key").dropDuplicates()
    kept = stored(counted(cut, "kind", "key").where(f"n > 1 OR kind <> {TOKEN}"), "hashes")
    shared = kept.where(f"kind = {TOKEN}").select(
        F.col("key").alias("token"), F.col("value").alias("id"), "n")
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("value")))
    sizes = stored(kept.where(f"kind <> {TOKEN}").groupBy(F.col("key").alias("id")).agg(
        of(SIZE).alias("size"), of(LAST).alias("last"), of(PRINT).alias("bits")), "sizes")
    check = lambda some: verified(
        some, rows, sizes.select("id", "size"), words, similarity)
    alike = check(print_pairs(sizes.select("id", "bits")))
    group = stored(components(alike).withColumnRenamed("bits", "id"), "alike")
    crowded = shared.where(F.col("n") > CROWD)
    least = F.col("size") - F.ceil(F.col("size") * similarity - SLACK) + 1
    room = F.least("size", least + F.floor(least / 2) + CROWD) - least
    # what a text can have in common with one that lists at least as far, beside hashes that are
    # listed and not crowded
    notes = sizes.join(crowded.groupBy("id").agg(F.count(F.lit(1)).alias("c")), "id", "left").select(
        "id", "size", "last", F.coalesce("c", F.lit(0)).alias("c"), room.alias("room"),
        (F.col("size") - least - room + F.coalesce("c", F.lit(0))).alias("more"))
    notes = stored(notes, "notes")
    dense = notes.where("c > room").select("id")
    note = lambda c: notes.select(F.col("id").alias(c), *[
        F.col(x).alias(f"{x}_{c}") for x in ("size", "last", "more")])
    least = F.lit(similarity / (1 + similarity)) * (F.col("size_a") + F.col("size_b")) - SLACK
    pairs = small_pairs(shared).join(note("a"), "a").join(note("b"), "b").where(
        F.col("o") + F.when(F.col("last_a") <= F.col("last_b"), F.col("more_a")).otherwise(
            F.col("more_b")) >= least).select("a", "b")
    if dense.isEmpty():
        return alike.unionAll(check(unjoined(pairs.distinct(), group)))
    sets = read_sets(rows, dense, words)
    other = stored(sets.select(F.col("id").alias("b"), F.explode("set").alias("token")).join(
        crowded.select("token").distinct(), "token", "left_anti"), "dense")
    again = token_rows(rows, words, similarity, bitmap_of(other)).select(
        F.col("key").alias("token"), F.col("value").alias("a")).distinct()
    across = again.join(dense.withColumnRenamed("id", "a"), "a", "left_anti").join(
        other, "token").groupBy("a", "b").agg(F.count(F.lit(1)).alias("o")).join(
        note("a"), "a").join(note("b"), "b").where(F.col("o") + F.col("more_a") >= least).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    common = stored(counted(rare_first(sets, similarity), "token").where("n > 1"), "common")
    pairs = pairs.unionAll(across).unionAll(small_pairs(common).drop("o")).distinct()
    found = alike.unionAll(check(unjoined(pairs, group)))
    crowd = common.where(F.col("n") > CROWD).drop("n")
    return found if crowd.isEmpty() else crowded_links(crowd, found, check, similarity)


def number_texts(known: DataFrame) -> DataFrame:
    """`known` with an `id` for each `hash`, a 64-bit hash of it; hashed again with another number
    should two ever have the same, so that equal ids mean equal texts."""
    salt = 0
    while True:
        numbered = known.withColumn("id", F.xxhash64("hash", F.lit(salt)))
        same = numbered.select("id", "hash").distinct().groupBy("id").agg(
            F.count(F.lit(1)).alias("n")).where("n > 1")
        if same.isEmpty():
            return numbered.withColumn("salt", F.lit(salt))
        salt += 1


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until the frame has no column that Spark takes for the same."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """The rows of `docs` without near copies: of every group that links at `similarity` join, the
    row with the smallest key stays (a null key comes last), one row if it is repeated.

    Equal texts are one entry. Null and empty texts are one group. All columns stay, whatever their
    names. An empty table stays empty.
    """
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    digest = F.md5(body.cast("binary"))
    known = number_texts(stored(docs.select(docs[f"`{key}`"].alias("doc"), digest.alias("hash")
                                            ).groupBy("doc", "hash").agg(
        F.count(F.lit(1)).alias("n")), "known"))
    salt = (known.select("salt").first() or [0])[0]
    rows = docs.select(F.xxhash64(digest, F.lit(salt)).alias("id"), body.alias("text"))
    group = components(similar_links(rows, words, similarity)).withColumnRenamed("bits", "id")
    rooted = known.join(group, "id", "left").withColumn("root", F.coalesce("root", "id"))
    order = F.struct(F.col("doc").isNull().alias("none"), F.col("doc").alias("doc"),
                     F.col("hash").alias("hash"))
    best = rooted.groupBy("root").agg(F.min(order).alias("best"))
    found = fresh(docs, "near_doc", "near_hash")
    judged = stored(join_apart(rooted, best, "root").select(
        F.col("doc").alias(found[0]), F.col("hash").alias(found[1]), "n",
        (F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("hash") == F.col("best.hash"))
         ).alias("kept")), "kept")
    gone = judged.where("NOT kept OR n > 1").select(*found)
    # rows whose mark no lost row has stay without a shuffle
    mark = lambda doc, text: F.pmod(F.xxhash64(doc, text), F.lit(MARKS))
    lost = F.broadcast(gone.select(mark(*found).alias("mark")).distinct())
    own = mark(docs[f"`{key}`"], digest)
    cond = docs[f"`{key}`"].eqNullSafe(gone[found[0]]) & (digest == gone[found[1]])
    once = docs.join(lost, own == lost["mark"], "left_anti").unionAll(
        docs.join(lost, own == lost["mark"], "left_semi").join(gone, cond, "left_anti"))
    twice = judged.where("kept AND n > 1").select(*found)
    cond = docs[f"`{key}`"].eqNullSafe(twice[found[0]]) & (digest == twice[found[1]])
    again = docs.join(twice, cond).dropDuplicates(found).select(
        *[docs[f"`{c}`"] for c in docs.columns])
    return once.unionAll(again)

"""Sharding by a k-d tree over row metadata.

The points of the tree are groups of equal texts, each with the bytes of all its rows and the
metadata of its least row, so a group stays in one shard; only one larger than a shard is cut. A node that should become p shards is split at the weighted median (weights floor(p/2) : ceil(p/2))
along its widest dimension, until every leaf is one shard of about the target bytes. All nodes of a
level are split at once: points are range-partitioned by (node, value, text), a point's cumulative
bytes are its slice's running sum plus the bytes of its node in earlier slices. Only metadata
moves, never the texts, and no row passes through the driver or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.operators.skew import join_null_safe, row_number_in_slices

FLOOR = -(1 << 63)
# a group larger than a shard is cut into pieces of this share of a shard
PIECES = 16
GROUP = ["crc", "mark", "size"]
POINT = [*GROUP, "piece"]


def dimension(docs: DataFrame, name: str) -> Column:
    """A metadata column as a number; text by its hash, so equal texts meet; null comes first."""
    kind = docs.schema[name].dataType.simpleString()
    col = docs[f"`{name}`"]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        col = F.xxhash64(col.cast("string"))
    return F.coalesce(col.cast("bigint"), F.lit(FLOOR))


def split_level(rows: DataFrame, dims: list[str], widths: dict[str, float]) -> DataFrame:
    """Splits every node that stands for several shards. A node is (first, parts): its shards are
    first .. first + parts - 1."""
    node = ["first", "parts"]
    spans = [F.struct(((F.max(d).cast("double") - F.min(d).cast("double")) / widths[d]).alias("w"),
                      F.lit(-k).alias("k")) for k, d in enumerate(dims)]
    # one row per node, at most twice the number of shards
    nodes = rows.where("parts > 1").groupBy(*node).agg(
        F.sum("weight").alias("_bytes"), F.greatest(*spans).alias("_widest") if len(spans) > 1
        else spans[0].alias("_widest"))
    nodes = nodes.select(*node, "_bytes", (-F.col("_widest.k")).alias("_axis"))
    value = F.lit(0).cast("bigint")
    for k, d in enumerate(dims):
        value = F.when(F.col("_axis") == k, F.col(d)).otherwise(value)
    placed = rows.join(nodes, node, "left").withColumn("_value", value)
    slices = (
        placed.repartitionByRange("first", "_value", *POINT)
        .withColumn("_slice", F.spark_partition_id()).checkpoint()
    )
    sums = slices.groupBy(*node, "_slice").agg(F.sum("weight").alias("_held"))
    before = Window.partitionBy(*node).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(*node, "_slice",
                          F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_earlier"))
    running = Window.partitionBy(*node, "_slice").orderBy("_value", *POINT).rowsBetween(
        Window.unboundedPreceding, 0)
    summed = join_null_safe(slices.withColumn("_run", F.sum("weight").over(running)), offsets,
                            [*node, "_slice"])
    left = F.floor(F.col("parts") / 2).cast("int")
    # the middle of a point decides on which side of the border it lies
    middle = 2 * (F.col("_earlier") + F.col("_run")) - F.col("weight")
    low = middle * F.col("parts") <= 2 * F.col("_bytes") * left
    several = F.col("parts") > 1
    return summed.select(
        *[c for c in rows.columns if c not in node],
        F.when(several & ~low, F.col("first") + left).otherwise(F.col("first")).alias("first"),
        F.when(~several, F.col("parts")).when(low, left).otherwise(
            F.col("parts") - left).cast("int").alias("parts"))


def cut_groups(rows: DataFrame, shard_bytes: int) -> DataFrame:
    """Rows with their `piece`: 0, but for groups larger than a shard, whose rows are dealt in order
    of key to pieces of a sixteenth of a shard. Such groups are fewer than the shards."""
    bytes_held = F.count(F.lit(1)) * F.col("size")
    large = rows.groupBy(*GROUP).agg(bytes_held.alias("_held")).where(
        F.col("_held") > shard_bytes).select(*GROUP, F.greatest(F.lit(1), F.floor(
            F.lit(shard_bytes) / (PIECES * F.col("size")))).cast("bigint").alias("_share"))
    marked = rows.join(F.broadcast(large), GROUP, "left")
    numbered = row_number_in_slices(marked.where("_share IS NOT NULL"), GROUP,
                                    [F.col("key"), F.col("rid")], "_number")
    whole = marked.where("_share IS NULL").select(*rows.columns, F.lit(0).cast("bigint").alias("piece"))
    return whole.unionByName(numbered.select(
        *rows.columns, F.floor((F.col("_number") - 1) / F.col("_share")).alias("piece")))


def assign(rows: DataFrame, dims: list[str], target_bytes: int | None, shards: int | None
           ) -> DataFrame:
    """`rows` (key, size, crc, mark, rid and the dimensions) with their `shard`."""
    whole = rows.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        *[(F.max(d).cast("double") - F.min(d).cast("double")).alias(d) for d in dims]).first()
    if shards is None:
        shards = max(1, -(-whole["bytes"] // target_bytes))
    widths = {d: whole[d] or 1.0 for d in dims}
    cut = cut_groups(rows, max(1, whole["bytes"] // shards)).checkpoint()
    least = F.min(F.struct("key", "rid", *dims))
    now = cut.groupBy(*POINT).agg(F.sum("size").alias("weight"), least.alias("_least")).select(
        *POINT, "weight", *[f"_least.{d}" for d in dims], F.lit(0).alias("first"),
        F.lit(shards).cast("int").alias("parts"))
    for _ in range((shards - 1).bit_length()):
        now = split_level(now, dims, widths)
    return cut.join(now.select(*POINT, F.col("first").alias("shard")), POINT)


def metadata(docs: DataFrame, dims: list[str], key: str, text: str, rid: Column) -> DataFrame:
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    return docs.select(
        docs[f"`{key}`"].alias("key"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"), F.xxhash64(body).alias("mark"),
        rid.alias("rid"), *[dimension(docs, d).alias(f"d{k}") for k, d in enumerate(dims)])


def numbered(assigned: DataFrame) -> DataFrame:
    """Rows with `slot`, gapless from 0 within a shard, by key."""
    placed = assigned.select("key", "size", "crc", "rid", "shard")
    return row_number_in_slices(
        placed, ["shard"], [F.col("key"), F.col("rid")], "slot").withColumn(
        "slot", F.col("slot") - 1)


def kd_shards(docs: DataFrame, dims: list[str], target_bytes: int | None = None,
              shards: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `size` (UTF-8 bytes of the text plus 1), `text_crc32`, `shard` (from 0) and `slot`
    (gapless from 0 within a shard, by key), one row per input row.

    Give the number of shards, or the bytes a shard should have. A null text has no bytes and is
    equal to an empty one; null keys and repeated rows are rows of their own. Rows of one text are
    in one shard unless they hold more bytes than a shard; then they lie in pieces of a sixteenth
    of a shard. Ties along a dimension go by text, and a border is at most half a group (or
    piece) off its place. An empty table has no shards.
    """
    rows = metadata(docs, dims, key, text, F.monotonically_increasing_id()).checkpoint()
    names = [f"d{k}" for k in range(len(dims))]
    return numbered(assign(rows, names, target_bytes, shards)).select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def write_shards(docs: DataFrame, path: str, dims: list[str], target_bytes: int | None = None,
                 shards: int | None = None, key: str = "doc_id", text: str = "text") -> None:
    """Shards the documents and writes them as one Parquet folder per shard, each dealt over
    several tasks by slot. Every row is written once, those with null or repeated keys too: the
    documents are kept in the shared folder under a row id first, and joined to their shard by
    it. A column named `shard` is replaced."""
    kept = docs.drop("shard") if "shard" in docs.columns else docs
    rid = next(n for n in ("_rid", *(f"_rid{k}" for k in range(len(docs.columns))))
               if n not in docs.columns)
    slot = next(n for n in ("_slot", *(f"_slot{k}" for k in range(len(docs.columns))))
                if n not in docs.columns)
    held = docs.withColumn(rid, F.monotonically_increasing_id()).checkpoint()
    rows = metadata(held, dims, key, text, held[rid])
    names = [f"d{k}" for k in range(len(dims))]
    place = numbered(assign(rows, names, target_bytes, shards)).select(
        F.col("rid").alias(rid), F.col("shard"), F.col("slot").alias(slot))
    joined = held.select(*[f"`{c}`" for c in kept.columns], rid).join(place, rid).drop(rid)
    joined.repartitionByRange("shard", slot).sortWithinPartitions("shard", slot).drop(
        slot).write.partitionBy("shard").mode("errorifexists").parquet(path)

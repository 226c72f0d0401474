"""Connected components by alternating star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder. Unlike a checkpoint it does not hand on what Spark
    has found out about the columns, which piles up over rounds and slows down planning."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(key: Column) -> Column:
    """A key of the same rows as a long `key` that no aggregate on `key` is dealt out by. A join on
    it gets shuffles of its own on both sides, which Spark can split where one key has many rows; a
    join on `key` would take over the aggregate's."""
    return key.bitwiseXOR(F.lit(1).cast("bigint"))


def join_apart(rows: DataFrame, aggregate: DataFrame, key: str) -> DataFrame:
    """Inner join of rows to an aggregate of theirs on a long `key`; a hot key can be split."""
    other = aggregate.withColumnRenamed(key, f"{key}_of_group")
    return rows.join(other, apart(rows[key]) == apart(other[f"{key}_of_group"])).drop(
        f"{key}_of_group")


def components(edges: DataFrame) -> DataFrame:
    """`bits` and `root` (the smallest node reachable) of every node with an edge (a, b).

    Each round hangs a node's larger neighbours below its smallest neighbour, then its smaller
    ones; the number of rounds grows with the logarithm of the longest path. A node with many
    neighbours meets them in aggregates that combine before the shuffle and in a join with shuffles
    of its own, which Spark splits, never as one list. Rounds end when the edge table no longer changes; only its size and a checksum reach the
    driver, and each round is written so that a lost executor costs one round.
    """
    now = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        mark = tuple(state.first())
        if mark[0] == 0 or mark == before:
            break
        before = mark
        now = stored(star(star(now, larger=True), larger=False), "edges")
    return now.select(F.greatest("a", "b").alias("bits"), F.least("a", "b").alias("root")).unionAll(
        now.select(F.least("a", "b"), F.least("a", "b"))).distinct()


def star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links the larger (or the smaller) neighbours of each node to its smallest neighbour or
    itself. The smaller step keeps every edge's larger end as the node."""
    if larger:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("w")).select(
        F.col("u").alias("node"), F.least("u", "w").alias("w"))
    joined = around.join(least, apart(around["u"]) == apart(least["node"]))
    if larger:
        out = joined.where("v > u").select(F.col("w").alias("a"), F.col("v").alias("b"))
    else:
        out = joined.where("v <> w").select(F.col("w").alias("a"), F.col("v").alias("b")).unionAll(
            least.select(F.col("w").alias("a"), F.col("node").alias("b")))
    return out.where("a <> b").distinct()

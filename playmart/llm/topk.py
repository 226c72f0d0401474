"""Exact top-k search by inner product with a three-phase uniform threshold.

A vector's dimensions are cut into `lists`; each list scores the candidates by its own dimensions,
and a candidate's score is the sum over the lists. A list is held in cells of a block of queries and
a slice of the candidates, and a cell sees the dimensions of its list alone.

1. Every list gathers its best entries for each query. The scores of the candidates met are
   resolved, and the k-th best of them is a safe bound: at least k candidates reach it.
2. A candidate that reaches the bound has at least one list in which it reaches the bound divided by
   the number of lists, whatever the signs. Each query carries this cutoff to all cells, and each
   list collects every entry that reaches it.
3. Candidates collected by all lists have their scores. They raise the bound; of the others those
   that cannot reach it, with the cutoff for what is missing, go; what remains is resolved exactly.

Rows with equal vectors are one candidate and one query, so copies never meet as pairs. Such a
candidate lists its `k + 1` smallest keys, which are all that a ranking with ties to smaller keys
can show once a query's own row is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.llm.vectors import filled, matrix, products, scaled, usable, widest

ASKED, HELD = 1024, 4096   # queries and candidates of a cell
CHUNK = 1024               # candidates scored at once
ENTRIES = "q bigint, list int, c bigint, part bigint"


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """`v`, `x`, its `keep` smallest `ids` (null last) and whether it is `asked`, once for each
    vector. Of each vector only so many rows of a task are shuffled."""
    first = Window.partitionBy("x").orderBy(F.col("id").asc_nulls_last())
    few = rows.select("x", "id", F.row_number().over(first).alias("at")).where(
        F.col("at") <= keep).groupBy("x").agg(
        F.array_sort(F.collect_list(F.struct("at", "id")))["id"].alias("ids"))
    asked = rows.where("asked").select(F.col("x").alias("y")).distinct()
    return few.join(asked, F.col("x") == F.col("y"), "left").select(
        F.monotonically_increasing_id().alias("v"), "x", "ids",
        F.col("y").isNotNull().alias("asked")).checkpoint()


def cells(vectors: DataFrame, queries: DataFrame, width: int, lists: int, blocks: int, slices: int
          ) -> tuple:
    """Queries and candidates dealt to the cells (list, query block, candidate slice)."""
    step = -(-width // lists)
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda v, n: F.pmod(F.xxhash64(v), F.lit(n)).cast("int")
    part = lambda x: F.slice(x, F.col("list") * step + 1, F.lit(step)).alias("part")
    held = vectors.select("v", "x", place("v", slices).alias("s"), numbers(lists).alias(
        "list")).select("v", "s", "list", part("x"), numbers(blocks).alias("b"))
    asked = queries.select("q", "y", "bound", place("q", blocks).alias("b"), numbers(lists).alias(
        "list")).select("q", "b", "list", "bound", part("y"), numbers(slices).alias("s"))
    cell = ["list", "b", "s"]
    return asked.groupBy(*cell).cogroup(held.groupBy(*cell)), step


def score_cells(grid, width: int, lists: int, step: int, pick) -> DataFrame:
    """What `pick` takes of every cell: it gets the queries' bounds and the scores of a chunk of
    candidates at a time, and gives (query places, candidate places, scores)."""

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        number = key[0].as_py()
        wide = max(0, min(step, width - number * step))
        q, c = asked.column("q").to_numpy(), held.column("v").to_numpy()
        found = []
        if len(q) and len(c):
            left, right = matrix(asked.column("part"), wide), matrix(held.column("part"), wide)
            parts = ((at, products(left, right[at:at + CHUNK])) for at in range(0, len(c), CHUNK))
            found = [(q[i], c[j], s) for i, j, s in pick(asked.column("bound"), parts)]
        qs, cs, ss = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64)
                      for k in range(3))
        return pa.table({"q": qs, "list": np.full(len(qs), number, np.int32), "c": cs,
                         "part": ss.astype(np.int64)})

    return grid.applyInArrow(run, ENTRIES)


def local_best(keep: int):
    """Each query's `keep` best entries of a cell."""

    def pick(bounds, parts):
        best = None
        for at, scores in parts:
            places = np.broadcast_to(np.arange(at, at + scores.shape[1]), scores.shape)
            if best:
                scores = np.concatenate((best[0], scores), axis=1)
                places = np.concatenate((best[1], places), axis=1)
            if scores.shape[1] > keep:
                top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
                scores = np.take_along_axis(scores, top, 1)
                places = np.take_along_axis(places, top, 1)
            best = scores, places
        asked = np.repeat(np.arange(len(best[0])), best[0].shape[1])
        yield asked, best[1].reshape(-1), best[0].reshape(-1)

    return pick


def reaching(lists: int):
    """All entries of a cell that reach their query's cutoff; all entries where it has none."""

    def pick(bounds, parts):
        least = np.array([-(1 << 62) if b is None else -(-b // lists) for b in bounds.to_pylist()],
                         np.int64)
        for at, scores in parts:
            asked, places = np.nonzero(scores >= least[:, None])
            yield asked, places + at, scores[asked, places]

    return pick


def resolved(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """`q`, `c` and their whole `score`."""
    side = lambda name, x: vectors.select(
        F.col("v").alias(name), F.col("x").alias(x))
    dot = F.aggregate(F.zip_with("_x", "_y", lambda a, b: a * b), F.lit(0).cast("bigint"),
                      lambda total, p: total + p)
    return pairs.join(side("q", "_x"), "q").join(side("c", "_y"), "c").select(
        "q", "c", dot.alias("score"))


def best_of(scores: DataFrame, keep: int, *ties: Column) -> DataFrame:
    """Each query's `keep` best rows."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), *ties)
    return scores.withColumn("at", F.row_number().over(order)).where(F.col("at") <= keep)


def bounds(scores: DataFrame, keep: int) -> DataFrame:
    """`q` and the score that `keep` of its candidates reach; queries with fewer have no row."""
    return best_of(scores, keep, F.col("c")).where(F.col("at") == keep).select(
        "q", F.col("score").alias("bound"))


def search(rows: DataFrame, asked: Column, k: int = 5, key: str = "vec_id",
           vector: str = "embedding", lists: int = 2) -> DataFrame:
    """`query_id`, `rank` (from 1), `key` and `score` of the `k` best other rows for each row that
    `asked` names; ties go to smaller keys, null keys last.

    Scores are inner products of floor(256 c) over the entries c, as long integers (an error where
    they may leave their range). Vectors that are
    null or hold null, NaN or infinity take no part. A shorter vector counts as if zeros followed.
    Each row is an entry of its own, whatever its key: a repeated row is a candidate for its twin.
    Fewer than `k` other rows give all of them; an empty table, or one without queries, no row.
    Other columns are ignored.
    """
    given = rows.select(rows[f"`{key}`"].alias("id"), rows[f"`{vector}`"].alias("given"),
                        F.coalesce(asked, F.lit(False)).alias("asked")).where(usable(F.col("given")))
    exact = given.select("id", "asked", scaled(F.col("given")).alias("x"))
    width, keep = widest(exact, "x"), k + 1
    exact = exact.withColumn("x", filled(F.col("x"), width))
    vectors = distinct_vectors(exact, keep)
    held, named = vectors.agg(F.count(F.lit(1)), F.count_if("asked")).first()
    lists = max(1, min(lists, width))
    blocks, slices = max(1, -(-named // ASKED)), max(1, -(-held // HELD))

    # phase 1
    queries = vectors.where("asked").select(F.col("v").alias("q"), F.col("x").alias("y"))
    grid, step = cells(vectors, queries.withColumn("bound", F.lit(None).cast("bigint")), width,
                       lists, blocks, slices)
    local = score_cells(grid, width, lists, step, local_best(keep))
    most = Window.partitionBy("q", "list").orderBy(F.col("part").desc(), "c")
    gathered = local.withColumn("at", F.row_number().over(most)).where(F.col("at") <= keep)
    met = resolved(gathered.select("q", "c").distinct(), vectors)
    first = bounds(met, keep).checkpoint()

    # phase 2
    grid, step = cells(vectors, queries.join(first, "q", "left"), width, lists, blocks, slices)
    collected = score_cells(grid, width, lists, step, reaching(lists)).groupBy("q", "c").agg(
        F.sum("part").alias("seen"), F.count(F.lit(1)).alias("n")).checkpoint()

    # phase 3
    whole = collected.where(F.col("n") == lists).select("q", "c", F.col("seen").alias("score"))
    raised = first.unionAll(bounds(whole, keep)).groupBy("q").agg(
        F.min("bound").alias("low"), F.max("bound").alias("bound"))
    missing = (F.lit(lists) - F.col("n")) * F.floor((F.col("low") - 1) / F.lit(lists))
    open_ = collected.join(raised, "q", "left").where(
        F.col("bound").isNull() | (F.col("seen") + missing >= F.col("bound")))
    part = open_.where(F.col("n") < lists).select("q", "c")
    scores = open_.where(F.col("n") == lists).select(
        "q", "c", F.col("seen").alias("score")).unionAll(resolved(part, vectors))

    ids = vectors.select(F.col("v").alias("c"), "ids")
    smaller = F.col("ids")[0].asc_nulls_last()
    top = best_of(scores.join(ids, "c"), keep, smaller).select(
        "q", "c", "score", F.explode("ids").alias("id"))
    ranked = best_of(top, keep, F.col("id").asc_nulls_last(), F.col("c")).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("at", "score", "id", "c"))).alias("best"))
    one = exact.where("asked").select("id", "x").join(queries, F.col("x") == F.col("y")).select(
        F.col("id").alias("query_id"), "q").join(ranked, "q")
    own = F.filter("best", lambda e: (e["c"] == F.col("q")) & e["id"].eqNullSafe(F.col("query_id")))
    place = F.coalesce(F.try_element_at(own, F.lit(1))["at"], F.lit(0))
    others = F.slice(F.filter("best", lambda e: e["at"] != F.col("own")), 1, k)
    return one.withColumn("own", place).select(
        "query_id", F.posexplode(others).alias("place", "entry")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("entry.id").alias(key),
        F.col("entry.score").alias("score"))

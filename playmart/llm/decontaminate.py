"""Benchmark decontamination over a positional inverted index.

The index holds a posting (document, term, position) for every occurrence of every test term in the
training texts. A phrase is found from its rarest terms: their posting lists, shifted by the terms'
offsets in the phrase, are intersected; the starts that are left are checked against the postings
of all other terms. Only built-in DataFrame functions run.

A document is known by its id and the hash of its text, so null and repeated ids need no care.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.session import scratch_path

WINDOW = 10
TERMS = 1_000_000        # test terms (or windows) up to which their table is broadcast
MARKS = 1 << 18          # marks of documents that still count; a bound, whatever the corpus
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["doc", "hash"]


def words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z only: runs of digits, letters and all that is not
    ASCII. Null and empty texts have none."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, BETWEEN), "")


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    return docs.select(docs[f"`{key}`"].alias("doc"), F.xxhash64(body).alias("hash"),
                       body.alias("text"))


def small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Broadcasts a table whose rows were counted, up to a bound; beyond it Spark joins by shuffle
    and splits what is skewed."""
    return F.broadcast(df) if rows <= most else df


def phrases(items: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """`item`, `phrase` (array of words): each run of `window` words, or all words of an item with
    fewer. Items without words have none."""
    listed = items.select(items[f"`{key}`"].cast("string").alias("item"),
                          words(items[f"`{text}`"]).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return listed.select("item", "w", F.explode(starts).alias("at")).select(
        "item", F.expr(f"slice(w, at, {window})").alias("phrase"))


def test_terms(windows: DataFrame) -> DataFrame:
    """`word` and `term`, a number for every word of the phrases."""
    return windows.select(F.explode("phrase").alias("word")).distinct().select(
        "word", F.monotonically_increasing_id().alias("term")).checkpoint()


def write_index(docs: DataFrame, terms: DataFrame, path: str, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Writes the postings of the test terms in all whole texts and returns them: `doc`, `hash`,
    `term` and `at` (word position from 0). A scan, without a shuffle while the terms are few."""
    tokens = identified(docs, key, text).select(
        *DOC, F.posexplode(words(F.col("text"))).alias("at", "word"))
    found = tokens.join(small(terms, terms.count(), TERMS), "word").select(*DOC, "term", "at")
    found.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def join_docs(left: DataFrame, right: DataFrame, how: str, on: tuple[str, ...] = (),
              within: int | None = None) -> DataFrame:
    """Joins rows of the same document that also agree `on` columns, or whose places `start` and
    `at` are `within` words apart; keeps the left columns, and the right's others for other joins
    than semi joins."""
    right = right.withColumnsRenamed({c: f"_{c}" for c in (*DOC, *on)})
    cond = F.col("doc").eqNullSafe(F.col("_doc"))
    for c in ("hash", *on):
        cond = cond & (F.col(c) == F.col(f"_{c}"))
    if within is not None:
        cond = cond & (F.abs(F.col("start") - F.col("at")) <= within)
    return left.join(right, cond, how).drop(*[f"_{c}" for c in (*DOC, *on)])


def by_rarity(listed: DataFrame, index: DataFrame, terms: DataFrame) -> DataFrame:
    """`wid` and `order`: structs (times the term occurs, term, offset), the rarest first, of every
    entry of `listed` (wid, phrase) whose terms all occur in the index."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    spread = listed.select("wid", F.size("phrase").alias("size"),
                           F.posexplode("phrase").alias("offset", "word"))
    counted = spread.join(terms, "word").join(counts, "term")
    return counted.groupBy("wid", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("order")
    ).where("size(order) = size").select("wid", "order").checkpoint()


def phrase_matches(index: DataFrame, listed: DataFrame, terms: DataFrame) -> DataFrame:
    """`doc`, `hash`, `wid`, `start` of every exact occurrence of a phrase of `listed` (wid,
    phrase), each once. Two occurrences may overlap."""
    order = by_rarity(listed, index, terms)
    rows = order.count()

    def nth(k: int) -> DataFrame:
        return order.where(F.size("order") > k).select(
            "wid", F.col("order")[k]["term"].alias("term"),
            F.col("order")[k]["offset"].alias("offset"))

    # the rarest term gives starts, the next one must agree
    first = index.join(small(nth(0), rows, TERMS), "term").select(
        *DOC, "wid", (F.col("at") - F.col("offset")).alias("start")).where("start >= 0")
    second = index.join(small(nth(1), rows, TERMS), "term").select(
        *DOC, "wid", (F.col("at") - F.col("offset")).alias("start"))
    longer = order.where("size(order) > 1").select("wid")
    alone = order.where("size(order) = 1").select("wid")
    a, b = first.join(small(longer, rows, TERMS), "wid"), second.distinct()
    both = join_docs(a, b, "left_semi", ("wid", "start"))
    starts = both.unionAll(
        first.join(small(alone, rows, TERMS), "wid").select(*a.columns)).distinct().checkpoint()

    rest = order.select("wid", F.expr("slice(order, 3, size(order))").alias("rest"))
    asked = starts.join(small(rest, rows, TERMS), "wid")
    done = asked.where("size(rest) = 0").select(*DOC, "wid", "start")
    asked = asked.where("size(rest) > 0").select(
        *DOC, "wid", "start", F.size("rest").alias("size"), F.explode("rest").alias("r")).select(
        *DOC, "wid", "start", "size", F.col("r.term").alias("term"),
        (F.col("start") + F.col("r.offset")).alias("at"))
    # postings of documents that no longer count are dropped before they are shuffled
    mark = F.pmod(F.col("hash"), F.lit(MARKS))
    marks = starts.select(mark.alias("mark")).distinct()
    seen = index.withColumn("mark", mark).join(F.broadcast(marks), "mark").select(
        *DOC, "term", "at")
    agreed = join_docs(asked, seen, "left_semi", ("at", "term"))
    full = agreed.groupBy(*DOC, "wid", "start", "size").agg(
        F.count(F.lit(1)).alias("n")).where("n = size").select(*DOC, "wid", "start")
    return done.unionAll(full)


def proximity_matches(index: DataFrame, listed: DataFrame, terms: DataFrame,
                      within: int) -> DataFrame:
    """`doc`, `hash`, `wid`, `start`: places of a phrase's rarest term that have every other of its
    terms at most `within` words away, in any order. A repeated word is asked for once."""
    once = listed.select("wid", F.array_distinct("phrase").alias("phrase"))
    order = by_rarity(once, index, terms)
    anchors = order.select("wid", F.col("order")[0]["term"].alias("term"),
                           F.size("order").alias("size"))
    others = order.select("wid", F.explode(F.expr("slice(order, 2, size(order))")).alias("o")
                          ).select("wid", F.col("o.term").alias("term"))
    places = index.join(anchors, "term").select(
        *DOC, "wid", "size", F.col("at").alias("start")).distinct().checkpoint()
    # both sides are cut into stretches of `within` words, so an equality join finds neighbours
    reach = F.explode(F.sequence(F.floor(F.col("start") / within) - 1,
                                 F.floor(F.col("start") / within) + 1))
    left = places.where("size > 1").withColumn("cell", reach).join(
        others.withColumnRenamed("term", "asked"), "wid")
    right = index.select(*DOC, F.col("term").alias("asked"), "at",
                         F.floor(F.col("at") / within).alias("cell"))
    met = join_docs(left, right, "inner", ("cell", "asked"), within)
    full = met.groupBy(*DOC, "wid", "start", "size").agg(
        F.count_distinct("asked").alias("n")).where("n = size - 1").select(*DOC, "wid", "start")
    return places.where("size = 1").select(*DOC, "wid", "start").unionAll(full)


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id",
         text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """`doc`, `hash`, `n_hit` (words inside any occurrence of a window) and `items` (sorted ids, as
    strings, of the items with occurring windows) of the documents that have an occurrence.

    Items with a null id hit words but are not listed; repeated items and documents count once.
    """
    spark = docs.sparkSession
    windows = phrases(items, item_key, item_text, window).checkpoint()
    terms = test_terms(windows)
    listed = windows.select("phrase").distinct().select(
        F.monotonically_increasing_id().alias("wid"), "phrase").checkpoint()
    index = write_index(docs, terms, scratch_path(spark, "postings"), key, text)
    found = phrase_matches(index, listed, terms).checkpoint()
    sized = listed.select("wid", F.size("phrase").alias("size"), "phrase")
    rows = listed.count()
    covered = found.join(small(sized, rows, TERMS), "wid").select(
        *DOC, F.explode(F.expr("sequence(start, start + size - 1)")).alias("at")
    ).distinct().groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_hit"))
    owners = windows.join(sized, "phrase").where("item IS NOT NULL").select(
        "wid", "item").distinct()
    named = found.select(*DOC, "wid").distinct().join(
        small(owners, windows.count(), TERMS), "wid").groupBy(*DOC).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    return join_docs(covered, named, "left").select(
        *DOC, "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  **options) -> DataFrame:
    """One row per document row: `key`, `n_words`, `n_hit`, `items` and `contaminated`."""
    found = hits(docs, items, key=key, text=text, **options)
    rows = identified(docs, key, text).select(
        *DOC, F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    return join_docs(rows, found, "left").select(
        F.col("doc").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          **options) -> DataFrame:
    """The rows of `docs` without any occurrence of a window, with all their columns."""
    found = hits(docs, items, key=key, text=text, **options).select(
        F.col("doc").alias("__hit_doc"), F.col("hash").alias("__hit_hash"))
    cond = docs[f"`{key}`"].eqNullSafe(found["__hit_doc"]) & (
        F.xxhash64(F.coalesce(docs[f"`{text}`"], F.lit(""))) == found["__hit_hash"])
    return docs.join(found, cond, "left_anti")

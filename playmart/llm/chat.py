"""Chat formatting over reply trees.

Messages name the message they answer. Self-joins that double their reach give every node its
ancestors, so the number of rounds grows with the logarithm of the depth. Branches (root to leaf)
are ranked by the sum of their messages' scores, and each chosen branch becomes one conversation
with a loss mask over the assistant's texts. Only built-in DataFrame functions run.

Template of a turn: `<|turn|>ROLE<|text|>TEXT<|end|>` and a line end. A control string inside a role
or text (of this template, or `<s>`, `</s>`, `[INST]`, `[/INST]` of others) gets one backslash after
its first character, as does one that already has backslashes there; reading takes one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.operators.skew import join_null_safe, row_number_in_slices

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
CONTROL = r"(\||/?s>|/?INST\])"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def reply_chain(turns: DataFrame, conv: str, order: list[str]) -> DataFrame:
    """`turns` with `node` and `parent`: each row answers the one before it in its conversation.
    Rows are numbered in slices, so a conversation with very many rows is no single group."""
    numbered = row_number_in_slices(turns, [conv], [F.col(c) for c in order], "node")
    return numbered.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def reply_paths(messages: DataFrame) -> DataFrame:
    """`tree`, `leaf`, `node`, `up` (steps above the leaf) for every leaf's path to its root.

    `messages` has `tree`, `node` (unique in its tree) and `parent`. A parent that does not exist
    makes a root. Messages in or below a cycle of replies belong to no path. Null trees are one
    tree. Each round is checkpointed.
    """
    nodes = messages.select("tree", "node", "parent").checkpoint()
    known = nodes.select("tree", F.col("node").alias("parent"))
    jump = join_null_safe(
        nodes.where("parent IS NOT NULL"), known, ["tree", "parent"], "left_semi"
    ).withColumnRenamed("parent", "above").checkpoint()
    answered = jump.select("tree", F.col("above").alias("node")).distinct()
    leaves = join_null_safe(nodes.select("tree", "node"), answered, ["tree", "node"], "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node",
                          F.lit(0).cast("bigint").alias("up")).checkpoint()
    reach, rounds, left = 1, nodes.count().bit_length(), jump.count()
    for _ in range(rounds):  # a chain without a cycle ends within so many doublings
        if not left:
            break
        step = jump.withColumnRenamed("above", "_above")
        higher = join_null_safe(paths, step, ["tree", "node"]).select(
            "tree", "leaf", F.col("_above").alias("node"), (F.col("up") + reach).alias("up"))
        paths = paths.unionAll(higher).checkpoint()
        twice = step.withColumnRenamed("node", "above").withColumnRenamed("_above", "_further")
        jump = join_null_safe(jump, twice, ["tree", "above"]).select(
            "tree", "node", F.col("_further").alias("above")).checkpoint()
        reach, left = 2 * reach, jump.count()
    if left:  # what still has something above it after all rounds hangs from a cycle
        endless = jump.select("tree", F.col("node").alias("leaf")).distinct()
        paths = join_null_safe(paths, endless, ["tree", "leaf"], "left_anti")
    return paths


def conversations(messages: DataFrame, best: int | None = 1,
                  learned: str = LEARNED) -> DataFrame:
    """`tree`, `rank`, `score`, `formatted` and `mask` (code point ranges, end exclusive, of the
    learned texts) of the `best` branches of every tree by score; all branches if it is None.

    `messages` has `tree`, `node`, `parent`, `role`, `text` and `score`; other columns are not
    read. Null roles, texts and scores are empty or 0. Ties go to the smaller leaf. A conversation
    is one row of the result, so only its own turns meet in a group.
    """
    paths = reply_paths(messages)
    said = messages.select("tree", "node", "role", "text",
                           F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    turns = join_null_safe(paths, said, ["tree", "node"])
    scored = turns.groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    ranked = row_number_in_slices(scored, ["tree"], [F.desc("total"), F.col("leaf")], "rank")
    chosen = ranked if best is None else ranked.where(F.col("rank") <= best)
    part = lambda c: escape(F.coalesce(c, F.lit("")))
    head = F.concat(F.lit(TURN), part(F.col("role")), F.lit(TEXT))
    body = part(F.col("text"))
    kept = join_null_safe(turns, chosen, ["tree", "leaf"]).select(
        "tree", "leaf", "rank", "total", "up", "role", F.concat(head, body, F.lit(END)).alias("s"),
        F.char_length(head).alias("_head"), F.char_length(body).alias("_body"))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = kept.withColumn("_at", F.coalesce(
        F.sum(F.char_length("s")).over(before), F.lit(0)) + F.col("_head"))
    turn = F.struct((-F.col("up")).alias("k"), "s", F.when(
        F.col("role") == learned,
        F.struct(F.col("_at").alias("start"), (F.col("_at") + F.col("_body")).alias("end"))
    ).alias("m"))
    grouped = placed.groupBy("tree", "leaf", "rank", "total").agg(
        F.array_sort(F.collect_list(turn)).alias("t"))
    return grouped.select(
        "tree", "rank", F.col("total").alias("score"),
        F.array_join("t.s", "").alias("formatted"), F.array_compact("t.m").alias("mask"))


def read_back(formatted: Column, mask: Column) -> tuple[Column, Column]:
    """Turns (array of role and text) and learned texts of a formatted conversation, unescaped."""
    segments = F.filter(F.split(formatted, r"<\|turn\|>"), lambda s: s != "")
    turns = F.transform(segments, lambda s: F.struct(
        unescape(F.substring_index(s, TEXT, 1)).alias("role"),
        unescape(F.regexp_extract(s, r"(?s)<\|text\|>(.*)<\|end\|>\n$", 1)).alias("text")))
    learned = F.transform(mask, lambda m: unescape(
        F.substring(formatted, (m["start"] + 1).cast("int"),
                    (m["end"] - m["start"]).cast("int"))))
    return turns, learned

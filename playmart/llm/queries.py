"""The numbered queries over the given tables, and their comparison SQL where SQL can say it.

Each query runs its operator with production parameters over the whole table and derives the
result's columns from the operator's output.
"""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm import (
    bpe,
    chat,
    decontaminate,
    extract,
    quality,
    secrets,
    shards,
    simhash,
    tokencount,
    topk,
    trie,
    warc,
    whiten,
)
from playmart.llm.batches import bound_batches
from playmart.llm.oracle import ORACLE_SQL  # noqa: F401
from playmart.session import ensure_checkpoint_dir, scratch_path


ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> None:
    """Sets the checkpoint folder and the size of batches, and lets Python workers find the package
    where it is not installed (a cluster gets it with --py-files)."""
    ensure_checkpoint_dir(spark)
    bound_batches(spark)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A public vocabulary file; `PLAYMART_TOKENIZERS` names another folder."""
    import public_tokenizers

    folder = os.environ.get("PLAYMART_TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def bpe_settings() -> tuple[str, str]:
    import public_tokenizers

    return tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = bpe_settings()
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode(encoded, path, pattern).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text").unionAll(planted)
    messages = chat.reply_chain(turns, "conv_id", ["turn", "role", "text"]).withColumn(
        "score", F.lit(0.0)).withColumnRenamed("conv_id", "tree")
    formatted = chat.conversations(messages, best=1)
    read, learned = chat.read_back(F.col("formatted"), F.col("mask"))
    back = formatted.select("tree", "formatted", read.alias("turns"),
                            F.array_join(learned, "").alias("learned"))
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.kd_shards(table(spark, sf_dir, "documents"),
                             ["source", "lang", "n_chars", "doc_id"], shards=16)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                        "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = {k})")).cast("bigint").alias(f"n_{name}")
              for k, name in enumerate(secrets.BASE)]
    return found.select(
        F.col("doc").alias("doc_id"), *counts,
        F.sha2(secrets.spelled(base), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    found = quality.judge(docs, model)
    return found.select("doc_id", *[f"quality.{c}" for c in quality.COUNTS],
                        "quality.base_failed", "quality.kept", "quality.score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(
        table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.join_revisits(warc.read(spark, path))
    return found.select(
        F.col("page_key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("original_key").cast("bigint").alias("refers_to"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract.extract(pages, extract.train(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"),
                        F.char_length("main_text").cast("bigint").alias("n_chars"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = trie.conversations(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.rebuilt(convs))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows["vec_id"] % 50 == 0, k=5)


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_chat": op3_chat,
    "op4_kd_shards": op4_kd_shards,
    "op5_secrets": op5_secrets,
    "op6_simhash": op6_simhash,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_warc": op9_warc,
    "op10_main_text": op10_main_text,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whiten": op12_whiten,
    "op13_top_k": op13_top_k,
}

"""The corpus pipeline: documents in, token ids of clean and distinct documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm import bpe, decontaminate, quality, secrets, simhash
from playmart.llm.queries import bpe_settings, ready, table
from playmart.session import scratch_path

NEAR, SHINGLE = 0.8, 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rule or the trees reject. The trees are taught by the
    labelled rows of the stage's own input."""
    ready(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge(docs, model, name="__quality")
    return judged.where("__quality.kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of exact and near copies."""
    ready(spark)
    return simhash.keep_one(docs, words=SHINGLE, similarity=NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of ten words of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets inside the texts; `n_chars` is counted anew where a text changed."""
    ready(spark)
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(
        F.col("text").contains(secrets.MARK), counted).otherwise(F.col("n_chars")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, its token `ids` and their number `n_tokens`."""
    ready(spark)
    path, pattern = bpe_settings()
    encoded = bpe.encode(docs, path, pattern)
    return encoded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]

# training, fingerprints and byte pairs are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents; each is written and read again as the next one's input,
    so a lost executor costs a part of one stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

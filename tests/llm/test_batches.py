import weakref

import pandas as pd
import pyarrow as pa
from pyspark.sql.functions import pandas_udf

from playmart.llm import batches, bpe, quality, queries, simhash as S


class Task:
    """Stands for a frame: what is mapped over its batches runs here, as in one worker."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        texts = pa.RecordBatch.from_pydict({"id": [1, 2], "key": [1, 2], "text": ["a b c", None]})
        return list(run(iter([texts])))


def test_an_encoders_table_does_not_stay_beside_near_copies():
    path, pattern = queries.bpe_settings()
    first = bpe.table(bpe.read_ranks(path), pattern)
    first.encode("some words that are remembered")
    assert bpe.table(bpe.read_ranks(path), pattern) is first and batches._KEPT
    held = weakref.ref(first)
    del first
    assert S.token_rows(Task(), 5, 0.8) and not batches._KEPT and held() is None
    assert not bpe.table(bpe.read_ranks(path), pattern).known


def test_batches_for_workers_are_bounded_in_bytes(spark):
    """Rows of 64 KB, 2 000 in one partition: by number of rows they are one batch."""
    before = spark.conf.get(batches.BATCH_CONF, None)
    spark.conf.unset(batches.BATCH_CONF)
    try:
        queries.ready(spark)
        rows = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat(char(97 + id % 26), 65536) AS text")

        def sizes(parts):
            for part in parts:
                yield pa.RecordBatch.from_pydict({"n": [part.nbytes]})

        @pandas_udf("long")
        def together(texts: pd.Series) -> pd.Series:
            return texts.map(len).sum() + 0 * texts.map(len)

        most = 3 * batches.SLICE_BYTES
        assert rows.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0] <= most
        assert rows.select(together("text").alias("n")).agg({"n": "max"}).first()[0] <= most
        spark.conf.set(batches.BATCH_CONF, "1000000")
        queries.ready(spark)
        assert spark.conf.get(batches.BATCH_CONF) == "1000000"  # the session's own size stays
    finally:
        spark.conf.unset(batches.BATCH_CONF)
        if before is not None:
            spark.conf.set(batches.BATCH_CONF, before)


def test_results_do_not_depend_on_the_size_of_batches(spark, docs):
    rows = docs([(k, f"text {k % 9} " + " ".join(f"w{k % 9}x{j}" for j in range(80))) for k in range(60)])
    before, seen = spark.conf.get(batches.BATCH_CONF, None), []
    try:
        for size in ("1", "67108864"):
            spark.conf.set(batches.BATCH_CONF, size)
            kept = sorted(r.doc_id for r in S.keep_one(rows).collect())
            judged = quality.judge(rows, None).select("doc_id", "quality.*").collect()
            seen.append((kept, sorted(map(tuple, judged))))
    finally:
        spark.conf.unset(batches.BATCH_CONF)
        if before is not None:
            spark.conf.set(batches.BATCH_CONF, before)
    assert seen[0] == seen[1] and seen[0][0] == list(range(9))

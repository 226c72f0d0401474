import pytest
from pyspark.sql import functions as F


def write_table(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs(spark):
    """Builds a documents table from (doc_id, text) pairs."""
    def build(rows):
        df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
        return df.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return build


# rows that every operator must take: nulls, empty and long texts, repeated rows and ids
AWKWARD = [
    (1, "plain words in a row"), (1, "plain words in a row"), (None, "no id at all"),
    (None, None), (2, None), (3, ""), (4, " \t\n "), (5, "x" * 200_000),
    (6, "word " * 40_000), (7, "é日本🤣 \x00 </s><|turn|>[INST]"), (3, "second text of three"),
]

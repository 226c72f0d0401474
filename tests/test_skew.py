import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playmart.operators import skew
from playmart.operators.skew import (
    hot_slices, join_null_safe, left_join_dim, previous_in_key, row_number_in_slices)
from tests.conftest import tuples


def test_previous_in_key_equals_a_plain_lag_when_one_key_owns_most_rows(spark):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}",
             start + timedelta(seconds=rng.randrange(40 * 3600)), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int")
    w = Window.partitionBy("k").orderBy("t", "i")
    plain = df.select("i", F.lag("i").over(w).alias("before"))
    for seconds in (600, 3600, 10 * 86400):
        sliced = previous_in_key(df, ["k"], "t", ["i"], ("i",), seconds)
        assert sorted(tuples(sliced.select("i", "previous.i")), key=str) == sorted(
            tuples(plain), key=str)


def test_previous_in_key_keeps_column_order(spark):
    df = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))], "v int, k string, t timestamp")
    assert previous_in_key(df, ["k"], "t", ["v"]).columns == ["v", "k", "t", "previous"]


def test_row_number_in_slices_equals_a_window(spark):
    rng = random.Random(3)
    rows = [(None if rng.random() < 0.3 else rng.choice("ab"), rng.randrange(50), i)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    order = [F.desc("v"), F.asc("i")]
    for keys in ([], ["k"]):
        w = Window.partitionBy(*keys).orderBy(*order)
        want = df.select("i", F.row_number().over(w).cast("bigint").alias("n"))
        got = row_number_in_slices(df, keys, order, "n").select("i", "n")
        assert sorted(tuples(got)) == sorted(tuples(want))


def test_left_join_dim_keeps_rows_without_key(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2), ("z", 3), (None, 4)], "k string, v int")
    dim = spark.createDataFrame([("a", "A"), (None, "N"), ("a", "B")], "k string, d string")
    got = left_join_dim(fact, dim, "k", ["d"])
    assert got.columns == ["k", "v", "d"]
    assert sorted(tuples(got, "v", "d"), key=str) == [(1, "A"), (1, "B"), (2, None), (3, None),
                                                      (4, None)]


def test_left_join_dim_spreads_rows_without_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(4000).select(F.lit(None).cast("string").alias("k"), "id")
        dim = spark.createDataFrame([("a", "A")], "k string, d string")
        joined = left_join_dim(fact, dim, "k", ["d"])
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_null_safe(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    assert sorted(tuples(join_null_safe(left, right, ["k"])), key=str) == [
        ("a", 1, 10), (None, 2, 20)]


def test_hot_key_of_a_play_grain_join_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        # a third of the rows has one key, a third has none
        key = (F.when(F.col("id") % 3 == 0, "hot")
               .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 1000)))
        fact = spark.range(0, 120_000, 1, 8).select(key.alias("k"), F.md5(
            F.col("id").cast("string")).alias("v"))
        dim = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), "id").union(
            spark.createDataFrame([("hot", -1)], "k string, id bigint"))
        joined = left_join_dim(fact, dim, "k", ["id"])
        rows = joined.groupBy(F.col("id").isNull().alias("none")).agg(
            F.count("v").alias("n"), F.max("v"))
        assert {r["none"]: r["n"] for r in rows.collect()} == {False: 80_000, True: 40_000}
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def _burst(spark, n=40_000):
    """Half of all rows are one key within an hour, unevenly; every tenth instant comes twice."""
    i = F.col("id")
    micros = F.when(i % 2 == 0, F.floor(F.pow(i / n, F.lit(3)) * 3_000_000_000)).otherwise(
        i * 977_000_003 % 864_000_000_000)
    micros = F.when(i % 10 == 8, F.lag(micros, 2).over(Window.orderBy("id"))).otherwise(micros)
    return spark.range(n).select(
        F.when(i % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), i % 50)).alias("k"), "id",
        F.timestamp_micros(micros + 1_700_000_000_000_000 // 3_600_000_000 * 3_600_000_000)
        .alias("t"))


@pytest.mark.parametrize("few", [10_000, 0])
def test_crowded_slices_are_cut_at_quantiles(spark, monkeypatch, few):
    monkeypatch.setattr(skew, "FEW_MARKS", few)
    df = _burst(spark).checkpoint()
    hot = hot_slices(df, ["k"], "t", slice_rows=1000)
    (row,) = [r for r in hot[0].collect() if r["k"] == "hot"]
    assert hot[1] == bool(few) and len(row["_cuts"]) >= 18
    micros = F.unix_micros("t")
    parts = df.where("k = 'hot'").groupBy(F.size(F.filter(
        F.array(*[F.lit(c) for c in row["_cuts"]]), lambda c: c < micros)).alias("p")).count()
    sizes = sorted(r["count"] for r in parts.collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and sizes[-1] <= 1200
    got = previous_in_key(df, ["k"], "t", ["id"], ("id",), hot=hot)
    want = df.withColumn("w", F.lag("id").over(Window.partitionBy("k").orderBy("t", "id")))
    assert got.columns == [*df.columns, "previous"]
    wrong = got.select("id", F.col("previous.id").alias("p")).join(want, "id").where(
        "NOT (p <=> w)")
    assert got.count() == df.count() and wrong.isEmpty()


def test_no_slice_is_cut_where_none_is_large(spark):
    df = _burst(spark, 200)
    assert hot_slices(df, ["k"], "t") is None
    assert hot_slices(df.where("false"), ["k"], "t", slice_rows=1) is None

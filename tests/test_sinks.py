import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.operators import sinks
from playmart.sources.tables import read_table
from tests.conftest import at, tuples


def test_upsert_rules(spark):
    old = spark.createDataFrame([("a", 1, "o"), (None, 2, "o"), ("b", 3, "o")],
                                "k string, v int, only_old string")
    new = spark.createDataFrame([("a", 10, True), ("a", 11, True), (None, 12, True)],
                                "k string, v int, only_new boolean")
    got = sinks.upsert(old, new, ["k"])
    assert got.columns == ["k", "v", "only_old", "only_new"]
    # NULL keys never match, repeats inside new stay
    assert sorted(tuples(got, "k", "v"), key=str) == sorted(
        [("a", 10), ("a", 11), ("b", 3), (None, 12), (None, 2)], key=str)
    no_null = new.where("k is not null")
    once = sinks.upsert(old, no_null, ["k"])
    twice = sinks.upsert(once, no_null, ["k"])
    assert sorted(tuples(once), key=str) == sorted(tuples(twice), key=str)
    assert sinks.upsert(None, new, ["k"]) is new


def test_upsert_without_keys_is_a_distinct_union(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert sorted(tuples(sinks.upsert(a, spark.createDataFrame([(2,), (3,)], "v int"), []))) == [
        (1,), (2,), (3,)]


def test_merge_keys():
    assert sinks.merge_keys("tracks_played") == ["played_at", "track_id", "user_id"]
    assert sinks.merge_keys("mbz_artist_genre") == []
    sinks.merge_keys("spotify_artists").append("x")
    assert sinks.merge_keys("spotify_artists") == ["artist_id"]


def test_align_schema(spark):
    new = spark.createDataFrame([(1, 2.0, at(), "x", 7)],
                                "i bigint, f double, t timestamp_ntz, s string, n int")
    stored = spark.createDataFrame([], "i int, f float, t timestamp, s string, other int")
    aligned = sinks.align_schema(new, stored)
    assert aligned.dtypes == [("i", "int"), ("f", "float"), ("t", "timestamp"), ("s", "string"),
                              ("n", "int")]
    back = sinks.align_schema(aligned, new)
    assert back.dtypes == new.dtypes
    assert back.first() == new.first()  # the wall time survives both ways


def test_harmonize(spark):
    a = spark.createDataFrame([(1,)], "x int").withColumn("v", F.lit(None))
    b = spark.createDataFrame([("q",)], "y string")
    left, right = sinks.harmonize_schemas([a, b])
    assert left.columns == right.columns == ["x", "v", "y"]
    assert isinstance(left.schema["v"].dataType, T.StringType)
    assert sinks.harmonize_schemas([]) == []


def test_write_modes(spark, tmp_path):
    base = str(tmp_path)
    sinks.write_table(spark.createDataFrame([("a", 1)], "artist_id string, v int"), base,
                      "spotify_artists")
    more = spark.createDataFrame([("a", 5, "new"), ("b", 2, "new")],
                                 "artist_id string, v bigint, extra string")
    sinks.write_table(more, base, "spotify_artists", "merge")
    got = read_table(spark, base, "spotify_artists")
    assert sorted(tuples(got, "artist_id", "v", "extra")) == [("a", 5, "new"), ("b", 2, "new")]
    assert dict(got.dtypes)["v"] == "int"
    sinks.write_table(more, base, "spotify_artists", "append")
    assert read_table(spark, base, "spotify_artists").count() == 4
    sinks.write_table(more, base, "spotify_artists", "overwrite")
    assert read_table(spark, base, "spotify_artists").count() == 2
    with pytest.raises(ValueError):
        sinks.write_table(more, base, "x", "upsert")


def test_merge_partitions_rewrites_only_touched_ones(spark, tmp_path):
    base = str(tmp_path)
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "id int, v string, p int")
    old.write.partitionBy("p").parquet(f"{base}/t")
    before = {f for f in (tmp_path / "t" / "p=2").iterdir()}
    new = spark.createDataFrame([(1, "x", 1), (9, "y", 3)], "id int, v string, p int")
    sinks.write_merge_partitions(new, base, "t", ["id", "p"], "p")
    assert sorted(tuples(read_table(spark, base, "t").select("id", "v", "p"))) == [
        (1, "x", 1), (2, "b", 1), (3, "c", 2), (9, "y", 3)]
    assert {f for f in (tmp_path / "t" / "p=2").iterdir()} == before


def test_table_info_and_validation(spark, tmp_path):
    base = str(tmp_path)
    assert sinks.table_info(spark, base, "none").first()["exists"] is False
    sinks.write_overwrite(spark.range(5).coalesce(1), base, "t")
    info = sinks.table_info(spark, base, "t").first()
    assert (info.record_count, info.columns, info.column_types, info.file_count) == (
        5, ["id"], {"id": "bigint"}, 1)
    assert info.total_bytes > 0
    checks = {r.table: r for r in sinks.validate_tables(spark, base, ("t", "u")).collect()}
    assert (checks["t"].exists, checks["t"].row_count) == (True, 5)
    assert (checks["u"].exists, checks["u"].all_valid) == (False, False)
    assert sinks.validate_tables(spark, base, ("t",)).first()["all_valid"] is True


def test_column_consistency(spark):
    a = spark.createDataFrame([], "Id int, name string")
    b = spark.createDataFrame([], "NAME string, id bigint")
    assert sinks.check_column_consistency(a, b).first()["columns_match"] is True
    c = spark.createDataFrame([], "id int, other string")
    rows = {r.column_name: r for r in sinks.check_column_consistency(a, c).collect()}
    assert set(rows) == {"id", "name", "other"}
    assert not rows["id"].columns_match and rows["id"].in_both and not rows["other"].in_both
    assert sinks.check_column_consistency(None, c).first()["columns_match"] is False


def broken(spark):
    """Rows whose tasks fail."""
    fail = F.raise_error(F.lit("task failed")).cast("int")
    return spark.range(2).select(F.lit("a").alias("artist_id"), fail.alias("v"))


def test_failed_writes_and_merges_keep_the_table(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "artist_id string, v int")
    sinks.write_overwrite(rows, base, "spotify_artists")
    for mode in ("overwrite", "merge"):
        with pytest.raises(Exception, match="task failed"):
            sinks.write_table(broken(spark), base, "spotify_artists", mode)
        assert sorted(tuples(read_table(spark, base, "spotify_artists"))) == [("a", 1), ("b", 1)]
    sinks.write_merge(spark.createDataFrame([("a", 2)], "artist_id string, v int"), base,
                      "spotify_artists")
    assert sorted(tuples(read_table(spark, base, "spotify_artists"))) == [("a", 2), ("b", 1)]


def test_a_broken_partition_merge_keeps_the_table(spark, tmp_path):
    base, ddl = str(tmp_path), "id int, v int, p string"
    sinks.write_merge_partitions(spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], ddl), base,
                                 "t", ["id"], "p")
    bad = spark.range(1).selectExpr("1 id", "cast(raise_error('task failed') as int) v", "'x' p")
    with pytest.raises(Exception, match="task failed"):
        sinks.write_merge_partitions(bad, base, "t", ["id"], "p")
    assert sorted(tuples(read_table(spark, base, "t"))) == [(1, 1, "x"), (2, 1, "y")]


def test_a_write_may_read_its_table(spark, tmp_path):
    base = str(tmp_path)
    sinks.write_overwrite(spark.range(4), base, "t")
    sinks.write_overwrite(read_table(spark, base, "t").where("id > 1"), base, "t")
    assert sorted(tuples(read_table(spark, base, "t"))) == [(2,), (3,)]


def test_replaced_partitions(spark, tmp_path):
    base, ddl = str(tmp_path), "v string, y int"
    sinks.write_overwrite(spark.createDataFrame(
        [("a", 1), ("b", 2), ("c", 3), ("n", None)], ddl), base, "t", ["y"])
    before = set((tmp_path / "t" / "y=3").iterdir())
    new = spark.createDataFrame([("B", 2), ("out of range", 9)], ddl)
    sinks.replace_partitions(new, base, "t", "y", [2])
    assert sorted(tuples(read_table(spark, base, "t")), key=str) == [
        ("B", 2), ("a", 1), ("c", 3), ("n", None)]
    assert set((tmp_path / "t" / "y=3").iterdir()) == before
    sinks.replace_partitions(new, base, "t", "y", [1, 2])  # year 1 has no row any more
    assert sorted(tuples(read_table(spark, base, "t")), key=str) == [
        ("B", 2), ("c", 3), ("n", None)]


def test_merges_by_other_keys_and_appends_keep_the_buckets_right(spark, tmp_path):
    base, ddl = str(tmp_path), "k string, j bigint, v int"
    rows = [("a", 1, 1), ("b", 2, 1), (None, 3, 1)]
    sinks.write_merge(spark.createDataFrame(rows, ddl), base, "t", ["k"], buckets=4)
    sinks.write_append(spark.createDataFrame([("c", 4, 1)], "k string, j int, v int"), base, "t")
    sinks.write_merge(spark.createDataFrame([("c", 5, 2), (None, 6, 2)], ddl), base, "t", ["k"])
    want = [("a", 1, 1), ("b", 2, 1), (None, 3, 1), ("c", 5, 2), (None, 6, 2)]
    assert sorted(tuples(read_table(spark, base, "t")), key=str) == sorted(want, key=str)
    assert len(list((tmp_path / "t").glob("bucket_of_4_by_k=*"))) <= 4
    sinks.write_merge(spark.createDataFrame([("z", 1, 9)], ddl), base, "t", ["j"], buckets=2)
    sinks.write_merge(spark.createDataFrame([("y", 2, 9)], "k string, j int, v int"), base, "t",
                      ["j"])
    want[:2] = [("z", 1, 9), ("y", 2, 9)]
    assert sorted(tuples(read_table(spark, base, "t")), key=str) == sorted(want, key=str)


def test_a_batch_is_merged_once(spark, tmp_path):
    base = str(tmp_path)
    one = spark.createDataFrame([("a", 1)], "artist_id string, v int")
    two = spark.createDataFrame([("a", 2)], "artist_id string, v int")
    for rows, number in ((one, 0), (two, 1), (one, 0)):
        sinks.write_merge(rows, base, "spotify_artists", batch=("q", number))
    assert tuples(read_table(spark, base, "spotify_artists")) == [("a", 2)]


def test_merge_into_the_null_partition_keeps_its_rows(spark, tmp_path):
    base, ddl = str(tmp_path), "id int, v string, day string"
    old = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "d1")], ddl)
    sinks.write_merge_partitions(old, base, "t", ["id"], "day")
    sinks.write_merge_partitions(
        spark.createDataFrame([(9, "z", None), (2, "x", None)], ddl), base, "t", ["id"], "day")
    assert sorted(tuples(read_table(spark, base, "t").select("id", "v", "day")), key=str) == [
        (1, "a", None), (2, "x", None), (3, "c", "d1"), (9, "z", None)]


def test_buckets_without_a_touched_key_keep_their_files(spark, tmp_path):
    base, ddl = str(tmp_path), "artist_id string, v int"
    sinks.write_merge(spark.range(100).select(
        F.col("id").cast("string").alias("artist_id"), F.lit(1).alias("v")), base,
        "spotify_artists")

    def files():
        found = {}
        for f in (tmp_path / "spotify_artists").rglob("*.parquet"):
            found.setdefault(f.parent.name, set()).add(f.name)
        return found

    before = files()
    sinks.write_merge(spark.createDataFrame([("7", 2)], ddl), base, "spotify_artists")
    after = files()
    assert len(before) > 8 and set(before) == set(after)
    assert sum(before[b] != after[b] for b in before) == 1
    stored = read_table(spark, base, "spotify_artists")
    assert stored.columns == ["artist_id", "v"] and stored.count() == 100
    assert tuples(stored.where("v = 2")) == [("7", 2)]


def test_merge_counts(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("c", 2)], "k string, v int")
    assert tuple(sinks.merge_counts(old, new, ["k"]).first()) == (1, 1, 3)
    assert tuple(sinks.merge_counts(None, new, ["k"]).first()) == (0, 2, 2)

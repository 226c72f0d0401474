import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playmart.functions import scoring as S
from playmart.functions.keys import NULL_PART, surrogate_key, timestamp_part
from playmart.functions.text import first_credit, null_if_placeholder, without_word
from playmart.functions.times import (
    clock_text, local_time, parse_played_at, seconds_of_day, whole_seconds_between)
from tests.conftest import tuples


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_tells_null_empty_and_token_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "x")], "p string, q string")
    keys = [r[0] for r in tuples(df.select(surrogate_key("p", "q")))]
    assert keys == [md5(f"a-{NULL_PART}"), md5("a-"), md5("a-x")]
    # an empty literal adds an empty part
    assert tuples(df.limit(1).select(surrogate_key("p", F.lit(""))))[0][0] == md5("a-")


def test_timestamp_part_is_microsecond_text(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5, 6),)], "t timestamp")
    assert tuples(df.select(timestamp_part("t"))) == [("2024-01-02 03:04:05.000006",)]


@pytest.mark.parametrize("text, expected", [
    ("2026-01-04T02:55:58.123Z", datetime(2026, 1, 4, 2, 55, 58, 123000)),
    ("2026-01-04T02:55:58+00:00", datetime(2026, 1, 4, 2, 55, 58)),
    ("2026-01-04T02:55:58+00:00Z", datetime(2026, 1, 4, 2, 55, 58)),
    ("2026-01-04T02:55:58-07:00", datetime(2026, 1, 4, 9, 55, 58)),
    ("2026-01-04T02:55:58Z", datetime(2026, 1, 4, 2, 55, 58)),
    ("garbage", None), (None, None),
])
def test_parse_played_at(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(parse_played_at("t").cast("timestamp_ntz")).first()[0]
    assert got == expected


def test_local_time_follows_daylight_saving(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 7, 1, 12),), (datetime(2024, 1, 1, 12),)], "t timestamp")
    local = df.select(local_time("t").alias("l"))
    assert [r[0].hour for r in tuples(local)] == [6, 5]
    assert tuples(local.select(seconds_of_day("l"))) == [(6 * 3600,), (5 * 3600,)]


def test_whole_seconds_are_elapsed_not_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 2, 100000))],
        "a timestamp, b timestamp")
    assert df.select(whole_seconds_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_clock_text(spark):
    df = spark.createDataFrame([(0,), (3661,), (86399,)], "s int")
    assert [r[0] for r in tuples(df.select(clock_text("s")))] == [
        "00:00:00", "01:01:01", "23:59:59"]


def test_popularity_bands(spark):
    values = [None, 0, 9, 10, 29, 30, 49, 50, 69, 70, 89, 90]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    codes = df.select(S.popularity_sort(
        F.col("v"), S.ARTIST_POPULARITY, S.ARTIST_POPULARITY_MISSING))
    assert [r[0] for r in codes.collect()] == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6]
    labels = df.select(S.popularity_label(
        F.col("v"), S.TRACK_POPULARITY, S.TRACK_POPULARITY_MISSING))
    assert [r[0] for r in labels.collect()] == [
        "No Track Popularity Data", "Not Popular", "Not Popular", "Mostly Unknown",
        "Mostly Unknown", "Niche", "Niche", "Popular", "Popular", "Very Popular",
        "Very Popular", "Extremely Popular"]


def test_length_bands_have_no_code_four(spark):
    values = [None, 29, 30, 179, 180, 299, 300, 419, 420, 599, 600]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = df.select(S.length_label(F.col("v")), S.length_sort(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [
        ("unknown", 0), ("very short", 1), ("short", 2), ("short", 2), ("average", 3),
        ("average", 3), ("pretty long", 5), ("pretty long", 5), ("long", 6), ("long", 6),
        ("possibly too long", 7)]


def test_scaled_ms_uses_32_bit_arithmetic(spark):
    df = spark.createDataFrame([(123456789012,)], "ms bigint")
    single = df.select(S.scaled_ms(F.col("ms"), 60_000, 2)).first()[0]
    double = df.select(S.scaled_ms(F.col("ms"), 60_000, 2, "double")).first()[0]
    assert single == 2057613.125
    assert double == 2057613.15


def test_scaled_ms_keeps_the_float_step_in_optimized_plans(spark):
    ms = (F.col("id") + 9156498000).alias("ms")
    df = spark.range(1).select(ms).repartition(1)
    assert df.select(S.scaled_ms(F.col("ms"), 60_000, 2)).first()[0] == 152608.3125


def test_exact_minutes_sum_is_order_free(spark):
    rows = [(0.1,), (0.2,), (0.7,)] * 1000
    df = spark.createDataFrame(rows, "m float")
    assert df.agg(F.sum(S.exact_minutes(F.col("m"))).cast("double")).first()[0] == 1000.0


@pytest.mark.parametrize("name, expected", [
    ("A, B", "A"), ("A feat. B", "A"), ("A Feat. B", "A Feat. B"), ("A [live]", "A"),
    ("A (live)", "A"), ("A & B", "A"), ("A&B", "A&B"), ("(x) A", ""), ("A, B & C", "A"),
    (" A ", "A"),
])
def test_first_credit(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(first_credit(F.col("n"))).first()[0] == expected


def test_placeholders_become_null(spark):
    df = spark.createDataFrame([(x,) for x in ["None", "NaN", "nan", "<NA>", "", "x", None]],
                               "v string")
    assert [r[0] for r in df.select(null_if_placeholder(F.col("v"))).collect()] == [
        None, None, None, None, None, "x", None]


@pytest.mark.parametrize("name, expected", [
    ("Copenhagen Municipality", "Copenhagen"), ("municipality of bar-baz", "Of Bar-Baz"),
    ("2nd o'brien municipality", "2nd O'Brien"),
    ("Oslo", "Oslo"), ("MUNICIPALITY municipality x", "Municipality X"), (None, None),
    ("Östersund Municipality", "Östersund"),
])
def test_without_word(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(without_word(F.col("n"), "municipality")).first()[0] == expected

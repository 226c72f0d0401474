import random

import pytest
from pyspark.sql import functions as F

from playmart.operators import dedup
from tests.conftest import at, plays, tuples


def test_exact_keeps_first_in_order_and_groups_null_ids(spark):
    df = spark.createDataFrame(
        [("t", at(), 3, "c"), ("t", at(), 1, "a"), (None, at(), 2, "x"), (None, at(), 1, "y"),
         ("t", at(1), 9, "z")], "track_id string, played_at timestamp, pos int, v string")
    got = dedup.dedup_exact(df, order=["pos"])
    assert got.columns == df.columns
    assert sorted(tuples(got, "pos", "v")) == [(1, "a"), (1, "y"), (9, "z")]
    again = dedup.dedup_exact(got, order=["pos"])
    assert sorted(tuples(again), key=str) == sorted(tuples(got), key=str)


def test_identity(spark):
    df = plays(spark, [("1", "n", "a", at(), 1), ("2", None, "a", at(), 1),
                       ("3", "n", None, at(), 1), ("4", "n", "a", None, 1)])
    assert tuples(dedup.require_play_identity(df), "track_id") == [("1",)]


@pytest.mark.parametrize("gap, duration, kept", [
    (10, 10_000, False),  # equal to the duration
    (11, 10_000, True),   # one second more
    (10, 10_001, False), (10, 9_999, True), (10, None, True), (0, 0, False),
])
def test_within_duration_boundary(spark, gap, duration, kept):
    df = plays(spark, [("1", "n", "a", at(), duration), ("2", "n", "a", at(gap), 5)])
    got = {r[0] for r in tuples(dedup.dedup_within_duration(df), "track_id")}
    assert got == ({"1", "2"} if kept else {"1"})


def test_within_duration_compares_with_the_previous_input_row(spark):
    # each play is inside its predecessor, so the second and third go although the third is
    # outside the first
    df = plays(spark, [("1", "n", "a", at(), 60_000), ("2", "n", "a", at(50), 60_000),
                       ("3", "n", "a", at(100), 60_000), ("4", "n", "b", at(100), 60_000)])
    got = dedup.dedup_within_duration(df)
    assert sorted(tuples(got, "track_id")) == [("1",), ("4",)]


def test_crowded_hours_change_no_row(spark):
    i = F.col("id")
    df = spark.range(3000).select(
        F.concat(F.lit("i"), i % 7).alias("track_id"), F.lit("t").alias("track_name"),
        F.when(i % 400 > 0, "a").alias("artist"),
        F.timestamp_seconds(1_700_000_000 + i * i % 3001).alias("played_at"),
        (i % 5 * 400).alias("duration_ms"))
    for make in (dedup.dedup_within_duration, dedup.dedup_plays):
        rows = df.dropna() if make is dedup.dedup_within_duration else df
        plain = sorted(tuples(make(rows)), key=str)
        assert len(plain) < 3000 and sorted(tuples(make(rows, slice_rows=50)), key=str) == plain
    assert tuples(dedup.dedup_audit(df, slice_rows=50)) == tuples(dedup.dedup_audit(df))


def test_within_duration_over_slice_borders(spark):
    # 12:59:50 and 13:00:10 are in different hours
    df = plays(spark, [("1", "n", "a", at(3590), 60_000), ("2", "n", "a", at(3610), 1_000),
                       ("3", "n", "a", at(50_000), 1_000)])
    for seconds in (5, 3600, 86_400):
        got = dedup.dedup_within_duration(df, slice_seconds=seconds)
        assert sorted(tuples(got, "track_id")) == [("1",), ("3",)]


def brute_force(rows):
    """Exact, identity and near repeats by a plain loop."""
    first = {}
    for r in sorted(rows, key=lambda r: r[5]):
        first.setdefault((r[0], r[3]), r)
    rest = sorted((r for r in first.values() if None not in (r[1], r[2], r[3])),
                  key=lambda r: (r[1], r[2], r[3], r[5]))
    kept, before = [], None
    for r in rest:
        same = before is not None and before[1:3] == r[1:3]
        gap = int((r[3] - before[3]).total_seconds()) if same else None
        if not same or before[4] is None or gap > before[4] / 1000:
            kept.append(r[5])
        before = r
    return len(rows), len(first), len(rest), sorted(kept)


def test_whole_chain_and_audit_against_a_loop(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        hot = rng.random() < 0.4
        rows.append((
            None if rng.random() < 0.2 else f"t{rng.randrange(4)}",
            None if rng.random() < 0.05 else ("hot" if hot else f"n{rng.randrange(3)}"),
            None if rng.random() < 0.05 else "a",
            at(rng.randrange(4000) * 7), rng.choice([None, 1000, 90_000, 300_000]), i))
    df = spark.createDataFrame(
        rows, "track_id string, track_name string, artist string, played_at timestamp, "
        "duration_ms bigint, pos int").repartition(5)
    total, exact, identity, kept = brute_force(rows)
    got = dedup.dedup_plays(df, ["pos"], ("pos",), 600)
    assert sorted(r[0] for r in tuples(got, "pos")) == kept
    audit = dedup.dedup_audit(df, ["pos"], ("pos",), 600).first().asDict()
    assert audit == {
        "rows_in": total, "exact_removed": total - exact, "null_removed": exact - identity,
        "near_removed": identity - len(kept), "total_removed": total - len(kept),
        "rows_out": len(kept)}


def test_priority(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "q")],
        "k string, p int, v string")
    best = dedup.deduplicate_with_priority(df, ["k"], "p")
    assert sorted(tuples(best), key=str) == [("a", 3, "y"), ("b", None, "q")]
    least = dedup.deduplicate_with_priority(df, ["k"], "p", ascending=True)
    assert sorted(tuples(least), key=str) == [("a", 1, "x"), ("b", None, "q")]
    assert dedup.deduplicate_with_priority(df, ["k"]).count() == 2
    doubled = df.union(df)
    assert dedup.deduplicate_with_priority(doubled, []).count() == 4
    assert dedup.deduplicate_with_priority(doubled.select("k"), ["k"]).count() == 2


def test_input_partitions_do_not_matter(spark):
    df = plays(spark, [(f"t{i % 7}", "n", "a", at(i * 13), 20_000) for i in range(200)])
    a = dedup.dedup_plays(df.repartition(1), tie=("track_id",))
    b = dedup.dedup_plays(df.repartition(6, F.rand(3)), tie=("track_id",))
    assert sorted(tuples(a)) == sorted(tuples(b))


def test_equal_instants_have_one_result_whatever_the_partitioning(spark):
    rng = random.Random(4)
    rows = [(None if rng.random() < 0.5 else f"t{rng.randrange(3)}", "n", "a", at(rng.randrange(4) * 30),
             rng.choice([None, 1000, 40_000, 90_000])) for _ in range(60)]
    df = plays(spark, rows)
    results = [sorted(tuples(dedup.dedup_within_duration(df.repartition(n, F.rand(n)))), key=str)
               for n in (1, 3, 5, 8)]
    assert all(r == results[0] for r in results)

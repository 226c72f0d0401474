import json
import random
import time

import pytest
from pyspark.sql import functions as F

from playmart.operators import dedup
from playmart.schemas import RAW_PLAY
from playmart.sources.tables import read_table
from playmart.streaming import plays as S
from tests.conftest import PLAY_DDL, at, plays, tuples


def feed(spark, folder, batches, ddl=PLAY_DDL):
    """One file per batch, read one per micro-batch in the order given."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1)  # files are taken in order of their modification time
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drained(spark, stream, tmp_path):
    S.run_available_now(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    return spark.read.parquet(str(tmp_path / "out"))


def test_raw_files_become_typed_plays_and_are_archived(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    source.mkdir()
    record = {"track_id": "t", "uri": "u", "duration_ms": 5, "played_at": "2024-01-01T12:00:00Z"}
    (source / "a.json").write_text(json.dumps([record, record]))
    (source / "b.json").write_text(json.dumps(record))
    stream = S.stream_raw_plays(spark, str(source), archive=str(archive))
    assert stream.isStreaming and "track_uri" in stream.columns
    got = drained(spark, stream, tmp_path)
    assert tuples(got.select("track_uri", "duration_ms", "played_at")) == [("u", 5, at())] * 3
    # a second run finds nothing new
    S.run_available_now(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert len(RAW_PLAY.split(",")) == 16


def test_one_stream_stores_plays_and_rejected_files(spark, tmp_path):
    source, archive, base = tmp_path / "in", tmp_path / "done", str(tmp_path / "tables")
    source.mkdir()
    play = {"track_id": "t", "uri": "u", "artist": "x", "track_name": "n", "duration_ms": 5,
            "played_at": "2024-01-01T12:00:00Z"}

    def run(checkpoint="check"):
        S.stream_ingest(spark, str(source), base, str(tmp_path / checkpoint), str(archive),
                        files_per_trigger=1).awaitTermination()
        return sorted(tuples(read_table(spark, base, "tracks_played"), "track_id"))

    (source / "a.json").write_text(json.dumps([play, play]))
    (source / "cut.json").write_text('[{"track_id": "cut')
    assert run() == [("t",)]
    bad = read_table(spark, base, "rejected_files").collect()
    assert [(r.source_file.split("/")[-1], r.text) for r in bad] == [("cut.json", '[{"track_id": "cut')]
    (source / "b.json").write_text(json.dumps([play, {**play, "track_id": "new"}]))
    assert run() == [("new",), ("t",)]
    # finished files are archived once a later batch has been planned
    assert {f.name for f in archive.rglob("*.json")} >= {"a.json", "cut.json"}
    # a lost checkpoint reads what is still there again and adds nothing
    assert run("other check") == [("new",), ("t",)]


def test_exact_dedup_equals_batch_over_three_files(spark, tmp_path):
    rows = [("a", "n", "x", at(0), 1), ("a", "n", "x", at(0), 1), (None, "n", "x", at(9), 1)]
    more = [("a", "n", "x", at(0), 1), (None, "n", "x", at(9), 1), ("b", "n", "x", at(60), 1)]
    stream = feed(spark, tmp_path / "in", [rows, more, more])
    got = drained(spark, S.stream_dedup_exact(stream), tmp_path)
    batch = dedup.dedup_exact(plays(spark, rows + more))
    assert sorted(tuples(got), key=str) == sorted(tuples(batch), key=str)


def end_of(rows, days=4):
    """A closing play, as a tuple of the columns of plays."""
    return (None, "", "", at(0, day=days), None)


def test_duration_dedup_equals_batch_over_batches(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"t{i}", rng.choice(["hot", "hot", "b"]), "x", at(i * 40 + rng.randrange(30)),
             rng.choice([None, 20_000, 50_000, 200_000])) for i in range(300)]
    rows += [("none", None, "x", at(50), 1), ("untimed", "b", "x", None, 1)]
    # order inside the delay is free
    mixed = sorted(rows, key=lambda r: (r[3] or at()).timestamp() + rng.randrange(600))
    stream = feed(spark, tmp_path / "in", [mixed[:100], mixed[100:200], mixed[200:],
                                           [end_of(rows)]])
    got = drained(spark, S.stream_dedup_within_duration(stream, "30 minutes", ("track_id",)),
                  tmp_path)
    batch = dedup.dedup_within_duration(
        dedup.require_play_identity(plays(spark, rows)), ("track_id",))
    assert sorted(tuples(got), key=str) == sorted(tuples(batch), key=str)


def test_duration_dedup_goes_on_from_its_checkpoint_and_drops_late_plays(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [
        [("1", "n", "x", at(0), 10_000_000), ("far", "z", "x", at(7200), 1000)]])
    first = drained(spark, S.stream_dedup_within_duration(stream, "1 hour"), tmp_path)
    assert tuples(first, "track_id") == [("1",)]     # "far" still waits for its order
    # the next run knows play 1, whose length reaches over "5", and what waits; "late" is behind the
    # mark; "3" comes before "far" of the same instant, which it covers, and "far" is over at "4"
    stream = feed(spark, tmp_path / "in", [
        [("late", "n", "x", at(30), 1000), ("3", "z", "x", at(7200), 5000),
         ("4", "z", "x", at(7203), 5000), ("5", "n", "x", at(9000), 1000)], [end_of([])]])
    got = drained(spark, S.stream_dedup_within_duration(stream, "1 hour"), tmp_path)
    assert sorted(tuples(got, "track_id")) == [("1",), ("3",), ("4",)]


def test_upsert_per_batch(spark, tmp_path):
    ddl = "artist_id string, v int"
    stream = feed(spark, tmp_path / "in", [[("a", 1), ("b", 1)], [("a", 2), ("c", 2)]], ddl)
    S.stream_upsert(stream, str(tmp_path / "tables"), "spotify_artists",
                    str(tmp_path / "check")).awaitTermination()
    got = read_table(spark, str(tmp_path / "tables"), "spotify_artists")
    assert sorted(tuples(got)) == [("a", 2), ("b", 1), ("c", 2)]


@pytest.mark.parametrize("slide, windows", [(None, 2), ("30 minutes", 4)])
def test_windows_close_behind_the_watermark(spark, tmp_path, slide, windows):
    rows = [(f"t{i}", "n", f"art{i % 3}", at(i * 60), 60_000) for i in range(120)]
    rows.append(("end", "n", "z", at(5 * 3600), 60_000))
    stream = feed(spark, tmp_path / "in", [rows])
    got = drained(spark, S.stream_plays_per_window(stream, "1 hour", slide), tmp_path)
    full = {r.window_start: r for r in got.collect()}
    assert at(0) in full and full[at(0)].plays == 60 and full[at(0)].minutes == 60.0
    assert full[at(0)].artists == 3
    assert len([w for w in full if at(-1800) <= w <= at(3600)]) == windows
    assert all(r.window_end <= at(4 * 3600) for r in full.values())


@pytest.mark.parametrize("slide", [None, "1 hour"])
def test_sketched_windows(spark, tmp_path, slide):
    i = F.col("id")
    rows = spark.range(30_000).select(
        F.lit("t").alias("track_id"), F.lit("n").alias("track_name"),
        F.when(i % 100 > 0, F.concat(F.lit("a"), i * 7919 % 9000)).alias("artist"),
        F.timestamp_seconds(1_704_096_000 + i % 21_600).alias("played_at"),
        (i % 7 * 30_000).alias("duration_ms"))
    path = str(tmp_path / "in")
    rows.write.parquet(path)
    S.closing_play(rows, at(0, day=9)).write.mode("append").parquet(path)
    length = "3 hours" if slide else "1 hour"

    def run(windows, name, **more):
        stream = spark.readStream.schema(rows.schema).parquet(path)
        got = drained(spark, windows(stream, length, slide, **more), tmp_path / name)
        return {r.window_start: r for r in got.collect()}

    want, got = run(S.stream_plays_per_window, "exact"), run(S.stream_sketched_windows, "sketch")
    assert len(want) == (8 if slide else 6) and set(want) == set(got)
    for start, row in want.items():
        assert got[start][:4] == row[:4]
        assert abs(got[start].artists - row.artists) <= 4 * 1.04 / 64 * row.artists
    if not slide:
        # one row of state a window, whatever the artists
        rough = run(S.stream_sketched_windows, "rough", log_k=4)
        assert any(rough[k].artists != want[k].artists for k in want)


def test_a_closing_play_emits_the_last_windows(spark, tmp_path):
    rows = [(f"t{i}", "n", f"art{i % 3}", at(i * 600), 60_000) for i in range(12)]
    ddl = PLAY_DDL
    source = plays(spark, rows)
    end = S.closing_play(source, at(0, day=4))
    assert end.schema == source.schema or end.columns == source.columns
    stream = feed(spark, tmp_path / "in", [rows, [tuple(end.first())]], ddl)
    got = drained(spark, S.stream_plays_per_window(stream, "3 hours", "1 hour"), tmp_path)
    rows = sorted(tuples(got, "window_start", "plays", "artists"))
    assert [r[1:] for r in rows] == [(6, 3), (12, 3), (12, 3), (6, 3)]


def test_unreadable_files_are_kept_apart(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('[{"track_id": "t", "uri": "u"}]')
    (source / "cut.json").write_text('[{"track_id": "t", "u')
    got = drained(spark, S.stream_raw_plays(spark, str(source)), tmp_path)
    assert tuples(got, "track_id") == [("t",)]
    bad = S.stream_rejected_files(spark, str(source))
    S.run_available_now(bad, str(tmp_path / "bad"), str(tmp_path / "bad-check"))
    assert [r.source_file.split("/")[-1] for r in spark.read.parquet(
        str(tmp_path / "bad")).collect()] == ["cut.json"]


def test_enrich(spark, tmp_path):
    ddl = "artist_id string, v int"
    stream = feed(spark, tmp_path / "in", [[("a", 1), (None, 2), ("q", 3)]], ddl)
    artists = spark.createDataFrame([("a", 9.0), (None, 1.0)], "artist_id string, p double")
    got = drained(spark, S.stream_enrich(stream, artists, ["p"]), tmp_path)
    assert sorted(tuples(got), key=str) == sorted([("a", 1, 9.0), (None, 2, None), ("q", 3, None)],
                                                  key=str)


def test_batches_only_use_public_columns(spark):
    df = plays(spark, [("1", "n", "a", at(), 1)])
    assert dedup.near_repeats(df).columns == [*df.columns, "near_repeat"]
    assert dedup.near_repeats(df).agg(F.max("near_repeat")).first()[0] is False


class FakeState:
    def __init__(self):
        self.lists, self.timers, self.value = [], [], None

    def getListState(self, name, schema):
        return self

    def getValueState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def appendList(self, rows):
        self.lists.append(rows)


def test_a_track_s_plays_reach_the_state_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 2)
    names = ["track_id", "duration_ms", S.MICROS]
    last, state = S.LastPlay(spark.createDataFrame([], "track_id string, duration_ms bigint, "
                                                   "_micros bigint").schema, ["track_id"]), FakeState()
    last.init(state)
    micros = (5_000, 3_000, None, 1_000, 9_000, 7_000)
    rows = (dict(zip(names, (str(m), 1, m))) for m in micros)
    assert list(last.handleInputRows(("n", "a"), rows, None)) == []
    assert [len(x) for x in state.lists] == [2, 2, 1] and state.timers == [2]
    assert list(last.handleInputRows(("n", None), iter([dict(zip(names, ("x", 1, 1)))]), None)) == []
    assert len(state.lists) == 3


def test_the_state_of_tracks_is_bounded_in_memory(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [[("a", "n", "x", at(0), 1)]])
    S.stream_dedup_within_duration(stream)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage") == "true"

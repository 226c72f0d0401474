import json

import pytest
from pyspark.sql import functions as F

from playmart.operators import ingest, sinks
from playmart.schemas import (
    ALBUM_PAYLOAD, LISTENS_PAYLOAD, RAW_PLAY, RECENT_PAYLOAD, SEEDS, TRACKS_PLAYED)
from playmart.sources import plays as sources
from playmart.sources import tables
from tests.conftest import at, tuples


def raw(**over):
    base = dict(user_id="u", track_id="t", uri="x:t", track_isrc="I", track_name="n", album_id="b",
                album_uri="x:b", album="B", artist_id="a", artist_mbid=None, artist="A",
                duration_ms=1000, played_at="2024-01-01T12:00:00.000Z", popularity=5,
                request_after="1", play_source="s")
    return {**base, **over}


def test_read_raw_plays_arrays_objects_and_mixed_numbers(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text(json.dumps([
        raw(track_id="1", duration_ms=1000), raw(track_id="2", duration_ms=1000.0),
        raw(track_id="3", duration_ms=None, popularity=None)], indent=1))
    (tmp_path / "sub" / "b.json").write_text(json.dumps(
        raw(track_id="4", played_at="2024-01-01T12:00:00+00:00")))
    (tmp_path / "skip.txt").write_text("[]")
    df = sources.read_raw_plays(spark, str(tmp_path))
    assert df.schema == spark.createDataFrame([], TRACKS_PLAYED).select(*df.columns).schema
    got = sorted(tuples(df, "track_id", "duration_ms", "popularity", "played_at"))
    assert [r[:3] for r in got] == [("1", 1000, 5), ("2", 1000, 5), ("3", None, None),
                                    ("4", 1000, 5)]
    assert got[0][3] == got[3][3]


def test_consolidate_writes_a_readable_snapshot(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([
        raw(), raw(played_at="2024-01-01T12:00:00.500Z"),
        raw(played_at="2024-01-01T12:01:00Z", track_name="with, comma"), raw(artist=None, track_id="q")]))
    (folder / "b.json").write_text(json.dumps([raw()]))
    sources.consolidate_plays(spark, str(folder), str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    got = sources.read_recently_played_csv(spark, str(tmp_path / "csv"))
    assert sorted(tuples(got, "track_name", "request_after")) == [("n", "1"), ("with, comma", "1")]


def test_flatten_recently_played(spark):
    def track(**over):
        base = dict(id="t", uri="u", name="n", duration_ms=1.0, popularity=7.0,
                    external_ids={"isrc": "I"}, artists=[{"id": "a", "name": "A"},
                                                         {"id": "b", "name": "B"}],
                    album={"id": "al", "uri": "au", "name": "AL"})
        return {**base, **over}
    items = [
        dict(track=track(), context={"uri": "ctx"}, played_at="p1"),
        dict(track=None, context=None, played_at="p2"),
        dict(track={}, context=None, played_at="p5"),
        dict(track=track(artists=[]), context=None, played_at="p3"),
        dict(track=track(popularity=None), context={"uri": None}, played_at="p4"),
    ]
    df = spark.createDataFrame([(items,)], RECENT_PAYLOAD)
    out = ingest.flatten_recently_played(df, "me", "99")
    # only track_uri and request_cursor are renamed later: raw contract
    assert out.columns == spark.createDataFrame([], RAW_PLAY).columns
    got = {r["played_at"]: r for r in out.collect()}
    assert sorted(got) == ["p1", "p3", "p4"]
    assert (got["p1"].artist, got["p1"].play_source, got["p1"].track_isrc) == ("A", "ctx", "I")
    assert (got["p3"].artist_id, got["p3"].play_source) == (None, "spotify")
    assert (got["p4"].popularity, got["p4"].user_id, got["p4"].request_after) == (0.0, "me", "99")


def test_flatten_listens(spark):
    def listen(client, ts=1704110400, mbids=("m1", "m2")):
        return dict(listened_at=ts, user_name="u", track_metadata=dict(
            track_name="n", release_name="r", artist_name="a",
            additional_info=dict(submission_client=client, duration_ms=5.0),
            mbid_mapping=dict(artist_mbids=list(mbids))))
    rows = [listen("Navidrome/0.5"), listen("other"), listen(""), listen(None, mbids=()),
            listen("navidrome", ts=0), listen("navidrome", ts=None)]
    df = spark.createDataFrame([({"listens": rows},)], LISTENS_PAYLOAD)
    got = ingest.flatten_listens(df).collect()
    assert len(got) == 3
    assert [r.artist_mbid for r in got] == ["m1", "m1", None]
    assert got[0].played_at == "2024-01-01T12:00:00+00:00"
    assert got[0].request_after == "1704110400000"
    assert got[0].track_id is None and got[0].play_source == "navidrome"


def test_flatten_albums_and_conform_artists(spark):
    df = spark.createDataFrame([
        ("1", "N", "album", [{"id": "a", "name": "A", "type": "artist"}], ["rock"], "L", 3,
         "1994", "year", 9),
        ("2", "M", "single", [], None, None, None, None, None, None)], ALBUM_PAYLOAD)
    first, second = ingest.flatten_albums(df, "2024-01-01 00:00:00").orderBy("album_id").collect()
    assert (first.artist_name, first.genres) == ("A", ["rock"])
    assert (second.artist_id, second.genres) == (None, [])
    artists = ingest.conform_artists(
        spark.createDataFrame([("i", "n", 5, "x")], "id string, name string, popularity int, z string"))
    assert artists.dtypes == [("artist_id", "string"), ("artist_name", "string"),
                              ("artist_mbid", "string"), ("artist_popularity", "float")]


def test_cursor_and_newer_rows(spark):
    df = spark.createDataFrame([(at(0),), (at(1.5),)], "played_at timestamp")
    ms = ingest.high_water_mark(df).first()["cursor"]
    s = ingest.high_water_mark(df, unit="s").first()["cursor"]
    assert ms == s * 1000 + 500 + 1
    later = spark.createDataFrame([(at(1.5),), (at(1.6),), (at(9),)], "played_at timestamp")
    assert ingest.newer_than(later, ms).count() == 2
    assert ingest.newer_than(later, s, unit="s").count() == 1
    assert ingest.newer_than(later, None).count() == 3


def test_append_plays_harmonizes(spark):
    history = spark.createDataFrame([("1", 5)], "track_id string, popularity bigint")
    new = spark.createDataFrame([("2",)], "track_id string").withColumn("note", F.lit(None))
    both = ingest.append_plays(history, new)
    assert sorted(tuples(both, "track_id", "note")) == [("1", None), ("2", None)]
    assert dict(both.dtypes)["note"] == "string"
    assert ingest.append_plays(None, new) is not None
    assert ingest.append_plays(None, None) is None
    # repeats stay
    assert ingest.append_plays(history, history).count() == 2


def test_tables_views_and_seeds(spark, tmp_path):
    base = str(tmp_path)
    assert tables.read_table(spark, base, "tracks_played") is None
    (tmp_path / "empty").mkdir()
    assert tables.read_table(spark, base, "empty") is None
    sinks.write_overwrite(spark.range(3), base, "spotify_artists")
    assert tables.register_views(spark, base) == ["spotify_artists"]
    assert spark.sql("SELECT count(*) FROM spotify_artists").first()[0] == 3
    assert tables.table_exists(spark, base, "spotify_artists")
    (tmp_path / "unmapped_areas.csv").write_bytes("﻿area,country\nÖ,SE\n".encode())
    assert tuples(tables.read_seed(spark, base, "unmapped_areas")) == [("Ö", "SE")]
    assert set(SEEDS) == {"integers", "mask_artists", "unmapped_areas"}


def test_unreadable_files_give_no_plays(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "good.json").write_text(json.dumps([raw(track_id="1"), raw(track_id="2")]))
    (folder / "cut.json").write_text('[{"track_id": "3", "track_na')
    (folder / "empty.json").write_text("")
    (folder / "none.json").write_text("[]")
    assert sorted(tuples(sources.read_raw_plays(spark, str(folder)), "track_id")) == [("1",), ("2",)]
    bad = sources.rejected_files(spark, str(folder)).collect()
    assert [(r.source_file.split("/")[-1], r.text[:14]) for r in bad] == [
        ("cut.json", '[{"track_id": ')]
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_raw_plays(spark, str(folder), strict=True).collect()


def test_raw_files_into_the_stored_plays(spark, tmp_path):
    folder, base = tmp_path / "raw", str(tmp_path / "base")
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([raw(track_id="1"), raw(track_id="1"), raw(artist=None)]))
    (folder / "cut.json").write_text('[{"track')
    for _ in range(2):  # the second run adds no play
        got = sources.ingest_raw_plays(spark, str(folder), base)
    assert tuples(got, "track_id") == [("1",)]
    assert tables.read_table(spark, base, "rejected_files").count() == 2


def test_newer_plays_follow_the_stored_cursor(spark, tmp_path):
    base = str(tmp_path)
    names = spark.createDataFrame([], RAW_PLAY).columns

    def feed(*rows):
        return spark.createDataFrame([
            tuple(raw(duration_ms=1000.0, popularity=5.0, **r).get(c) for c in names)
            for r in rows], RAW_PLAY)

    first = feed(dict(track_id="1", played_at="2024-01-01T12:00:00.500Z"), dict(
        track_id="1", played_at="2024-01-01T12:00:00.500Z"))
    assert sources.ingest_newer(first, base).count() == 1
    more = feed(dict(track_id="old", played_at="2024-01-01T11:00:00Z"),
                dict(track_id="same", played_at="2024-01-01T12:00:00.500Z"),
                dict(track_id="2", played_at="2024-01-01T12:00:00.501Z"),
                dict(track_id="3", played_at="2024-01-02T12:00:00Z"))
    for _ in range(2):  # the second run finds nothing past the cursor
        got = sources.ingest_newer(more, base)
        assert sorted(tuples(got, "track_id")) == [("1",), ("2",), ("3",)]
    own = F.col("track_id") == "1"
    got = sources.ingest_newer(feed(dict(track_id="4", played_at="2024-01-01T13:00:00Z")), base,
                               source=own)
    assert sorted(tuples(got, "track_id")) == [("1",), ("2",), ("3",), ("4",)]
    assert sources.ingest_newer(feed(), base).count() == 4


def test_added_plays_repeat_nothing_stored(spark, tmp_path):
    base = str(tmp_path)
    names = spark.createDataFrame([], RAW_PLAY).columns

    def plays(*keys):
        return sources.typed_plays(spark.createDataFrame(
            [tuple(raw(track_id=t, played_at=f"2024-01-0{d}T12:00:00Z", duration_ms=1000.0,
                       popularity=5.0).get(c) for c in names) for t, d in keys], RAW_PLAY))

    sources.add_plays(plays(("a", 1), ("a", 1), ("b", 5)), base)
    sources.add_plays(plays(("a", 1), ("a", 2), ("c", 5), ("b", 5)), base)
    assert sorted(tuples(tables.read_table(spark, base, "tracks_played"), "track_id")) == [
        ("a",), ("a",), ("b",), ("c",)]

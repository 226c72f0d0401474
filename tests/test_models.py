from datetime import date

import pytest
from pyspark.sql import functions as F

from playmart.functions.scoring import NO_GENRE
from playmart.plans import intermediate as I
from playmart.plans import stage, warehouse
from playmart.schemas import AREA_HIERARCHY, ARTIST_INFO, TRACKS_PLAYED
from tests.conftest import at, tuples


def tracks_played(spark, rows):
    """Plays from (track_id, track_name, album_id, album, artist_id, artist_mbid, artist,
    duration_ms, played_at, popularity) rows."""
    full = [("u", r[0], None, None, r[1], r[2], None, r[3], r[4], r[5], r[6], r[7], r[8], r[9],
             "1", "s") for r in rows]
    return spark.createDataFrame(full, TRACKS_PLAYED)


def play(artist_id="a", artist="A", n=0, track="t", ms=1000, mbid=None, popularity=5):
    return (track, track, "al", "Al", artist_id, mbid, artist, ms, at(n), popularity)


def test_stage_cities(spark):
    df = spark.createDataFrame([("c", "NO", "p", "", "1.5", "n/a"), ("d", "NO", "q", "S", None, "2")],
                               "city_name string, country_code string, params string, "
                               "state_code string, lat string, long string")
    assert sorted(tuples(stage.stg_cities(df), "city_name", "state_code", "lat", "longitude")) == [
        ("c", None, 1.5, None), ("d", "S", None, 2.0)]


def test_stage_plays_distinct_but_not_over_cursors(spark):
    df = tracks_played(spark, [play(), play()])
    other = df.limit(1).withColumn("request_cursor", F.lit("2"))
    got = stage.stg_tracks_played(df.union(other))
    assert got.count() == 2
    row = got.first()
    assert (row.played_at_local.hour, row.duration_mins) == (5, 0.0)
    assert stage.stg_tracks_played(df, "UTC").first().played_at_local.hour == 12


@pytest.mark.parametrize("text, day, decade", [
    ("1994", date(1994, 1, 1), 1990), ("1994-05", date(1994, 5, 1), 1990),
    ("2003-05-06", date(2003, 5, 6), 2000), (None, None, None)])
def test_albums_pad_release_dates(spark, text, day, decade):
    plays = tracks_played(spark, [play(), play(artist_id="b"), play(artist="Z")])
    info = spark.createDataFrame([("al", "L", 9, text, "x", 3), ("al", "L", 9, text, "x", 7)],
                                 "album_id string, label string, total_tracks bigint, "
                                 "release_date string, release_date_precision string, "
                                 "popularity bigint")
    got = {r.artist: r for r in I.albums(plays, info).collect()}
    assert len(got) == 2
    a = got["A"]
    assert (a.artist_id, a.release_date, a.release_decade, a.album_popularity, a.artist_album) == (
        "b", day, decade, 7, "A - Al")


def test_genre_rank_and_top_genre(spark):
    df = spark.createDataFrame([("a", "A", "rock"), ("a", "A", "pop"), ("b", "B", "pop"),
                                ("c", "C", None), ("d", "D", "x"), ("d", "D", "w")],
                               "artist_id string, artist_name string, genre string")
    ranks = {(r.artist_id, r.genre): (r.genre_total, r.artist_genre_rank)
             for r in I.artist_genre_rank(df).collect()}
    assert ranks == {("a", "pop"): (2, 1), ("a", "rock"): (1, 2), ("b", "pop"): (2, 1),
                     ("c", None): (1, 1), ("d", "w"): (1, 1), ("d", "x"): (1, 2)}
    top = {r.artist_id: r.primary_genre for r in I.artist_top_genre(df).collect()}
    assert top == {"a": "pop", "b": "pop", "c": NO_GENRE, "d": "w"}


def located(spark, rows):
    columns = ["artist_id", "artist_mbid", "artist_name", "continent_code", "continent",
               "country_code", "country", "state_province_code", "state_province", "county",
               "city", "district"]
    ddl = ", ".join(f"{c} string" for c in columns) + ", lat double, longitude double"
    full = [(r[0], r[1], "x", None, None, r[2], None, None, None, None, r[3], None, None, None)
            for r in rows]
    return spark.createDataFrame(full, ddl)


def test_artists_best_spelling_location_and_unmatched(spark):
    distinct = spark.createDataFrame(
        [("a", "A", "m", 10.0), ("a", "A2", "m", 90.0), ("b", "B", None, None)],
        "artist_id string, artist_name string, artist_mbid string, artist_popularity float")
    top = spark.createDataFrame([("a", "A", "rock")],
                                "artist_id string, artist_name string, primary_genre string")
    places = located(spark, [("a", "m", "AA", "x"), ("a", "m", "ZZ", "y"), (None, "u", "QQ", "z")])
    unmatched = spark.createDataFrame([("New", "u", "New", 3)],
                                      "artist_name string, artist_mbid string, "
                                      "potential_match string, count_played bigint")
    got = {r.artist_name: r for r in I.artists(distinct, top, places, unmatched).collect()}
    assert set(got) == {"A2", "B", "New"}
    assert (got["A2"].country_code, got["A2"].city, got["A2"].primary_genre) == ("ZZ", "y", "rock")
    assert (got["New"].artist_id, got["New"].country_code) == (None, "QQ")
    assert got["B"].country_code is None
    assert got["B"].asDict().keys() == dict.fromkeys(I.ARTIST_COLUMNS).keys()


def test_unmatched_names(spark):
    names = ["A, B", "Solo", "(x) C", "A feat. D", "E Feat. F", "G & H, I", " pad "]
    rows = [play(None, n, i, mbid="m") for i, n in enumerate(names)] + [play("id", "Known")]
    prep = I.unmatched_artists_prep(tracks_played(spark, rows))
    got = sorted((r.artist_name, r.potential_match) for r in prep.collect())
    assert got == sorted([("A, B", "A"), ("Solo", "Solo"), ("A feat. D", "A"),
                          ("E Feat. F", "E Feat. F"), ("G & H, I", "G"), (" pad ", "pad"),
                          (" pad ", " pad ")])
    two = tracks_played(spark, [play(None, "X", 0, mbid="m1"), play(None, "X", 1, mbid="m2"),
                                play(None, "X", 2, mbid="m2")])
    best = I.unmatched_artists(I.unmatched_artists_prep(two))
    assert tuples(best) == [("X", "m2", "X", 2)]


def test_genre_stats(spark):
    plays = stage.stg_tracks_played(tracks_played(spark, [
        play("a", "A", 0), play("a", "A", 1), play("b", "B", 2, ms=7000), play(None, "N", 3)]))
    artists = spark.createDataFrame([("a", 10.0), ("b", 90.0), ("a", 10.0)],
                                    "artist_id string, artist_popularity float")
    genres = spark.createDataFrame([("a", "rock"), ("b", "rock"), ("b", "pop")],
                                   "artist_id string, genre string")
    got = {r.genre: tuple(r)[1:] for r in I.genre_stats(plays, artists, genres).collect()}
    # artist a is listed twice, so its two plays count twice
    assert got == {"rock": ("A", "B", 5, 11_000), "pop": ("B", "B", 1, 7000),
                   NO_GENRE: ("N", "N", 1, 1000)}


@pytest.mark.parametrize("mode, expected", [
    ("exact", [1 / (7 / 5) + 1, 2 / (7 / 5) + 1, 3 / (7 / 5) + 1, 4 / (7 / 5) + 1, 5 / (7 / 5) + 1,
               6 / (7 / 5) + 1, 5.0]),
    ("floor", [1, 1, 2, 3, 3, 4, 5])])
def test_genre_groups(spark, mode, expected):
    stats = spark.createDataFrame([(f"g{i}", "t", "m", 100 - i, i) for i in range(7)],
                                  "genre string, top_artist_in_genre string, "
                                  "most_popular_artist_in_genre string, "
                                  "total_tracks_played_in_genre bigint, "
                                  "total_ms_played_in_genre bigint")
    got = I.ranked_genre(stats, groups_mode=mode).orderBy("genre").collect()
    assert [r.tracks_grouping for r in got] == expected
    assert [r.rank_by_time_played for r in got] == [7, 6, 5, 4, 3, 2, 1]
    with pytest.raises(ValueError):
        I.ranked_genre(stats, groups_mode="x")


def test_fewer_genres_than_groups_and_ties(spark):
    stats = spark.createDataFrame([("b", "t", "m", 1, None), ("a", "t", "m", 1, 5)],
                                  "genre string, top_artist_in_genre string, "
                                  "most_popular_artist_in_genre string, "
                                  "total_tracks_played_in_genre bigint, "
                                  "total_ms_played_in_genre bigint")
    got = {r.genre: r for r in I.ranked_genre(stats, groups_mode="floor").collect()}
    assert (got["a"].rank_by_tracks_played, got["b"].rank_by_tracks_played) == (1, 2)
    assert got["b"].rank_by_time_played == 2
    dim = {r.genre: r for r in warehouse.dim_artist_genre(
        I.ranked_genre(stats, groups_mode="floor")).collect()}
    assert dim["a"].group_by_tracks_played == "Group 1 (Most Played Genres)"
    assert dim["b"].total_minutes_played_in_genre == 0


def test_played_and_facts(spark):
    plays = stage.stg_tracks_played(tracks_played(spark, [play(), play(None, "N", 5, "q")]))
    artists = spark.createDataFrame([("a", "A", 3.0), ("a", "A2", 8.0), (None, "N", 1.0)],
                                    "artist_id string, artist_name string, artist_popularity float")
    played = I.played(plays, artists)
    got = {r.artist: r for r in played.collect()}
    assert (got["A"].artist_popularity, got["A"].time_sid, got["A"].date_sid) == (
        8.0, 5 * 3600, date(2024, 1, 1))
    assert got["N"].artist_popularity is None
    fact = warehouse.fact_track_played(played)
    genres = spark.createDataFrame([("a", "rock"), ("a", "pop")], "artist_id string, genre string")
    by_genre = warehouse.fact_artist_genre(played, genres)
    assert fact.count() == 2 and by_genre.count() == 3
    assert by_genre.select("track_played_uid").distinct().count() == 2
    keys = {r.genre_sid for r in by_genre.collect()}
    dim = spark.createDataFrame([("rock",), (NO_GENRE,)], "genre string").select(
        warehouse.surrogate_key("genre", F.lit("")).alias("k"))
    rock, none = [r.k for r in dim.collect()]
    # a play without genres has the key of a missing genre, which no dimension row has
    assert rock in keys and none not in keys


def test_dim_artist_masks_the_name_but_not_the_key(spark):
    places = ", ".join(f"CAST(NULL AS string) AS {c}" for c in I.LOCATION)
    artists = spark.sql(f"""SELECT 'a' AS artist_id, 'm' AS artist_mbid, 'A' AS artist_name,
        CAST(50 AS float) AS artist_popularity, CAST(NULL AS string) AS primary_genre, {places}
        UNION ALL SELECT NULL, 'n', 'N', NULL, 'pop', {places}""")
    masks = spark.createDataFrame([("a", "Hidden")], "artist_id string, mask_name string")
    plain = {r.artist_sid for r in warehouse.dim_artist(artists, masks.limit(0)).collect()}
    got = {r.artist_name: r for r in warehouse.dim_artist(artists, masks).collect()}
    assert {r.artist_sid for r in got.values()} == plain
    assert (got["Hidden"].is_popular, got["Hidden"].primary_genre) == ("Popular", NO_GENRE)
    assert got["N"].is_popular == "No Artist Popularity Data"


def test_dim_track(spark):
    got = {r.track_name: r for r in warehouse.dim_track(I.tracks(tracks_played(spark, [
        play(track="x", ms=90_000_000, popularity=None), play(track="y", ms=None, popularity=70),
        play(track="y", n=1, ms=200_000, popularity=10)]))).collect()}
    assert (got["x"].is_popular, got["x"].track_popularity_sort, got["x"].track_length_sort) == (
        "Not Popular", 0, 7)
    assert got["x"].track_duration == 3_600_000  # wraps at 24 hours
    assert (got["y"].track_popularity_group, got["y"].track_length, got["y"].track_minutes) == (
        "Very Popular", "average", 3.0)
    assert got["y"].artist_track == "A - y"


def test_dim_date(spark):
    days = [date(2024, 12, 29), date(2024, 12, 30), date(2024, 2, 29), date(2023, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "date_sid date")
    got = {r.date: r for r in warehouse.dim_date(df).collect()}
    assert got[days[0]].day_of_week == 0 and got[days[0]].day_of_week_name == "Sunday"
    assert (got[days[1]].week_of_year, got[days[1]].year_num) == (1, 2024)
    leap = got[days[2]]
    assert (leap.month_end_date, leap.day_of_year, leap.year_end_date, leap.quarter) == (
        days[2], 60, date(2024, 12, 31), 1)
    assert (leap.month_name, leap.month_start_date) == ("February", date(2024, 2, 1))


def test_spines(spark):
    span = I.dates(spark, date(2024, 2, 27), date(2024, 3, 1))
    assert [r[0].day for r in span.collect()] == [27, 28, 29, 1]
    # the spine has no longest length
    assert I.dates(spark, date(2000, 1, 1), date(2050, 1, 1)).count() == 18_264
    assert I.times(spark).count() == 86_400


@pytest.mark.parametrize("clock, part, sort", [
    ((0, 0, 0), "Night", 1), ((5, 59, 59), "Night", 1), ((6, 0, 0), "Morning", 2),
    ((11, 59, 59), "Morning", 2), ((12, 0, 0), "Afternoon", 3), ((17, 59, 59), "Afternoon", 3),
    ((18, 0, 0), "Evening", 4), ((23, 59, 59), "Evening", 4)])
def test_dim_time(spark, clock, part, sort):
    h, m, s = clock
    df = spark.createDataFrame([(h * 3600 + m * 60 + s,)] * 2, "time_sid int")
    row, = warehouse.dim_time(df).collect()
    assert (row.hour_of_day, row.minute_of_hour, row.second_of_hour) == clock
    assert (row.time_of_day, row.time_of_day_sort) == (part, sort)
    assert row.am_pm == ("AM" if h < 12 else "PM")
    assert row.time == "%02d:%02d:%02d" % clock


def test_recently_played_popularity_text(spark):
    df = spark.createDataFrame([(90_000.0, None), (90_000.0, 0.0), (None, 55.0)],
                               "duration_ms double, popularity double")
    assert tuples(warehouse.recently_played(df)) == [
        (90_000.0, "--", 1.5), (90_000.0, "--", 1.5), (None, "55/100", None)]


def test_wide_projections(spark):
    areas = spark.createDataFrame([], ", ".join(f"{c} string" for c in [*AREA_HIERARCHY, "x"]))
    assert stage.stg_area_hierarchy(areas).columns == list(AREA_HIERARCHY)
    assert len(AREA_HIERARCHY) == 33 and len(ARTIST_INFO) == 30
    hierarchy = I.area_hierarchy(stage.stg_area_hierarchy(areas))
    assert {"state_id", "state_name", "city_name", "params"} <= set(hierarchy.columns)


def test_select_and_exclude():
    assert warehouse.selected_models(["dim_date"]) == ["dim_date"]
    assert "dim_date" not in warehouse.selected_models(exclude=["dim_date"])
    with pytest.raises(ValueError, match="nope"):
        warehouse.selected_models(["nope"])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_plays_are_dealt_out_before_they_are_aggregated(spark):
    plan = plan_of(stage.stg_tracks_played(tracks_played(spark, [play(), play()])))
    assert plan.count("Exchange") == 1
    assert plan.rindex("HashAggregate") < plan.index("Exchange")


def test_genres_fan_out_behind_every_shuffle_and_sort(spark):
    plays = tracks_played(spark, [play("a", "A", n) for n in range(3)] + [play(None, "N", 9)])
    genres = spark.createDataFrame(
        [("a", "A", "rock"), ("a", "A", "pop"), ("a", "A", None)],
        "artist_id string, artist_name string, genre string")
    artists = spark.createDataFrame([("a", "A", "m", 3.0)], "artist_id string, artist_name string, "
                                    "artist_mbid string, artist_popularity float")
    inputs = warehouse.Inputs(spark, {"tracks_played": plays, "spotify_artists": artists,
                                      "spotify_artist_genre": genres})
    df = warehouse._in_files(inputs, "fact_artist_genre")
    above = plan_of(df).split("Generate")[0]
    # nor are keys made for each genre
    assert "Exchange" not in above and "Sort" not in above and "md5" not in above
    assert df.groupBy("track_played_uid").count().orderBy("count").select("count").collect() == [
        (1,), (3,), (3,), (3,)]


def test_genre_files_keep_a_play_together_by_date(spark, tmp_path):
    rows = [play("a", "A", 86_400 * 200 * (k % 4) + k) for k in range(40)] + [play(None, "N", 9)]
    genres = [("a", "A", f"g{k}") for k in range(5)]
    inputs = warehouse.Inputs(spark, {
        "tracks_played": tracks_played(spark, rows),
        "spotify_artists": spark.createDataFrame(
            [("a", "A", "m", 3.0)], "artist_id string, artist_name string, artist_mbid string, "
            "artist_popularity float"),
        "spotify_artist_genre": spark.createDataFrame(
            genres, "artist_id string, artist_name string, genre string")})
    base = str(tmp_path)
    warehouse.write_warehouse(inputs, base, list(warehouse.FACTS))
    assert spark.read.parquet(f"{base}/fact_artist_genre").count() == 40 * 5 + 1
    for file in tmp_path.glob("fact_artist_genre/*/*.parquet"):
        got = spark.read.parquet(str(file)).select("date_sid", "track_played_uid").collect()
        assert [r.date_sid for r in got] == sorted(r.date_sid for r in got)
        runs = [r for k, r in enumerate(got) if not k or got[k - 1] != r]
        assert len(runs) == len(set(runs))


ODD = [play(), play(), play("a", "A", 1), play("a", None, 1), play(None, "A", 1),
       play(None, "A", 1), play(None, "A", 2), play("a", "A", 1, "q")]


def stored_plays(spark, path, rows):
    tracks_played(spark, rows).write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("few", [stage.FEW_REPEATS, 0])
@pytest.mark.parametrize("rows", [ODD, ODD[1:3], ODD[:2], []])
def test_stored_plays_are_made_distinct_by_their_hashes(spark, tmp_path, rows, few):
    df = stored_plays(spark, tmp_path / "plays", rows)
    want, got = stage.stg_tracks_played(df), stage.stored_tracks_played(df, few=few)
    assert got.schema == want.schema and got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_plays_that_share_a_hash_alone_all_stay(spark, tmp_path, monkeypatch):
    df = stored_plays(spark, tmp_path / "plays", ODD)
    want = sorted(tuples(stage.stg_tracks_played(df)), key=str)
    monkeypatch.setattr(stage, "row_hash", lambda columns: F.col("duration_ms") % 2)
    assert sorted(tuples(stage.stored_tracks_played(df)), key=str) == want


def test_plays_are_not_shuffled_into_the_facts(spark, tmp_path):
    rows = [play("a", "A", k) for k in range(20)] + [play(None, "N", 9)]
    tables = {
        "tracks_played": stored_plays(spark, tmp_path / "plays", rows),
        "spotify_artists": spark.createDataFrame(
            [("a", "A", "m", 3.0)], "artist_id string, artist_name string, artist_mbid string, "
            "artist_popularity float"),
        "spotify_artist_genre": spark.createDataFrame(
            [("a", "A", "x"), ("a", "A", "y")], "artist_id string, artist_name string, genre string")}
    inputs = warehouse.Inputs(spark, tables)
    for name in warehouse.FACTS:
        plan = plan_of(warehouse._in_files(inputs, name))
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan, name
    days = plan_of(warehouse.build_model(inputs, "fact_days"))
    assert days.count("Exchange hashpartitioning") == 1  # one row for each task and day

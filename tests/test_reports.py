from datetime import date

import pytest

from playmart.operators import reports as R
from tests.conftest import at, tuples


@pytest.fixture(scope="module")
def star(spark):
    fact = spark.createDataFrame([
        ("t1", "s1", date(2023, 12, 31), 0), ("t1", "s1", date(2024, 1, 1), 6 * 3600),
        ("t2", "s1", date(2024, 1, 2), 19 * 3600), ("t3", "s2", date(2024, 1, 2), 13 * 3600),
        ("t4", "s3", date(2024, 1, 3), 13 * 3600), ("t5", "gone", date(2024, 1, 2), 5),
    ], "track_sid string, artist_sid string, date_sid date, time_sid int")
    artists = spark.createDataFrame([
        ("s1", "One", "Europe", "Norway", "S", "Oslo", 1.0, 2.0, "rock", "NO"),
        ("s2", "Two", "Europe", "Sweden", None, "Umea", 3.0, 4.0, "no genre defined", "SE"),
        ("s3", "Three", None, None, None, None, None, None, "pop", ""),
    ], "artist_sid string, artist_name string, continent string, country string, "
       "state_province string, city string, lat double, longitude double, primary_genre string, "
       "country_code string")
    days = spark.sql("""SELECT d AS date_sid, d AS date, CAST(year(d) AS bigint) AS year_num
        FROM (SELECT explode(sequence(DATE '2023-12-01', DATE '2024-01-31')) AS d)""")
    clock = spark.sql("""SELECT CAST(id AS int) AS time_sid, id div 3600 AS hour_of_day,
        CASE WHEN id < 21600 THEN 'Night' WHEN id < 43200 THEN 'Morning'
             WHEN id < 64800 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day
        FROM range(86400)""")
    genre_fact = spark.createDataFrame([
        ("t1", "s1", "g1", date(2023, 12, 31)), ("t1", "s1", "g1", date(2024, 1, 1)),
        ("t2", "s1", "g2", date(2024, 1, 2)), ("t3", "s2", "g1", date(2024, 1, 2)),
        ("t4", "s3", "gx", date(2024, 1, 2)),
    ], "track_sid string, artist_sid string, genre_sid string, date_sid date")
    genres = spark.createDataFrame([("g1", "rock", "One", "Two"), ("g2", "pop", "One", "One"),
                                    ("gx", "no genre defined", "Three", "Three")],
                                   "genre_sid string, genre string, top_artist_in_genre string, "
                                   "most_popular_artist_in_genre string")
    return dict(t=fact, a=artists, d=days, c=clock, f=genre_fact, g=genres)


FULL = ("2023-12-31", "2024-01-03")


def test_date_bounds_are_inclusive(star):
    t, a, d = star["t"], star["a"], star["d"]
    count = lambda *span: R.track_count_by_geography(t, a, d, *span).first()[0]
    assert count(*FULL) == 5  # the play of an unknown artist drops out
    assert count("2024-01-01", "2024-01-02") == 3
    assert count(date(2024, 1, 3), date(2024, 1, 3)) == 1
    assert count("2025-01-01", "2025-01-02") == 0


def test_geography_filters(star):
    t, a, d = star["t"], star["a"], star["d"]
    count = lambda **f: R.track_count_by_geography(t, a, d, *FULL, **f).first()[0]
    assert count(continents=[]) == 5
    assert count(continents=["Europe"]) == 4
    assert count(countries=["Norway"]) == 3
    assert count(continents=["Europe"], genres=["pop"]) == 0
    assert tuples(R.genre_distribution(t, a, d, *FULL)) == [("rock", 3), ("pop", 1)]
    assert tuples(R.artists_by_geography(t, a, d, *FULL)) == [("One", 3), ("Three", 1), ("Two", 1)]
    assert tuples(R.artists_by_geography(t, a, d, *FULL, top=1)) == [("One", 3)]


def test_lists(star):
    a, g = star["a"], star["g"]
    assert tuples(R.continents(a)) == [("Europe",)]
    assert tuples(R.country_codes(a)) == [("NO",), ("SE",)]
    assert tuples(R.countries_for_continents(a, ["Europe"])) == [("Norway",), ("Sweden",)]
    assert tuples(R.countries_for_continents(a, [])) == []
    assert tuples(R.genres(g)) == [("pop",), ("rock",)]


def test_time_reports(star):
    t, a, d, c = star["t"], star["a"], star["d"], star["c"]
    assert tuples(R.tracks_by_year(t, a, d, *FULL)) == [(2023, 1), (2024, 4)]
    assert tuples(R.tracks_by_year(t, a, d, *FULL, country_code="SE")) == [(2024, 1)]
    assert tuples(R.tracks_by_hour(t, a, d, c, *FULL)) == [(0, 1), (6, 1), (13, 2), (19, 1)]
    assert tuples(R.tracks_by_time_of_day(t, a, d, c, *FULL)) == [
        ("Morning", 1), ("Afternoon", 2), ("Evening", 1), ("Night", 1)]


def test_genre_reports(star):
    f, g, a, d = star["f"], star["g"], star["a"], star["d"]
    assert tuples(R.tracks_by_year_and_genre(f, g, d, *FULL)) == [(2023, 1), (2024, 3)]
    assert tuples(R.tracks_by_year_and_genre(f, g, d, *FULL, genres=["pop"])) == [(2024, 1)]
    assert tuples(R.genre_distribution_with_artists(f, g, d, *FULL)) == [
        ("rock", 3, "One", "Two"), ("pop", 1, "One", "One")]
    # the largest genre count of the artist, not the sum
    assert tuples(R.artists_by_genre(f, g, a, d, *FULL)) == [("One", 2), ("Two", 1)]
    assert tuples(R.artists_by_genre(f, g, a, d, *FULL, genres=["rock"], years=[2024])) == [
        ("One", 1), ("Two", 1)]
    assert tuples(R.top_artist_in_top_genres(f, g, a, d, *FULL, top_genres=1)) == [
        ("One", 2), ("Two", 1)]
    by_year = R.tracks_by_year_and_genre(f, g, d, *FULL)
    assert tuples(R.selectable_years(by_year)) == [(2023,), (2024,)]
    assert R.genre_treemap_midpoint(
        R.genre_distribution_with_artists(f, g, d, *FULL)).first()[0] == 2.0


def test_map_and_bubbles(star):
    geo = R.geographic_data(star["t"], star["a"], star["d"], *FULL)
    assert geo.count() == 2
    assert tuples(R.map_aggregate(geo, "Country")) == [("Norway", 3, 1.0, 2.0),
                                                       ("Sweden", 1, 3.0, 4.0)]
    assert tuples(R.map_aggregate(geo, "Continent")) == [("Europe", 4, 2.0, 3.0)]
    assert R.map_aggregate(geo, "City", countries=["Sweden"]).count() == 1
    with pytest.raises(ValueError):
        R.map_aggregate(geo, "Street")
    every = R.map_aggregate_all(geo).collect()
    assert sorted(r.level for r in every) == ["City", "City", "Continent", "Country", "Country",
                                              "State/Province", "State/Province"]
    city = next(r for r in every if r.city == "Oslo")
    assert (city.lat, city.longitude, city.total_tracks) == (1.0, 2.0, 3)
    bubbles = R.bubble_size(R.map_aggregate(geo, "Country"))
    assert [r.bubble_size for r in bubbles.collect()] == [35.0, 15.0]
    drill = {(r.continent, r.country, r.depth): r.track_count
             for r in R.location_drilldown(geo).collect()}
    assert drill[(None, None, 0)] == 4 and drill[("Europe", "Norway", 2)] == 3


def test_last_24_hours(spark):
    df = spark.createDataFrame([
        ("A", "x", 1.5, at(0)), ("A", "x", 2.25, at(5)), ("B", "y", 1.0, at(9)),
        ("B", "old", 9.0, at(-86_400)), (None, "z", 1.0, at(1))],
        "artist string, track_name string, minutes_played float, played_at timestamp")
    for c in ("user_id", "track_id", "artist_id", "album", "duration_ms", "popularity",
              "play_source"):
        df = df.selectExpr("*", f"CAST(NULL AS string) AS {c}")
    recent = R.last_24h_tracks(df, "2024-01-02 12:00:00")
    assert len(recent.columns) == 11
    assert [r.played_at for r in recent.collect()][0] == at(9)
    assert recent.count() == 4  # a play exactly 24 hours old counts
    assert R.last_24h_tracks(df, "2024-01-02 12:00:01").count() == 3
    assert tuples(R.artist_aggregates(recent, 2)) == [("A", 3.75, 2), ("B", 1.0, 1)]
    assert tuple(R.kpi_last_24h(recent).first()) == (5.75, 4, 3, 3)
    assert tuple(R.artist_detail(recent, "A").first()) == (3.75, 2, 1.875)
    assert tuple(R.artist_detail(recent, "nobody").first()) == (0.0, 0, 0.0)
    assert tuples(R.tracks_for_artist(recent, "A"), "track_name", "minutes_played") == [
        ("x", 2.25), ("x", 1.5)]


def test_unknown_minutes_count_as_none(spark):
    df = spark.createDataFrame([("A", "x", None)],
                               "artist string, track_name string, minutes_played float")
    assert tuples(R.artist_aggregates(df)) == [("A", 0.0, 1)]
    assert R.kpi_last_24h(df).first()["total_minutes"] == 0.0


def test_measures(spark, star):
    t = star["t"].selectExpr("*", "CAST(90000 AS bigint) AS duration_ms")
    row = R.measures(t, star["f"], *FULL).first()
    assert (row.count_tracks_played, row.sum_of_minutes_played,
            row.count_tracks_played_in_genre) == (6, 9.0, 5)


def test_selected_keys_cut_the_fact_before_it_is_grouped(spark, star):
    t, a, d = star["t"], star["a"], star["d"]
    plan = R.tracks_by_year(t, a, d, *FULL, country_code="NO")._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert "LeftSemi" in text and text.index("Aggregate") < text.index("LeftSemi")
    whole = R.tracks_by_year(t, a, d, *FULL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in whole

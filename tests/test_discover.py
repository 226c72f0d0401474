import pytest
from pyspark.sql import functions as F

from playmart.operators import discover
from tests.conftest import at, tuples

NOW = "2024-01-03 12:00:00"


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame([
        ("a", "A", "b1", "i2", 5, at()), ("a", "A", "b1", "i1", 9, at(1)),
        ("k", "K", "b2", "i3", 1, at(2)), (None, "N", None, "i4", 2, at(2)),
        ("o", "O", "b1", "i5", 3, at(-1)), ("p", "P", "b3", None, 3, at(5)),
    ], "artist_id string, artist string, album_id string, track_isrc string, popularity int, "
       "played_at timestamp")


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("k", "k"), ("k", "k"), (None, None)],
                                 "artist_id string, spotify_id string")


def test_missing_artists_and_paging(history, known):
    got = tuples(discover.missing_artists(history, known))
    assert got == [("a", "A"), ("o", "O"), ("p", "P")]
    assert tuples(discover.missing_artists(history, known, limit=1, offset=1)) == [("o", "O")]
    assert len(tuples(discover.missing_artists(history, None))) == 4


def test_missing_albums(spark, history):
    albums = spark.createDataFrame([("b3",), ("b3",)], "album_id string")
    assert tuples(discover.missing_albums(history, albums)) == [("b1", 3), ("b2", 1)]


def test_catalog_artists_of_exactly_48_hours(history, known):
    got = tuples(discover.missing_catalog_artists(history, known, NOW))
    assert got == [("a", "A", "i1")]  # a play 48 hours old counts, one second more does not
    wide = tuples(discover.missing_catalog_artists_with_popularity(history, known, NOW))
    assert wide == [("a", "A", "i1", 9), (None, "N", "i4", 2)]


def test_cities_and_areas(spark):
    areas = spark.createDataFrame([
        ("1", "Oslo,NO", "Oslo", "NO", "Norway", None, "Europe"),
        ("2", "", "Rome", "IT", "Italy", None, None),
        ("3", None, None, None, None, "Guam", "Unknown"),
        ("4", "Bern,CH", "Bern", "CH", "Switzerland", None, ""),
    ], "area_id string, params string, city_name string, country_code string, "
       "country_name string, island_name string, continent string")
    cities = spark.createDataFrame([("Bern,CH",), ("Bern,CH",)], "params string")
    assert [r[0] for r in tuples(discover.cities_needing_coordinates(areas, cities))] == ["Oslo,NO"]
    assert sorted(r[0] for r in tuples(discover.areas_without_continent(areas))) == ["2", "3", "4"]
    needing = discover.areas_needing_coordinates(areas, cities)
    assert sorted(r[0] for r in tuples(needing)) == ["1", "2"]
    assert sorted(tuples(discover.countries_needing_enrichment(areas))) == [("Guam",), ("Italy",)]
    everything = discover.countries_needing_enrichment(areas.drop("continent"))
    assert everything.count() == 4
    assert discover.missing_count("cities", areas=areas, known=cities).first()["count"] == 1


def test_missing_count(history, known):
    assert discover.missing_count("artists", plays=history, known=known).first()["count"] == 3
    assert discover.missing_count(
        "mbz_artists", plays=history, known=known, now=NOW).first()["count"] == 1
    with pytest.raises(ValueError):
        discover.missing_count("tracks")


def test_check_exists_does_not_fan_out(spark, known):
    ids = spark.createDataFrame([("k",), ("z",)], "artist_id string")
    assert sorted(tuples(discover.check_exists(ids, known))) == [("k", True), ("z", False)]


def test_area_ids(spark):
    info = spark.createDataFrame([("x", "y", None), ("x", None, "z"), (None, None, None)],
                                 "area_id string, begin_area_id string, end_area_id string")
    done = spark.createDataFrame([("y",)], "area_id string")
    assert tuples(discover.area_ids_to_process(info, done)) == [("x",), ("z",)]


def test_batches(spark):
    df = spark.range(23).select(F.col("id"))
    got = discover.assign_batches(df, [F.desc("id")], 10).orderBy(F.desc("id")).collect()
    assert [(r.batch_index, r.batch_offset, r.batch_size) for r in got[::10]] == [
        (0, 0, 10), (1, 10, 10), (2, 20, 3)]
    assert got[0].id == 22


def test_track_failures(spark):
    failed = spark.createDataFrame([("a", "A", None, "i1", None), ("b", "B", "i2", "zz", "r")],
                                   "artist_id string, artist string, track_isrc string, "
                                   "isrc string, reason string")
    got = discover.track_failures(failed, "now")
    assert sorted(tuples(got)) == [("a", "A", "i1", "Unknown failure", "now"),
                                   ("b", "B", "i2", "r", "now")]
    again = discover.track_failures(failed, "later", got)
    assert again.count() == 2 and {r.failed_at for r in again.collect()} == {"later"}

"""The manifest of the facts and refreshes that find what changed."""

import os
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from playmart.plans import catalog, warehouse
from tests.conftest import at, tuples

SF = "/root/testdata/sf0.001"
ARTISTS = "artist_id string, artist_popularity double"
GENRES = "artist_id string, genre string"


def manifest(spark, plays, artists=(("a", 5.0), ("b", None)), genres=(("a", "x"), ("a", "y"))):
    rows = spark.createDataFrame(
        plays, "artist_id string, played_at_local timestamp, album string, uri string")
    return warehouse.fact_days(rows, spark.createDataFrame(list(artists), ARTISTS),
                               spark.createDataFrame(list(genres), GENRES))


BASE = [("a", at(0), "x", None), ("a", at(9), "x", None), ("b", at(0, 2), None, "x"),
        (None, at(0, 3), "x", "y"), ("c", None, "x", "y")]


@pytest.mark.parametrize("change, days", [
    ({}, []),
    ({"plays": BASE[::-1]}, []),
    ({"plays": BASE[1:]}, [date(2024, 1, 1)]),
    ({"plays": [*BASE, ("z", at(0, 4), "x", "y")]}, [date(2024, 1, 4)]),
    ({"plays": BASE[:3] + BASE[4:]}, [date(2024, 1, 3)]),
    ({"plays": BASE[:4]}, [None]),
    ({"plays": BASE[:2] + [("b", at(0, 2), "x", None)] + BASE[3:]}, [date(2024, 1, 2)]),
    ({"plays": [BASE[0], BASE[0], *BASE[2:]]}, [date(2024, 1, 1)]),
    ({"artists": [("a", 6.0), ("b", None)]}, [date(2024, 1, 1)]),
    ({"artists": [("a", 5.0), ("b", 0.0)]}, [date(2024, 1, 2)]),
    ({"artists": [("a", 5.0), ("a", 4.0), ("b", None), ("q", 1.0)]}, []),
    ({"genres": [("a", "x")]}, [date(2024, 1, 1)]),
    ({"genres": [("a", "y"), ("a", "x"), ("q", "x")]}, []),
    ({"genres": [("a", "x"), ("a", "y"), ("a", "y")]}, [date(2024, 1, 1)]),
    ({"genres": [("a", "x"), ("a", "y"), ("c", "y")]}, [None]),
    ({"plays": []}, [None, date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]),
])
def test_changed_days(spark, change, days):
    old, new = manifest(spark, BASE), manifest(spark, **{"plays": BASE, **change})
    got = tuples(warehouse.changed_days(old, new))
    assert sorted(got, key=str) == sorted([(d,) for d in days], key=str)


def fact_files(base):
    return {str(p) for name in warehouse.FACTS for p in Path(base, name).rglob("*.parquet")}


def same(spark, base, inputs):
    stored = warehouse.stored_warehouse(spark, base)
    for name in warehouse.FACTS:
        want = warehouse.build_model(inputs, name)
        got = stored[name].select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_a_refresh_without_dates_equals_a_full_build(spark, tmp_path):
    base, source = str(tmp_path), catalog.Source(spark, SF)
    inputs = source.inputs
    years = {r[0] for r in source.model("played").select(F.year("date_sid")).distinct().collect()}
    fresh = lambda **tables: replace(inputs, tables={**inputs.tables, **tables}, built={})

    assert warehouse.refresh_warehouse(fresh(), base) == sorted(years)  # nothing stored yet
    files = fact_files(base)
    assert warehouse.refresh_warehouse(fresh(), base) == [] and fact_files(base) == files

    # plays of one year, one without a time
    first = 1996
    lost = F.when(F.month("played_at") > 6, F.col("played_at"))
    plays = source.history.withColumn("played_at", F.when(
        F.year("played_at") == first, lost).otherwise(F.col("played_at")))
    changed = fresh(tracks_played=plays)
    # a play early on the first of January is one of the year before in local time
    assert set(warehouse.refresh_warehouse(changed, base)) >= {first, None}
    same(spark, base, changed)
    assert fact_files(base) & files

    # enrichment of an artist who is played, then all of it back
    artist = source.history.where("artist_id IS NOT NULL").first()["artist_id"]
    mine = F.col("artist_id") == artist
    tables = {}
    for name, column, value in (("spotify_artist_genre", "genre", "other"),
                                ("spotify_artists", "artist_popularity", 101)):
        rows = inputs.table(name)
        other = F.when(mine, F.lit(value).cast(rows.schema[column].dataType))
        tables[name] = rows.withColumn(column, F.coalesce(other, F.col(column)))
    warehouse.refresh_warehouse(fresh(**tables), base)
    same(spark, base, fresh(**tables))
    # by hand, without the years that changed: they stay on the list
    day = date(first, 6, 1)
    assert warehouse.refresh_warehouse(fresh(), base, day, day) == [first]
    assert first not in warehouse.refresh_warehouse(fresh(), base)
    same(spark, base, fresh())
    with pytest.raises(ValueError):
        warehouse.refresh_warehouse(fresh(), base, day)

"""The named queries on the smallest driver tables, against their SQL and against each other."""

import os

import pytest

import __spark_entry__ as entry
from playmart.operators import reports
from playmart.plans import catalog, warehouse
from tests.conftest import tuples

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
SAMPLE = ["c3_dedup_plays", "d12_assign_batches", "g2_pivot_hierarchy", "i7_artists",
          "i11_ranked_genre", "j8_fact_artist_genre", "k13_tracks_by_year", "k20_map_aggregate_all"]


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for f in os.listdir(SF):
        connection.execute(
            f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return connection


def as_set(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert as_set(df.columns, df.collect()) == as_set(columns, cursor.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["primary_genre", "track_count"] and df.count() > 0


def test_stored_warehouse_gives_the_same_reports(spark, tmp_path):
    source = catalog.Source(spark, SF)
    written = warehouse.write_warehouse(source.inputs, str(tmp_path))
    assert written == list(warehouse.WAREHOUSE)
    stored = warehouse.stored_warehouse(spark, str(tmp_path))
    assert set(stored) == set(warehouse.WAREHOUSE)
    span = (catalog.START, catalog.END)
    by_year = reports.tracks_by_year(
        stored["fact_track_played"], stored["dim_artist"], stored["dim_date"], *span)
    assert tuples(by_year) == tuples(catalog.QUERIES["k13_tracks_by_year"](spark, SF))
    # folders outside the period are not read
    plan = by_year._jdf.queryExecution().toString()
    assert "play_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # every play finds its album; tracks and artists may be known under another id or spelling
    fact = stored["fact_track_played"]
    albums = fact.join(stored["dim_album"], "album_sid", "left_anti")
    assert fact.count() == source.model("played").count()
    assert albums.count() == 0


def test_stored_tables_feed_the_models(spark, tmp_path):
    source = catalog.Source(spark, SF)
    for name in ("tracks_played", "spotify_artists"):
        source.inputs.table(name).write.parquet(f"{tmp_path}/{name}")
    inputs = warehouse.stored_inputs(spark, str(tmp_path))
    played = warehouse.build_warehouse(inputs, select=["fact_track_played"])["fact_track_played"]
    assert played.count() == source.model("fact_track_played").count()


def test_the_column_report_counts_both_tables(spark, db):
    name = "e11_check_column_consistency"
    got = catalog.QUERIES[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert {"stored_rows", "model_rows"} <= set(got.columns) and set(columns) == set(got.columns)
    assert as_set(got.columns, got.collect()) == as_set(columns, cursor.fetchall())

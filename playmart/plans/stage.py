"""Staged tables: typed projections of the stored ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.keys import row_hash
from playmart.functions.scoring import scaled_ms
from playmart.functions.times import LOCAL_ZONE, local_time
from playmart.schemas import ALBUMS, AREA_HIERARCHY, ARTIST_INFO

MINUTE_MS = 60_000
# row hashes that come several times, up to which they are broadcast
FEW_REPEATS = 1_000_000
PLAY_COLUMNS = (
    "user_id", "track_id", "track_uri", "track_isrc", "track_name", "album_id", "album_uri",
    "album", "artist_id", "artist_mbid", "artist", "duration_ms", "played_at", "popularity",
    "request_cursor", "play_source",
)


def stg_cities(cities: DataFrame) -> DataFrame:
    return cities.select(
        "city_name", "country_code", "params",
        F.nullif(F.col("state_code"), F.lit("")).alias("state_code"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("long").try_cast("double").alias("longitude"),
    )


def stg_area_hierarchy(areas: DataFrame) -> DataFrame:
    return areas.select(*AREA_HIERARCHY)


def stg_artist_info(info: DataFrame) -> DataFrame:
    return info.select(*ARTIST_INFO)


def stg_albums(albums: DataFrame) -> DataFrame:
    return albums.select(*ALBUMS)


def stg_artist_genre(artist_genre: DataFrame) -> DataFrame:
    return artist_genre.where(F.col("artist_id").isNotNull()).select(
        "artist_id", "artist_name", "genre")


def stg_artists(artists: DataFrame) -> DataFrame:
    return artists.select("artist_id", "artist_name", "artist_mbid", "artist_popularity")


def stg_tracks_played(plays: DataFrame, zone: str = LOCAL_ZONE,
                      precision: str = "float") -> DataFrame:
    """Distinct plays with rounded minutes and local time.

    Only stored columns take part in the distinct; the computed ones follow from them. Whole plays
    rarely repeat within a task, where an aggregate would hold, and spill, all of them to combine
    none: rows are dealt out first, and each task makes its own distinct.
    """
    return _timed(_dealt_out(plays.select(*PLAY_COLUMNS)), zone, precision)


def stored_tracks_played(plays: DataFrame, zone: str = LOCAL_ZONE, precision: str = "float",
                         few: int = FEW_REPEATS) -> DataFrame:
    """The rows of ``stg_tracks_played`` where the plays are a stored table, which may be read
    several times: a hash of 8 bytes for each play is shuffled instead of the play.

    A row whose hash comes once has no copy and stays where it is. Rows whose hash comes again are
    compared whole, so rows that only share a hash all stay. Beyond ``few`` such hashes the plays
    are dealt out as they are.
    """
    rows = plays.select(*PLAY_COLUMNS)
    mark = row_hash(rows.columns).alias("_hash")
    repeated = rows.select(mark).repartition("_hash").groupBy("_hash").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("_hash").checkpoint()
    count = repeated.count()
    if count > few:
        rows = _dealt_out(rows)
    elif count:
        marked, known = rows.select("*", mark), F.broadcast(repeated)
        copies = marked.join(known, "_hash", "left_semi").select(*PLAY_COLUMNS).distinct()
        rows = marked.join(known, "_hash", "left_anti").select(*PLAY_COLUMNS).unionAll(copies)
    return _timed(rows, zone, precision)


def _dealt_out(rows: DataFrame) -> DataFrame:
    return rows.repartition(*rows.columns).distinct()


def _timed(rows: DataFrame, zone: str, precision: str) -> DataFrame:
    return rows.withColumns({
        "duration_mins": scaled_ms(F.col("duration_ms"), MINUTE_MS, 0, precision),
        "played_at_local": local_time("played_at", zone),
    })

"""Entities in the plays or areas that still lack metadata.

Plays are reduced to entity grain before any join, so the anti joins never see a hot key's plays.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.operators.sinks import upsert
from playmart.operators.skew import row_number_in_slices
from playmart.schemas import MERGE_KEYS

CATALOG_HOURS = 48  # fixed value: plays this recent are looked up in the catalog
UNKNOWN_CONTINENT = "Unknown"
DEFAULT_REASON = "Unknown failure"


def _page(df: DataFrame, limit: int | None, offset: int) -> DataFrame:
    """LIMIT/OFFSET, which only applies when a limit is given."""
    if not limit:
        return df
    return df.offset(offset).limit(limit) if offset else df.limit(limit)


def _without(df: DataFrame, known: DataFrame | None, key: str, known_key: str | None = None):
    if known is None:
        return df
    ids = known.select(F.col(known_key or key).alias(key))
    return df.join(ids, key, "left_anti").select(*df.columns)


def missing_artists(plays: DataFrame, artists: DataFrame | None, limit: int | None = None,
                    offset: int = 0) -> DataFrame:
    pairs = plays.where(F.col("artist_id").isNotNull()).select("artist_id", "artist").distinct()
    ordered = _without(pairs, artists, "artist_id").orderBy(
        F.asc_nulls_last("artist"), "artist_id")
    return _page(ordered, limit, offset)


def missing_albums(plays: DataFrame, albums: DataFrame | None, limit: int | None = None,
                   offset: int = 0) -> DataFrame:
    counts = plays.where(F.col("album_id").isNotNull()).groupBy("album_id").agg(
        F.count(F.lit(1)).alias("play_count"))
    ordered = _without(counts, albums, "album_id").orderBy(F.desc("play_count"), "album_id")
    return _page(ordered, limit, offset)


def _recent(plays: DataFrame, now: datetime | str, hours: int) -> DataFrame:
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return plays.where((F.col("played_at") >= since) & F.col("track_isrc").isNotNull())


def missing_catalog_artists(plays: DataFrame, catalog: DataFrame | None, now: datetime | str,
                            hours: int = CATALOG_HOURS, limit: int | None = None,
                            offset: int = 0) -> DataFrame:
    """Recently played artists with an ISRC that the catalog lacks; the lowest ISRC is kept."""
    found = (
        _recent(plays, now, hours).where(F.col("artist_id").isNotNull())
        .groupBy("artist_id", "artist").agg(F.min("track_isrc").alias("track_isrc"))
    )
    ordered = _without(found, catalog, "artist_id", "spotify_id").orderBy(
        F.asc_nulls_last("artist"), "artist_id")
    return _page(ordered, limit, offset)


def missing_catalog_artists_with_popularity(
    plays: DataFrame, catalog: DataFrame | None, now: datetime | str, hours: int = CATALOG_HOURS
) -> DataFrame:
    """As above with the highest popularity; artists without an id stay in."""
    found = _recent(plays, now, hours).groupBy("artist_id", "artist").agg(
        F.min("track_isrc").alias("track_isrc"), F.max("popularity").alias("max_popularity"))
    return _without(found, catalog, "artist_id", "spotify_id").orderBy(
        F.asc_nulls_last("artist"), F.asc_nulls_last("artist_id"))


def cities_needing_coordinates(areas: DataFrame, cities: DataFrame | None,
                               limit: int | None = None, offset: int = 0) -> DataFrame:
    wanted = areas.where(F.col("params") != "").select(
        "params", "city_name", "country_code", "country_name").distinct()
    ordered = _without(wanted, cities, "params").orderBy(
        F.asc_nulls_last("city_name"), "params", F.asc_nulls_last("country_code"),
        F.asc_nulls_last("country_name"))
    return _page(ordered, limit, offset)


def missing_count(entity_type: str, *, plays: DataFrame | None = None,
                  known: DataFrame | None = None, areas: DataFrame | None = None,
                  now: datetime | str | None = None) -> DataFrame:
    """One row, ``count``: distinct ids that ``known`` lacks."""
    if entity_type == "artists":
        ids, key, known_key = plays, "artist_id", "artist_id"
    elif entity_type == "albums":
        ids, key, known_key = plays, "album_id", "album_id"
    elif entity_type == "mbz_artists":
        ids, key, known_key = _recent(plays, now, CATALOG_HOURS), "artist_id", "spotify_id"
    elif entity_type == "cities":
        ids, key, known_key = areas.where(F.col("params") != ""), "params", "params"
    else:
        raise ValueError(f"Unknown entity_type: {entity_type}")
    distinct = ids.where(F.col(key).isNotNull()).select(key).distinct()
    return _without(distinct, known, key, known_key).agg(F.count(F.lit(1)).alias("count"))


def check_exists(ids: DataFrame, table: DataFrame, key: str = "artist_id") -> DataFrame:
    """Each id with whether the table holds it."""
    known = table.where(F.col(key).isNotNull()).select(key).distinct().withColumn(
        "_known", F.lit(True))
    return ids.select(key).join(known, key, "left").select(
        key, F.coalesce("_known", F.lit(False)).alias("exists"))


def areas_without_continent(areas: DataFrame) -> DataFrame:
    continent = F.col("continent")
    return areas.where(continent.isNull() | continent.isin(UNKNOWN_CONTINENT, ""))


def areas_needing_coordinates(areas: DataFrame, cities: DataFrame | None) -> DataFrame:
    return _without(areas.where(F.col("params").isNotNull()), cities, "params")


def _country() -> Column:
    return F.coalesce("country_name", "island_name")


def countries_needing_enrichment(areas: DataFrame) -> DataFrame:
    todo = areas.where(_country().isNotNull())
    if "continent" in areas.columns:
        todo = todo.where(
            F.col("continent").isNull() | (F.col("continent") == UNKNOWN_CONTINENT))
    return todo.select(_country().alias("country_name")).distinct()


def area_ids_to_process(artist_info: DataFrame, areas: DataFrame | None) -> DataFrame:
    """Area ids that artists refer to and the hierarchy lacks, sorted."""
    columns = [c for c in ("area_id", "begin_area_id", "end_area_id") if c in artist_info.columns]
    ids = (
        artist_info.select(F.explode(F.array(*columns)).alias("area_id"))
        .where(F.col("area_id").isNotNull()).distinct()
    )
    return _without(ids, areas, "area_id").orderBy("area_id")


def assign_batches(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """Adds batch_index (from 0), batch_offset and batch_size; the last batch may be short.

    Numbering runs on a snapshot, so writes between batches cannot shift later ones.
    """
    numbered = row_number_in_slices(df, [], order, "_row")
    index = F.floor((F.col("_row") - 1) / F.lit(size)).cast("bigint")
    total = numbered.agg(F.count(F.lit(1))).scalar()
    return (
        numbered.withColumn("batch_index", index)
        .withColumn("batch_offset", F.col("batch_index") * size)
        .withColumn("_total", total)
        .withColumn("batch_size", F.least(F.lit(size).cast("bigint"),
                                          F.col("_total") - F.col("batch_offset")))
        .drop("_row", "_total")
    )


def track_failures(failed: DataFrame, now: str, known: DataFrame | None = None) -> DataFrame:
    """Failed look-ups in the stored form, merged over those already known."""
    def text(*names: str) -> Column:
        present = [F.nullif(F.col(n), F.lit("")) for n in names if n in failed.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    new = failed.select(
        F.col("artist_id"), F.col("artist"),
        text("track_isrc", "isrc").alias("track_isrc"),
        (F.coalesce("reason", F.lit(DEFAULT_REASON)) if "reason" in failed.columns
         else F.lit(DEFAULT_REASON)).alias("reason"),
        F.lit(now).alias("failed_at"),
    )
    return new if known is None else upsert(known, new, MERGE_KEYS["mbz_artist_not_found"])

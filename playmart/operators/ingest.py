"""Service payloads to flat plays, cursors and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators.sinks import harmonize_schemas

# fixed values: the client whose listens are kept, and the two play sources
LISTEN_CLIENT = "navidrome"
DEFAULT_SOURCE = "spotify"
LISTEN_SOURCE = "navidrome"


def _null(name: str):
    return F.lit(None).cast("string").alias(name)


def flatten_recently_played(
    payloads: DataFrame, user_id: str, request_after: str | None = None
) -> DataFrame:
    """One raw play per item that has a track (not NULL, not ``{}``); first artist only."""
    item = payloads.select(F.explode("items").alias("i")).select("i.*")
    artist = F.try_element_at("track.artists", F.lit(1))
    empty = F.from_json(F.lit("{}"), item.schema["track"].dataType)
    return item.where(F.col("track").isNotNull() & ~F.col("track").eqNullSafe(empty)).select(
        F.lit(user_id).alias("user_id"),
        F.col("track.id").alias("track_id"),
        F.col("track.uri").alias("uri"),
        F.col("track.external_ids.isrc").alias("track_isrc"),
        F.col("track.name").alias("track_name"),
        F.col("track.album.id").alias("album_id"),
        F.col("track.album.uri").alias("album_uri"),
        F.col("track.album.name").alias("album"),
        artist["id"].alias("artist_id"),
        _null("artist_mbid"),
        artist["name"].alias("artist"),
        F.col("track.duration_ms").alias("duration_ms"),
        F.col("played_at"),
        F.coalesce("track.popularity", F.lit(0.0)).alias("popularity"),
        F.lit(request_after).cast("string").alias("request_after"),
        F.coalesce("context.uri", F.lit(DEFAULT_SOURCE)).alias("play_source"),
    )


def flatten_listens(payloads: DataFrame) -> DataFrame:
    """One raw play per listen of the accepted client (or of no named client) with a time."""
    listen = payloads.select(F.explode("payload.listens").alias("l")).select("l.*")
    meta = F.col("track_metadata")
    client = F.coalesce(meta["additional_info"]["submission_client"], F.lit(""))
    kept = listen.where(
        ((client == "") | F.lower(client).startswith(LISTEN_CLIENT))
        & (F.coalesce("listened_at", F.lit(0)) != 0)
    )
    return kept.select(
        F.col("user_name").alias("user_id"),
        _null("track_id"), _null("uri"), _null("track_isrc"),
        meta["track_name"].alias("track_name"),
        _null("album_id"), _null("album_uri"),
        meta["release_name"].alias("album"),
        _null("artist_id"),
        F.try_element_at(meta["mbid_mapping"]["artist_mbids"], F.lit(1)).alias("artist_mbid"),
        meta["artist_name"].alias("artist"),
        meta["additional_info"]["duration_ms"].alias("duration_ms"),
        F.date_format(F.timestamp_seconds("listened_at"), "yyyy-MM-dd'T'HH:mm:ssxxx")
        .alias("played_at"),
        F.lit(None).cast("double").alias("popularity"),
        (F.col("listened_at") * 1000).cast("string").alias("request_after"),
        F.lit(LISTEN_SOURCE).alias("play_source"),
    )


def flatten_albums(albums: DataFrame, now=None) -> DataFrame:
    artist = F.try_element_at("artists", F.lit(1))
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return albums.select(
        "album_type",
        artist["id"].alias("artist_id"),
        artist["name"].alias("artist_name"),
        artist["type"].alias("artist_type"),
        F.coalesce("genres", F.array().cast("array<string>")).alias("genres"),
        F.col("id").alias("album_id"),
        "label",
        F.col("name").alias("album_name"),
        "popularity", "release_date", "release_date_precision", "total_tracks",
        stamp.alias("last_modified"),
    )


def conform_artists(artists: DataFrame) -> DataFrame:
    return artists.select(
        F.col("id").alias("artist_id"),
        F.col("name").alias("artist_name"),
        _null("artist_mbid"),
        F.col("popularity").cast("float").alias("artist_popularity"),
    )


def high_water_mark(plays: DataFrame, col: str = "played_at", unit: str = "ms") -> DataFrame:
    """One row, ``cursor``: the newest time in ms plus 1, or in whole seconds."""
    newest = F.max(col)
    cursor = F.unix_millis(newest) + 1 if unit == "ms" else F.unix_seconds(newest)
    return plays.agg(cursor.alias("cursor"))


def newer_than(plays: DataFrame, cursor: int | None, col: str = "played_at",
               unit: str = "ms") -> DataFrame:
    """Rows past the cursor; no cursor keeps all."""
    if cursor is None:
        return plays
    if unit == "ms":
        return plays.where(F.col(col) > F.timestamp_millis(F.lit(cursor)))
    return plays.where(F.col(col) >= F.timestamp_seconds(F.lit(cursor + 1)))


def append_plays(history: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
    """History plus new plays by column name; repeats stay (staging removes them)."""
    parts = [df for df in (history, new) if df is not None]
    if not parts:
        return None
    out, *rest = harmonize_schemas(parts)
    for df in rest:
        out = out.unionByName(df)
    return out

"""Models between staging and the star schema.

Where the natural form is ``row_number() = 1`` the plan aggregates ``max(struct(...))`` instead:
it combines before the shuffle, so a key with very many rows costs one row per input task. Ties
go to the larger remaining columns, which makes every result reproducible.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.scoring import NO_GENRE, scaled_ms
from playmart.functions.text import MARK, first_credit, mark_credits
from playmart.functions.times import seconds_of_day
from playmart.operators.sinks import settled
from playmart.operators.skew import join_null_safe, left_join_dim, row_number_in_slices

SPINE_START = date(2005, 2, 1)
SPINE_DAYS_AHEAD = 30
GENRE_GROUPS = 5
DAY_SECONDS = 86_400
LOCATION = (
    "continent_code", "continent", "country_code", "country", "state_province_code",
    "state_province", "county", "city", "district", "lat", "longitude",
)
ARTIST_COLUMNS = ("artist_id", "artist_mbid", "artist_name", "artist_popularity",
                  "primary_genre", *LOCATION)


def albums(plays: DataFrame, album_info: DataFrame) -> DataFrame:
    """One row per artist and album name with the attributes of the highest album id."""
    played = plays.groupBy("artist", "album").agg(
        F.max("artist_id").alias("artist_id"), F.max("album_id").alias("album_id"))
    info = album_info.groupBy(
        "album_id", "label", "total_tracks", "release_date", "release_date_precision"
    ).agg(F.max("popularity").alias("album_popularity"))
    # year and month precision are padded to the first day
    released = F.left(F.concat("release_date", F.lit("-01-01")), F.lit(10)).cast("date")
    return (
        played.join(info, "album_id", "left")
        .withColumn("release_date", released)
        .withColumn("release_year", F.year("release_date").cast("bigint"))
        .select(
            "artist_id", "album_id", "artist", "album",
            F.concat("artist", F.lit(" - "), F.coalesce("album", F.lit(""))).alias("artist_album"),
            "label", "total_tracks", "album_popularity", "release_date", "release_year",
            (F.floor(F.col("release_year") / 10) * 10).cast("int").alias("release_decade"),
            "release_date_precision",
        )
    )


def area_hierarchy(areas: DataFrame) -> DataFrame:
    def either(a: str, b: str) -> Column:
        return F.coalesce(a, b).alias(a)

    return areas.select(
        "area_id", "area_type", "area_name", "area_sort_name", "continent_code", "continent",
        either("country_id", "island_id"), "country_code", either("country_name", "island_name"),
        F.col("subdivision_id").alias("state_id"), F.col("subdivision_name").alias("state_name"),
        "county_id", "county_name",
        either("city_id", "municipality_id"), either("city_name", "municipality_name"),
        "district_id", "district_name", "params",
    )


def _with_genre_total(artist_genre: DataFrame) -> DataFrame:
    totals = artist_genre.groupBy("genre").agg(F.count(F.lit(1)).alias("genre_total"))
    return join_null_safe(artist_genre, totals, ["genre"])


def artist_genre_rank(artist_genre: DataFrame) -> DataFrame:
    """Rank of each artist's genres by how many artist rows the genre has; ties by genre name."""
    return row_number_in_slices(
        _with_genre_total(artist_genre), ["artist_id"],
        [F.desc("genre_total"), F.asc_nulls_last("genre"), F.asc_nulls_last("artist_name")],
        "artist_genre_rank")


def artist_top_genre(artist_genre: DataFrame) -> DataFrame:
    """The rank 1 rows of ``artist_genre_rank`` as an aggregate."""
    best = _with_genre_total(artist_genre).groupBy("artist_id").agg(
        F.min(F.struct(
            (-F.col("genre_total")).alias("order"),
            F.col("genre").isNull().alias("no_genre"), "genre",
            F.col("artist_name").isNull().alias("no_name"), "artist_name",
        )).alias("b"))
    return best.select("artist_id", "b.artist_name",
                       F.coalesce("b.genre", F.lit(NO_GENRE)).alias("primary_genre"))


def artist_location(artist_info: DataFrame) -> DataFrame:
    return artist_info.select(
        F.coalesce("area_id", "end_area_id", "begin_area_id").alias("area_id"),
        F.col("spotify_id").alias("artist_id"), F.col("id").alias("artist_mbid"),
        F.col("name").alias("artist_name"),
    )


def artist_location_hierarchy(location: DataFrame, areas: DataFrame,
                              cities: DataFrame) -> DataFrame:
    """Located artists. Areas meet cities first, so one area row serves many artists."""
    coordinates = cities.select("params", "state_code", "lat", "longitude")
    located = areas.join(coordinates, "params", "left").select(
        "area_id", "continent_code", "continent", "country_code",
        F.col("country_name").alias("country"), F.col("state_code").alias("state_province_code"),
        F.col("state_name").alias("state_province"), F.col("county_name").alias("county"),
        F.col("city_name").alias("city"), F.col("district_name").alias("district"),
        "lat", "longitude",
    )
    return location.join(located, "area_id").select(
        "artist_id", "artist_mbid", "artist_name", *LOCATION)


def artists_distinct(artists: DataFrame) -> DataFrame:
    return artists.groupBy("artist_id", "artist_name").agg(
        F.max("artist_mbid").alias("artist_mbid"),
        F.max("artist_popularity").alias("artist_popularity"))


def artists(distinct: DataFrame, top_genre: DataFrame, location: DataFrame,
            unmatched: DataFrame) -> DataFrame:
    """One row per known artist id and per unmatched artist name.

    Each side is first reduced to its best row; the best location of an artist is the one with
    the highest country code, so it can be picked before the join.
    """
    def best_location(key: str) -> DataFrame:
        order = ("country_code", *[c for c in LOCATION if c != "country_code"])
        return location.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.max(F.struct(*order)).alias("place"))

    best = distinct.groupBy("artist_id").agg(
        F.max(F.struct("artist_popularity", "artist_name", "artist_mbid")).alias("a"))
    known = (
        best.join(top_genre.select("artist_id", "primary_genre"), "artist_id", "left")
        .join(best_location("artist_id"), "artist_id", "left")
        .select("artist_id", "a.artist_mbid", "a.artist_name", "a.artist_popularity",
                "primary_genre", *[F.col(f"place.{c}").alias(c) for c in LOCATION])
    )
    by_name = (
        unmatched.join(best_location("artist_mbid"), "artist_mbid", "left")
        .select(F.lit(None).cast("string").alias("artist_id"), "artist_mbid", "artist_name",
                F.lit(None).cast("float").alias("artist_popularity"),
                F.lit(None).cast("string").alias("primary_genre"),
                *[F.col(f"place.{c}").alias(c) for c in LOCATION])
    )
    return known.unionByName(by_name)


def dates(spark: SparkSession, start: date = SPINE_START, end: date | None = None) -> DataFrame:
    """One row per day."""
    end = end or date.today() + timedelta(days=SPINE_DAYS_AHEAD)
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_sid"))


def times(spark: SparkSession) -> DataFrame:
    """One row per second of the day."""
    return spark.range(DAY_SECONDS).select(F.col("id").cast("int").alias("time_sid"))


def genre_stats(plays: DataFrame, artists: DataFrame, artist_genre: DataFrame) -> DataFrame:
    """Totals, most played and most popular artist per genre.

    Plays shrink to artist grain before both joins. An artist listed several times with one
    popularity counts as often, as in a join of the plays themselves.
    """
    per_artist = plays.groupBy("artist_id", "artist").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("duration_ms").alias("ms"))
    popularity = artists.where(F.col("artist_id").isNotNull()).groupBy(
        "artist_id", "artist_popularity").agg(F.count(F.lit(1)).alias("listed"))
    listed = F.coalesce("listed", F.lit(1))
    scored = left_join_dim(per_artist, popularity, "artist_id", ["artist_popularity", "listed"])
    scored = scored.select("artist_id", "artist", "artist_popularity",
                           (F.col("plays") * listed).alias("plays"),
                           (F.col("ms") * listed).alias("ms"))
    tagged = left_join_dim(scored, artist_genre, "artist_id", ["genre"])
    return tagged.groupBy("genre").agg(
        F.max(F.struct("plays", "artist"))["artist"].alias("top_artist_in_genre"),
        F.max(F.struct("artist_popularity", "artist"))["artist"]
        .alias("most_popular_artist_in_genre"),
        F.sum("plays").alias("total_tracks_played_in_genre"),
        F.sum("ms").alias("total_ms_played_in_genre"),
    ).withColumn("genre", F.coalesce("genre", F.lit(NO_GENRE)))


def played(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """Plays with the artist's popularity and date and time keys.

    The artist row kept per id is the one of highest popularity, so the highest popularity per id
    is all a play needs of it. It is settled first, so that plays are not shuffled for few artists.
    """
    popularity = settled(artists.groupBy("artist_id").agg(
        F.max("artist_popularity").alias("artist_popularity")), "popularity")
    return left_join_dim(plays, popularity, "artist_id", ["artist_popularity"]).select(
        "track_id", "track_name", "artist", "artist_id", "album_id", "album", "request_cursor",
        "played_at", "played_at_local",
        F.to_date("played_at_local").alias("date_sid"),
        seconds_of_day("played_at_local").alias("time_sid"),
        "popularity", "artist_popularity", "duration_ms", "duration_mins",
        F.lit(1).alias("tracks_played"),
    )


def ranked_genre(stats: DataFrame, groups: int = GENRE_GROUPS,
                 groups_mode: str = "exact") -> DataFrame:
    """Ranks by plays and by time and the group each rank falls into.

    ``exact`` divides without rounding, so groups are fractions; ``floor`` gives whole groups.
    """
    if groups_mode not in ("exact", "floor"):
        raise ValueError(f"Unknown groups_mode: {groups_mode}")
    by_plays = row_number_in_slices(
        stats, [], [F.desc("total_tracks_played_in_genre"), F.asc("genre")],
        "rank_by_tracks_played")
    by_time = row_number_in_slices(
        by_plays, [], [F.desc_nulls_last("total_ms_played_in_genre"), F.asc("genre")],
        "rank_by_time_played")
    total = by_time.agg(F.count(F.lit(1))).scalar()

    def group_of(rank: str) -> Column:
        # the division by the group size is written as in `rank / (total / groups)`
        per_group = F.col("_total") / F.lit(groups)
        if groups_mode == "floor":
            # rank - 1 whole groups, in integers: exact for every total
            whole = F.floor((F.col(rank) - 1) * groups / F.col("_total")) + 1
            return F.least(F.lit(groups).cast("bigint"), whole).cast("double")
        return F.when(F.col(rank) == F.col("_total"), F.lit(float(groups))).otherwise(
            F.try_divide(F.col(rank), per_group) + 1)

    return by_time.withColumn("_total", total).select(
        "genre", "top_artist_in_genre", "most_popular_artist_in_genre",
        "rank_by_tracks_played", group_of("rank_by_tracks_played").alias("tracks_grouping"),
        "total_tracks_played_in_genre",
        "rank_by_time_played", group_of("rank_by_time_played").alias("time_grouping"),
        "total_ms_played_in_genre",
    )


def tracks(raw_plays: DataFrame, precision: str = "float") -> DataFrame:
    """One row per track name and artist from the stored plays.

    ``track_duration`` is the duration as a clock time of day, in ms (it wraps at 24 hours).
    """
    ms = F.col("track_duration_ms")
    return raw_plays.groupBy("track_name", "artist").agg(
        F.max("track_id").alias("track_id"), F.max("track_isrc").alias("track_isrc"),
        F.max("popularity").alias("track_popularity"),
        F.max("duration_ms").alias("track_duration_ms"),
    ).select(
        "track_id", "track_isrc", "track_name", "artist", "track_popularity",
        "track_duration_ms",
        scaled_ms(ms, 1000, 0, precision).alias("track_duration_sec"),
        scaled_ms(ms, 60_000, 0, precision).alias("track_duration_min"),
        (ms % (DAY_SECONDS * 1000)).alias("track_duration"),
    )


def unmatched_artists_prep(raw_plays: DataFrame) -> DataFrame:
    """Played names without an artist id and the name to look for: the first credited artist.

    Names without a delimiter also appear under their unchanged name.
    """
    names = raw_plays.where(F.col("artist_id").isNull()).groupBy(
        F.col("artist").alias("artist_name"), "artist_mbid"
    ).agg(F.count(F.lit(1)).alias("count_played"))
    name = F.col("artist_name")
    credit = F.when(first_credit(name) != "", first_credit(name))
    whole = F.when(~mark_credits(name).contains(MARK), name)
    # both candidates of a row in one pass; equal ones collapse, NULLs (no candidate) go
    found = F.array_compact(F.array_distinct(F.array(credit, whole)))
    return names.select("artist_name", "artist_mbid",
                        F.explode(found).alias("potential_match"), "count_played")


def unmatched_artists(prep: DataFrame) -> DataFrame:
    """The most played row per name."""
    best = prep.groupBy("artist_name").agg(
        F.max(F.struct("count_played", "artist_mbid", "potential_match")).alias("b"))
    return best.select("artist_name", "b.artist_mbid", "b.potential_match", "b.count_played")

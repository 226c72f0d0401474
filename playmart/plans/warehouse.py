"""Star schema: dimensions, facts, and the assembly of all models."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions import scoring as S
from playmart.functions.keys import row_hash, surrogate_key, timestamp_part
from playmart.functions.times import LOCAL_ZONE, clock_text
from playmart.operators.sinks import is_among, replace_partitions, settled, write_overwrite
from playmart.operators.skew import left_join_dim
from playmart.plans import intermediate as I
from playmart.plans import stage
from playmart.schemas import REQUIRED_TABLES, SEEDS
from playmart.sources.plays import read_recently_played_csv
from playmart.sources.tables import found, read_seed, read_table

NO_DATE = "1900-01-01"
FACT_PARTITION = "play_year"
# fixed values: labels of the outer genre groups
FIRST_GROUP, LAST_GROUP = "Group 1 (Most Played Genres)", "Group 5 (Least Played Genres)"
MINUTE_MS = 60_000


def dim_album(albums: DataFrame) -> DataFrame:
    return albums.select(
        surrogate_key("album_id", "album", "artist").alias("album_sid"),
        F.col("album").alias("album_name"), "artist_album", "label", "total_tracks",
        "album_popularity", "release_date", "release_year", "release_decade",
        "release_date_precision",
    )


def dim_artist(artists: DataFrame, masks: DataFrame) -> DataFrame:
    """The key uses the catalog name, the displayed name may be masked."""
    popularity = F.col("artist_popularity")
    classes = (S.ARTIST_POPULARITY, S.ARTIST_POPULARITY_MISSING)
    masked = left_join_dim(artists, masks, "artist_id", ["mask_name"])
    return masked.select(
        surrogate_key("artist_id", "artist_name").alias("artist_sid"),
        F.coalesce("mask_name", "artist_name").alias("artist_name"),
        "artist_popularity",
        S.popularity_label(popularity, *classes).alias("artist_popularity_group"),
        S.popularity_sort(popularity, *classes).alias("artist_popularity_sort"),
        F.when(popularity.isNull(), S.ARTIST_POPULARITY_MISSING[0])
        .when(popularity >= S.POPULAR_FROM, "Popular").otherwise("Not Popular")
        .alias("is_popular"),
        F.coalesce("primary_genre", F.lit(S.NO_GENRE)).alias("primary_genre"),
        *I.LOCATION,
    )


def dim_artist_genre(ranked: DataFrame, precision: str = "float") -> DataFrame:
    def label(group: str):
        value = F.col(group)
        return (
            F.when(value == 1, FIRST_GROUP).when(value == I.GENRE_GROUPS, LAST_GROUP)
            .otherwise(F.concat_ws("", F.lit("Group "), value.cast("string")))
        )

    minutes = S.scaled_ms(F.coalesce("total_ms_played_in_genre", F.lit(0)),
                          MINUTE_MS, 2, precision)
    return ranked.select(
        surrogate_key("genre", F.lit("")).alias("genre_sid"),
        "genre", "top_artist_in_genre", "most_popular_artist_in_genre",
        "rank_by_tracks_played", "tracks_grouping",
        label("tracks_grouping").alias("group_by_tracks_played"),
        "total_tracks_played_in_genre", "rank_by_time_played", "time_grouping",
        label("time_grouping").alias("group_by_time_played"),
        minutes.alias("total_minutes_played_in_genre"),
    )


def dim_date(dates: DataFrame) -> DataFrame:
    d = F.col("date_sid")
    return dates.select(
        F.coalesce(d, F.lit(NO_DATE).cast("date")).alias("date_sid"),
        d.alias("date"),
        (F.dayofweek(d) - 1).cast("bigint").alias("day_of_week"),  # Sunday is 0
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        F.year(d).cast("bigint").alias("year_num"),
        F.year(d).cast("string").alias("year_text"),
        F.month(d).cast("bigint").alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.trunc(d, "year").alias("year_start_date"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("year_end_date"),
    )


def dim_time(times: DataFrame) -> DataFrame:
    """Seconds of the day; ``time`` is the clock text of ``time_sid``."""
    second = F.col("time_sid")
    hour = F.floor(second / 3600)
    return times.distinct().select(
        "time_sid",
        clock_text(second).alias("time"),
        hour.alias("hour_of_day"),
        F.floor(second % 3600 / 60).alias("minute_of_hour"),
        (second % 60).cast("bigint").alias("second_of_hour"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        S.part_of_day(hour).alias("time_of_day"),
        S.part_of_day_sort(hour).alias("time_of_day_sort"),
    )


def dim_track(tracks: DataFrame) -> DataFrame:
    popularity, seconds = F.col("track_popularity"), F.col("track_duration_sec")
    classes = (S.TRACK_POPULARITY, S.TRACK_POPULARITY_MISSING)
    return tracks.select(
        surrogate_key("track_id", "track_name", "artist").alias("track_sid"),
        "track_name",
        F.concat("artist", F.lit(" - "), "track_name").alias("artist_track"),
        "track_popularity",
        S.popularity_label(popularity, *classes).alias("track_popularity_group"),
        S.popularity_sort(popularity, *classes).alias("track_popularity_sort"),
        # unlike artists, a track without data counts as not popular
        F.when(popularity >= S.POPULAR_FROM, "Popular").otherwise("Not Popular")
        .alias("is_popular"),
        F.col("track_duration_sec").alias("track_seconds"),
        F.col("track_duration_min").alias("track_minutes"),
        "track_duration",
        S.length_label(seconds).alias("track_length"),
        S.length_sort(seconds).alias("track_length_sort"),
    )


def _play_keys() -> list:
    return [
        surrogate_key("track_id", "track_name", "artist").alias("track_sid"),
        surrogate_key("artist_id", "artist").alias("artist_sid"),
        surrogate_key("album_id", "album", "artist").alias("album_sid"),
    ]


def keyed_plays(played: DataFrame, *more: str) -> DataFrame:
    """Plays with the keys of both facts. Keys are hashes, which no codec makes smaller, so they are
    made of the played names last, behind every shuffle; ``more`` names further columns."""
    uid = surrogate_key("track_id", "track_name", "artist", timestamp_part("played_at"))
    return played.select(
        "artist", uid.alias("track_played_uid"), *_play_keys(), "request_cursor",
        "date_sid", "time_sid", "popularity", "artist_popularity", "duration_ms", "duration_mins",
        "tracks_played", *more,
    )


def fact_track_played(played: DataFrame, *more: str) -> DataFrame:
    return keyed_plays(played, *more).select(
        "track_sid", "artist_sid", "album_sid", F.col("artist").alias("artist_name"), "request_cursor", "date_sid",
        "time_sid", "popularity", "artist_popularity", "duration_ms", "duration_mins",
        "tracks_played", *more,
    )


def tagged_plays(played: DataFrame, artist_genre: DataFrame) -> DataFrame:
    """Plays with the genre keys of their artist as one array, so a play is one row until it is
    read or written as a fact. Without genres the array has the key of a missing genre. The arrays
    are settled first, so that plays are not shuffled for few artists."""
    genre_sids = settled(artist_genre.groupBy("artist_id").agg(F.array_sort(F.collect_list(
        surrogate_key("genre", F.lit("")))).alias("genre_sids")), "genre-sids")
    tagged = left_join_dim(played, genre_sids, "artist_id", ["genre_sids"])
    missing = F.array(surrogate_key(F.lit(None).cast("string"), F.lit("")))
    return tagged.withColumn("genre_sids", F.coalesce("genre_sids", missing))


def genre_rows(tagged: DataFrame, *more: str) -> DataFrame:
    """One row per play and genre, in the order of the plays; ``more`` names further columns."""
    # keys in a step of their own: once per play, after the join and before genres fan out
    keyed = keyed_plays(tagged, "genre_sids", *more)
    return keyed.select(
        "track_played_uid", "track_sid", "artist_sid", "album_sid",
        F.explode("genre_sids").alias("genre_sid"),
        "date_sid", "time_sid", "popularity", "duration_ms", "duration_mins", *more,
    )


def fact_artist_genre(played: DataFrame, artist_genre: DataFrame) -> DataFrame:
    """One row per play and genre of its artist; a play without genres keeps one row.

    The genre key is that of the raw genre, so plays without a genre match no dimension row.
    """
    return genre_rows(tagged_plays(played, artist_genre))


def _row_hash(columns: list[str]) -> Column:
    return row_hash(columns).cast("decimal(20,0)")


def fact_days(plays: DataFrame, artists: DataFrame, artist_genre: DataFrame) -> DataFrame:
    """Manifest of what the facts are made of: per local day the plays, the sum of their hashes,
    and the sum over the plays of the hashes of their artist's popularity and genres.

    Sums do not depend on row order. A day's facts can differ only if its row here does. Artists
    are settled first, and plays shrink to days on the map side.
    """
    held = plays.select(
        F.to_date("played_at_local").alias("date_sid"), "artist_id",
        _row_hash(plays.columns).alias("h"))
    popularity = artists.groupBy("artist_id").agg(
        F.max("artist_popularity").alias("popularity")).select(
        "artist_id", F.col("popularity").cast("double").alias("popularity"),
        F.lit(None).cast("string").alias("genre"), F.lit(False).alias("tag"))
    tags = artist_genre.select(
        "artist_id", F.lit(None).cast("double").alias("popularity"), "genre",
        F.lit(True).alias("tag"))
    known = popularity.unionByName(tags)
    known = settled(known.groupBy("artist_id").agg(
        F.sum(_row_hash(known.columns)).alias("known")), "known")
    return left_join_dim(held, known, "artist_id", ["known"]).groupBy("date_sid").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("h").cast("decimal(38,0)").alias("play_hashes"),
        F.sum(_row_hash(["artist_id", "known"])).alias("artist_hashes"))


def changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """``date_sid`` of the days (NULL is one) that are in one manifest only or differ."""
    row = F.struct("plays", "play_hashes", "artist_hashes")
    both = old.unionByName(new).groupBy("date_sid").agg(
        F.count(F.lit(1)).alias("n"), F.min(row).alias("low"), F.max(row).alias("high"))
    return both.where((F.col("n") != 2) | (F.col("low") != F.col("high"))).select("date_sid")


def recently_played(snapshot: DataFrame, precision: str = "float") -> DataFrame:
    """The consolidated snapshot with minutes and a popularity text."""
    popularity = F.col("popularity")
    text = F.when(F.coalesce(popularity, F.lit(0)) == 0, "--").otherwise(
        F.concat(popularity.cast("int").cast("string"), F.lit("/100")))
    return snapshot.withColumns({
        "minutes_played": S.scaled_ms(F.col("duration_ms"), 60_000, 2, precision),
        "popularity": text,
    })


@dataclass
class Inputs:
    """Stored tables the models read, by name, and the parameters of the models.

    A table may be a DataFrame or a function that gives one; only those that a selected model
    needs are opened. The plays are read several times, so they should be files.
    """

    spark: SparkSession
    tables: dict[str, DataFrame | Callable[[], DataFrame]]
    zone: str = LOCAL_ZONE
    precision: str = "float"
    groups_mode: str = "exact"
    spine_start: date = I.SPINE_START
    spine_end: date | None = None
    built: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    lock: RLock = field(default_factory=RLock, repr=False)

    def table(self, name: str) -> DataFrame:
        with self.lock:
            found = self.tables[name]
            if callable(found):
                found = self.tables[name] = found()
        if found is None:
            raise FileNotFoundError(f"the stored table {name} is missing")
        return found


def stored_inputs(spark: SparkSession, base: str, seeds: str | None = None,
                  snapshot: str | None = None, **params) -> Inputs:
    """Inputs over what is stored below ``base``: Parquet tables, the seed CSVs (in ``seeds``,
    by default ``base/seeds``) and the consolidated CSV snapshot (``base/recently_played``).

    A missing table is an error as soon as a selected model needs it; without a mask seed no
    artist is masked.
    """
    seeds, snapshot = seeds or f"{base}/seeds", snapshot or f"{base}/recently_played"

    def masks() -> DataFrame:
        stored = found(lambda: read_seed(spark, seeds, "mask_artists"))
        if stored is None:
            stored = read_table(spark, base, "mask_artists")
        return spark.createDataFrame([], SEEDS["mask_artists"]) if stored is None else stored

    def recent() -> DataFrame | None:
        files = found(lambda: spark.read.format("binaryFile").option(
            "pathGlobFilter", "*.csv").load(snapshot).select("path"))
        if files is not None and not files.isEmpty():
            return read_recently_played_csv(spark, snapshot)
        return read_table(spark, base, "recently_played")

    tables = {n: (lambda n=n: read_table(spark, base, n)) for n in REQUIRED_TABLES}
    return Inputs(spark, {**tables, "mask_artists": masks, "recently_played": recent}, **params)


# model name -> builder; ``m`` gives other models by name
MODELS = {
    "stg_cities": lambda i, m: stage.stg_cities(i.table("cities_with_lat_long")),
    "stg_area_hierarchy": lambda i, m: stage.stg_area_hierarchy(i.table("mbz_area_hierarchy")),
    "stg_artist_info": lambda i, m: stage.stg_artist_info(i.table("mbz_artist_info")),
    "stg_albums": lambda i, m: stage.stg_albums(i.table("spotify_albums")),
    "stg_artist_genre": lambda i, m: stage.stg_artist_genre(i.table("spotify_artist_genre")),
    "stg_artists": lambda i, m: stage.stg_artists(i.table("spotify_artists")),
    "stg_tracks_played": lambda i, m: stage.stored_tracks_played(
        i.table("tracks_played"), i.zone, i.precision),
    # highest ids per name: repeats do not matter, so the stored plays do without the distinct
    "albums": lambda i, m: I.albums(i.table("tracks_played"), m("stg_albums")),
    "area_hierarchy": lambda i, m: I.area_hierarchy(m("stg_area_hierarchy")),
    "artist_genre_rank": lambda i, m: I.artist_genre_rank(m("stg_artist_genre")),
    "artist_location": lambda i, m: I.artist_location(m("stg_artist_info")),
    "artist_location_hierarchy": lambda i, m: I.artist_location_hierarchy(
        m("artist_location"), m("area_hierarchy"), m("stg_cities")),
    "artist_top_genre": lambda i, m: I.artist_top_genre(m("stg_artist_genre")),
    "artists_distinct": lambda i, m: I.artists_distinct(m("stg_artists")),
    "unmatched_artists_prep": lambda i, m: I.unmatched_artists_prep(i.table("tracks_played")),
    "unmatched_artists": lambda i, m: I.unmatched_artists(m("unmatched_artists_prep")),
    "artists": lambda i, m: I.artists(
        m("artists_distinct"), m("artist_top_genre"), m("artist_location_hierarchy"),
        m("unmatched_artists")),
    "dates": lambda i, m: I.dates(i.spark, i.spine_start, i.spine_end),
    "times": lambda i, m: I.times(i.spark),
    "genre_stats": lambda i, m: I.genre_stats(
        m("stg_tracks_played"), m("stg_artists"), m("stg_artist_genre")),
    "played": lambda i, m: I.played(m("stg_tracks_played"), m("artists_distinct")),
    "ranked_genre": lambda i, m: I.ranked_genre(m("genre_stats"), groups_mode=i.groups_mode),
    "tracks": lambda i, m: I.tracks(i.table("tracks_played"), i.precision),
    "dim_album": lambda i, m: dim_album(m("albums")),
    "dim_artist": lambda i, m: dim_artist(m("artists"), i.table("mask_artists")),
    "dim_artist_genre": lambda i, m: dim_artist_genre(m("ranked_genre"), i.precision),
    "dim_date": lambda i, m: dim_date(m("dates")),
    "dim_time": lambda i, m: dim_time(m("times")),
    "dim_track": lambda i, m: dim_track(m("tracks")),
    "fact_days": lambda i, m: fact_days(
        m("stg_tracks_played"), m("artists_distinct"), m("stg_artist_genre")),
    "fact_track_played": lambda i, m: fact_track_played(m("played")),
    "tagged_plays": lambda i, m: tagged_plays(m("played"), m("stg_artist_genre")),
    "fact_artist_genre": lambda i, m: genre_rows(m("tagged_plays")),
    "recently_played": lambda i, m: recently_played(i.table("recently_played"), i.precision),
}
# models that read the distinct plays, and with them the stored ones more than once
FROM_DISTINCT_PLAYS = {"stg_tracks_played", "dim_artist_genre", "ranked_genre", "genre_stats",
                       "played", "tagged_plays", "fact_days", "fact_track_played",
                       "fact_artist_genre"}
FACTS = ("fact_track_played", "fact_artist_genre")
WAREHOUSE = ("dim_album", "dim_artist", "dim_artist_genre", "dim_date", "dim_time", "dim_track",
             "fact_track_played", "fact_artist_genre")


def build_model(inputs: Inputs, name: str) -> DataFrame:
    """One model as a lazy DataFrame over the inputs; shared upstream models are built once."""
    with inputs.lock:
        if name not in inputs.built:
            inputs.built[name] = MODELS[name](inputs, lambda other: build_model(inputs, other))
        return inputs.built[name]


def selected_models(select: list[str] | None = None, exclude: list[str] | None = None
                    ) -> list[str]:
    names = list(WAREHOUSE) if select is None else list(select)
    unknown = [n for n in [*names, *(exclude or [])] if n not in MODELS]
    if unknown:
        raise ValueError(f"Unknown models: {', '.join(unknown)}")
    return [n for n in names if n not in (exclude or [])]


def build_warehouse(inputs: Inputs, select: list[str] | None = None,
                    exclude: list[str] | None = None) -> dict[str, DataFrame]:
    """The selected models (by default the star schema) as lazy DataFrames."""
    return {name: build_model(inputs, name) for name in selected_models(select, exclude)}


def _with_year(fact: DataFrame) -> DataFrame:
    return fact.withColumn(FACT_PARTITION, F.year("date_sid"))


def _in_files(inputs: Inputs, name: str, years: list | None = None) -> DataFrame:
    """A fact with its year (of ``years`` alone, if given), in the order of its files. Plays are put
    in order before they get their keys and fan out into genres: those rows are neither shuffled nor
    sorted again."""
    tracks = name == "fact_track_played"
    plays = _with_year(build_model(inputs, "played" if tracks else "tagged_plays"))
    if years is not None:
        plays = plays.where(is_among(FACT_PARTITION, years))
    ordered = plays.sortWithinPartitions(FACT_PARTITION, "date_sid")
    return (fact_track_played if tracks else genre_rows)(ordered, FACT_PARTITION)


def refresh_warehouse(inputs: Inputs, base: str, start: date | None = None,
                      end: date | None = None) -> list[int | None]:
    """Brings the written warehouse up to date: the facts of the years that changed are built and
    replaced, other years' files stay; the dimensions are written anew.

    Without dates the years are those of the days whose row in the stored manifest (``fact_days``)
    differs from the inputs, be it by new, changed or removed plays or by the popularity or genres
    of an artist who is played then. Without a manifest everything is written. With dates the years
    from ``start`` to ``end`` are built, whatever changed. The manifest is stored last, so a refresh
    that was cut off is done again. Returns the years.
    """
    if (start is None) != (end is None):
        raise ValueError("a refresh by dates needs both")
    # fixed before the facts are read: what changes meanwhile is found by the next refresh
    days = build_model(inputs, "fact_days").checkpoint()
    stored = read_table(inputs.spark, base, "fact_days")
    if start is not None:
        years = list(range(start.year, end.year + 1))
    elif stored is not None:
        # one value for each changed folder of the facts
        changed = _with_year(changed_days(stored, days)).select(FACT_PARTITION).distinct()
        years = sorted((r[0] for r in changed.collect()), key=lambda y: (y is None, y))
    else:
        write_warehouse(inputs, base)
        return sorted((r[0] for r in _with_year(days).select(FACT_PARTITION).distinct().collect()),
                      key=lambda y: (y is None, y))
    write_warehouse(inputs, base, exclude=list(FACTS))
    if not years:
        return years
    held = _with_year(days).where(is_among(FACT_PARTITION, years)).select(
        FACT_PARTITION).distinct().collect()
    for name in FACTS:
        # both facts have a row for every play
        replace_partitions(_in_files(inputs, name, years), base, name, FACT_PARTITION, years,
                           held=[r[0] for r in held])
    if stored is not None:
        others = _with_year(stored).where(~is_among(FACT_PARTITION, years))
        rows = _with_year(days).where(is_among(FACT_PARTITION, years))
        write_overwrite(others.unionByName(rows).drop(FACT_PARTITION), base, "fact_days")
    return years


def write_warehouse(inputs: Inputs, base: str, select: list[str] | None = None,
                    exclude: list[str] | None = None, jobs: int = 4) -> list[str]:
    """Writes the selected models to Parquet folders.

    Facts are partitioned by the year of ``date_sid``, so report date ranges prune folders, and
    sorted by it within files, so they prune row groups. They have a file for each year and task
    that reads the stored plays: plays are not shuffled on their way into the files unless many of
    them repeat or artists are too many to be broadcast. With both facts their manifest is written,
    after them.
    """
    names = selected_models(select, exclude)
    days = None
    if set(FACTS) <= set(names):
        days = build_model(inputs, "fact_days").checkpoint()

    def write(name: str) -> None:
        if name in FACTS:
            write_overwrite(_in_files(inputs, name), base, name, [FACT_PARTITION])
        else:
            write_overwrite(build_model(inputs, name), base, name)

    # independent jobs, long ones first: small models run in the gaps of the facts
    with ThreadPoolExecutor(max_workers=jobs) as pool:
        list(pool.map(write, sorted(names, key=lambda n: not n.startswith("fact_"))))
    if days is not None:
        write_overwrite(days, base, "fact_days")
    return names


def stored_warehouse(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The written star schema, for reports."""
    stored = {name: read_table(spark, base, name, merge_schema=False) for name in WAREHOUSE}
    return {name: df for name, df in stored.items() if df is not None}

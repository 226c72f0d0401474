"""Report queries over the star schema.

A report first reduces the fact to (dimension key, year or hour) counts, then joins dimensions to
those few rows: a hot artist's plays are combined before any shuffle. Where artists or genres are
selected, the fact is cut to their keys before it is grouped. Spark broadcasts a side by its own
size check. Date bounds are inclusive and are applied to the fact itself as well, so they reach its
scan. An empty or missing filter list does not filter.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.scoring import NO_GENRE, exact_minutes

# fixed values: sizes of the ranked lists, genre placeholder, order of the parts of the day
TOP_ARTISTS_24H = 15
TOP_GENRES_GEO = 20
TOP_ARTISTS_GEO = 25
TOP_GENRES = 25
TOP_ARTISTS_GENRE = 15
DAY_ORDER = ("Morning", "Afternoon", "Evening", "Night")
LAST_HOURS = 24
BUBBLE_SCALE, BUBBLE_BASE = 30, 5
MAP_LEVELS = {
    "City": ["lat", "longitude", "country", "state_province", "city"],
    "State/Province": ["country", "state_province"],
    "Country": ["country"],
    "Continent": ["continent"],
}
DRILL = ("continent", "country", "state_province", "city")

Day = date | str
Names = list[str] | None


def _in(column: str, values) -> Column:
    return F.col(column).isin(*values) if values else F.lit(True)


def _between(column: str, start: Day, end: Day) -> Column:
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def _period(fact: DataFrame, start: Day, end: Day) -> DataFrame:
    """Fact rows of the period; a stored fact is also cut to the folders of its years."""
    rows = fact.where(_between("date_sid", start, end))
    if "play_year" in fact.columns:
        years = [F.year(F.lit(day).cast("date")) for day in (start, end)]
        rows = rows.where(F.col("play_year").between(*years))
    return rows


def _counts(fact: DataFrame, dim_date: DataFrame, start: Day, end: Day, by: list[str],
            dim_time: DataFrame | None = None, filters: Column | None = None,
            selected: DataFrame | None = None) -> DataFrame:
    """``plays`` per ``by`` columns, which may come from the fact, dim_date or dim_time.

    ``selected`` is one column of dimension keys; only their plays are read further.
    """
    days = dim_date.where(_between("date", start, end)).select("date_sid", "year_num")
    rows = _period(fact, start, end)
    if selected is not None:
        rows = rows.join(selected, selected.columns, "left_semi")
    rows = rows.join(days, "date_sid")
    if dim_time is not None:
        rows = rows.join(dim_time.select("time_sid", "hour_of_day", "time_of_day"), "time_sid")
    if filters is not None:
        rows = rows.where(filters)
    return rows.groupBy(*by).agg(F.count("track_sid").alias("plays"))


def _keys(dim: DataFrame, key: str, *filters) -> DataFrame | None:
    """The dimension's keys if anything is selected."""
    return dim.select(key) if any(filters) else None


# last 24 hours

def last_24h_tracks(recent: DataFrame, now: datetime | str, hours: int = LAST_HOURS) -> DataFrame:
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return recent.where(F.col("played_at") >= since).select(
        "user_id", "track_id", "track_name", "artist", "artist_id", "album", "duration_ms",
        "minutes_played", "played_at", "popularity", "play_source",
    ).orderBy(F.desc("played_at"))


def _total_minutes() -> Column:
    """Exact sum of minutes; 0 where none are known."""
    minutes = F.sum(exact_minutes(F.col("minutes_played")))
    return F.coalesce(minutes, F.lit(0)).cast("double")


def artist_aggregates(tracks: DataFrame, top: int | None = None) -> DataFrame:
    out = tracks.groupBy("artist").agg(
        _total_minutes().alias("total_minutes"),
        F.count("artist").alias("track_count"),
    ).orderBy(F.desc("total_minutes"), F.asc_nulls_last("artist"))
    return out.limit(top) if top else out


def tracks_for_artist(tracks: DataFrame, artist: str) -> DataFrame:
    return tracks.where(F.col("artist") == artist).select(
        "track_name", "album", "minutes_played", "played_at", "popularity",
    ).orderBy(F.desc("played_at"))


def kpi_last_24h(tracks: DataFrame) -> DataFrame:
    """Minutes, plays, distinct track names and distinct artists (a missing artist counts)."""
    return tracks.agg(
        _total_minutes().alias("total_minutes"),
        F.count(F.lit(1)).alias("total_tracks"),
        F.countDistinct("track_name").alias("distinct_tracks"),
        (F.countDistinct("artist")
         + F.coalesce(F.max(F.col("artist").isNull().cast("int")), F.lit(0)))
        .alias("total_artists"),
    )


def artist_detail(tracks: DataFrame, artist: str) -> DataFrame:
    return tracks.where(F.col("artist") == artist).agg(
        _total_minutes().alias("total_minutes"), F.count("artist").alias("track_count"),
    ).withColumn("avg_minutes", F.coalesce(
        F.try_divide("total_minutes", "track_count"), F.lit(0.0)))


# geography

def geographic_data(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame,
                    start: Day, end: Day) -> DataFrame:
    """Plays per located artist."""
    plays = _counts(fact, dim_date, start, end, ["artist_sid"])
    place = ["artist_name", "continent", "country", "state_province", "city", "lat",
             "longitude", "primary_genre"]
    artists = dim_artist.where(F.col("country").isNotNull()).select("artist_sid", *place)
    return (
        plays.join(artists, "artist_sid").groupBy("artist_sid", *place)
        .agg(F.sum("plays").alias("track_count")).drop("artist_sid")
        .orderBy(F.desc("track_count"), F.asc_nulls_last("artist_name"))
    )


def _listed(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values, sorted."""
    return df.where(F.col(column) != "").select(column).distinct().orderBy(column)


def continents(dim_artist: DataFrame) -> DataFrame:
    return _listed(dim_artist, "continent")


def countries_for_continents(dim_artist: DataFrame, selected: Names) -> DataFrame:
    """Countries of the selected continents; nothing selected gives nothing."""
    chosen = F.col("continent").isin(*selected) if selected else F.lit(False)
    return _listed(dim_artist.where(chosen), "country")


def country_codes(dim_artist: DataFrame) -> DataFrame:
    return _listed(dim_artist, "country_code")


def _selected_artists(dim_artist: DataFrame, continents: Names, countries: Names,
                      genres: Names = None) -> DataFrame:
    return dim_artist.where(_in("continent", continents) & _in("country", countries)
                            & _in("primary_genre", genres))


def track_count_by_geography(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame,
                             start: Day, end: Day, continents: Names = None,
                             countries: Names = None, genres: Names = None) -> DataFrame:
    artists = _selected_artists(dim_artist, continents, countries, genres)
    plays = _counts(fact, dim_date, start, end, ["artist_sid"],
                    selected=_keys(artists, "artist_sid", continents, countries, genres))
    return plays.join(artists.select("artist_sid"), "artist_sid").agg(
        F.coalesce(F.sum("plays"), F.lit(0)).alias("track_count"))


def genre_distribution(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame,
                       start: Day, end: Day, continents: Names = None,
                       countries: Names = None, top: int = TOP_GENRES_GEO) -> DataFrame:
    artists = _selected_artists(dim_artist, continents, countries).where(
        F.col("primary_genre") != NO_GENRE)
    plays = _counts(fact, dim_date, start, end, ["artist_sid"],
                    selected=_keys(artists, "artist_sid", continents, countries))
    return (
        plays.join(artists.select("artist_sid", "primary_genre"), "artist_sid")
        .groupBy("primary_genre").agg(F.sum("plays").alias("track_count"))
        .orderBy(F.desc("track_count"), "primary_genre").limit(top)
    )


def artists_by_geography(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame,
                         start: Day, end: Day, continents: Names = None,
                         countries: Names = None, genres: Names = None,
                         top: int = TOP_ARTISTS_GEO) -> DataFrame:
    artists = _selected_artists(dim_artist, continents, countries, genres)
    plays = _counts(fact, dim_date, start, end, ["artist_sid"],
                    selected=_keys(artists, "artist_sid", continents, countries, genres))
    return (
        plays.join(artists.select("artist_sid", "artist_name"), "artist_sid")
        .groupBy("artist_sid", "artist_name").agg(F.sum("plays").alias("track_count"))
        .orderBy(F.desc("track_count"), F.asc_nulls_last("artist_name"), "artist_sid")
        .limit(top).select("artist_name", "track_count")
    )


def map_aggregate(geo: DataFrame, level: str, continents: Names = None, countries: Names = None,
                  genres: Names = None) -> DataFrame:
    """Rows of ``geographic_data`` summed per city, state, country or continent."""
    if level not in MAP_LEVELS:
        raise ValueError(f"Unknown level: {level}")
    columns = MAP_LEVELS[level]
    aggs = [F.sum("track_count").alias("total_tracks")]
    if level != "City":
        aggs += [F.avg("lat").alias("lat"), F.avg("longitude").alias("longitude")]
    return (
        _selected_artists(geo, continents, countries, genres).groupBy(*columns).agg(*aggs)
        .orderBy(F.desc("total_tracks"), *[F.asc_nulls_last(c) for c in columns])
    )


def map_aggregate_all(geo: DataFrame) -> DataFrame:
    """All four levels in one pass, marked by ``level``."""
    names = list(dict.fromkeys(c for cols in MAP_LEVELS.values() for c in cols))
    point = ["lat", "longitude"]
    keyed = geo.select(
        *[F.col(c).alias(f"point_{c}" if c in point else c) for c in names],
        *point, "track_count")
    sets = [[F.col(f"point_{c}" if c in point else c) for c in cols]
            for cols in MAP_LEVELS.values()]
    every = [F.col(f"point_{c}" if c in point else c) for c in names]
    # a level is recognised by which columns it does not group by
    absent = F.concat(*[F.grouping(c) for c in every])
    label = F.lit(None)
    for level, cols in MAP_LEVELS.items():
        bits = "".join("0" if c in cols else "1" for c in names)
        label = F.when(F.col("_absent") == bits, level).otherwise(label)
    out = keyed.groupingSets(sets, *every).agg(
        absent.alias("_absent"), F.sum("track_count").alias("total_tracks"),
        F.avg("lat").alias("lat"), F.avg("longitude").alias("longitude"))
    return out.select(label.alias("level"), "continent", "country", "state_province", "city",
                      "lat", "longitude", "total_tracks")


def bubble_size(aggregated: DataFrame) -> DataFrame:
    largest = aggregated.agg(F.max("total_tracks")).scalar()
    return aggregated.withColumn(
        "bubble_size", F.col("total_tracks") / largest * BUBBLE_SCALE + BUBBLE_BASE)


def location_drilldown(geo: DataFrame) -> DataFrame:
    """Counts at every level of continent, country, state, city; ``depth`` is the level."""
    return geo.rollup(*DRILL).agg(
        F.sum("track_count").alias("track_count"),
        (F.lit(len(DRILL)) - sum((F.grouping(c) for c in DRILL), F.lit(0)))
        .cast("bigint").alias("depth"),
    )


# time

def _by_artist(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame, start: Day, end: Day,
               column: str, country_code: str | None, dim_time: DataFrame | None = None):
    """Plays per ``column`` over artists with a name, optionally of one country."""
    artists = dim_artist.where(F.col("artist_name").isNotNull())
    if country_code:
        artists = artists.where(F.col("country_code") == country_code)
    plays = _counts(fact, dim_date, start, end, ["artist_sid", column], dim_time,
                    selected=_keys(artists, "artist_sid", country_code))
    return plays.join(artists.select("artist_sid"), "artist_sid").groupBy(column).agg(
        F.sum("plays").alias("track_count"))


def tracks_by_year(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame,
                   start: Day, end: Day, country_code: str | None = None) -> DataFrame:
    return _by_artist(fact, dim_artist, dim_date, start, end, "year_num", country_code).orderBy(
        "year_num")


def tracks_by_hour(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame,
                   dim_time: DataFrame, start: Day, end: Day,
                   country_code: str | None = None) -> DataFrame:
    return _by_artist(fact, dim_artist, dim_date, start, end, "hour_of_day", country_code,
                      dim_time).orderBy("hour_of_day")


def tracks_by_time_of_day(fact: DataFrame, dim_artist: DataFrame, dim_date: DataFrame,
                          dim_time: DataFrame, start: Day, end: Day,
                          country_code: str | None = None) -> DataFrame:
    """Morning first, night last."""
    rank = F.array_position(F.array(*[F.lit(x) for x in DAY_ORDER]), F.col("time_of_day"))
    return _by_artist(fact, dim_artist, dim_date, start, end, "time_of_day", country_code,
                      dim_time).orderBy(rank)


# genres

def _genres(dim_genre: DataFrame, selected: Names) -> DataFrame:
    return dim_genre.where((F.col("genre") != NO_GENRE) & _in("genre", selected))


def genres(dim_genre: DataFrame) -> DataFrame:
    return _listed(dim_genre.where(F.col("genre") != NO_GENRE), "genre")


def tracks_by_year_and_genre(fact: DataFrame, dim_genre: DataFrame, dim_date: DataFrame,
                             start: Day, end: Day, genres: Names = None) -> DataFrame:
    chosen = _genres(dim_genre, genres)
    plays = _counts(fact, dim_date, start, end, ["genre_sid", "year_num"],
                    selected=_keys(chosen, "genre_sid", genres))
    return (
        plays.join(chosen.select("genre_sid"), "genre_sid")
        .groupBy("year_num").agg(F.sum("plays").alias("track_count")).orderBy("year_num")
    )


def genre_distribution_with_artists(fact: DataFrame, dim_genre: DataFrame, dim_date: DataFrame,
                                    start: Day, end: Day, genres: Names = None,
                                    top: int = TOP_GENRES) -> DataFrame:
    chosen = _genres(dim_genre, genres)
    plays = _counts(fact, dim_date, start, end, ["genre_sid"],
                    selected=_keys(chosen, "genre_sid", genres))
    dim = chosen.select(
        "genre_sid", "genre", F.col("top_artist_in_genre").alias("top_artist"),
        F.col("most_popular_artist_in_genre").alias("most_popular_artist"))
    return (
        plays.join(dim, "genre_sid").groupBy("genre", "top_artist", "most_popular_artist")
        .agg(F.sum("plays").alias("track_count"))
        .orderBy(F.desc("track_count"), "genre").limit(top)
        .select("genre", "track_count", "top_artist", "most_popular_artist")
    )


def _artist_genre_counts(fact: DataFrame, dim_genre: DataFrame, dim_artist: DataFrame,
                         dim_date: DataFrame, start: Day, end: Day,
                         years: list[int] | None = None, cut: bool = False) -> DataFrame:
    """Plays per artist and genre of ``dim_genre``; with ``cut`` the fact is cut to its keys."""
    in_years = F.col("year_num").isin(*years) if years else None
    plays = _counts(fact, dim_date, start, end, ["artist_sid", "genre_sid"], filters=in_years,
                    selected=_keys(dim_genre, "genre_sid", cut))
    return (
        plays.join(dim_genre.select("genre_sid", "genre"), "genre_sid")
        .join(dim_artist.select("artist_sid", "artist_name"), "artist_sid")
        .groupBy("artist_sid", "artist_name", "genre").agg(F.sum("plays").alias("track_count"))
    )


def artists_by_genre(fact: DataFrame, dim_genre: DataFrame, dim_artist: DataFrame,
                     dim_date: DataFrame, start: Day, end: Day, genres: Names = None,
                     years: list[int] | None = None, top: int = TOP_ARTISTS_GENRE) -> DataFrame:
    """Each artist with the count of the genre it is played in most."""
    counts = _artist_genre_counts(fact, _genres(dim_genre, genres), dim_artist, dim_date, start,
                                  end, years, bool(genres))
    return counts.groupBy("artist_name").agg(F.max("track_count").alias("track_count")).orderBy(
        F.desc("track_count"), F.asc_nulls_last("artist_name")).limit(top)


def genre_treemap_midpoint(distribution: DataFrame) -> DataFrame:
    return distribution.agg(F.median("track_count").alias("midpoint"))


def selectable_years(by_year: DataFrame) -> DataFrame:
    return by_year.select("year_num").distinct().orderBy("year_num")


def top_artist_in_top_genres(fact: DataFrame, dim_genre: DataFrame, dim_artist: DataFrame,
                             dim_date: DataFrame, start: Day, end: Day,
                             top_genres: int = TOP_GENRES) -> DataFrame:
    """Plays per artist within the most played genres of the period."""
    leading = genre_distribution_with_artists(
        fact, dim_genre, dim_date, start, end, top=top_genres).select("genre")
    few = _genres(dim_genre, None).join(leading, "genre", "left_semi")
    counts = _artist_genre_counts(fact, few, dim_artist, dim_date, start, end, cut=True)
    return (
        counts.groupBy("artist_sid", "artist_name")
        .agg(F.sum("track_count").alias("track_count"))
        .orderBy(F.desc("track_count"), F.asc_nulls_last("artist_name"), "artist_sid")
        .select("artist_name", "track_count")
    )


def measures(fact_tracks: DataFrame, fact_genres: DataFrame, start: Day, end: Day) -> DataFrame:
    """The three named measures over a period."""
    minutes = F.sum(exact_minutes(F.col("duration_ms") / F.lit(60_000))).cast("double")
    in_genre = _period(fact_genres, start, end).agg(
        F.count("track_sid")).scalar()
    return _period(fact_tracks, start, end).agg(
        F.count("track_sid").alias("count_tracks_played"),
        minutes.alias("sum_of_minutes_played"),
    ).withColumn("count_tracks_played_in_genre", in_genre)

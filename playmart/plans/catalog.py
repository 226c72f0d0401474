"""Named queries: every operator applied to the driver tables through the proxies."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions.keys import surrogate_key
from playmart.functions.times import local_time, parse_played_at
from playmart.operators import dedup, discover, geo, ingest, jsonops, reach, reports, sinks
from playmart.plans import intermediate, stage, warehouse
from playmart.plans.proxies import spark_proxy
from playmart.session import configure, scratch_path
from playmart.sources import plays as play_sources
from playmart.sources import tables
from playmart.streaming import plays as streaming

NOW = "2024-01-30 00:00:00"
START, END = "1996-01-01", "2000-12-31"
SPINE_START, SPINE_END = date(1995, 1, 1), date(2002, 1, 31)
COUNTRY, CONTINENTS, COUNTRIES = "N3", ["AFRICA", "ASIA"], ["NATION_0", "NATION_2", "NATION_7"]
CODES = ["N0", "N2", "N7"]
GENRES, YEARS = ["standard widget", "standard plate", "medium widget"], [1997, 1998]
ARTIST = "Supplier#000000003"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result columns without widths or zone labels that differ between engines."""
    casts = {}
    for f in df.schema:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            casts[f.name] = F.col(f.name).cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


class Source:
    """Proxies, warehouse inputs and scratch tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._frames = configure(spark), sf_dir, {}
        self.inputs = warehouse.Inputs(
            spark,
            tables={
                "tracks_played": lambda: self.history,
                "spotify_artists": lambda: self.artist_rows,
                "spotify_artist_genre": lambda: self.artist_genre,
                "spotify_albums": lambda: self.album_rows,
                "mbz_artist_info": lambda: self.info_rows,
                "mbz_area_hierarchy": lambda: self.area_rows,
                "cities_with_lat_long": lambda: self.city_rows,
                "mask_artists": lambda: self.mask_rows,
                "recently_played": self.snapshot,
            },
            spine_start=SPINE_START, spine_end=SPINE_END,
        )

    def __getattr__(self, name: str) -> DataFrame:
        return spark_proxy(self.spark, self.sf_dir, name, self._frames)

    @property
    def stored(self) -> warehouse.Inputs:
        """The inputs with the plays as a stored table, for models that read them several times."""
        if "stored" not in self._frames:
            # every column, so that a play is the same whoever reads it
            plays = sinks.settled(self.history, "history")
            self._frames["stored"] = replace(
                self.inputs, tables={**self.inputs.tables, "tracks_played": plays}, built={})
        return self._frames["stored"]

    def model(self, name: str) -> DataFrame:
        return self.models(name)[0]

    def models(self, *names: str) -> list[DataFrame]:
        several = warehouse.FROM_DISTINCT_PLAYS.intersection(names)
        inputs = self.stored if several else self.inputs
        return [warehouse.build_model(inputs, n) for n in names]

    def snapshot(self) -> DataFrame:
        """Plays under the column names of the consolidated snapshot."""
        return self.plays.drop("play_id").withColumns({
            "duration_ms": F.col("duration_ms").cast("double"),
            "popularity": F.col("popularity").cast("double"),
        }).withColumnsRenamed({"track_uri": "uri", "request_cursor": "request_after"})

    def recent(self) -> DataFrame:
        return reports.last_24h_tracks(self.model("recently_played"), NOW)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def json_folder(self, records: DataFrame, order: str, per_file: int = 2000) -> str:
        """Records as files that hold one JSON array of at most ``per_file`` records each."""
        path = self.scratch("json")
        number = F.floor(F.col(order).cast("bigint") / per_file)
        record = F.to_json(F.struct(*[c for c in records.columns if c != order]))
        arrays = records.groupBy(number.alias("file_no")).agg(
            F.collect_list(record).alias("r")).select(
            "file_no", F.concat(F.lit("["), F.array_join("r", ","), F.lit("]")).alias("value"))
        arrays.repartition("file_no").write.partitionBy("file_no").text(path)
        return path

    def raw_json(self) -> str:
        """Plays as raw JSON files, times as text."""
        return self.json_folder(self.snapshot_raw(), "play_id")

    def snapshot_raw(self) -> DataFrame:
        text = F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        return self.plays.withColumn("played_at", text).withColumnsRenamed(
            {"track_uri": "uri", "request_cursor": "request_after"})


_SOURCES: dict[tuple[str, str], Source] = {}


def source_for(spark: SparkSession, sf_dir: str) -> Source:
    """One source per application and folder: its lazy DataFrames are planned once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SOURCES:
        _SOURCES[key] = Source(spark, sf_dir)
    configure(spark)
    return _SOURCES[key]


def query(name: str):
    def add(fn: Callable[[Source], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(source_for(spark, sf_dir)))
        return fn
    return add


# ---- A sources

RAW_GLOB = "*.txt"
PLAY_FIELDS = [f for f in stage.PLAY_COLUMNS]


@query("a1_read_raw_plays")
def _(s):
    return play_sources.read_raw_plays(s.spark, s.raw_json(), glob=RAW_GLOB).select(*PLAY_FIELDS)


@query("a2_read_table")
def _(s):
    base = s.scratch("tables")
    sinks.write_overwrite(s.history, base, "tracks_played")
    return tables.read_table(s.spark, base, "tracks_played")


@query("a3_register_views")
def _(s):
    base = s.scratch("tables")
    sinks.write_overwrite(s.history, base, "tracks_played")
    sinks.write_overwrite(s.artist_rows, base, "spotify_artists")
    tables.register_views(s.spark, base)
    return s.spark.sql("""
        SELECT t.*, a.artist_name, a.artist_popularity
        FROM tracks_played t JOIN spotify_artists a ON t.artist_id = a.artist_id""")


@query("a4_read_recently_played_csv")
def _(s):
    path = s.scratch("csv")
    sinks.write_csv_snapshot(s.snapshot(), path)
    return play_sources.read_recently_played_csv(s.spark, path)


@query("a5_read_seed")
def _(s):
    folder = s.scratch("seeds")
    s.mask_rows.write.option("header", True).csv(f"{folder}/mask_artists.csv")
    return tables.read_seed(s.spark, folder, "mask_artists")


@query("a6_report_extract_views")
def _(s):
    base = s.scratch("extracts")
    fact, by_genre = s.models("fact_track_played", "fact_artist_genre")
    sinks.write_overwrite(fact, base, "track_plays")
    sinks.write_overwrite(by_genre, base, "artist_genre_plays")
    tables.report_extract_views(s.spark, base)
    return s.spark.sql("""
        SELECT 'track_plays' AS extract, date_sid, COUNT(*) AS plays
        FROM track_plays GROUP BY date_sid
        UNION ALL
        SELECT 'artist_genre_plays', date_sid, COUNT(*) FROM artist_genre_plays
        GROUP BY date_sid""")


# ---- B ingest

PER_CALL = 50  # a service call returns at most this many plays


@query("b1_flatten_recently_played")
def _(s):
    source = F.col("play_source")
    track = F.struct(
        F.col("track_id").alias("id"), F.col("track_uri").alias("uri"),
        F.col("track_name").alias("name"), F.col("duration_ms").cast("double").alias("duration_ms"),
        F.col("popularity").cast("double").alias("popularity"), F.struct(F.col("track_isrc").alias("isrc"))
        .alias("external_ids"),
        F.when(source == "error", F.array().cast("array<struct<id:string,name:string>>"))
        .otherwise(F.array(F.struct(F.col("artist_id").alias("id"), F.col("artist").alias("name"))))
        .alias("artists"),
        F.struct(F.col("album_id").alias("id"), F.col("album_uri").alias("uri"),
                 F.col("album").alias("name")).alias("album"),
    )
    item = F.struct(
        F.when(source != "signup", track).alias("track"),
        F.when(source != "view", F.struct(F.concat(F.lit("ctx:"), source).alias("uri")))
        .alias("context"),
        F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("played_at"),
    )
    call = F.floor(F.col("play_id").cast("bigint") / PER_CALL)
    payloads = s.plays.groupBy(call).agg(F.collect_list(item).alias("items"))
    return ingest.flatten_recently_played(payloads, "listener", "17")


@query("b2_flatten_listens")
def _(s):
    source = F.col("play_source")
    client = F.when(source == "view", "Navidrome/0.5").when(source == "click", "other").when(
        source == "signup", "")
    listen = F.struct(
        F.when(F.col("duration_ms") < 4000, 0).otherwise(F.unix_seconds("played_at"))
        .alias("listened_at"),
        F.col("user_id").alias("user_name"),
        F.struct(
            "track_name", F.col("album").alias("release_name"),
            F.col("artist").alias("artist_name"),
            F.struct(client.alias("submission_client"),
                     F.col("duration_ms").cast("double").alias("duration_ms"))
            .alias("additional_info"),
            F.struct(F.array_compact(F.array("artist_mbid")).alias("artist_mbids"))
            .alias("mbid_mapping"),
        ).alias("track_metadata"),
    )
    call = F.floor(F.col("play_id").cast("bigint") / PER_CALL)
    payloads = s.plays.groupBy(call).agg(
        F.struct(F.collect_list(listen).alias("listens")).alias("payload"))
    return ingest.flatten_listens(payloads)


@query("b3_flatten_albums")
def _(s):
    artists = F.when(F.col("release_date").isNotNull(), F.array(F.struct(
        F.col("artist_id").alias("id"), F.col("artist_name").alias("name"),
        F.col("artist_type").alias("type"))))
    payload = s.album_rows.select(
        F.col("album_id").alias("id"), F.col("album_name").alias("name"), "album_type",
        artists.alias("artists"),
        F.when(F.col("popularity") == 50, F.array("label")).alias("genres"),
        "label", "popularity", "release_date", "release_date_precision", "total_tracks")
    return ingest.flatten_albums(payload, NOW).withColumn("genres", F.array_join("genres", ","))


@query("b4_conform_artists")
def _(s):
    return ingest.conform_artists(s.supplier.select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
        F.floor("s_acctbal").alias("popularity")))


@query("b5_parse_played_at")
def _(s):
    source = F.col("play_source")
    text = (
        F.when(source == "view", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(source == "click", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .when(source == "error", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00Z'"))
        .when(source == "signup", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'-07:00'"))
        .otherwise("not a time")
    )
    return s.plays.select("play_id", parse_played_at(text).alias("played_at"))


@query("b6_high_water_mark")
def _(s):
    by_ms = ingest.high_water_mark(s.plays).select(F.lit("ms").alias("unit"), "cursor")
    by_second = ingest.high_water_mark(s.plays, unit="s").select(
        F.lit("s").alias("unit"), "cursor")
    return by_ms.unionByName(by_second)


@query("b6_newer_than")
def _(s):
    cursor = 1705276800000  # 2024-01-15
    return ingest.newer_than(s.plays, cursor).select("play_id", "played_at")


@query("b7_append_plays")
def _(s):
    new = s.plays.drop("play_id", "track_isrc").withColumn("note", F.lit(None).cast("string"))
    return ingest.append_plays(s.history, new)


# ---- C de-duplication

ORDER, TIE = ["seq", "play_id"], ("seq", "play_id")


@query("c1_dedup_exact")
def _(s):
    return dedup.dedup_exact(s.raw_plays, order=ORDER)


@query("c2_require_play_identity")
def _(s):
    raw = s.raw_plays.withColumn(
        "artist", F.when(F.col("play_source") != "error", F.col("artist")))
    return dedup.require_play_identity(raw)


@query("c3_dedup_within_duration")
def _(s):
    return dedup.dedup_within_duration(s.raw_plays, TIE)


@query("c3_dedup_plays")
def _(s):
    return dedup.dedup_plays(s.raw_plays, ORDER, TIE)


@query("c4_dedup_audit")
def _(s):
    raw = s.raw_plays.withColumn(
        "artist", F.when(F.col("artist_id") != "3", F.col("artist")))
    return dedup.dedup_audit(raw, ORDER, TIE)


@query("c5_consolidate_plays")
def _(s):
    path = s.scratch("snapshot")
    play_sources.consolidate_plays(s.spark, s.raw_json(), path, glob=RAW_GLOB, tie=("track_id",))
    return play_sources.read_recently_played_csv(s.spark, path)


@query("c6_deduplicate_with_priority")
def _(s):
    return dedup.deduplicate_with_priority(
        s.plays.select("track_id", "duration_ms", "play_id"), ["track_id"], "duration_ms")


@query("c6_deduplicate_ascending")
def _(s):
    return dedup.deduplicate_with_priority(
        s.history.select("artist", "duration_ms", "track_id"), ["artist"], "duration_ms", True)


@query("c6_deduplicate_distinct")
def _(s):
    return dedup.deduplicate_with_priority(s.history.select("artist", "album"), [])


# ---- D discovery

@query("d1_missing_artists")
def _(s):
    return discover.missing_artists(s.history, s.artist_rows)


@query("d1_missing_artists_page")
def _(s):
    return discover.missing_artists(s.history, s.artist_rows, limit=3, offset=2)


@query("d2_missing_albums")
def _(s):
    return discover.missing_albums(s.history, s.album_rows)


@query("d3_missing_catalog_artists")
def _(s):
    return discover.missing_catalog_artists(s.plays, s.info_rows, NOW)


@query("d4_missing_catalog_artists_with_popularity")
def _(s):
    return discover.missing_catalog_artists_with_popularity(s.plays, s.info_rows, NOW)


@query("d5_cities_needing_coordinates")
def _(s):
    return discover.cities_needing_coordinates(s.area_rows, s.city_rows)


@query("d6_missing_count")
def _(s):
    counts = {
        "artists": dict(plays=s.history, known=s.artist_rows),
        "albums": dict(plays=s.history, known=s.album_rows),
        "mbz_artists": dict(plays=s.plays, known=s.info_rows, now=NOW),
        "cities": dict(areas=s.area_rows, known=s.city_rows),
    }
    out = None
    for entity, args in counts.items():
        row = discover.missing_count(entity, **args).select(F.lit(entity).alias("entity"), "count")
        out = row if out is None else out.unionByName(row)
    return out


@query("d7_check_exists")
def _(s):
    ids = s.history.select("artist_id").distinct()
    return discover.check_exists(ids, s.artist_rows)


@query("d8_areas_without_continent")
def _(s):
    return discover.areas_without_continent(s.area_rows).select("area_id", "continent")


@query("d9_areas_needing_coordinates")
def _(s):
    return discover.areas_needing_coordinates(s.area_rows, s.city_rows).select("area_id", "params")


@query("d10_countries_needing_enrichment")
def _(s):
    return discover.countries_needing_enrichment(s.area_rows)


@query("d11_area_ids_to_process")
def _(s):
    known = s.area_rows.where(F.col("area_type") == "Country")
    return discover.area_ids_to_process(s.info_rows, known)


@query("d12_assign_batches")
def _(s):
    plays = s.plays.select("play_id", "played_at")
    return discover.assign_batches(plays, [F.col("played_at"), F.col("play_id")], 70)


@query("d13_track_failures")
def _(s):
    failed = s.plays.where(F.col("track_isrc").isNotNull()).select(
        "artist_id", "artist", F.col("track_isrc").alias("isrc"),
        F.when(F.col("play_source") == "view", "lookup failed").alias("reason")).distinct()
    known = failed.where(F.col("reason").isNotNull()).select(
        "artist_id", "artist", F.col("isrc").alias("track_isrc"), "reason",
        F.lit("2024-01-01").alias("failed_at"))
    return discover.track_failures(
        failed.where(F.col("reason").isNull()).select("artist_id", "artist", "isrc"), NOW, known)


# ---- E sinks

def _artist_update(s) -> DataFrame:
    """A later fetch of the richer half, with one new column."""
    return s.supplier.where(F.col("s_acctbal") > 4000).select(
        F.col("s_suppkey").cast("string").alias("artist_id"),
        F.concat("s_name", F.lit(" (new)")).alias("artist_name"),
        F.lit(None).cast("string").alias("artist_mbid"),
        (F.floor("s_acctbal") / 100).alias("artist_popularity"),
        F.lit(True).alias("checked"))


@query("e1_write_overwrite")
def _(s):
    base = s.scratch("tables")
    sinks.write_table(s.plays, base, "t")
    sinks.write_table(s.history, base, "t", "overwrite")
    return tables.read_table(s.spark, base, "t")


@query("e2_write_append")
def _(s):
    base = s.scratch("tables")
    sinks.write_table(s.history, base, "t", "append")
    sinks.write_table(s.plays.withColumn("popularity", F.col("popularity").cast("int")),
                      base, "t", "append")
    return tables.read_table(s.spark, base, "t")


@query("e3_upsert")
def _(s):
    return sinks.upsert(s.artist_rows, _artist_update(s), sinks.merge_keys("spotify_artists"))


@query("e3_write_merge")
def _(s):
    base = s.scratch("tables")
    sinks.write_table(s.artist_rows, base, "spotify_artists")
    sinks.write_table(_artist_update(s), base, "spotify_artists", "merge")
    return tables.read_table(s.spark, base, "spotify_artists")


@query("e3_upsert_plays_by_day")
def _(s):
    """Re-fetched plays of one day onwards replace the stored ones, partition by partition; plays
    without a readable day have a partition too."""
    base = s.scratch("tables")
    day = F.when(F.col("play_source") != "error", F.to_date("played_at"))
    plays = s.plays.withColumn("day", day)
    plays.write.partitionBy("day").parquet(f"{base}/tracks_played")
    fresh = plays.where(F.col("played_at") >= "2024-01-20").withColumn(
        "popularity", F.lit(1).cast("bigint"))
    sinks.write_merge_partitions(
        fresh, base, "tracks_played", sinks.merge_keys("tracks_played"), "day")
    return tables.read_table(s.spark, base, "tracks_played")


@query("e4_upsert_without_keys")
def _(s):
    genres = s.artist_genre
    new = genres.where(F.col("genre").contains("ring")).unionByName(
        genres.withColumn("genre", F.upper("genre")))
    return sinks.upsert(genres, new, sinks.merge_keys("mbz_artist_genre"))


@query("e5_align_schema")
def _(s):
    stored = s.artist_rows
    new = s.artist_rows.withColumn("artist_popularity", F.col("artist_popularity").cast("double"))
    aligned = sinks.align_schema(new, stored)
    return aligned.select("*", F.typeof("artist_popularity").alias("type"))


@query("e7_harmonize_schemas")
def _(s):
    left, right = sinks.harmonize_schemas([
        s.supplier.select("s_name", F.lit(None).alias("note")),
        s.part.select("p_name", F.lit(None).alias("label"))])
    return left.unionByName(right).select("s_name", "note", "p_name", "label")


@query("e8_table_info")
def _(s):
    base = s.scratch("tables")
    sinks.write_table(s.history, base, "tracks_played")
    info = sinks.table_info(s.spark, base, "tracks_played")
    types = F.array_join(F.transform("columns", lambda c: F.try_element_at("column_types", c)), ",")
    return info.select("table", "exists", "record_count",
                       F.array_join("columns", ",").alias("columns"), types.alias("types"),
                       (F.col("file_count") > 0).alias("has_files"),
                       (F.col("total_bytes") > 0).alias("has_bytes"))


@query("e9_write_csv_snapshot")
def _(s):
    path = s.scratch("csv")
    sinks.write_csv_snapshot(s.snapshot(), path)
    return play_sources.read_recently_played_csv(s.spark, path)


@query("e10_validate_tables")
def _(s):
    base = s.scratch("tables")
    sinks.write_table(s.history, base, "tracks_played")
    sinks.write_table(s.artist_rows, base, "spotify_artists")
    sinks.write_table(s.album_rows, base, "spotify_albums")
    return sinks.validate_tables(s.spark, base)


@query("e11_check_column_consistency")
def _(s):
    """Column report over two fact tables, with the plays each of them holds."""
    played, genre = s.models("fact_track_played", "fact_artist_genre")
    rows = sinks.check_column_consistency(played, genre)
    return rows.withColumn("stored_rows", played.agg(F.count(F.lit(1))).scalar()).withColumn(
        "model_rows", genre.agg(F.count(F.lit(1))).scalar()).select(
        "column_name", "in_both", "columns_match", "stored_rows", "model_rows")


# columns that are compared for every written model: all but fractions
CHECKED = {
    "dim_album": "album_sid album_name artist_album label total_tracks album_popularity "
                 "release_date release_year release_decade release_date_precision",
    "dim_artist": "artist_sid artist_name artist_popularity_group artist_popularity_sort "
                  "is_popular primary_genre continent_code continent country_code country "
                  "state_province_code state_province county city district",
    "dim_artist_genre": "genre_sid genre top_artist_in_genre most_popular_artist_in_genre "
                        "rank_by_tracks_played total_tracks_played_in_genre rank_by_time_played",
    "dim_date": "date_sid date day_of_week day_of_week_name week_of_year year_num year_text "
                "month_num month_name quarter day_of_month day_of_year month_start_date "
                "month_end_date year_start_date year_end_date",
    "dim_time": "time_sid time hour_of_day minute_of_hour second_of_hour am_pm time_of_day "
                "time_of_day_sort",
    "dim_track": "track_sid track_name artist_track track_popularity track_popularity_group "
                 "track_popularity_sort is_popular track_duration track_length track_length_sort",
    "fact_track_played": "track_sid artist_sid album_sid artist_name request_cursor date_sid "
                         "time_sid popularity duration_ms tracks_played",
    "fact_artist_genre": "track_played_uid track_sid artist_sid album_sid genre_sid date_sid "
                         "time_sid popularity duration_ms",
}


def _fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Rows of a model and a sum over the hashes of its rows."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in CHECKED[name].split()]
    part = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("row_count"),
                  F.sum(part).alias("row_hashes"))


def _fingerprints(s, base: str) -> DataFrame:
    written = warehouse.stored_warehouse(s.spark, base)
    return reduce(DataFrame.unionByName, [_fingerprint(df, n) for n, df in written.items()])


@query("e12_build_warehouse")
def _(s):
    base = s.scratch("warehouse")
    warehouse.write_warehouse(replace(s.stored, built={}), base)
    return _fingerprints(s, base)


@query("e12_refresh_warehouse")
def _(s):
    """A warehouse over the plays before 1997, brought up to date with all later ones."""
    base = s.scratch("warehouse")
    early = s.stored.table("tracks_played").where(F.col("played_at") < "1997-01-03")
    old = replace(s.stored, tables={**s.stored.tables, "tracks_played": early}, built={})
    warehouse.write_warehouse(old, base)
    warehouse.refresh_warehouse(replace(s.stored, built={}), base, date(1997, 1, 1), SPINE_END)
    return _fingerprints(s, base)


@query("e12_refresh_changed")
def _(s):
    """A warehouse over other plays, genres and popularity, brought up to date without dates."""
    base = s.scratch("warehouse")
    third = F.crc32(F.col("artist_id").cast("string")) % 3 == 0
    tables = {
        **s.stored.tables, "tracks_played": s.stored.table("tracks_played").where(
            ~F.year("played_at").isin(1995, 1997)),
        "spotify_artist_genre": s.artist_genre.withColumn(
            "genre", F.when(third, F.concat("genre", F.lit("!"))).otherwise(F.col("genre"))),
        "spotify_artists": s.artist_rows.withColumn("artist_popularity", F.when(
            third, F.col("artist_popularity") + 1).otherwise(F.col("artist_popularity"))),
    }
    warehouse.write_warehouse(replace(s.stored, tables=tables, built={}), base)
    warehouse.refresh_warehouse(replace(s.stored, built={}), base)
    return _fingerprints(s, base)


# ---- F semi-structured

@query("f1_normalize_artist_json")
def _(s):
    documents = s.supplier.join(s.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
        F.struct(F.col("n_name").alias("name"), F.array(F.lit("x")).alias("alias-list"))
        .alias("area"),
        F.struct(F.col("n_nationkey").cast("string").alias("begin")).alias("life-span"),
        F.array(F.struct(F.lower("n_name").alias("name"))).alias("tag-list"),
        F.array(F.lit("a")).alias("isrc-list"), F.col("s_name").alias("sort-name"))
    return jsonops.normalize_artist_json(documents)


@query("f1_read_artist_json")
def _(s):
    """One document per nation, written and read back."""
    path = s.scratch("artists")
    documents = s.nation.select(
        F.col("n_name").alias("file"), F.to_json(F.struct(
            F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"),
            F.struct(F.col("n_regionkey").cast("string").alias("id")).alias("area")))
        .alias("value"))
    documents.write.partitionBy("file").text(path)
    read = jsonops.read_artist_json(
        s.spark, path, "id string, name string, area struct<id: string>", glob=RAW_GLOB)
    suppliers = s.supplier.groupBy(F.col("s_nationkey").cast("string").alias("id")).agg(
        F.count(F.lit(1)).alias("suppliers"))
    return jsonops.normalize_artist_json(read.drop("source_file")).join(
        suppliers, "id", "left").select("id", "name", "area_id", "suppliers")


@query("f2_conform_to_table")
def _(s):
    new = s.info_rows.select(
        "name", "id", F.array("gender", "country").alias("tag_list"), F.lit(5).alias("alias_count"))
    return jsonops.conform_to_table(new, s.info_rows.select(
        "alias_count", "id", "name", "tag_list", "type"))


@query("f3_flatten_json_column")
def _(s):
    return jsonops.flatten_json_column(
        s.events.select("event_id", "props"), "props", "prop", ["k"])


@query("f3_flatten_json_discovered")
def _(s):
    objects = s.part.select("p_partkey", F.to_json(F.struct(
        F.col("p_size").alias("item-size"), F.col("p_brand").alias("brand"))).alias("j"))
    return jsonops.flatten_json_column(objects, "j")


@query("f4_json_extract")
def _(s):
    return jsonops.json_extract(s.events.select("event_id", "props"), "props", "$.k")\
        .withColumnRenamed("extracted_$.k", "extracted")


@query("f5_explode_array")
def _(s):
    words = s.part.select("p_partkey", F.when(F.col("p_size") > 5, F.to_json(
        F.split("p_name", " "))).alias("words"))
    return jsonops.explode_array(words, "words")


@query("f6_artist_genres")
def _(s):
    listed = s.part.select(
        F.col("p_partkey").cast("string").alias("artist_id"), F.col("p_name").alias("artist_name"),
        F.array("p_type", F.lit(""), F.when(F.col("p_size") > 9, F.col("p_brand"))).alias("genres"))
    return jsonops.artist_genres(listed)


@query("f6_album_genres")
def _(s):
    listed = s.album_rows.select("album_id", "album_name", F.split("label", "A").alias("genres"))
    return jsonops.album_genres(listed)


@query("f7_catalog_artist_genre")
def _(s):
    return jsonops.catalog_artist_genre(s.info_rows)


@query("f8_clean_null_strings")
def _(s):
    return jsonops.clean_null_strings(
        s.info_rows.select("id", "gender", "life_span_begin", "life_span_ended", "alias_count"))


# ---- G geography

@query("g1_area_closure")
def _(s):
    return geo.area_closure(s.area_edges, s.area_nodes.select("area_id")).withColumn(
        "visit", F.array_join("visit", "."))


@query("g2_pivot_hierarchy")
def _(s):
    closure = geo.area_closure(s.area_edges, s.area_nodes.select("area_id"))
    return geo.pivot_hierarchy(closure, s.area_nodes)


@query("g2_hierarchy_levels")
def _(s):
    closure = geo.area_closure(s.area_edges, s.area_nodes.select("area_id"))
    return geo.hierarchy_levels(closure, s.area_nodes)


def _lookup_names(s) -> DataFrame:
    """Names that match exactly, by one of the codes, by part, and not at all."""
    name, key = F.col("s_name"), F.col("s_nationkey").cast("string")
    balance = F.col("s_acctbal")
    return s.supplier.select(
        F.when(balance < 2000, F.concat(F.lit("nation_"), key))
        .when(balance < 4000, F.concat(F.lit("N"), key))
        .when(balance < 6000, F.concat(F.lit("Isle of NATION_"), key, F.lit("!")))
        .when(balance < 7000, F.lit("Guam"))
        .when(balance < 7500, F.concat(F.lit("na"), key))
        .when(balance < 8000, F.concat(F.lit("Republic No. "), key))
        .otherwise(name).alias("country_name")).distinct()


@query("g3_continent_lookup")
def _(s):
    return geo.continent_lookup(_lookup_names(s), s.country_ref, {"Guam": "NATION_4"})


@query("g4_merge_continents")
def _(s):
    lookup = geo.continent_lookup(
        discover.countries_needing_enrichment(s.area_rows), s.country_ref)
    return geo.merge_continents(s.area_rows, lookup).select(
        "area_id", "country_name", "island_name", "continent", "country_code", "continent_code")


@query("g5_add_geocoding_params")
def _(s):
    return geo.add_geocoding_params(s.area_rows).select("area_id", "params")


@query("g5_merge_geocoding_params")
def _(s):
    return geo.merge_geocoding_params(s.area_rows).select("area_id", "params")


@query("g6_add_state_codes_and_params")
def _(s):
    states = s.nation.where(F.col("n_regionkey") < 3).select(
        F.concat(F.lit("State "), F.col("n_nationkey").cast("string")).alias("name"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_code"),
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("code"))
    return geo.add_state_codes_and_params(s.area_rows, states).select("area_id", "code", "params")


@query("g7_clean_municipality_names")
def _(s):
    return geo.clean_municipality_names(s.area_rows).select("area_id", "municipality_name")


def _params(s) -> DataFrame:
    """Params of one to four parts, and empty ones."""
    k = F.col("s_suppkey").cast("string")
    n = F.col("s_nationkey").cast("string")
    region = F.col("s_nationkey") % 5
    return s.supplier.select(
        F.when(region == 0, F.concat(F.lit("City "), k, F.lit(",N"), n))
        .when(region == 1, F.concat(F.lit("City "), k, F.lit(",ST,N"), n))
        .when(region == 2, F.concat(F.lit("City "), k))
        .when(region == 3, F.concat(F.lit("City "), k, F.lit(",a,b,N"), n))
        .otherwise("").alias("params"))


@query("g8_parse_location_params")
def _(s):
    return geo.parse_location_params(_params(s))


@query("g9_attach_coordinates")
def _(s):
    wanted = discover.areas_needing_coordinates(s.area_rows, None)
    return geo.attach_coordinates(wanted, s.city_rows)


@query("g9_coordinate_counts")
def _(s):
    wanted = discover.areas_needing_coordinates(s.area_rows, None)
    return geo.coordinate_counts(geo.attach_coordinates(wanted, s.city_rows))


@query("g10_backfill_artist_mbids")
def _(s):
    return geo.backfill_artist_mbids(s.artist_rows, s.info_rows)


@query("g10_backfill_count")
def _(s):
    updated = geo.backfill_artist_mbids(s.artist_rows, s.info_rows)
    return geo.backfill_count(s.artist_rows, updated)


def _stored(s, **frames: DataFrame) -> str:
    base = s.scratch("tables")
    for name, df in frames.items():
        sinks.write_table(df, base, name)
    return base


@query("g11_enrich_continents")
def _(s):
    base = _stored(s, mbz_area_hierarchy=s.area_rows)
    return geo.enrich_continents(s.spark, base, s.country_ref)


@query("g12_enrich_params")
def _(s):
    base = _stored(s, mbz_area_hierarchy=s.area_rows)
    return geo.enrich_params(s.spark, base)


@query("g13_enrich_coordinates")
def _(s):
    """Cities of the first nations are stored; the others are looked up."""
    known = s.city_rows.where(F.col("country_code") < "N15")
    base = _stored(s, mbz_area_hierarchy=s.area_rows, cities_with_lat_long=known)
    return geo.enrich_coordinates(s.spark, base, s.city_rows)


@query("g14_enrich_artist_ids")
def _(s):
    base = _stored(s, spotify_artists=s.artist_rows, mbz_artist_info=s.info_rows)
    return geo.enrich_artist_ids(s.spark, base)


@query("b8_ingest_raw_plays")
def _(s):
    """Raw files, one of them cut off, into a table that holds part of the plays."""
    folder = s.raw_json()
    s.spark.range(1).select(F.lit('[{"track_id": "cut').alias("value")).write.text(
        f"{folder}/file_no=bad")
    known = play_sources.typed_plays(s.snapshot_raw().drop("play_id")).where(
        F.col("play_source") == "click").select(*PLAY_FIELDS)
    base = _stored(s, tracks_played=known)
    return play_sources.ingest_raw_plays(s.spark, folder, base, RAW_GLOB)


@query("b6_ingest_newer")
def _(s):
    """A table with the plays of the first days, brought up to date from all raw plays by its
    cursor."""
    raw = s.snapshot_raw().drop("play_id")
    known = play_sources.typed_plays(raw).where("played_at < '2024-01-12'").select(*PLAY_FIELDS)
    base = _stored(s, tracks_played=known)
    return play_sources.ingest_newer(raw, base).select(*PLAY_FIELDS)


# ---- H, I, J models

MODEL_QUERIES = {
    "h1_stg_cities": "stg_cities", "h2_stg_area_hierarchy": "stg_area_hierarchy",
    "h3_stg_artist_info": "stg_artist_info", "h4_stg_albums": "stg_albums",
    "h5_stg_artist_genre": "stg_artist_genre", "h6_stg_artists": "stg_artists",
    "h7_stg_tracks_played": "stg_tracks_played",
    "i1_albums": "albums", "i2_area_hierarchy": "area_hierarchy",
    "i3_artist_genre_rank": "artist_genre_rank", "i4_artist_location": "artist_location",
    "i5_artist_location_hierarchy": "artist_location_hierarchy",
    "i6_artist_top_genre": "artist_top_genre", "i7_artists": "artists",
    "i9_genre_stats": "genre_stats", "i10_played": "played", "i11_ranked_genre": "ranked_genre",
    "i12_artists_distinct": "artists_distinct", "i14_tracks": "tracks",
    "i15_unmatched_artists_prep": "unmatched_artists_prep",
    "i16_unmatched_artists": "unmatched_artists",
    "j1_dim_album": "dim_album", "j2_dim_artist": "dim_artist",
    "j3_dim_artist_genre": "dim_artist_genre", "j6_dim_track": "dim_track",
    "j7_fact_track_played": "fact_track_played", "j8_fact_artist_genre": "fact_artist_genre",
    "j9_recently_played": "recently_played",
}
for _key, _model in MODEL_QUERIES.items():
    query(_key)(lambda s, m=_model: s.model(m))


def _daily(s) -> DataFrame:
    return s.history.groupBy(F.to_date(local_time("played_at")).alias("date_sid")).agg(
        F.count(F.lit(1)).alias("plays"))


def _spine(s) -> DataFrame:
    """Days from the first to 30 days after the last local play."""
    first, last = _daily(s).agg(F.min("date_sid"), F.max("date_sid")).first()
    return intermediate.dates(
        s.spark, first, last + timedelta(days=intermediate.SPINE_DAYS_AHEAD))


@query("i8_dates")
def _(s):
    return _spine(s).join(_daily(s), "date_sid", "left")


@query("i11_ranked_genre_floor")
def _(s):
    return intermediate.ranked_genre(s.model("genre_stats"), groups_mode="floor")


@query("i13_times")
def _(s):
    plays = s.model("played").groupBy("time_sid").agg(F.count(F.lit(1)).alias("plays"))
    return intermediate.times(s.spark).join(plays, "time_sid", "left")


@query("j4_dim_date")
def _(s):
    return warehouse.dim_date(_spine(s)).join(_daily(s), "date_sid", "left")


@query("j5_dim_time")
def _(s):
    plays = s.model("played").groupBy("time_sid").agg(F.count(F.lit(1)).alias("plays"))
    return s.model("dim_time").join(plays, "time_sid", "left")


@query("j10_surrogate_key")
def _(s):
    return s.history.select(
        surrogate_key("track_id", "artist_id", "duration_ms").alias("key"),
        surrogate_key("artist_mbid", F.lit("")).alias("padded_key"))


# ---- K reports

REPORTS = {
    "k6_geographic_data": ("geographic_data", "t a d", {}),
    "k9_track_count_by_geography": ("track_count_by_geography", "t a d", {}),
    "k9_track_count_filtered": (
        "track_count_by_geography", "t a d",
        dict(continents=CONTINENTS, countries=COUNTRIES, genres=GENRES)),
    "k10_genre_distribution": ("genre_distribution", "t a d", {}),
    "k10_genre_distribution_filtered": (
        "genre_distribution", "t a d", dict(continents=CONTINENTS, countries=COUNTRIES)),
    "k11_artists_by_geography": ("artists_by_geography", "t a d", {}),
    "k11_artists_by_geography_filtered": (
        "artists_by_geography", "t a d", dict(continents=CONTINENTS, genres=GENRES)),
    "k13_tracks_by_year": ("tracks_by_year", "t a d", {}),
    "k13_tracks_by_year_country": ("tracks_by_year", "t a d", dict(country_code=COUNTRY)),
    "k14_tracks_by_hour": ("tracks_by_hour", "t a d c", {}),
    "k14_tracks_by_hour_country": ("tracks_by_hour", "t a d c", dict(country_code=COUNTRY)),
    "k15_tracks_by_time_of_day": ("tracks_by_time_of_day", "t a d c", {}),
    "k17_tracks_by_year_and_genre": ("tracks_by_year_and_genre", "f g d", {}),
    "k17_tracks_by_year_and_genre_filtered": (
        "tracks_by_year_and_genre", "f g d", dict(genres=GENRES)),
    "k18_genre_distribution_with_artists": ("genre_distribution_with_artists", "f g d", {}),
    "k19_artists_by_genre": ("artists_by_genre", "f g a d", {}),
    "k19_artists_by_genre_filtered": (
        "artists_by_genre", "f g a d", dict(genres=GENRES, years=YEARS)),
    "k26_top_artist_in_top_genres": ("top_artist_in_top_genres", "f g a d", {}),
}
LETTERS = {"t": "fact_track_played", "f": "fact_artist_genre", "a": "dim_artist",
           "d": "dim_date", "c": "dim_time", "g": "dim_artist_genre"}


def run_report(s: Source, name: str) -> DataFrame:
    function, letters, params = REPORTS[name]
    frames = s.models(*[LETTERS[x] for x in letters.split()])
    return getattr(reports, function)(*frames, START, END, **params)


for _key in REPORTS:
    query(_key)(lambda s, k=_key: run_report(s, k))


@query("k1_last_24h_tracks")
def _(s):
    return s.recent()


@query("k2_artist_aggregates")
def _(s):
    return reports.artist_aggregates(s.recent(), reports.TOP_ARTISTS_24H)


@query("k3_tracks_for_artist")
def _(s):
    return reports.tracks_for_artist(s.recent(), ARTIST)


@query("k4_kpi_last_24h")
def _(s):
    return reports.kpi_last_24h(s.recent())


@query("k5_artist_detail")
def _(s):
    return reports.artist_detail(s.recent(), ARTIST)


@query("k7_continents")
def _(s):
    return reports.continents(s.model("dim_artist"))


@query("k8_countries_for_continents")
def _(s):
    return reports.countries_for_continents(s.model("dim_artist"), CONTINENTS)


@query("k12_country_codes")
def _(s):
    return reports.country_codes(s.model("dim_artist"))


@query("k16_genres")
def _(s):
    return reports.genres(s.model("dim_artist_genre"))


for _level in reports.MAP_LEVELS:
    query("k20_map_aggregate_" + _level.split("/")[0].lower())(
        lambda s, level=_level: reports.map_aggregate(run_report(s, "k6_geographic_data"), level))


@query("k20_map_aggregate_filtered")
def _(s):
    return reports.map_aggregate(
        run_report(s, "k6_geographic_data"), "Country", CONTINENTS, None, GENRES)


@query("k20_map_aggregate_all")
def _(s):
    return reports.map_aggregate_all(run_report(s, "k6_geographic_data"))


@query("k21_bubble_size")
def _(s):
    return reports.bubble_size(
        reports.map_aggregate(run_report(s, "k6_geographic_data"), "Country"))


@query("k22_genre_treemap_midpoint")
def _(s):
    return reports.genre_treemap_midpoint(run_report(s, "k18_genre_distribution_with_artists"))


@query("k23_selectable_years")
def _(s):
    return reports.selectable_years(run_report(s, "k17_tracks_by_year_and_genre_filtered"))


@query("k24_location_drilldown")
def _(s):
    return reports.location_drilldown(run_report(s, "k6_geographic_data"))


@query("k25_measures")
def _(s):
    return reports.measures(*s.models("fact_track_played", "fact_artist_genre"), START, END)


def _stored_cells(s, name: str, cells: DataFrame) -> DataFrame:
    base = s.scratch("cells")
    sinks.write_overwrite(cells, base, name)
    return tables.read_table(s.spark, base, name)


def _in_period():
    return F.col("date_sid").between(F.lit(START).cast("date"), F.lit(END).cast("date"))


@query("k25_measures_of_cells")
def _(s):
    """Plays, minutes and artists of a period, in some countries and in some genres there, from
    stored cells."""
    tracks, tagged, artist, genre = s.models(
        "fact_track_played", "fact_artist_genre", "dim_artist", "dim_artist_genre")
    cells = _stored_cells(s, "play_cells", reach.play_cells(tracks, artist))
    tags = _stored_cells(s, "genre_cells", reach.genre_cells(tagged, artist, genre))
    measured = ["plays", "minutes", "artists"]
    there = _in_period() & F.col("country_code").isin(CODES)
    whole, one = reach.measures_of(cells, _in_period()), reach.measures_of(cells, there)
    both = reach.measures_of(tags, there & F.col("genre").isin(GENRES))
    named = [x.select(F.lit(n).alias("selected"), *measured)
             for n, x in (("all", whole), ("countries", one), ("countries and genres", both))]
    return reduce(DataFrame.unionByName, named)


@query("k25_shared_artists")
def _(s):
    """Artists played in the period, outside of it, in both and in all."""
    cells = _stored_cells(s, "play_cells", reach.play_cells(
        *s.models("fact_track_played", "dim_artist")))
    return reach.shared_artists(cells, _in_period(), ~_in_period())


# ---- L streaming

def _stream_folder(s, df: DataFrame) -> DataFrame:
    """The rows written to a new folder and read back as a stream."""
    path = s.scratch("stream-in")
    df.write.parquet(path)
    return s.spark.readStream.schema(df.schema).parquet(path)


def _drained(s, stream: DataFrame) -> DataFrame:
    out = s.scratch("stream-out")
    streaming.run_available_now(stream, out, s.scratch("stream-check"))
    return s.spark.read.parquet(out)


def _closed(s, plays: DataFrame) -> DataFrame:
    """All plays as a stream that ends with a closing play."""
    path, last = s.scratch("stream-in"), plays.agg(F.max("played_at")).first()[0]
    plays.write.parquet(path)
    if last is not None:
        streaming.closing_play(plays, last + timedelta(days=3)).write.mode("append").parquet(path)
    return s.spark.readStream.schema(plays.schema).parquet(path)


@query("l1_stream_raw_plays")
def _(s):
    stream = streaming.stream_raw_plays(s.spark, s.raw_json() + "/*", glob=RAW_GLOB)
    return _drained(s, stream).select(*PLAY_FIELDS)


@query("l1_stream_ingest")
def _(s):
    """Raw files, one of them cut off, into the stored plays by one stream."""
    folder = s.raw_json()
    s.spark.range(1).select(F.lit('[{"track_id": "cut').alias("value")).write.text(
        f"{folder}/file_no=bad")
    base = s.scratch("tables")
    streaming.stream_ingest(s.spark, folder + "/*", base, s.scratch("stream-check"),
                            glob=RAW_GLOB).awaitTermination()
    return tables.read_table(s.spark, base, "tracks_played").select(*PLAY_FIELDS)


@query("l2_stream_dedup_exact")
def _(s):
    stream = _stream_folder(s, s.raw_plays)
    # which of several copies arrives first is open, so what tells them apart is left out
    return _drained(s, streaming.stream_dedup_exact(stream)).drop("seq")


@query("l3_stream_dedup_within_duration")
def _(s):
    stream = _closed(s, s.raw_plays)
    return _drained(s, streaming.stream_dedup_within_duration(stream, tie=TIE))


@query("l4_stream_upsert")
def _(s):
    """Three micro-batches: two parts of an update, then the first part once more."""
    base, path = s.scratch("tables"), s.scratch("stream-in")
    sinks.write_table(s.artist_rows, base, "spotify_artists")
    update = _artist_update(s)
    half = F.pmod(F.xxhash64("artist_id"), F.lit(2)) == 0
    check = s.scratch("stream-check")
    for part in (update.where(half), update.where(~half), update.where(half)):
        part.write.mode("append").parquet(path)
        stream = s.spark.readStream.schema(update.schema).parquet(path)
        streaming.stream_upsert(stream, base, "spotify_artists", check).awaitTermination()
    return tables.read_table(s.spark, base, "spotify_artists")


@query("l5_stream_plays_per_window")
def _(s):
    return _drained(s, streaming.stream_plays_per_window(_closed(s, s.plays)))


@query("l5_stream_plays_sliding_window")
def _(s):
    return _drained(s, streaming.stream_plays_per_window(
        _closed(s, s.plays), "24 hours", "1 hour"))


@query("l5_stream_sketched_windows")
def _(s):
    return _drained(s, streaming.stream_sketched_windows(
        _closed(s, s.plays), "24 hours", "1 hour"))


@query("l6_stream_enrich")
def _(s):
    stream = _stream_folder(s, s.plays)
    popularity = s.artist_rows.groupBy("artist_id").agg(
        F.max("artist_popularity").alias("artist_popularity"))
    return _drained(s, streaming.stream_enrich(stream, popularity, ["artist_popularity"])).select(
        "play_id", "artist_id", "played_at", "artist_popularity")

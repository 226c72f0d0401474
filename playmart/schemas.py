"""Table contracts as Spark DDL (fixed values: names and types of the stored tables)."""

RAW_PLAY = """
user_id string, track_id string, uri string, track_isrc string, track_name string,
album_id string, album_uri string, album string, artist_id string, artist_mbid string,
artist string, duration_ms double, played_at string, popularity double,
request_after string, play_source string
"""

TRACKS_PLAYED = """
user_id string, track_id string, track_uri string, track_isrc string, track_name string,
album_id string, album_uri string, album string, artist_id string, artist_mbid string,
artist string, duration_ms bigint, played_at timestamp, popularity bigint,
request_cursor string, play_source string
"""

# the consolidated snapshot keeps the raw column names
RECENTLY_PLAYED_CSV = """
user_id string, track_id string, uri string, track_isrc string, track_name string,
album_id string, album_uri string, album string, artist_id string, artist_mbid string,
artist string, duration_ms double, played_at timestamp, popularity double,
request_after string, play_source string
"""

RECENT_PAYLOAD = """
items array<struct<
  track: struct<id: string, uri: string, name: string, duration_ms: double, popularity: double,
    external_ids: struct<isrc: string>, artists: array<struct<id: string, name: string>>,
    album: struct<id: string, uri: string, name: string>>,
  context: struct<uri: string>, played_at: string>>
"""

LISTENS_PAYLOAD = """
payload struct<listens: array<struct<
  listened_at: bigint, user_name: string,
  track_metadata: struct<track_name: string, release_name: string, artist_name: string,
    additional_info: struct<submission_client: string, duration_ms: double>,
    mbid_mapping: struct<artist_mbids: array<string>>>>>>
"""

ALBUM_PAYLOAD = """
id string, name string, album_type string,
artists array<struct<id: string, name: string, type: string>>, genres array<string>,
label string, popularity bigint, release_date string, release_date_precision string,
total_tracks bigint
"""

SEEDS = {
    "integers": "int_val int",
    "mask_artists": "artist_id string, mask_name string",
    "unmapped_areas": "area string, country string",
}

NOT_FOUND = "artist_id string, artist string, track_isrc string, reason string, failed_at string"

# fixed values: columns of the staged area, artist and album tables
AREA_LEVELS = (
    "city", "country", "county", "district", "island", "municipality", "subdivision", "unknown",
)
AREA_HIERARCHY = (
    "area_id", "area_type", "area_name", "area_sort_name",
    *(f"{level}_{part}" for level in AREA_LEVELS for part in ("id", "name", "sort_name")),
    "continent", "country_code", "continent_code", "state_code", "params",
)
ARTIST_INFO = (
    "alias_count", "area_disambiguation", "area_id", "area_life_span_begin", "area_name",
    "area_sort_name", "begin_area_disambiguation", "begin_area_id", "begin_area_life_span_begin",
    "begin_area_name", "begin_area_sort_name", "country", "disambiguation", "end_area_id",
    "end_area_name", "end_area_sort_name", "gender", "id", "ipi", "life_span_begin",
    "life_span_end", "life_span_ended", "name", "release_group_count", "sort_name", "source_file",
    "tag_list", "type", "end_area_disambiguation", "spotify_id",
)
ALBUMS = (
    "album_type", "artist_id", "artist_name", "artist_type", "album_id", "label", "album_name",
    "popularity", "release_date", "release_date_precision", "total_tracks", "last_modified",
)

# fixed values: merge keys per stored table; any other table is merged by whole-row distinct
MERGE_KEYS = {
    "spotify_artists": ["artist_id"],
    "spotify_albums": ["album_id"],
    "spotify_artist_genre": ["artist_id", "genre"],
    "mbz_artist_info": ["id"],
    "mbz_area_hierarchy": ["area_id"],
    "mbz_artist_not_found": ["artist_id", "track_isrc"],
    "cities_with_lat_long": ["params"],
    "tracks_played": ["played_at", "track_id", "user_id"],
}

# fixed values: names of the stored tables
REQUIRED_TABLES = (
    "tracks_played", "spotify_artists", "spotify_albums", "spotify_artist_genre",
    "mbz_artist_info", "mbz_artist_genre", "mbz_area_hierarchy", "cities_with_lat_long",
)

VIEW_TABLES = (
    "tracks_played", "spotify_artists", "spotify_albums", "mbz_artist_info",
    "mbz_area_hierarchy", "cities_with_lat_long",
)

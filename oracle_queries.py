"""Comparison SQL for the named queries, written for DuckDB over the driver tables.

``VIEWS`` are the models as SQL, ``FINAL`` the query per name. ``oracle_sql`` prefixes a query
with the views it needs.
"""

from __future__ import annotations

import re

from playmart.plans import catalog as c
from playmart.plans.proxies import oracle_proxies

# fixed values, written out a second time: a changed constant of the package must show here
NULL_PART = "_dbt_utils_surrogate_key_null_"
NO_GENRE = "no genre defined"
ZONE = "America/Denver"
PLAY_COLUMNS = (
    "user_id", "track_id", "track_uri", "track_isrc", "track_name", "album_id", "album_uri",
    "album", "artist_id", "artist_mbid", "artist", "duration_ms", "played_at", "popularity",
    "request_cursor", "play_source",
)
AREA_COLUMNS = (
    "area_id", "area_type", "area_name", "area_sort_name", "city_id", "city_name",
    "city_sort_name", "country_id", "country_name", "country_sort_name", "county_id",
    "county_name", "county_sort_name", "district_id", "district_name", "district_sort_name",
    "island_id", "island_name", "island_sort_name", "municipality_id", "municipality_name",
    "municipality_sort_name", "subdivision_id", "subdivision_name", "subdivision_sort_name",
    "unknown_id", "unknown_name", "unknown_sort_name", "continent", "country_code",
    "continent_code", "state_code", "params",
)
INFO_COLUMNS = (
    "alias_count", "area_disambiguation", "area_id", "area_life_span_begin", "area_name",
    "area_sort_name", "begin_area_disambiguation", "begin_area_id", "begin_area_life_span_begin",
    "begin_area_name", "begin_area_sort_name", "country", "disambiguation", "end_area_id",
    "end_area_name", "end_area_sort_name", "gender", "id", "ipi", "life_span_begin",
    "life_span_end", "life_span_ended", "name", "release_group_count", "sort_name", "source_file",
    "tag_list", "type", "end_area_disambiguation", "spotify_id",
)
ALBUM_COLUMNS = (
    "album_type", "artist_id", "artist_name", "artist_type", "album_id", "label", "album_name",
    "popularity", "release_date", "release_date_precision", "total_tracks", "last_modified",
)
PLAYS = ", ".join(PLAY_COLUMNS)
LOCATION = ("continent_code, continent, country_code, country, state_province_code, "
            "state_province, county, city, district, lat, longitude")


def key(*parts: str) -> str:
    texts = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULL_PART}')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def band(value: str, classes, missing, pick: int, at_least: bool) -> str:
    """Label (1) or code (2) of the band a value falls in, looked up in a band table."""
    edge = -1e18 if at_least else 1e18
    rows = ", ".join(f"({edge if b is None else b}, '{label}', {code})"
                     for b, label, code in classes)
    column = ("label", "code")[pick - 1]
    best, test = ("max", ">=") if at_least else ("min", "<")
    found = (f"(SELECT arg_{best}({column}, edge) FROM (VALUES {rows}) t(edge, label, code) "
             f"WHERE {value} {test} edge)")
    none = f"'{missing[0]}'" if pick == 1 else missing[1]
    return f"coalesce({found}, {none})" if pick == 1 else f"CAST(coalesce({found}, {none}) AS BIGINT)"


def desc_all(columns: str) -> str:
    return ", ".join(f"{x.strip()} DESC NULLS LAST" for x in columns.split(","))


def mins(ms: str, unit: int, digits: int) -> str:
    return f"round(CAST({ms} AS FLOAT) / {unit}, {digits})"


# (border, label, code) of each band, and what stands for no value
ARTIST_BANDS = (
    ((90, "Extremely Popular", 6), (70, "Very Popular", 5), (50, "Popular", 4),
     (30, "Niche Popularity", 3), (10, "Mostly Unknown", 2), (None, "Not Popular", 1)),
    ("No Artist Popularity Data", 0))
TRACK_BANDS = (
    ((90, "Extremely Popular", 6), (70, "Very Popular", 5), (50, "Popular", 4), (30, "Niche", 3),
     (10, "Mostly Unknown", 2), (None, "Not Popular", 1)),
    ("No Track Popularity Data", 0))
LENGTH_BANDS = (
    ((30, "very short", 1), (180, "short", 2), (300, "average", 3), (420, "pretty long", 5),
     (600, "long", 6), (None, "possibly too long", 7)),
    ("unknown", 0))
HOUR_BANDS = (
    ((6, "Night", 1), (12, "Morning", 2), (18, "Afternoon", 3), (24, "Evening", 4)), ("", 0))

_GENRE_GROUP = ("CASE WHEN {rank} = n THEN 5.0 ELSE {rank} / (n / 5) + 1 END")
_LABEL = ("CASE {g} WHEN 1 THEN 'Group 1 (Most Played Genres)' "
          "WHEN 5 THEN 'Group 5 (Least Played Genres)' "
          "ELSE 'Group ' || CAST({g} AS VARCHAR) END")

VIEWS = {
    **oracle_proxies(),
    "o_plays": f"""
SELECT DISTINCT {PLAYS}, {mins('duration_ms', 60000, 0)} AS duration_mins,
    (played_at AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS played_at_local
FROM history""",
    "o_genre": "SELECT * FROM artist_genre WHERE artist_id IS NOT NULL",
    "o_city": """
SELECT city_name, country_code, params, CASE WHEN state_code <> '' THEN state_code END
    AS state_code, TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(long AS DOUBLE) AS longitude
FROM city_rows""",
    "o_albums": """
SELECT p.artist_id, p.album_id, p.artist, p.album,
    p.artist || ' - ' || ifnull(p.album, '') AS artist_album, s.label, s.total_tracks,
    max(s.popularity) AS album_popularity,
    TRY_CAST(substr(s.release_date || '-01-01', 1, 10) AS DATE) AS release_date,
    datepart('year', TRY_CAST(substr(s.release_date || '-01-01', 1, 10) AS DATE)) AS release_year,
    datepart('year', TRY_CAST(substr(s.release_date || '-01-01', 1, 10) AS DATE)) // 10 * 10
        AS release_decade,
    s.release_date_precision
FROM (SELECT artist, album, max(artist_id) AS artist_id, max(album_id) AS album_id
      FROM o_plays GROUP BY ALL) p
LEFT JOIN album_rows s USING (album_id)
GROUP BY ALL""",
    "o_area": """
SELECT area_id, area_type, area_name, area_sort_name, continent_code, continent,
    ifnull(country_id, island_id) AS country_id, country_code,
    ifnull(country_name, island_name) AS country_name, subdivision_id AS state_id,
    subdivision_name AS state_name, county_id, county_name,
    ifnull(city_id, municipality_id) AS city_id, ifnull(city_name, municipality_name) AS city_name,
    district_id, district_name, params
FROM area_rows""",
    "o_located": """
SELECT i.spotify_id AS artist_id, i.id AS artist_mbid, i.name AS artist_name, a.continent_code,
    a.continent, a.country_code, a.country_name AS country, g.state_code AS state_province_code,
    a.state_name AS state_province, a.county_name AS county, a.city_name AS city,
    a.district_name AS district, g.lat, g.longitude
FROM info_rows i
JOIN o_area a ON a.area_id = ifnull(i.area_id, ifnull(i.end_area_id, i.begin_area_id))
LEFT JOIN o_city g USING (params)""",
    "o_genre_rank": """
SELECT g.*, t.genre_total, row_number() OVER (PARTITION BY g.artist_id
    ORDER BY t.genre_total DESC, g.genre NULLS LAST, g.artist_name NULLS LAST)
    AS artist_genre_rank
FROM o_genre g JOIN (SELECT genre, count(*) AS genre_total FROM o_genre GROUP BY genre) t
    ON t.genre IS NOT DISTINCT FROM g.genre""",
    "o_top_genre": f"""
SELECT artist_id, artist_name, ifnull(genre, '{NO_GENRE}') AS primary_genre
FROM o_genre_rank WHERE artist_genre_rank = 1""",
    "o_distinct": """
SELECT artist_id, artist_name, max(artist_mbid) AS artist_mbid,
    max(artist_popularity) AS artist_popularity
FROM artist_rows GROUP BY ALL""",
    "o_credits": """
SELECT artist AS artist_name, artist_mbid, count(*) AS count_played,
    regexp_replace(artist, ',|feat\\.|\\[|\\(| & ', '|', 'g') AS marked
FROM history WHERE artist_id IS NULL GROUP BY ALL""",
    "o_prep": """
SELECT artist_name, artist_mbid, trim(split_part(marked, '|', 1)) AS potential_match, count_played
FROM o_credits WHERE trim(split_part(marked, '|', 1)) <> ''
UNION
SELECT artist_name, artist_mbid, artist_name, count_played
FROM o_credits WHERE NOT contains(marked, '|')""",
    "o_unmatched": f"""
SELECT artist_name, artist_mbid, potential_match, count_played FROM o_prep
QUALIFY row_number() OVER (PARTITION BY artist_name
    ORDER BY {desc_all('count_played, artist_mbid, potential_match')}) = 1""",
    "o_artists": f"""
SELECT artist_id, artist_mbid, artist_name, artist_popularity, primary_genre, {LOCATION}
FROM (SELECT d.artist_id, d.artist_mbid, d.artist_name, d.artist_popularity, t.primary_genre,
          {LOCATION}
      FROM o_distinct d LEFT JOIN o_top_genre t ON t.artist_id = d.artist_id
      LEFT JOIN o_located l ON l.artist_id = d.artist_id) known
QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY
    {desc_all('artist_popularity, country_code, artist_name, artist_mbid,' + LOCATION)}) = 1
UNION ALL
SELECT NULL, artist_mbid, artist_name, NULL, NULL, {LOCATION}
FROM (SELECT u.artist_mbid, u.artist_name, u.count_played, {LOCATION}
      FROM o_unmatched u LEFT JOIN o_located l ON l.artist_mbid = u.artist_mbid) other
QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY
    {desc_all('count_played, country_code, artist_mbid,' + LOCATION)}) = 1""",
    "o_tagged": """
SELECT p.artist, p.duration_ms, p.artist_id, a.artist_popularity, g.genre
FROM o_plays p LEFT JOIN artist_rows a ON a.artist_id = p.artist_id
LEFT JOIN o_genre g ON g.artist_id = p.artist_id""",
    "o_genre_artist": """
SELECT genre, artist_id, artist, artist_popularity, count(*) AS plays FROM o_tagged GROUP BY ALL""",
    "o_genre_stats": f"""
SELECT ifnull(s.genre, '{NO_GENRE}') AS genre, t.artist AS top_artist_in_genre,
    m.artist AS most_popular_artist_in_genre, s.total_tracks_played_in_genre,
    s.total_ms_played_in_genre
FROM (SELECT genre, count(*) AS total_tracks_played_in_genre,
          CAST(sum(duration_ms) AS BIGINT) AS total_ms_played_in_genre
      FROM o_tagged GROUP BY genre) s
JOIN (SELECT genre, artist FROM o_genre_artist QUALIFY row_number() OVER (
          PARTITION BY genre ORDER BY plays DESC, artist DESC NULLS LAST) = 1) t
    ON t.genre IS NOT DISTINCT FROM s.genre
JOIN (SELECT genre, artist FROM o_genre_artist QUALIFY row_number() OVER (PARTITION BY genre
          ORDER BY artist_popularity DESC NULLS LAST, artist DESC NULLS LAST) = 1) m
    ON m.genre IS NOT DISTINCT FROM s.genre""",
    "o_ranked_base": """
SELECT *, row_number() OVER (ORDER BY total_tracks_played_in_genre DESC, genre) AS by_plays,
    row_number() OVER (ORDER BY total_ms_played_in_genre DESC NULLS LAST, genre) AS by_time,
    count(*) OVER () AS n
FROM o_genre_stats""",
    "o_ranked": f"""
SELECT genre, top_artist_in_genre, most_popular_artist_in_genre,
    by_plays AS rank_by_tracks_played, {_GENRE_GROUP.format(rank='by_plays')} AS tracks_grouping,
    total_tracks_played_in_genre, by_time AS rank_by_time_played,
    {_GENRE_GROUP.format(rank='by_time')} AS time_grouping, total_ms_played_in_genre
FROM o_ranked_base""",
    "o_dim_genre": f"""
SELECT {key('genre', "''")} AS genre_sid, genre, top_artist_in_genre,
    most_popular_artist_in_genre, rank_by_tracks_played, tracks_grouping,
    {_LABEL.format(g='tracks_grouping')} AS group_by_tracks_played, total_tracks_played_in_genre,
    rank_by_time_played, time_grouping, {_LABEL.format(g='time_grouping')} AS group_by_time_played,
    {mins('ifnull(total_ms_played_in_genre, 0)', 60000, 2)} AS total_minutes_played_in_genre
FROM o_ranked""",
    "o_played": """
SELECT p.track_id, p.track_name, p.artist, p.artist_id, p.album_id, p.album, p.request_cursor,
    p.played_at, p.played_at_local, CAST(p.played_at_local AS DATE) AS date_sid,
    CAST(floor(epoch(p.played_at_local)) AS BIGINT) % 86400 AS time_sid, p.popularity,
    a.artist_popularity, p.duration_ms, p.duration_mins, CAST(1 AS BIGINT) AS tracks_played
FROM o_plays p LEFT JOIN o_artists a ON a.artist_id = p.artist_id""",
    "o_fact": f"""
SELECT {key('track_id', 'track_name', 'artist')} AS track_sid,
    {key('artist_id', 'artist')} AS artist_sid, {key('album_id', 'album', 'artist')} AS album_sid,
    artist AS artist_name, request_cursor, date_sid, time_sid, popularity, artist_popularity,
    duration_ms, duration_mins, tracks_played
FROM o_played""",
    "o_fact_genre": f"""
SELECT {key('track_id', 'track_name', 'artist',
            "strftime(played_at, '%Y-%m-%d %H:%M:%S.%f')")} AS track_played_uid,
    {key('track_id', 'track_name', 'artist')} AS track_sid,
    {key('p.artist_id', 'artist')} AS artist_sid,
    {key('album_id', 'album', 'artist')} AS album_sid, {key('genre', "''")} AS genre_sid,
    date_sid, time_sid, popularity, duration_ms, duration_mins
FROM o_played p LEFT JOIN o_genre g ON g.artist_id = p.artist_id""",
    "o_dim_artist": f"""
SELECT {key('a.artist_id', 'a.artist_name')} AS artist_sid,
    ifnull(m.mask_name, a.artist_name) AS artist_name, a.artist_popularity,
    {band('a.artist_popularity', *ARTIST_BANDS, 1, True)} AS artist_popularity_group,
    {band('a.artist_popularity', *ARTIST_BANDS, 2, True)} AS artist_popularity_sort,
    CASE WHEN a.artist_popularity >= 50 THEN 'Popular'
         WHEN a.artist_popularity IS NOT NULL THEN 'Not Popular'
         ELSE 'No Artist Popularity Data' END AS is_popular,
    ifnull(a.primary_genre, '{NO_GENRE}') AS primary_genre, {LOCATION}
FROM o_artists a LEFT JOIN mask_rows m ON m.artist_id = a.artist_id""",
    "o_tracks": f"""
SELECT max(track_id) AS track_id, max(track_isrc) AS track_isrc, track_name, artist,
    max(popularity) AS track_popularity, max(duration_ms) AS track_duration_ms,
    {mins('max(duration_ms)', 1000, 0)} AS track_duration_sec,
    {mins('max(duration_ms)', 60000, 0)} AS track_duration_min,
    max(duration_ms) % 86400000 AS track_duration
FROM history GROUP BY track_name, artist""",
    "o_days": f"""
SELECT CAST(unnest(generate_series(DATE '{c.SPINE_START}', DATE '{c.SPINE_END}',
    INTERVAL 1 DAY)) AS DATE) AS "date" """,
    "o_daily": "SELECT date_sid, count(*) AS plays FROM o_played_all GROUP BY date_sid",
    "o_played_all": f"""
SELECT CAST((played_at AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS DATE) AS date_sid
FROM history""",
    "o_spine": """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_sid
FROM (SELECT min(date_sid) AS lo, max(date_sid) + 30 AS hi FROM o_played_all) b""",
    "o_seconds": """
SELECT s AS time_sid, count(p.track_id) AS n
FROM range(0, 86400) t(s) LEFT JOIN o_played p ON p.time_sid = s GROUP BY s""",
    "o_recent_all": f"""
SELECT user_id, track_id, track_uri AS uri, track_isrc, track_name, album_id, album_uri, album,
    artist_id, artist_mbid, artist, CAST(duration_ms AS DOUBLE) AS duration_ms, played_at,
    CASE WHEN ifnull(popularity, 0) = 0 THEN '--' ELSE CAST(popularity AS VARCHAR) || '/100' END
        AS popularity,
    request_cursor AS request_after, play_source, {mins('duration_ms', 60000, 2)} AS minutes_played
FROM plays""",
    "o_recent": f"""
SELECT user_id, track_id, track_name, artist, artist_id, album, duration_ms, minutes_played,
    played_at, popularity, play_source
FROM o_recent_all WHERE played_at >= TIMESTAMP '{c.NOW}' - INTERVAL 24 HOUR""",
    # report bases: play rows with their dimension columns
    "o_report": f"""
SELECT f.track_sid, f.time_sid, year(d."date") AS year_num, a.*
FROM o_fact f JOIN o_days d ON d."date" = f.date_sid
JOIN o_dim_artist a ON a.artist_sid = f.artist_sid
WHERE d."date" BETWEEN DATE '{c.START}' AND DATE '{c.END}'""",
    "o_report_genre": f"""
SELECT f.track_sid, f.artist_sid, g.genre, g.top_artist_in_genre, g.most_popular_artist_in_genre,
    year(d."date") AS year_num
FROM o_fact_genre f JOIN o_days d ON d."date" = f.date_sid
JOIN o_dim_genre g ON g.genre_sid = f.genre_sid
WHERE d."date" BETWEEN DATE '{c.START}' AND DATE '{c.END}' AND g.genre <> '{NO_GENRE}'""",
    "o_geo": """
SELECT artist_name, continent, country, state_province, city, lat, longitude, primary_genre,
    count(*) AS track_count
FROM o_report WHERE country IS NOT NULL GROUP BY artist_sid, ALL""",
    "o_top_genres": """
SELECT genre, count(*) AS track_count, top_artist_in_genre AS top_artist,
    most_popular_artist_in_genre AS most_popular_artist
FROM o_report_genre GROUP BY ALL ORDER BY track_count DESC, genre LIMIT 25""",
    # de-duplication
    "o_exact": """
SELECT * FROM raw_plays
QUALIFY row_number() OVER (PARTITION BY track_id, played_at ORDER BY seq, play_id) = 1""",
    "o_exact_masked": """
SELECT * REPLACE (CASE WHEN artist_id <> '3' THEN artist END AS artist) FROM raw_plays
QUALIFY row_number() OVER (PARTITION BY track_id, played_at ORDER BY seq, play_id) = 1""",
    # area tree
    "o_steps": """
SELECT child, parent, row_number() OVER (PARTITION BY child ORDER BY parent) AS place
FROM (SELECT DISTINCT child, parent FROM area_edges) e""",
    "o_closure": """
SELECT root_id, area_id, min(visit) AS visit FROM (
    WITH RECURSIVE up(root_id, area_id, visit, seen) AS (
        SELECT area_id, area_id, CAST([] AS BIGINT[]), [area_id] FROM area_nodes
        UNION ALL
        SELECT up.root_id, e.parent, list_append(up.visit, e.place),
            list_append(up.seen, e.parent)
        FROM up JOIN o_steps e ON e.child = up.area_id WHERE NOT list_contains(up.seen, e.parent))
    SELECT * FROM up) x
GROUP BY ALL""",
    "o_closure_named": """
SELECT x.root_id, x.visit, n.area_id, n.name, ifnull(n.sort_name, n.name) AS sort_name,
    ifnull(n.type, 'Unknown') AS type,
    translate(lower(ifnull(n.type, 'Unknown')), ' -', '__') AS level
FROM o_closure x JOIN area_nodes n ON n.area_id = x.area_id""",
    "o_levels": """
SELECT * FROM o_closure_named
QUALIFY row_number() OVER (PARTITION BY root_id, level ORDER BY visit DESC) = 1""",
}
VIEWS["o_geo"] = """
SELECT artist_sid, artist_name, continent, country, state_province, city, lat, longitude,
    primary_genre, count(*) AS track_count
FROM o_report WHERE country IS NOT NULL GROUP BY ALL"""


def near(source: str, extra: str = "*") -> str:
    """Plays not inside the duration of the play before; whole elapsed seconds."""
    return f"""
SELECT {extra} FROM (
    SELECT *, lag(played_at) OVER w AS before_at, lag(duration_ms) OVER w AS before_ms,
    FROM {source} WINDOW w AS (PARTITION BY track_name, artist ORDER BY played_at, seq, play_id)) x
WHERE before_at IS NULL OR before_ms IS NULL
    OR date_sub('second', before_at, played_at) > before_ms / 1000"""


def plays_per(column: str, where: str = "TRUE") -> str:
    return (f"SELECT {column}, count(*) AS track_count FROM o_report "
            f"WHERE artist_name IS NOT NULL AND {where} GROUP BY ALL")


def listed(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


IN_CONTINENTS = f"continent IN ({listed(c.CONTINENTS)})"
IN_COUNTRIES = f"country IN ({listed(c.COUNTRIES)})"
IN_GENRES = f"genre IN ({listed(c.GENRES)})"
IN_PRIMARY = f"primary_genre IN ({listed(c.GENRES)})"
HOUR = "CAST(time_sid // 3600 AS BIGINT)"
_MERGED_ARTISTS = """
SELECT artist_id, artist_name, {mbid} artist_popularity, CAST(NULL AS BOOLEAN) AS checked
FROM artist_rows WHERE artist_id NOT IN (
    SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 4000)
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name || ' (new)', {null} CAST(floor(s_acctbal) / 100 AS FLOAT),
    TRUE
FROM supplier WHERE s_acctbal > 4000"""


def top(base: str, columns: str, n: int, where: str = "TRUE", by: str = "") -> str:
    order = by or columns
    return (f"SELECT {columns}, count(*) AS track_count FROM {base} WHERE {where} "
            f"GROUP BY {columns} ORDER BY track_count DESC, {order} LIMIT {n}")


def _artist_top(where: str = "TRUE") -> str:
    return f"""
SELECT artist_name, track_count FROM (
    SELECT artist_sid, artist_name, count(*) AS track_count FROM o_report WHERE {where}
    GROUP BY ALL) x
ORDER BY track_count DESC, artist_name NULLS LAST, artist_sid LIMIT 25"""


def _artist_genre_max(where: str = "TRUE") -> str:
    return f"""
SELECT artist_name, max(n) AS track_count FROM (
    SELECT a.artist_sid, a.artist_name, r.genre, count(*) AS n
    FROM o_report_genre r JOIN o_dim_artist a USING (artist_sid) WHERE {where} GROUP BY ALL) x
GROUP BY artist_name ORDER BY track_count DESC, artist_name NULLS LAST LIMIT 15"""


def _map(columns: str) -> str:
    return (f"SELECT {columns}, CAST(sum(track_count) AS BIGINT) AS total_tracks, "
            f"avg(lat) AS lat, avg(longitude) AS longitude FROM o_geo GROUP BY {columns}")


def _levels() -> str:
    def level(name: str, has: list[str], group: str, lat: str, lon: str) -> str:
        columns = ", ".join(x if x in has else f"CAST(NULL AS VARCHAR) AS {x}"
                            for x in ("continent", "country", "state_province", "city"))
        return (f"SELECT '{name}' AS level, {columns}, {lat} AS lat, {lon} AS longitude, "
                f"CAST(sum(track_count) AS BIGINT) AS total_tracks FROM o_geo GROUP BY {group}")
    mean = ("avg(lat)", "avg(longitude)")
    return " UNION ALL ".join([
        level("City", ["country", "state_province", "city"],
              "lat, longitude, country, state_province, city", "lat", "longitude"),
        level("State/Province", ["country", "state_province"], "country, state_province", *mean),
        level("Country", ["country"], "country", *mean),
        level("Continent", ["continent"], "continent", *mean)])


def _area_levels() -> str:
    levels = ("city", "country", "county", "district", "island", "municipality", "subdivision",
              "unknown")
    parts = (("area_id", "id"), ("name", "name"), ("sort_name", "sort_name"))
    return ", ".join(f"max(l.{source}) FILTER (l.level = '{level}') AS {level}_{part}"
                     for level in levels for source, part in parts)


def _windows(slide_hours: int, length_hours: int) -> str:
    steps = length_hours // slide_hours
    return f"""
SELECT w AS window_start, w + INTERVAL {length_hours} HOUR AS window_end, count(*) AS plays,
    CAST(sum(CAST(m AS DECIMAL(18, 2))) AS DOUBLE) AS minutes, count(DISTINCT artist) AS artists
FROM (SELECT date_trunc('hour', played_at) - to_hours(CAST(k * {slide_hours} AS BIGINT)) AS w,
          {mins('duration_ms', 60000, 2)} AS m, artist
      FROM plays CROSS JOIN range(0, {steps}) t(k)) x
GROUP BY w"""


# the columns of the consolidated snapshot
SNAPSHOT = """user_id, track_id, track_uri AS uri, track_isrc, track_name, album_id, album_uri, album,
    artist_id, artist_mbid, artist, CAST(duration_ms AS DOUBLE) AS duration_ms, played_at,
    CAST(popularity AS DOUBLE) AS popularity, request_cursor AS request_after, play_source"""

FINAL = {
    # A
    "a1_read_raw_plays": f"SELECT {PLAYS} FROM plays",
    "a2_read_table": "SELECT * FROM history",
    "a3_register_views": """
SELECT h.*, a.artist_name, a.artist_popularity
FROM history h JOIN artist_rows a ON a.artist_id = h.artist_id""",
    "a4_read_recently_played_csv": f"SELECT {SNAPSHOT} FROM plays",
    "a5_read_seed": "SELECT * FROM mask_rows",
    "a6_report_extract_views": """
SELECT 'track_plays' AS extract, date_sid, count(*) AS plays FROM o_fact GROUP BY date_sid
UNION ALL
SELECT 'artist_genre_plays', date_sid, count(*) FROM o_fact_genre GROUP BY date_sid""",
    # B
    "b1_flatten_recently_played": """
SELECT 'listener' AS user_id, track_id, track_uri AS uri, track_isrc, track_name, album_id,
    album_uri, album, artist_id, CAST(NULL AS VARCHAR) AS artist_mbid,
    CASE WHEN play_source <> 'error' THEN artist END AS artist,
    CAST(duration_ms AS DOUBLE) AS duration_ms,
    strftime(date_trunc('millisecond', played_at), '%Y-%m-%dT%H:%M:%S.%gZ') AS played_at,
    CAST(ifnull(popularity, 0) AS DOUBLE) AS popularity, '17' AS request_after,
    CASE WHEN play_source = 'view' THEN 'spotify' ELSE 'ctx:' || play_source END AS play_source
FROM plays WHERE play_source <> 'signup'""",
    "b2_flatten_listens": """
SELECT user_id, CAST(NULL AS VARCHAR) AS track_id, CAST(NULL AS VARCHAR) AS uri,
    CAST(NULL AS VARCHAR) AS track_isrc, track_name, CAST(NULL AS VARCHAR) AS album_id,
    CAST(NULL AS VARCHAR) AS album_uri, album, CAST(NULL AS VARCHAR) AS artist_id, artist_mbid,
    artist, CAST(duration_ms AS DOUBLE) AS duration_ms,
    strftime(played_at, '%Y-%m-%dT%H:%M:%S+00:00') AS played_at,
    CAST(NULL AS DOUBLE) AS popularity,
    CAST(CAST(floor(epoch(played_at)) AS BIGINT) * 1000 AS VARCHAR) AS request_after,
    'navidrome' AS play_source
FROM plays WHERE play_source <> 'click' AND duration_ms >= 4000""",
    "b3_flatten_albums": f"""
SELECT album_type, CASE WHEN release_date IS NOT NULL THEN artist_id END AS artist_id,
    CASE WHEN release_date IS NOT NULL THEN artist_name END AS artist_name,
    CASE WHEN release_date IS NOT NULL THEN artist_type END AS artist_type,
    CASE WHEN popularity = 50 THEN label ELSE '' END AS genres, album_id, label, album_name,
    popularity, release_date, release_date_precision, total_tracks,
    TIMESTAMP '{c.NOW}' AS last_modified
FROM album_rows""",
    "b4_conform_artists": """
SELECT CAST(s_suppkey AS VARCHAR) AS artist_id, s_name AS artist_name,
    CAST(NULL AS VARCHAR) AS artist_mbid, CAST(floor(s_acctbal) AS FLOAT) AS artist_popularity
FROM supplier""",
    "b5_parse_played_at": """
SELECT play_id, CASE play_source WHEN 'view' THEN date_trunc('millisecond', played_at)
    WHEN 'click' THEN date_trunc('second', played_at)
    WHEN 'error' THEN date_trunc('second', played_at)
    WHEN 'signup' THEN date_trunc('second', played_at) + INTERVAL 7 HOUR END AS played_at
FROM plays""",
    "b6_high_water_mark": """
SELECT 'ms' AS unit, epoch_us(max(played_at)) // 1000 + 1 AS "cursor" FROM plays
UNION ALL SELECT 's', CAST(floor(epoch(max(played_at))) AS BIGINT) FROM plays""",
    "b6_newer_than": """
SELECT play_id, played_at FROM plays WHERE played_at > TIMESTAMP '2024-01-15 00:00:00'""",
    "b7_append_plays": """
SELECT *, CAST(NULL AS VARCHAR) AS note FROM history
UNION ALL BY NAME
SELECT * EXCLUDE (play_id) REPLACE (CAST(NULL AS VARCHAR) AS track_isrc),
    CAST(NULL AS VARCHAR) AS note FROM plays""",
    "b8_ingest_raw_plays": f"SELECT {PLAYS} FROM plays",
    "b6_ingest_newer": f"SELECT {PLAYS} FROM plays",
    # C
    "c1_dedup_exact": "SELECT * FROM o_exact",
    "c2_require_play_identity": "SELECT * FROM raw_plays WHERE play_source <> 'error'",
    "c3_dedup_within_duration": near("raw_plays", "* EXCLUDE (before_at, before_ms)"),
    "c3_dedup_plays": near("o_exact", "* EXCLUDE (before_at, before_ms)"),
    "c4_dedup_audit": f"""
SELECT a AS rows_in, a - b AS exact_removed, b - k AS null_removed, k - z AS near_removed,
    a - z AS total_removed, z AS rows_out
FROM (SELECT (SELECT count(*) FROM raw_plays) AS a, (SELECT count(*) FROM o_exact_masked) AS b,
          (SELECT count(*) FROM o_exact_masked WHERE artist IS NOT NULL) AS k,
          (SELECT count(*) FROM ({near('(SELECT * FROM o_exact_masked WHERE artist IS NOT NULL)')})
          ) AS z) x""",
    "c5_consolidate_plays": f"""
SELECT {SNAPSHOT} FROM ({near("(SELECT *, track_id AS seq FROM plays)")}) y""",
    "c6_deduplicate_with_priority": """
SELECT track_id, duration_ms, play_id FROM plays QUALIFY row_number() OVER (
    PARTITION BY track_id ORDER BY duration_ms DESC NULLS LAST, play_id DESC) = 1""",
    "c6_deduplicate_ascending": """
SELECT artist, min(duration_ms) AS duration_ms,
    ifnull(min(track_id) FILTER (duration_ms = low), min(track_id)) AS track_id
FROM (SELECT artist, duration_ms, track_id, min(duration_ms) OVER (PARTITION BY artist) AS low
      FROM history) x GROUP BY artist""",
    "c6_deduplicate_distinct": "SELECT DISTINCT artist, album FROM history",
    # D
    "d1_missing_artists": """
SELECT DISTINCT artist_id, artist FROM history ANTI JOIN artist_rows USING (artist_id)
WHERE artist_id IS NOT NULL""",
    "d1_missing_artists_page": """
SELECT DISTINCT artist_id, artist FROM history ANTI JOIN artist_rows USING (artist_id)
WHERE artist_id IS NOT NULL ORDER BY artist, artist_id LIMIT 3 OFFSET 2""",
    "d2_missing_albums": """
SELECT album_id, count(*) AS play_count FROM history ANTI JOIN album_rows USING (album_id)
GROUP BY album_id""",
    "d3_missing_catalog_artists": f"""
SELECT artist_id, artist, min(track_isrc) AS track_isrc FROM plays
WHERE played_at >= TIMESTAMP '{c.NOW}' - INTERVAL 48 HOUR AND track_isrc IS NOT NULL
    AND artist_id IS NOT NULL
    AND artist_id NOT IN (SELECT spotify_id FROM info_rows WHERE spotify_id IS NOT NULL)
GROUP BY ALL""",
    "d4_missing_catalog_artists_with_popularity": f"""
SELECT artist_id, artist, min(track_isrc) AS track_isrc, max(popularity) AS max_popularity
FROM plays
WHERE played_at >= TIMESTAMP '{c.NOW}' - INTERVAL 48 HOUR AND track_isrc IS NOT NULL
    AND NOT EXISTS (FROM info_rows i WHERE i.spotify_id = artist_id)
GROUP BY ALL""",
    "d5_cities_needing_coordinates": """
SELECT DISTINCT params, city_name, country_code, country_name FROM area_rows
WHERE params <> '' AND params NOT IN (SELECT params FROM city_rows)""",
    "d6_missing_count": f"""
SELECT 'artists' AS entity, count(DISTINCT artist_id) AS "count"
FROM history WHERE artist_id NOT IN (SELECT artist_id FROM artist_rows)
UNION ALL
SELECT 'albums', count(DISTINCT album_id) FROM history
WHERE album_id NOT IN (SELECT album_id FROM album_rows)
UNION ALL
SELECT 'mbz_artists', count(DISTINCT artist_id) FROM plays
WHERE played_at >= TIMESTAMP '{c.NOW}' - INTERVAL 48 HOUR AND track_isrc IS NOT NULL
    AND artist_id NOT IN (SELECT spotify_id FROM info_rows WHERE spotify_id IS NOT NULL)
UNION ALL
SELECT 'cities', count(DISTINCT params) FROM area_rows
WHERE params <> '' AND params NOT IN (SELECT params FROM city_rows)""",
    "d7_check_exists": """
SELECT h.artist_id, EXISTS (FROM artist_rows a WHERE a.artist_id = h.artist_id) AS "exists"
FROM (SELECT DISTINCT artist_id FROM history) h""",
    "d8_areas_without_continent": """
SELECT area_id, continent FROM area_rows WHERE ifnull(continent, '') IN ('', 'Unknown')""",
    "d9_areas_needing_coordinates": """
SELECT area_id, params FROM area_rows
WHERE params IS NOT NULL AND params NOT IN (SELECT params FROM city_rows)""",
    "d10_countries_needing_enrichment": """
SELECT DISTINCT ifnull(country_name, island_name) AS country_name FROM area_rows
WHERE ifnull(continent, 'Unknown') = 'Unknown' AND ifnull(country_name, island_name) IS NOT NULL""",
    "d11_area_ids_to_process": """
SELECT area_id FROM info_rows WHERE area_id IS NOT NULL
UNION SELECT begin_area_id FROM info_rows UNION
SELECT end_area_id FROM info_rows WHERE end_area_id IS NOT NULL
EXCEPT SELECT area_id FROM area_rows WHERE area_type = 'Country'""",
    "d12_assign_batches": """
SELECT play_id, played_at, (r - 1) // 70 AS batch_index, (r - 1) // 70 * 70 AS batch_offset,
    count(*) OVER (PARTITION BY (r - 1) // 70) AS batch_size
FROM (SELECT play_id, played_at, row_number() OVER (ORDER BY played_at, play_id) AS r
      FROM plays) x""",
    "d13_track_failures": f"""
WITH f AS (SELECT DISTINCT artist_id, artist, track_isrc, play_source = 'view' AS named
           FROM plays WHERE track_isrc IS NOT NULL)
SELECT artist_id, artist, track_isrc, 'lookup failed' AS reason, '2024-01-01' AS failed_at
FROM f WHERE named AND NOT EXISTS (
    FROM f o WHERE NOT o.named AND o.artist_id = f.artist_id AND o.track_isrc = f.track_isrc)
UNION ALL
SELECT artist_id, artist, track_isrc, 'Unknown failure', '{c.NOW}' FROM f WHERE NOT named""",
    # E
    "e1_write_overwrite": "SELECT * FROM history",
    "e2_write_append": """
SELECT *, CAST(NULL AS VARCHAR) AS play_id FROM history UNION ALL BY NAME SELECT * FROM plays""",
    "e3_upsert": _MERGED_ARTISTS.format(mbid="artist_mbid,", null="NULL,"),
    "e3_write_merge": _MERGED_ARTISTS.format(mbid="artist_mbid,", null="NULL,"),
    "e3_upsert_plays_by_day": """
SELECT * REPLACE (CASE WHEN played_at >= TIMESTAMP '2024-01-20' THEN 1 ELSE popularity END
        AS popularity),
    CASE WHEN play_source <> 'error' THEN CAST(played_at AS DATE) END AS day
FROM plays""",
    "e4_upsert_without_keys": """
SELECT * FROM artist_genre UNION
SELECT artist_id, artist_name, upper(genre) FROM artist_genre""",
    "e5_align_schema": "SELECT *, 'float' AS type FROM artist_rows",
    "e7_harmonize_schemas": """
SELECT s_name, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS p_name,
    CAST(NULL AS VARCHAR) AS label FROM supplier
UNION ALL SELECT NULL, NULL, p_name, NULL FROM part""",
    "e8_table_info": f"""
SELECT 'tracks_played' AS "table", TRUE AS "exists", count(*) AS record_count,
    (SELECT string_agg(column_name, ',') FROM (DESCRIBE SELECT * FROM history)) AS columns,
    (SELECT string_agg(CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END,
        ',') FROM (DESCRIBE SELECT * FROM history)) AS types,
    TRUE AS has_files, TRUE AS has_bytes
FROM history""",
    "e9_write_csv_snapshot": f"""
SELECT {SNAPSHOT} FROM plays""",
    "e10_validate_tables": """
SELECT t AS "table", n IS NOT NULL AS "exists", ifnull(n, 0) AS row_count, FALSE AS all_valid
FROM (VALUES ('tracks_played', (SELECT count(*) FROM history)),
    ('spotify_artists', (SELECT count(*) FROM artist_rows)),
    ('spotify_albums', (SELECT count(*) FROM album_rows)), ('spotify_artist_genre', NULL),
    ('mbz_artist_info', NULL), ('mbz_artist_genre', NULL), ('mbz_area_hierarchy', NULL),
    ('cities_with_lat_long', NULL)) x(t, n)""",
    "e11_check_column_consistency": """
SELECT column_name, a.n IS NOT NULL AND b.n IS NOT NULL AS in_both, FALSE AS columns_match,
    (SELECT count(*) FROM o_fact) AS stored_rows, (SELECT count(*) FROM o_fact_genre) AS model_rows
FROM (SELECT unnest(['track_sid', 'artist_sid', 'album_sid', 'artist_name', 'request_cursor',
          'date_sid', 'time_sid', 'popularity', 'artist_popularity', 'duration_ms',
          'duration_mins', 'tracks_played']) AS column_name, 1 AS n) a
FULL JOIN (SELECT unnest(['track_played_uid', 'track_sid', 'artist_sid', 'album_sid', 'genre_sid',
          'date_sid', 'time_sid', 'popularity', 'duration_ms', 'duration_mins']) AS column_name,
          1 AS n) b USING (column_name)""",
    # F
    "f1_normalize_artist_json": """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, n_name AS area_name,
    CAST(n_nationkey AS VARCHAR) AS life_span_begin,
    '[{"name":"' || lower(n_name) || '"}]' AS tag_list, s_name AS sort_name
FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "f1_read_artist_json": """
SELECT CAST(n_nationkey AS VARCHAR) AS id, any_value(n_name) AS name,
    CAST(any_value(n_regionkey) AS VARCHAR) AS area_id,
    nullif(count(s_suppkey), 0) AS suppliers
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey""",
    "f2_conform_to_table": """
SELECT '5' AS alias_count, id, name, '["' || gender || '","' || country || '"]' AS tag_list,
    CAST(NULL AS VARCHAR) AS type
FROM info_rows""",
    "f3_flatten_json_column": """
SELECT event_id, props, json_extract_string(props, '$.k') AS prop_k FROM events""",
    "f3_flatten_json_discovered": """
SELECT p_partkey, '{"item-size":' || CAST(p_size AS VARCHAR) || ',"brand":"' || p_brand || '"}'
    AS j, p_brand AS brand, CAST(p_size AS VARCHAR) AS item_size
FROM part""",
    "f4_json_extract": """
SELECT event_id, props, json_extract_string(props, '$.k') AS extracted FROM events""",
    "f5_explode_array": """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS words FROM part WHERE p_size > 5
UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size <= 5""",
    "f6_artist_genres": """
SELECT CAST(p_partkey AS VARCHAR) AS artist_id, p_name AS artist_name, p_type AS genre FROM part
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), p_name, p_brand FROM part WHERE p_size > 9""",
    "f6_album_genres": """
SELECT album_id, album_name, genre
FROM (SELECT album_id, album_name, unnest(string_split(label, 'A')) AS genre FROM album_rows) x
WHERE genre <> ''""",
    "f7_catalog_artist_genre": """
SELECT id AS artist_mbid, spotify_id AS artist_spotify_id, name AS artist_name, mbz_genre,
    CAST(sum(n) AS BIGINT) AS count_genre_tags
FROM (SELECT id, spotify_id, name, json_extract_string(tag, '$.name') AS mbz_genre,
          TRY_CAST(json_extract_string(tag, '$.count') AS BIGINT) AS n
      FROM (SELECT id, spotify_id, name, unnest(CAST(tag_list AS JSON[])) AS tag
            FROM info_rows WHERE tag_list IS NOT NULL) x) y
WHERE mbz_genre IS NOT NULL GROUP BY ALL""",
    "f8_clean_null_strings": """
SELECT id, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS life_span_begin,
    CAST(NULL AS VARCHAR) AS life_span_ended, alias_count
FROM info_rows""",
    # G
    "g1_area_closure": """
SELECT root_id, area_id, array_to_string(visit, '.') AS visit, CAST(len(visit) AS BIGINT) AS depth
FROM o_closure""",
    "g2_pivot_hierarchy": f"""
SELECT o.root_id AS area_id, o.type AS area_type, o.name AS area_name,
    o.sort_name AS area_sort_name, {_area_levels()}
FROM o_closure_named o JOIN o_levels l USING (root_id)
WHERE o.area_id = o.root_id GROUP BY ALL""",
    "g2_hierarchy_levels": """
SELECT root_id AS area_id, level, area_id AS level_id, name AS level_name,
    sort_name AS level_sort_name
FROM o_levels""",
    "g3_continent_lookup": """
WITH names AS (
    SELECT DISTINCT CASE WHEN s_acctbal < 2000 THEN 'nation_' || CAST(s_nationkey AS VARCHAR)
        WHEN s_acctbal < 4000 THEN 'N' || CAST(s_nationkey AS VARCHAR)
        WHEN s_acctbal < 6000 THEN 'Isle of NATION_' || CAST(s_nationkey AS VARCHAR) || '!'
        WHEN s_acctbal < 7000 THEN 'Guam'
        WHEN s_acctbal < 7500 THEN 'na' || CAST(s_nationkey AS VARCHAR)
        WHEN s_acctbal < 8000 THEN 'Republic No. ' || CAST(s_nationkey AS VARCHAR)
        ELSE s_name END AS country FROM supplier),
asked AS (SELECT country, lower(CASE country WHEN 'Guam' THEN 'NATION_4' ELSE country END) AS q
          FROM names),
hits AS (
    SELECT country, continent, alpha_2, continent_code,
        row_number() OVER (PARTITION BY country
            ORDER BY q IN (lower(name), lower(alpha_2), lower(alpha_3),
                lower(official_name)) DESC, ord) AS r
    FROM asked JOIN country_ref
        ON q IN (lower(alpha_2), lower(alpha_3), lower(official_name)) OR contains(q, lower(name)) OR contains(lower(name), q))
SELECT a.country, h.continent, h.alpha_2 AS country_code, h.continent_code
FROM asked a LEFT JOIN hits h ON h.country = a.country AND h.r = 1""",
    "g4_merge_continents": """
WITH todo AS (SELECT DISTINCT ifnull(country_name, island_name) AS country FROM area_rows
              WHERE ifnull(continent, 'Unknown') = 'Unknown')
SELECT a.area_id, a.country_name, a.island_name, ifnull(r.continent, a.continent) AS continent,
    ifnull(r.alpha_2, a.country_code) AS country_code,
    ifnull(r.continent_code, a.continent_code) AS continent_code
FROM area_rows a LEFT JOIN todo t ON t.country = ifnull(a.country_name, a.island_name)
LEFT JOIN country_ref r ON r.name = t.country""",
    "g5_add_geocoding_params": """
SELECT area_id, ifnull(city_name, municipality_name) || ',' || ifnull(country_code, '') AS params
FROM area_rows WHERE ifnull(city_name, municipality_name) IS NOT NULL""",
    "g5_merge_geocoding_params": """
SELECT area_id, ifnull(ifnull(city_name, municipality_name) || ',' || ifnull(country_code, ''),
    params) AS params
FROM area_rows""",
    "g6_add_state_codes_and_params": """
SELECT area_id, code, ifnull(city_name, municipality_name) || ',' || ifnull(code || ',', '')
    || country_code AS params
FROM (SELECT *, CASE WHEN subdivision_name IS NOT NULL AND country_code IS NOT NULL
                  AND CAST(substr(country_code, 2) AS INT) % 5 < 3
                THEN 'S' || substr(country_code, 2) END AS code FROM area_rows) x""",
    "g7_clean_municipality_names": """
SELECT area_id, CASE WHEN municipality_name LIKE '2nd%'
    THEN '2nd O''Brien-' || split_part(split_part(municipality_name, '-', 2), ' ', 1)
    WHEN municipality_name IS NOT NULL
    THEN 'Town ' || split_part(municipality_name, ' ', 2) END AS municipality_name
FROM area_rows""",
    "g8_parse_location_params": """
SELECT 'City ' || CAST(s_suppkey AS VARCHAR) AS city_name,
    CASE s_nationkey % 5 WHEN 1 THEN 'ST' ELSE '' END AS state_code,
    CASE s_nationkey % 5 WHEN 2 THEN '' ELSE 'N' || CAST(s_nationkey AS VARCHAR) END
        AS country_code,
    'City ' || CAST(s_suppkey AS VARCHAR) || CASE s_nationkey % 5
        WHEN 0 THEN ',N' || CAST(s_nationkey AS VARCHAR)
        WHEN 1 THEN ',ST,N' || CAST(s_nationkey AS VARCHAR) WHEN 2 THEN ''
        ELSE ',a,b,N' || CAST(s_nationkey AS VARCHAR) END AS params
FROM supplier WHERE s_nationkey % 5 < 4""",
    "g9_attach_coordinates": """
SELECT split_part(a.params, ',', 1) AS city_name, '' AS state_code,
    split_part(a.params, ',', 2) AS country_code, a.params, g.lat, g.long
FROM (SELECT DISTINCT params FROM area_rows WHERE params <> '') a
LEFT JOIN city_rows g USING (params)""",
    "g9_coordinate_counts": """
SELECT count(*) AS locations_processed, count(g.lat) AS successful_lookups
FROM (SELECT DISTINCT params FROM area_rows WHERE params <> '') a
LEFT JOIN city_rows g USING (params)""",
    "g10_backfill_artist_mbids": """
SELECT artist_id, artist_name, ifnull(artist_mbid, (
    SELECT min(id) FROM info_rows i WHERE i.spotify_id = a.artist_id)) AS artist_mbid,
    artist_popularity
FROM artist_rows a""",
    "g10_backfill_count": """
SELECT count(*) AS updates_made FROM artist_rows a
WHERE artist_mbid IS NULL AND EXISTS (FROM info_rows i WHERE i.spotify_id = a.artist_id)""",
    # H
    "h1_stg_cities": "SELECT * FROM o_city",
    "h2_stg_area_hierarchy": f"SELECT {', '.join(AREA_COLUMNS)} FROM area_rows",
    "h3_stg_artist_info": f"SELECT {', '.join(INFO_COLUMNS)} FROM info_rows",
    "h4_stg_albums": f"SELECT {', '.join(ALBUM_COLUMNS)} FROM album_rows",
    "h5_stg_artist_genre": "SELECT * FROM o_genre",
    "h6_stg_artists": "SELECT * FROM artist_rows",
    "h7_stg_tracks_played": "SELECT * FROM o_plays",
    # I
    "i1_albums": "SELECT * FROM o_albums",
    "i2_area_hierarchy": "SELECT * FROM o_area",
    "i3_artist_genre_rank": "SELECT * FROM o_genre_rank",
    "i4_artist_location": """
SELECT CASE WHEN area_id IS NOT NULL THEN area_id WHEN end_area_id IS NOT NULL THEN end_area_id
    ELSE begin_area_id END AS area_id, spotify_id AS artist_id, id AS artist_mbid,
    name AS artist_name
FROM info_rows""",
    "i5_artist_location_hierarchy": "SELECT * FROM o_located",
    "i6_artist_top_genre": "SELECT * FROM o_top_genre",
    "i7_artists": "SELECT * FROM o_artists",
    "i8_dates": "SELECT s.date_sid, d.plays FROM o_spine s LEFT JOIN o_daily d USING (date_sid)",
    "i9_genre_stats": "SELECT * FROM o_genre_stats",
    "i10_played": "SELECT * FROM o_played",
    "i11_ranked_genre": "SELECT * FROM o_ranked",
    "i11_ranked_genre_floor": """
SELECT genre, top_artist_in_genre, most_popular_artist_in_genre, by_plays AS rank_by_tracks_played,
    CAST(least(5, floor((by_plays - 1) / (n / 5)) + 1) AS DOUBLE) AS tracks_grouping,
    total_tracks_played_in_genre, by_time AS rank_by_time_played,
    CAST(least(5, floor((by_time - 1) / (n / 5)) + 1) AS DOUBLE) AS time_grouping,
    total_ms_played_in_genre
FROM o_ranked_base""",
    "i12_artists_distinct": "SELECT * FROM o_distinct",
    "i13_times": "SELECT time_sid, nullif(n, 0) AS plays FROM o_seconds",
    "i14_tracks": "SELECT * FROM o_tracks",
    "i15_unmatched_artists_prep": "SELECT * FROM o_prep",
    "i16_unmatched_artists": "SELECT * FROM o_unmatched",
    # J
    "j1_dim_album": f"""
SELECT {key('album_id', 'album', 'artist')} AS album_sid, album AS album_name, artist_album, label,
    total_tracks, album_popularity, release_date, release_year, release_decade,
    release_date_precision
FROM o_albums""",
    "j2_dim_artist": "SELECT * FROM o_dim_artist",
    "j3_dim_artist_genre": "SELECT * FROM o_dim_genre",
    "j4_dim_date": """
SELECT date_sid, date_sid AS "date", dayofweek(date_sid) AS day_of_week,
    dayname(date_sid) AS day_of_week_name, weekofyear(date_sid) AS week_of_year,
    year(date_sid) AS year_num, CAST(year(date_sid) AS VARCHAR) AS year_text,
    month(date_sid) AS month_num, monthname(date_sid) AS month_name,
    quarter(date_sid) AS quarter, day(date_sid) AS day_of_month,
    dayofyear(date_sid) AS day_of_year,
    make_date(year(date_sid), month(date_sid), 1) AS month_start_date,
    CAST(make_date(year(date_sid), month(date_sid), 1) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)
        AS month_end_date,
    make_date(year(date_sid), 1, 1) AS year_start_date,
    make_date(year(date_sid), 12, 31) AS year_end_date, plays
FROM o_spine LEFT JOIN o_daily USING (date_sid)""",
    "j5_dim_time": f"""
SELECT time_sid, strftime(TIMESTAMP '2000-01-01' + to_seconds(time_sid), '%H:%M:%S') AS "time",
    time_sid // 3600 AS hour_of_day, time_sid % 3600 // 60 AS minute_of_hour,
    time_sid % 60 AS second_of_hour, CASE WHEN time_sid < 43200 THEN 'AM' ELSE 'PM' END AS am_pm,
    {band('time_sid // 3600', *HOUR_BANDS, 1, False)} AS time_of_day,
    {band('time_sid // 3600', *HOUR_BANDS, 2, False)} AS time_of_day_sort,
    nullif(n, 0) AS plays
FROM o_seconds""",
    "j6_dim_track": f"""
SELECT {key('track_id', 'track_name', 'artist')} AS track_sid, track_name,
    artist || ' - ' || track_name AS artist_track, track_popularity,
    {band('track_popularity', *TRACK_BANDS, 1, True)} AS track_popularity_group,
    {band('track_popularity', *TRACK_BANDS, 2, True)} AS track_popularity_sort,
    CASE WHEN ifnull(track_popularity, 0) >= 50 THEN 'Popular' ELSE 'Not Popular' END
        AS is_popular,
    track_duration_sec AS track_seconds, track_duration_min AS track_minutes, track_duration,
    {band('track_duration_sec', *LENGTH_BANDS, 1, False)} AS track_length,
    {band('track_duration_sec', *LENGTH_BANDS, 2, False)} AS track_length_sort
FROM o_tracks""",
    "j7_fact_track_played": "SELECT * FROM o_fact",
    "j8_fact_artist_genre": "SELECT * FROM o_fact_genre",
    "j9_recently_played": "SELECT * FROM o_recent_all",
    "j10_surrogate_key": f"""
SELECT {key('track_id', 'artist_id', 'duration_ms')} AS key, {key('artist_mbid', "''")}
    AS padded_key
FROM history""",
    # K
    "k1_last_24h_tracks": "SELECT * FROM o_recent",
    "k2_artist_aggregates": """
SELECT artist, CAST(ifnull(sum(CAST(minutes_played AS DECIMAL(18, 2))), 0) AS DOUBLE)
    AS total_minutes, count(artist) AS track_count
FROM o_recent GROUP BY artist ORDER BY total_minutes DESC, artist LIMIT 15""",
    "k3_tracks_for_artist": f"""
SELECT track_name, album, minutes_played, played_at, popularity FROM o_recent
WHERE artist = '{c.ARTIST}'""",
    "k4_kpi_last_24h": """
SELECT CAST(sum(CAST(minutes_played AS DECIMAL(18, 2))) AS DOUBLE) AS total_minutes,
    count(*) AS total_tracks, count(DISTINCT track_name) AS distinct_tracks,
    count(DISTINCT artist) AS total_artists
FROM o_recent""",
    "k5_artist_detail": f"""
SELECT ifnull(m, 0) AS total_minutes, n AS track_count, CASE WHEN n > 0 THEN m / n ELSE 0 END
    AS avg_minutes
FROM (SELECT CAST(sum(CAST(minutes_played AS DECIMAL(18, 2))) AS DOUBLE) AS m, count(*) AS n
      FROM o_recent WHERE artist = '{c.ARTIST}') x""",
    "k6_geographic_data": "SELECT * EXCLUDE (artist_sid) FROM o_geo",
    "k7_continents": "SELECT DISTINCT continent FROM o_dim_artist WHERE continent <> ''",
    "k8_countries_for_continents": f"""
SELECT DISTINCT country FROM o_dim_artist WHERE {IN_CONTINENTS} AND country <> ''""",
    "k9_track_count_by_geography": "SELECT count(*) AS track_count FROM o_report",
    "k9_track_count_filtered": f"""
SELECT count(*) AS track_count FROM o_report
WHERE {IN_CONTINENTS} AND {IN_COUNTRIES} AND {IN_PRIMARY}""",
    "k10_genre_distribution": top(
        "o_report", "primary_genre", 20, f"primary_genre <> '{NO_GENRE}'"),
    "k10_genre_distribution_filtered": top(
        "o_report", "primary_genre", 20,
        f"primary_genre <> '{NO_GENRE}' AND {IN_CONTINENTS} AND {IN_COUNTRIES}"),
    "k11_artists_by_geography": _artist_top(),
    "k11_artists_by_geography_filtered": _artist_top(f"{IN_CONTINENTS} AND {IN_PRIMARY}"),
    "k12_country_codes": "SELECT DISTINCT country_code FROM o_dim_artist WHERE country_code <> ''",
    "k13_tracks_by_year": plays_per("year_num"),
    "k13_tracks_by_year_country": plays_per("year_num", f"country_code = '{c.COUNTRY}'"),
    "k14_tracks_by_hour": plays_per(f"{HOUR} AS hour_of_day"),
    "k14_tracks_by_hour_country": plays_per(
        f"{HOUR} AS hour_of_day", f"country_code = '{c.COUNTRY}'"),
    "k15_tracks_by_time_of_day": plays_per(
        f"{band('time_sid // 3600', *HOUR_BANDS, 1, False)} AS time_of_day"),
    "k16_genres": f"""
SELECT genre FROM o_dim_genre WHERE genre <> '' AND genre <> '{NO_GENRE}'""",
    "k17_tracks_by_year_and_genre":
        "SELECT year_num, count(*) AS track_count FROM o_report_genre GROUP BY year_num",
    "k17_tracks_by_year_and_genre_filtered": f"""
SELECT year_num, count(*) AS track_count FROM o_report_genre WHERE {IN_GENRES} GROUP BY year_num""",
    "k18_genre_distribution_with_artists": "SELECT * FROM o_top_genres",
    "k19_artists_by_genre": _artist_genre_max(),
    "k19_artists_by_genre_filtered": _artist_genre_max(
        f"{IN_GENRES} AND year_num IN ({listed(c.YEARS)})"),
    "k20_map_aggregate_city": """
SELECT lat, longitude, country, state_province, city,
    CAST(sum(track_count) AS BIGINT) AS total_tracks
FROM o_geo GROUP BY ALL""",
    "k20_map_aggregate_state": _map("country, state_province"),
    "k20_map_aggregate_country": _map("country"),
    "k20_map_aggregate_continent": _map("continent"),
    "k20_map_aggregate_filtered": f"""
SELECT country, CAST(sum(track_count) AS BIGINT) AS total_tracks, avg(lat) AS lat,
    avg(longitude) AS longitude
FROM o_geo WHERE {IN_CONTINENTS} AND {IN_PRIMARY} GROUP BY country""",
    "k20_map_aggregate_all": _levels(),
    "k21_bubble_size": f"""
SELECT *, total_tracks / max(total_tracks) OVER () * 30 + 5 AS bubble_size
FROM ({_map('country')}) x""",
    "k22_genre_treemap_midpoint": "SELECT median(track_count) AS midpoint FROM o_top_genres",
    "k23_selectable_years": f"SELECT DISTINCT year_num FROM o_report_genre WHERE {IN_GENRES}",
    "k24_location_drilldown": """
SELECT continent, country, state_province, city, CAST(sum(track_count) AS BIGINT) AS track_count,
    4 - grouping(continent) - grouping(country) - grouping(state_province) - grouping(city)
        AS depth
FROM o_geo GROUP BY ROLLUP (continent, country, state_province, city)""",
    "k25_measures": f"""
SELECT count(*) AS count_tracks_played,
    CAST(sum(CAST(round(duration_ms / 60000, 2) AS DECIMAL(18, 2))) AS DOUBLE)
        AS sum_of_minutes_played,
    (SELECT count(*) FROM o_fact_genre WHERE date_sid BETWEEN DATE '{c.START}' AND DATE '{c.END}')
        AS count_tracks_played_in_genre
FROM o_fact WHERE date_sid BETWEEN DATE '{c.START}' AND DATE '{c.END}'""",
    "k25_measures_of_cells": f"""
WITH t AS (SELECT f.*, a.country_code FROM o_fact f LEFT JOIN o_dim_artist a USING (artist_sid)
           WHERE date_sid BETWEEN DATE '{c.START}' AND DATE '{c.END}'),
g AS (SELECT f.*, a.country_code, g.genre FROM o_fact_genre f
      LEFT JOIN o_dim_artist a USING (artist_sid) LEFT JOIN o_dim_genre g USING (genre_sid)
      WHERE date_sid BETWEEN DATE '{c.START}' AND DATE '{c.END}'),
x AS (SELECT 'all' AS selected, artist_sid, duration_ms FROM t
      UNION ALL SELECT 'countries', artist_sid, duration_ms FROM t
      WHERE country_code IN ('{"', '".join(c.CODES)}')
      UNION ALL SELECT 'countries and genres', artist_sid, duration_ms FROM g
      WHERE country_code IN ('{"', '".join(c.CODES)}') AND genre IN ('{"', '".join(c.GENRES)}'))
SELECT selected, count(*) AS plays,
    CAST(sum(CAST(round(duration_ms / 60000, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS minutes,
    count(DISTINCT artist_sid) AS artists
FROM x GROUP BY selected""",
    "k25_shared_artists": f"""
WITH a AS (SELECT artist_sid, bool_or(p) AS inside, bool_or(NOT p) AS outside
    FROM (SELECT artist_sid, date_sid BETWEEN DATE '{c.START}' AND DATE '{c.END}' AS p FROM o_fact) x
    WHERE p IS NOT NULL GROUP BY artist_sid)
SELECT count(*) FILTER (inside) AS first, count(*) FILTER (outside) AS second,
    count(*) FILTER (inside AND outside) AS "both", count(*) AS either
FROM a""",
    "k26_top_artist_in_top_genres": """
WITH lead AS (SELECT genre FROM o_top_genres ORDER BY track_count DESC, genre LIMIT 25)
SELECT artist_name, track_count FROM (
    SELECT a.artist_sid, a.artist_name, count(*) AS track_count
    FROM o_report_genre r JOIN o_dim_artist a USING (artist_sid)
    WHERE r.genre IN (SELECT genre FROM lead) GROUP BY ALL) x""",
    # L
    "l1_stream_raw_plays": f"SELECT {PLAYS} FROM plays",
    "l1_stream_ingest": f"SELECT {PLAYS} FROM plays",
    "l2_stream_dedup_exact": "SELECT * EXCLUDE (seq) FROM o_exact",
    "l3_stream_dedup_within_duration": near("raw_plays", "* EXCLUDE (before_at, before_ms)"),
    "l4_stream_upsert": _MERGED_ARTISTS.format(mbid="artist_mbid,", null="NULL,"),
    "l5_stream_plays_per_window": _windows(1, 1),
    "l5_stream_plays_sliding_window": _windows(1, 24),
    "l5_stream_sketched_windows": _windows(1, 24),
    "l6_stream_enrich": """
SELECT play_id, artist_id, played_at, (SELECT max(artist_popularity) FROM artist_rows a
    WHERE a.artist_id = p.artist_id) AS artist_popularity
FROM plays p""",
}


# the written star schema: each model as SQL
_DAYS = FINAL["j4_dim_date"].replace(
    "FROM o_spine LEFT JOIN o_daily USING (date_sid)",
    'FROM (SELECT "date" AS date_sid FROM o_days) s').replace(", plays", "")
_MODELS = {
    "dim_album": f"({FINAL['j1_dim_album']})", "dim_artist": "o_dim_artist",
    "dim_artist_genre": "o_dim_genre", "dim_date": f"({_DAYS})",
    "dim_time": f"({FINAL['j5_dim_time']})", "dim_track": f"({FINAL['j6_dim_track']})",
    "fact_track_played": "o_fact", "fact_artist_genre": "o_fact_genre",
}


def _model_hashes(model: str) -> str:
    texts = ", ".join(f"ifnull(CAST(\"{x}\" AS VARCHAR), '~')" for x in c.CHECKED[model].split())
    return f"""
SELECT '{model}' AS model, count(*) AS row_count, CAST(sum(CAST('0x' ||
    substr(md5(concat_ws('|', {texts})), 1, 8) AS BIGINT)) AS BIGINT) AS row_hashes
FROM {_MODELS[model]} m"""


FINAL["e12_build_warehouse"] = " UNION ALL ".join(_model_hashes(m) for m in _MODELS)
FINAL["e12_refresh_warehouse"] = FINAL["e12_build_warehouse"]
FINAL["e12_refresh_changed"] = FINAL["e12_build_warehouse"]
# enrichment flows over stored tables
FINAL["g11_enrich_continents"] = f"""
SELECT a.* REPLACE (g.continent AS continent, g.country_code AS country_code,
    g.continent_code AS continent_code, m.municipality_name AS municipality_name)
FROM area_rows a JOIN ({FINAL['g4_merge_continents'].strip()}) g
    USING (area_id)
JOIN ({FINAL['g7_clean_municipality_names']}) m USING (area_id)"""
FINAL["g12_enrich_params"] = f"""
SELECT a.* REPLACE (g.params AS params)
FROM area_rows a JOIN ({FINAL['g5_merge_geocoding_params']}) g USING (area_id)"""
FINAL["g13_enrich_coordinates"] = """
WITH known AS (SELECT * FROM city_rows WHERE country_code < 'N15'),
asked AS (SELECT DISTINCT params FROM area_rows
          WHERE params <> '' AND params NOT IN (SELECT params FROM known))
SELECT * FROM known
UNION ALL BY NAME
SELECT split_part(a.params, ',', 1) AS city_name, split_part(a.params, ',', 2) AS country_code,
    '' AS state_code, a.params, g.lat, g.long
FROM asked a LEFT JOIN city_rows g ON g.params = a.params"""
FINAL["g14_enrich_artist_ids"] = FINAL["g10_backfill_artist_mbids"]


def _needed(text: str, out: list[str]) -> list[str]:
    """Views a text refers to, each after those it refers to itself."""
    for name in dict.fromkeys(re.findall(r"(?:FROM|JOIN)\s+(\w+)", text)):
        if name in VIEWS and name not in out:
            _needed(VIEWS[name], out)
            out.append(name)
    return out


def full_sql(name: str) -> str:
    text = FINAL[name].strip()
    views = [f"{v} AS ({VIEWS[v].strip()})" for v in _needed(text, [])]
    if not views:
        return text
    if text.startswith("WITH "):
        return "WITH " + ",\n".join(views) + ",\n" + text[5:]
    return "WITH " + ",\n".join(views) + "\n" + text


def oracle_sql() -> dict[str, str]:
    return {name: full_sql(name) for name in FINAL}

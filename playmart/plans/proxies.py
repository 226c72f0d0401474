"""The music tables expressed over generic order and event tables.

Each proxy is one SQL text that Spark and the comparison engine both run; only adding seconds to a
timestamp is spelled differently. The rows cover the edge cases the operators have to handle:
missing ids, several spellings, credits, padded dates, texts that are not numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem", "events")

_TRACK = """
    CAST(p.p_partkey AS STRING) AS track_id,
    'track:' || CAST(p.p_partkey AS STRING) AS track_uri,
    CASE WHEN p.p_size > 20 THEN 'ISRC' || CAST(p.p_partkey AS STRING) END AS track_isrc,
    p.p_name AS track_name, p.p_brand AS album_id, 'album:' || p.p_brand AS album_uri,
    p.p_brand AS album"""
_POPULARITY = "CAST(CASE WHEN p.p_size > 48 THEN NULL ELSE p.p_size * 2 END AS BIGINT)"

SQL = {
    # plays with a time of day; plays of type 'error' have no artist id
    "plays": f"""
SELECT CAST(e.event_id AS STRING) AS play_id, CAST(e.user_id AS STRING) AS user_id, {_TRACK},
    CASE WHEN e.event_type = 'error' THEN NULL ELSE CAST(a.s_suppkey AS STRING) END AS artist_id,
    CASE WHEN e.event_type = 'error' THEN 'mb-' || CAST(a.s_suppkey AS STRING) END AS artist_mbid,
    a.s_name AS artist, CAST(floor(e.value * 2000) AS BIGINT) AS duration_ms,
    CAST(e.ts AS TIMESTAMP) AS played_at, {_POPULARITY} AS popularity,
    CAST(e.user_id % 10 AS STRING) AS request_cursor, e.event_type AS play_source
FROM {{events}} e
JOIN {{part}} p ON p.p_partkey = CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT)
JOIN {{supplier}} a ON a.s_suppkey = p.p_partkey % (SELECT COUNT(*) FROM {{supplier}})""",
    # the same with exact repeats (purchases) and repeats five seconds later (views)
    "raw_plays": """
SELECT CAST(0 AS BIGINT) AS seq, * FROM {plays}
UNION ALL SELECT CAST(1 AS BIGINT) AS seq, * FROM {plays} WHERE play_source = 'purchase'
UNION ALL
SELECT CAST(2 AS BIGINT) AS seq, play_id, user_id, track_id, track_uri, track_isrc, track_name, album_id,
    album_uri, album, artist_id, artist_mbid, artist, duration_ms,
    played_at + @seconds(5) AS played_at, popularity, request_cursor, play_source
FROM {plays} WHERE play_source = 'view'""",
    # years of plays from order lines; returned lines have no artist id and a credit text
    "history": f"""
SELECT CAST(o.o_custkey AS STRING) AS user_id, {_TRACK},
    CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(s.s_suppkey AS STRING) END AS artist_id,
    CASE WHEN l.l_returnflag = 'R' THEN 'mb-' || CAST(s.s_suppkey AS STRING) END AS artist_mbid,
    CASE WHEN l.l_returnflag <> 'R' THEN s.s_name
         WHEN l.l_linenumber = 1 THEN s.s_name || ' feat. Guest'
         WHEN l.l_linenumber = 2 THEN s.s_name || ' & Friends'
         WHEN l.l_linenumber = 3 THEN '(Live) ' || s.s_name
         WHEN l.l_linenumber = 4 THEN s.s_name || ', Choir'
         WHEN l.l_linenumber = 5 THEN s.s_name || ' [Remix]'
         ELSE s.s_name END AS artist,
    CAST(CASE WHEN l.l_tax > 0.07 THEN NULL ELSE floor(l.l_quantity * 13000) END AS BIGINT)
        AS duration_ms,
    CAST(o.o_orderdate AS TIMESTAMP)
        + @seconds((l.l_orderkey * 7919 + l.l_linenumber * 3571 + l.l_partkey * 131) % 86400)
        AS played_at,
    {_POPULARITY} AS popularity, CAST(l.l_orderkey % 10 AS STRING) AS request_cursor,
    o.o_orderpriority AS play_source
FROM {{lineitem}} l
JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey
JOIN {{part}} p ON p.p_partkey = l.l_partkey
JOIN {{supplier}} s ON s.s_suppkey = l.l_suppkey""",
    # suppliers in debt are not in the artist table; rich ones have a second spelling
    "artist_rows": """
SELECT CAST(s_suppkey AS STRING) AS artist_id, s_name AS artist_name,
    CASE WHEN s_acctbal > 3000 THEN 'mb-' || CAST(s_suppkey AS STRING) END AS artist_mbid,
    CAST(CASE WHEN s_acctbal < 500 THEN NULL ELSE floor(s_acctbal / 100) END AS FLOAT)
        AS artist_popularity
FROM {supplier} WHERE s_acctbal >= 0
UNION ALL
SELECT CAST(s_suppkey AS STRING), s_name || ' Band', NULL, CAST(5 AS FLOAT)
FROM {supplier} WHERE s_acctbal > 8000""",
    "artist_genre": """
SELECT DISTINCT CAST(s.s_suppkey AS STRING) AS artist_id, s.s_name AS artist_name,
    lower(p.p_type) || ' ' || split_part(p.p_name, ' ', 2) AS genre
FROM {part} p JOIN {supplier} s ON s.s_suppkey = p.p_partkey % (SELECT COUNT(*) FROM {supplier})
UNION ALL SELECT DISTINCT CAST(NULL AS STRING), p_type, lower(p_type) FROM {part}""",
    # release dates of year, month and day precision; the newest brands have no album row
    "album_rows": """
SELECT 'album' AS album_type, CAST(min(p_partkey) AS STRING) AS artist_id,
    min(p_name) AS artist_name, 'artist' AS artist_type, p_brand AS album_id,
    max(p_type) AS label, p_brand AS album_name, CAST(max(p_size) AS BIGINT) AS popularity,
    CASE WHEN b < 9 THEN CAST(1970 + b AS STRING)
         WHEN b < 17 THEN CAST(1970 + b AS STRING) || '-05'
         WHEN b < 22 THEN CAST(1970 + b AS STRING) || '-05-06' END AS release_date,
    CASE WHEN b < 9 THEN 'year' WHEN b < 17 THEN 'month' WHEN b < 22 THEN 'day' END
        AS release_date_precision,
    CAST(COUNT(*) AS BIGINT) AS total_tracks,
    CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS last_modified
FROM (SELECT *, CAST(split_part(p_brand, '#', 2) AS INT) AS b FROM {part}) x
WHERE b < 24 GROUP BY p_brand, b""",
    "info_rows": """
SELECT CAST(NULL AS STRING) AS alias_count, CAST(NULL AS STRING) AS area_disambiguation,
    CASE WHEN s_acctbal >= 2000 THEN 's' || CAST(s_suppkey AS STRING) END AS area_id,
    CAST(NULL AS STRING) AS area_life_span_begin, n_name AS area_name, n_name AS area_sort_name,
    CAST(NULL AS STRING) AS begin_area_disambiguation,
    'n' || CAST(s_nationkey AS STRING) AS begin_area_id,
    CAST(NULL AS STRING) AS begin_area_life_span_begin, n_name AS begin_area_name,
    n_name AS begin_area_sort_name, 'N' || CAST(s_nationkey AS STRING) AS country,
    CAST(NULL AS STRING) AS disambiguation,
    CASE WHEN s_acctbal >= 1000 THEN 'n' || CAST((s_nationkey + 1) % 25 AS STRING) END
        AS end_area_id,
    CAST(NULL AS STRING) AS end_area_name, CAST(NULL AS STRING) AS end_area_sort_name,
    CASE WHEN s_acctbal > 5000 THEN 'nan' ELSE 'None' END AS gender,
    'mb-' || CAST(s_suppkey AS STRING) AS id, CAST(NULL AS STRING) AS ipi, '' AS life_span_begin,
    CAST(NULL AS STRING) AS life_span_end, '<NA>' AS life_span_ended, s_name AS name,
    CAST(NULL AS STRING) AS release_group_count, s_name AS sort_name,
    CAST(s_suppkey AS STRING) AS source_file,
    CASE WHEN s_acctbal < 9000 THEN
        '[{{"count":"' || CAST(s_nationkey AS STRING) || '","name":"rock"}},{{"count":3,"name":"'
        || lower(n_name) || '"}},{{"count":"2","name":"rock"}},{{"count":"1"}}]' END AS tag_list,
    'Person' AS type, CAST(NULL AS STRING) AS end_area_disambiguation,
    CASE WHEN s_acctbal >= 1500 THEN CAST(s_suppkey AS STRING) END AS spotify_id
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey""",
    # one city or municipality per supplier, one country per nation; nation 24 is an island
    "area_rows": """
SELECT 's' || k AS area_id, 'City' AS area_type, 'City ' || k AS area_name,
    'City ' || k AS area_sort_name,
    CASE WHEN nat < 20 THEN 's' || k END AS city_id,
    CASE WHEN nat < 20 THEN 'City ' || k END AS city_name,
    CASE WHEN nat < 20 THEN 'City ' || k END AS city_sort_name,
    CASE WHEN nat <> 24 THEN 'n' || n END AS country_id,
    CASE WHEN nat <> 24 THEN n_name END AS country_name,
    CASE WHEN nat <> 24 THEN n_name END AS country_sort_name,
    'c' || n AS county_id, 'County ' || n AS county_name, 'County ' || n AS county_sort_name,
    CAST(NULL AS STRING) AS district_id, CAST(NULL AS STRING) AS district_name,
    CAST(NULL AS STRING) AS district_sort_name,
    CASE WHEN nat = 24 THEN 'n' || n END AS island_id,
    CASE WHEN nat = 24 THEN n_name END AS island_name,
    CASE WHEN nat = 24 THEN n_name END AS island_sort_name,
    CASE WHEN nat >= 20 THEN 's' || k END AS municipality_id,
    CASE WHEN nat = 20 THEN '2nd o' || chr(39) || 'brien-' || k || ' Municipality'
         WHEN nat > 20 THEN 'town ' || k || ' Municipality' END AS municipality_name,
    CASE WHEN nat >= 20 THEN 'town ' || k END AS municipality_sort_name,
    'd' || n AS subdivision_id, 'State ' || n AS subdivision_name,
    'State ' || n AS subdivision_sort_name,
    CAST(NULL AS STRING) AS unknown_id, CAST(NULL AS STRING) AS unknown_name,
    CAST(NULL AS STRING) AS unknown_sort_name,
    CASE WHEN n_regionkey = 4 THEN NULL WHEN n_regionkey = 3 THEN 'Unknown' ELSE r_name END
        AS continent,
    CASE WHEN nat <> 23 THEN 'N' || n END AS country_code,
    'R' || CAST(n_regionkey AS STRING) AS continent_code, CAST(NULL AS STRING) AS state_code,
    CASE WHEN nat = 22 THEN '' WHEN nat <> 21 THEN 'City ' || k || ',N' || n END AS params
FROM (SELECT CAST(s_suppkey AS STRING) AS k, CAST(s_nationkey AS STRING) AS n,
             s_nationkey AS nat, n_name, n_regionkey, r_name
      FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
      JOIN {region} ON r_regionkey = n_regionkey) x
UNION ALL
SELECT 'n' || CAST(n_nationkey AS STRING), 'Country', n_name, n_name, NULL, NULL, NULL,
    'n' || CAST(n_nationkey AS STRING), n_name, n_name, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    r_name, 'N' || CAST(n_nationkey AS STRING), 'R' || CAST(n_regionkey AS STRING), NULL, NULL
FROM {nation} JOIN {region} ON r_regionkey = n_regionkey""",
    # coordinates are texts, some of them unreadable
    "city_rows": """
SELECT 'City ' || CAST(s_suppkey AS STRING) AS city_name,
    'N' || CAST(s_nationkey AS STRING) AS country_code,
    CASE WHEN s_nationkey > 12 THEN 'ST' ELSE '' END AS state_code,
    'City ' || CAST(s_suppkey AS STRING) || ',N' || CAST(s_nationkey AS STRING) AS params,
    CASE WHEN s_nationkey = 5 THEN 'n/a' ELSE CAST(s_nationkey * 7 - 84 AS STRING) END AS lat,
    CAST(s_nationkey * 14 - 168 AS STRING) AS long
FROM {supplier} WHERE s_acctbal >= 1000""",
    "mask_rows": """
SELECT CAST(s_suppkey AS STRING) AS artist_id, 'Masked ' || CAST(s_suppkey AS STRING) AS mask_name
FROM {supplier} WHERE s_nationkey = 7""",
    # long ids with a common beginning; cities lie in a district and in their nation, districts in
    # a base of no known level, and the world is part of its first region (a cycle)
    "area_edges": """
SELECT 'aaaaaaaa-1111-s' || CAST(s_suppkey AS STRING) AS child,
    'aaaaaaaa-1111-n' || CAST(s_nationkey AS STRING) AS parent FROM {supplier}
UNION ALL
SELECT 'aaaaaaaa-1111-s' || CAST(s_suppkey AS STRING),
    'aaaaaaaa-1111-d' || CAST(s_suppkey % 40 AS STRING) FROM {supplier}
UNION ALL
SELECT DISTINCT 'aaaaaaaa-1111-d' || CAST(s_suppkey % 40 AS STRING),
    'aaaaaaaa-1111-b' || CAST(s_suppkey % 5 AS STRING) FROM {supplier}
UNION ALL
SELECT 'aaaaaaaa-1111-b' || CAST(r_regionkey AS STRING),
    'aaaaaaaa-1111-n' || CAST(r_regionkey * 3 AS STRING) FROM {region}
UNION ALL
SELECT 'aaaaaaaa-1111-n' || CAST(n_nationkey AS STRING),
    'aaaaaaaa-1111-r' || CAST(n_regionkey AS STRING) FROM {nation}
UNION ALL
SELECT 'aaaaaaaa-1111-r' || CAST(r_regionkey AS STRING), 'aaaaaaaa-1111-w' FROM {region}
UNION ALL
SELECT 'aaaaaaaa-1111-w', 'aaaaaaaa-1111-r' || CAST(min(r_regionkey) AS STRING) FROM {region}""",
    "area_nodes": """
SELECT 'aaaaaaaa-1111-s' || CAST(s_suppkey AS STRING) AS area_id, 'City' AS type, s_name AS name,
    s_name AS sort_name FROM {supplier}
UNION ALL
SELECT DISTINCT 'aaaaaaaa-1111-d' || CAST(s_suppkey % 40 AS STRING), 'District',
    'District ' || CAST(s_suppkey % 40 AS STRING), CAST(NULL AS STRING) FROM {supplier}
UNION ALL
SELECT 'aaaaaaaa-1111-b' || CAST(r_regionkey AS STRING), 'Military base',
    'Base ' || CAST(r_regionkey AS STRING), CAST(NULL AS STRING) FROM {region}
UNION ALL
SELECT 'aaaaaaaa-1111-n' || CAST(n_nationkey AS STRING), 'Country', n_name, n_name FROM {nation}
UNION ALL
SELECT 'aaaaaaaa-1111-r' || CAST(r_regionkey AS STRING), NULL, r_name, NULL FROM {region}
UNION ALL SELECT DISTINCT 'aaaaaaaa-1111-w', 'World', 'World', 'World' FROM {region}""",
    "country_ref": """
SELECT n_nationkey AS ord, n_name AS name, 'N' || CAST(n_nationkey AS STRING) AS alpha_2,
    'NA' || CAST(n_nationkey AS STRING) AS alpha_3,
    'Republic No. ' || CAST(n_nationkey AS STRING) AS official_name,
    r_name AS continent, 'R' || CAST(n_regionkey AS STRING) AS continent_code
FROM {nation} JOIN {region} ON r_regionkey = n_regionkey""",
}


def _seconds(text: str, spelled: str) -> str:
    """Replaces ``@seconds(x)``; the argument may hold one level of parentheses."""
    while "@seconds(" in text:
        head, _, tail = text.partition("@seconds(")
        depth, end = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(tail[end], 0)
            end += 1
        text = head + spelled.format(tail[:end - 1]) + tail[end:]
    return text


def spark_proxy(spark: SparkSession, sf_dir: str, name: str,
                frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """A driver table or proxy as a lazy DataFrame; ``frames`` keeps those already built."""
    frames = {} if frames is None else frames
    if name not in frames:
        if name in TABLES:
            frames[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            text = _seconds(SQL[name], "make_dt_interval(0, 0, 0, {})")
            used = {n: spark_proxy(spark, sf_dir, n, frames)
                    for n in (*TABLES, *SQL) if "{" + n + "}" in text}
            frames[name] = spark.sql(text, **used)
    return frames[name]


def oracle_proxies() -> dict[str, str]:
    """Proxy name to SQL over the bare table names."""
    names = {n: n for n in (*TABLES, *SQL)}
    return {n: _seconds(text, "to_seconds({})").format(**names) for n, text in SQL.items()}

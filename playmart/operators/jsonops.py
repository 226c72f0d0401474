"""Semi-structured columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions.text import null_if_placeholder

# fixed values: keys with this part are dropped, except the tag list
LIST_PART = "-list"
KEPT_LIST = "tag-list"
# a tag count may be a JSON string or a number, so it is read as text
TAGS = "array<struct<count: string, name: string>>"


def _underscored(name: str) -> str:
    return name.replace("-", "_")


def read_artist_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
                     glob: str = "*.json") -> DataFrame:
    """Artist documents, one per file, with ``source_file`` = file name without extension."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]+$", "")
    return reader.json(path).select("*", stem.alias("source_file"))


def normalize_artist_json(df: DataFrame) -> DataFrame:
    """Flattens one level of objects, drops list keys, turns arrays into JSON text."""
    out: list[Column] = []
    for field in df.schema:
        name, column = field.name, F.col(f"`{field.name}`")
        if LIST_PART in name and name != KEPT_LIST:
            continue
        if isinstance(field.dataType, T.StructType):
            out += [
                column[nested.name].alias(_underscored(f"{name}_{nested.name}"))
                for nested in field.dataType if LIST_PART not in nested.name
            ]
        elif isinstance(field.dataType, T.ArrayType):
            out.append(F.to_json(column).alias(_underscored(name)))
        else:
            out.append(column.alias(_underscored(name)))
    return df.select(*out)


def _as_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column).alias(field.name)
    return column.cast("string").alias(field.name)


def conform_to_table(df: DataFrame, stored: DataFrame | None) -> DataFrame:
    """All columns as text; with a stored table, exactly its columns in its order."""
    text = df.select(*[_as_text(f) for f in df.schema])
    if stored is None:
        return text
    return text.select(*[
        F.col(c) if c in text.columns else F.lit(None).cast("string").alias(c)
        for c in stored.columns
    ])


def flatten_json_column(df: DataFrame, col: str, prefix: str | None = None,
                        keys: list[str] | None = None) -> DataFrame:
    """One text column per key of a JSON object column; other values give NULLs.

    Without ``keys`` the keys of all rows are looked up first. They are the names of the result's
    columns, so one row of them reaches the driver, whatever the number of rows; there is no bound
    on their number. Keys that would share a column, with each other or with a column of ``df``,
    are an error.
    """
    if col not in df.columns:
        return df
    parsed = F.from_json(F.col(col), "map<string,string>")
    if keys is None:
        found = df.select(F.explode(F.map_keys(parsed)).alias("k")).distinct()
        keys = found.agg(F.array_sort(F.collect_list("k"))).first()[0]
    columns: dict[str, str] = {}
    taken = {c.lower() for c in df.columns}
    for k in dict.fromkeys(keys):
        name = _underscored(f"{prefix}_{k}" if prefix else k)
        if name in columns or name.lower() in taken:
            raise ValueError(f"key {k!r} of {col} would overwrite column {name!r}")
        columns[name] = k
    wide = df.withColumn("_object", parsed)
    named = {name: F.try_element_at("_object", F.lit(k)) for name, k in columns.items()}
    return wide.withColumns(named).drop("_object") if named else df


def json_extract(df: DataFrame, col: str, path: str) -> DataFrame:
    """Adds ``extracted_{path}``; missing paths and bad JSON give NULL."""
    return df.withColumn(f"extracted_{path}", F.get_json_object(col, path))


def explode_array(df: DataFrame, col: str = "genres") -> DataFrame:
    """One row per element; an empty or NULL array keeps one row with NULL."""
    if dict(df.dtypes)[col] == "string":
        df = df.withColumn(col, F.from_json(col, "array<string>"))
    return df.select(*[F.explode_outer(c).alias(c) if c == col else F.col(c)
                       for c in df.columns])


def _entity_genres(df: DataFrame, key: str, name: str) -> DataFrame:
    rows = explode_array(df.select(key, name, F.col("genres").alias("genre")), "genre")
    return rows.where(F.col("genre") != "")


def artist_genres(artists: DataFrame) -> DataFrame:
    return _entity_genres(artists, "artist_id", "artist_name")


def album_genres(albums: DataFrame) -> DataFrame:
    return _entity_genres(albums, "album_id", "album_name")


def catalog_artist_genre(info: DataFrame) -> DataFrame:
    """Tags per artist with summed counts."""
    tags = info.select(
        F.col("id").alias("artist_mbid"),
        F.col("spotify_id").alias("artist_spotify_id"),
        F.col("name").alias("artist_name"),
        F.explode(F.from_json("tag_list", TAGS)).alias("tag"),
    )
    return (
        tags.where(F.col("tag.name").isNotNull())
        .groupBy("artist_mbid", "artist_spotify_id", "artist_name",
                 F.col("tag.name").alias("mbz_genre"))
        .agg(F.coalesce(F.sum(F.col("tag.count").try_cast("bigint")), F.lit(0))
             .alias("count_genre_tags"))
        .orderBy(F.asc_nulls_last("artist_name"), F.desc("count_genre_tags"), "mbz_genre",
                 "artist_mbid", F.asc_nulls_last("artist_spotify_id"))
    )


def clean_null_strings(df: DataFrame) -> DataFrame:
    """All columns as text, with placeholder texts turned into NULL."""
    return df.select(*[null_if_placeholder(F.col(c).cast("string")).alias(c)
                       for c in df.columns])

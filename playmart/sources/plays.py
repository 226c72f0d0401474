"""Readers of raw play files and of the consolidated snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions.times import parse_played_at
from playmart.operators.dedup import (
    EXACT_KEYS,
    dedup_exact,
    dedup_plays,
    require_play_identity,
)
from playmart.operators.ingest import high_water_mark, newer_than
from playmart.operators.sinks import write_append, write_csv_snapshot
from playmart.operators.skew import join_null_safe
from playmart.schemas import RAW_PLAY, RECENTLY_PLAYED_CSV
from playmart.sources.tables import read_table

TRACKS = "tracks_played"


def typed_plays(raw: DataFrame) -> DataFrame:
    """Raw records with stored names and types: numbers are read as double because files mix
    ``1000``, ``1000.0`` and null."""
    return raw.withColumns({
        "duration_ms": F.col("duration_ms").cast("bigint"),
        "popularity": F.col("popularity").cast("bigint"),
        "played_at": parse_played_at("played_at"),
    }).withColumnsRenamed({"uri": "track_uri", "request_after": "request_cursor"})


CORRUPT = "_corrupt_record"


def raw_schema() -> T.StructType:
    return T.StructType.fromDDL(RAW_PLAY).add(CORRUPT, "string")


def split_rejected(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable records, and what could not be read: ``source_file`` and ``text``. A file that is
    not JSON throughout gives no play at all."""
    path = F.col("_metadata.file_path")
    # the reader refuses queries for nothing but the bad text, so a part of no length goes with it
    nothing = F.substring(F.coalesce("user_id", F.lit("")), 1, 0)
    bad = raw.where(F.col(CORRUPT).isNotNull()).select(
        path.alias("source_file"), F.concat(CORRUPT, nothing).alias("text"))
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def _raw(spark: SparkSession, path: str, glob: str, strict: bool) -> DataFrame:
    return (
        spark.read.schema(raw_schema())
        .option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
    )


def read_raw_plays(spark: SparkSession, path: str, with_file: bool = False,
                   glob: str = "*.json", strict: bool = False) -> DataFrame:
    """All JSON files below ``path``; a file holds an array of records or one record.

    Files that cannot be read give no rows (see ``rejected_files``); ``strict`` raises instead.
    """
    good, _ = split_rejected(_raw(spark, path, glob, strict))
    if with_file:
        good = good.select("*", F.col("_metadata.file_path").alias("source_file"))
    return typed_plays(good)


def rejected_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``source_file`` and ``text`` of the files that ``read_raw_plays`` leaves out."""
    return split_rejected(_raw(spark, path, glob, False))[1]


def add_plays(new: DataFrame, base: str) -> None:
    """Appends plays to the stored ones, without those that lack an identity and without exact
    repeats of their own or of stored plays. Of the stored plays only keys of the time span of the
    new ones are read. Adding the same plays again adds nothing."""
    spark = new.sparkSession
    new = dedup_exact(require_play_identity(new)).persist()
    try:
        stored = read_table(spark, base, TRACKS)
        if stored is not None:
            micros = F.unix_micros("played_at")
            first, last = new.agg(F.min(micros), F.max(micros)).first()
            known = stored.select(*EXACT_KEYS).distinct()
            if first is not None:
                span = F.col("played_at").between(*[
                    F.timestamp_micros(F.lit(t)) for t in (first, last)])
                # plays without a time are identified by the track alone
                known = stored.where(span | F.col("played_at").isNull()).select(
                    *EXACT_KEYS).distinct()
            new = join_null_safe(new, known, list(EXACT_KEYS), "left_anti")
        write_append(new, base, TRACKS)
    finally:
        new.unpersist()


def ingest_raw_plays(spark: SparkSession, raw_path: str, base: str, glob: str = "*.json",
                     rejected: str = "rejected_files") -> DataFrame:
    """Raw files into the stored plays: unreadable files go to a table of their own, the others'
    plays are appended without exact repeats of their own or of stored plays. Returns the plays."""
    write_append(rejected_files(spark, raw_path, glob), base, rejected)
    add_plays(read_raw_plays(spark, raw_path, glob=glob), base)
    return read_table(spark, base, TRACKS)


def ingest_newer(raw: DataFrame, base: str, unit: str = "ms",
                 source: Column | None = None) -> DataFrame:
    """Flattened raw plays past the cursor of the stored ones into the stored plays, as one call;
    returns the plays. The cursor is the high-water mark of the stored plays, or of those for which
    ``source`` holds, where services with cursors of their own share the table."""
    stored = read_table(raw.sparkSession, base, TRACKS)
    cursor = None
    if stored is not None:
        own = stored if source is None else stored.where(source)
        cursor = high_water_mark(own, unit=unit).first()["cursor"]
    # a cursor of ms is one past the newest play, and the reader takes what lies past the cursor
    at = cursor - 1 if cursor is not None and unit == "ms" else cursor
    add_plays(newer_than(typed_plays(raw), at, unit=unit), base)
    return read_table(raw.sparkSession, base, TRACKS)


def read_recently_played_csv(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot; a file whose header differs from the contract is refused."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(
        RECENTLY_PLAYED_CSV).csv(path)


def consolidate_plays(spark: SparkSession, raw_path: str, csv_path: str, glob: str = "*.json",
                      tie: tuple[str, ...] = (), single_file: bool = False) -> None:
    """All raw files, without exact and near repeats, as the CSV snapshot."""
    raw = read_raw_plays(spark, raw_path, with_file=True, glob=glob)
    unique = dedup_plays(raw, order=["source_file"], tie=tie).drop("source_file")
    snapshot = unique.withColumnsRenamed(
        {"track_uri": "uri", "request_cursor": "request_after"})
    write_csv_snapshot(snapshot, csv_path, single_file)

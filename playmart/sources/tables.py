"""Stored tables: Parquet folders, seeds, report extracts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from playmart.schemas import SEEDS, VIEW_TABLES

# raised by Spark when a folder is absent or holds no file of the format
_NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
_BUCKET = re.compile(r"bucket_of_(\d+)_by_(.+)", re.DOTALL)


def bucket_name(count: int, keys: list[str]) -> str:
    """Name of the partition column of a table in ``count`` buckets by the hash of its keys."""
    if any("," in k for k in keys):
        raise ValueError(f"a key of a bucketed table has a comma: {keys}")
    return f"bucket_of_{count}_by_{','.join(keys)}"


def bucket_parts(name: str) -> tuple[int, list[str]]:
    found = _BUCKET.fullmatch(name)
    return int(found[1]), found[2].split(",")


def bucket_column(columns: list[str]) -> str | None:
    return next((c for c in columns if _BUCKET.fullmatch(c)), None)


def found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` opens, or None where there is nothing to open."""
    try:
        return read()
    except AnalysisException as err:
        if (err.getCondition() or "").split(".")[0] in _NO_DATA:
            return None
        raise


def read_table(spark: SparkSession, base: str, name: str, merge_schema: bool = True,
               raw: bool = False) -> DataFrame | None:
    """The Parquet folder ``base/name``, or None where it holds no data. Reading changes nothing.

    The schemas of all files are merged unless ``merge_schema`` is False, as files of different
    age may lack columns. The bucket column of a merged table is left out unless ``raw``.
    """
    df = found(lambda: spark.read.option("mergeSchema", merge_schema).parquet(f"{base}/{name}"))
    bucket = None if df is None or raw else bucket_column(df.columns)
    return df.drop(bucket) if bucket else df


def table_exists(spark: SparkSession, base: str, name: str) -> bool:
    return read_table(spark, base, name, merge_schema=False) is not None


def register_views(spark: SparkSession, base: str, names=VIEW_TABLES) -> list[str]:
    """Temp views over the stored tables that are present; returns their names."""
    found = []
    for name in names:
        table = read_table(spark, base, name)
        if table is not None:
            table.createOrReplaceTempView(name)
            found.append(name)
    return found


def read_seed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A seed CSV with its declared types (a byte order mark is skipped by the reader)."""
    return spark.read.option("header", True).schema(SEEDS[name]).csv(f"{folder}/{name}.csv")


def report_extract_views(spark: SparkSession, folder: str) -> list[str]:
    """Views over the exported report tables."""
    return register_views(spark, folder, ("artist_genre_plays", "track_plays"))

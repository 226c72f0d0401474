"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the text that stands for NULL inside a key, and the part separator
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the parts as text; a NULL part and an empty part give different keys."""
    texts = [
        F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(NULL_PART))
        for p in parts
    ]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


def row_hash(columns: list[str]) -> Column:
    """64 bits over a row. A hash alone skips NULLs, so their places are hashed as well."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def timestamp_part(col: str | Column) -> Column:
    """Microsecond text of a timestamp, so that keys do not depend on display settings."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")

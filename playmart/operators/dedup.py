"""Removal of repeated play events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.times import whole_seconds_between
from playmart.operators.skew import HOUR, SLICE_ROWS, hot_slices, previous_in_key

EXACT_KEYS = ("track_id", "played_at")
TRACK_KEYS = ("track_name", "artist")
IDENTITY = ("track_name", "artist", "played_at")


def _best_row(df: DataFrame, keys: list[str], pick: Column) -> DataFrame:
    """One row per key from an aggregate over structs that hold the other columns.

    An aggregate combines on the map side, so a key with many copies shrinks before the shuffle.
    """
    best = df.groupBy(*keys).agg(pick.alias("_row"))
    return best.select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def dedup_exact(df: DataFrame, keys=EXACT_KEYS, order: list[str] | None = None) -> DataFrame:
    """First row per key in ``order`` (by default all other columns); NULL keys form one group."""
    rest = [c for c in df.columns if c not in keys]
    first = list(order or [])
    ordered = first + [c for c in rest if c not in first]
    return _best_row(df, list(keys), F.min(F.struct(*ordered)))


def require_play_identity(df: DataFrame) -> DataFrame:
    return df.dropna(subset=list(IDENTITY))


def total_order(df: DataFrame, tie: tuple[str, ...] = ()) -> tuple[str, ...]:
    """``tie`` and then all other columns: only equal rows are left without an order, so results
    do not depend on how rows are partitioned."""
    fixed = (*TRACK_KEYS, "played_at", *tie)
    return (*tie, *[c for c in df.columns if c not in fixed])


def crowded_hours(df: DataFrame, slice_seconds: int = HOUR, slice_rows: int = SLICE_ROWS
                  ) -> tuple[DataFrame, bool] | None:
    """Cut points of the track hours with over ``slice_rows`` plays, see ``hot_slices``."""
    return hot_slices(df, list(TRACK_KEYS), "played_at", slice_seconds, slice_rows)


def near_repeats(df: DataFrame, tie: tuple[str, ...] = (), slice_seconds: int = HOUR,
                 crowded: tuple[DataFrame, bool] | None = None) -> DataFrame:
    """Adds ``near_repeat``: the play starts within the previous input row's duration. ``crowded``
    names the hours that are cut further; it decides on tasks, not on rows."""
    tie = total_order(df, tie)
    rows = previous_in_key(
        df, list(TRACK_KEYS), "played_at", ["played_at", "duration_ms"], tie, slice_seconds,
        crowded)
    gap = whole_seconds_between(F.col("previous")["played_at"], F.col("played_at"))
    inside = gap <= F.col("previous")["duration_ms"] / F.lit(1000)
    return rows.withColumn("near_repeat", F.coalesce(inside, F.lit(False))).drop("previous")


def dedup_within_duration(
    df: DataFrame, tie: tuple[str, ...] = (), slice_seconds: int = HOUR,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Drops a play that starts within the duration of the play before it of the same track.

    The play before is the previous input row, kept or not. Plays of one instant are ordered by
    ``tie`` and then by all other columns. Track hours are counted first; those with over
    ``slice_rows`` plays are cut at quantiles of their times.
    """
    return _kept(df, tie, slice_seconds, crowded_hours(df, slice_seconds, slice_rows))


def _kept(df: DataFrame, tie: tuple[str, ...], slice_seconds: int,
          crowded: tuple[DataFrame, bool] | None) -> DataFrame:
    marked = near_repeats(df, tie, slice_seconds, crowded)
    return marked.where(~F.col("near_repeat")).drop("near_repeat")


def dedup_plays(df: DataFrame, order: list[str] | None = None, tie: tuple[str, ...] = (),
                slice_seconds: int = HOUR, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Exact repeats, rows without identity, near repeats, in that order. Track hours are counted
    on the input, so that the removal of exact repeats runs once."""
    exact = dedup_exact(df, order=order)
    return _kept(require_play_identity(exact), tie, slice_seconds,
                 crowded_hours(df, slice_seconds, slice_rows))


def dedup_audit(df: DataFrame, order: list[str] | None = None, tie: tuple[str, ...] = (),
                slice_seconds: int = HOUR, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row: rows in, removed by each step, rows out.

    The rows that exact repeats stand for are carried as a count, so every step is counted in one
    pass. Rows without identity are counted apart.
    """
    copies = "_copies"
    rest = [c for c in df.columns if c not in EXACT_KEYS]
    first = [*(order or []), *[c for c in rest if c not in (order or [])]]
    best = df.groupBy(*EXACT_KEYS).agg(
        F.min(F.struct(*first)).alias("_row"), F.count(F.lit(1)).alias(copies))
    exact = best.select(*[F.col(c) if c in EXACT_KEYS else F.col("_row")[c].alias(c)
                          for c in df.columns], copies)
    known = F.lit(True)
    for c in IDENTITY:
        known = known & F.col(c).isNotNull()
    crowded = crowded_hours(df, slice_seconds, slice_rows)
    near = near_repeats(exact.where(known), tie, slice_seconds, crowded).select(
        copies, F.lit(True).alias("_known"), "near_repeat")
    rows = near.unionAll(exact.where(~known).select(copies, F.lit(False), F.lit(False)))
    n = F.count(F.lit(1))
    counts = rows.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows_in"), n.alias("after_exact"),
        F.count_if("_known").alias("after_identity"),
        F.count_if(F.col("_known") & ~F.col("near_repeat")).alias("rows_out"))
    return counts.select(
        "rows_in",
        (F.col("rows_in") - F.col("after_exact")).alias("exact_removed"),
        (F.col("after_exact") - F.col("after_identity")).alias("null_removed"),
        (F.col("after_identity") - F.col("rows_out")).alias("near_removed"),
        (F.col("rows_in") - F.col("rows_out")).alias("total_removed"),
        "rows_out",
    )


def deduplicate_with_priority(
    df: DataFrame, subset: list[str], priority_col: str | None = None, ascending: bool = False
) -> DataFrame:
    """Best row per key: highest priority, or lowest if ``ascending``; NULL priority comes last.

    Equal priorities are settled by the other columns. Without a priority column any row of the
    key would do; the smallest one is kept so that reruns agree.
    """
    if not subset:
        return df.distinct()
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.distinct()
    if priority_col is None or priority_col not in df.columns:
        return _best_row(df, subset, F.min(F.struct(*rest)))
    others = [priority_col] + [c for c in rest if c != priority_col]
    if ascending:
        missing = F.col(priority_col).isNull().alias("_missing")
        return _best_row(df, subset, F.min(F.struct(missing, *others)))
    return _best_row(df, subset, F.max(F.struct(*others)))

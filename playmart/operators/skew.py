"""Order-dependent columns and joins that hold when one key owns a large share of the rows.

A plain window sends a whole key to one task. Here a key is cut into slices (hours, parts of equal
depth of a crowded hour, or ranges of the sort order), each slice is a group of its own, and only
one summary row per slice crosses slice borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600
# rows of a key's time slice above which it is cut further
SLICE_ROWS = 1_000_000
# parts of one slice at most, and the size of its sketch (rank error about 0.1 %)
PARTS, SKETCH = 256, 4096
# rows of marks up to which they are broadcast, and places of each beyond
FEW_MARKS, SALTS = 10_000, 64


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in keys])


def _slice(time_col: str, slice_seconds: int) -> Column:
    return F.floor(F.unix_micros(time_col) / F.lit(slice_seconds * 1_000_000))


def _with_marks(rows: DataFrame, marks: DataFrame, few: bool, group: list[str]) -> DataFrame:
    """Inner or left join of rows to one small row per hot group. Marks are broadcast where they are
    counted to be few; otherwise each goes to ``SALTS`` places, over which its rows are spread."""
    if few:
        return rows.join(F.broadcast(marks), group, "left")
    salted = marks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return spread.join(salted, [*group, "_salt"], "left").drop("_salt")


def hot_slices(df: DataFrame, keys: list[str], time_col: str, slice_seconds: int = HOUR,
               slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, bool] | None:
    """Cut points, by time in microseconds, of every (key, time slice) with over ``slice_rows`` rows,
    and whether these slices are few; None where there is none.

    One aggregate over key and time counts the slices. Only rows of the large ones are read again,
    into a mergeable quantile sketch for each, which gives points of about equal depth: a part has
    ``slice_rows`` rows, or a 256th of its slice where that is more, give or take the sketch's rank
    error of about 0.1 %. Rows of one instant stay together. The points may come from other rows
    than those that are cut: they decide only how evenly, never with what result.
    """
    group = [*keys, "_slice"]
    timed = df.select(*keys, time_col).dropna().select(
        *keys, _slice(time_col, slice_seconds).alias("_slice"),
        F.unix_micros(time_col).alias("_micros"))
    large = timed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > slice_rows).checkpoint()
    count = large.count()
    if not count:
        return None
    few = count <= FEW_MARKS
    held = _with_marks(timed, large, few, group).where(F.col("_n").isNotNull())
    sketched = held.groupBy(*group).agg(
        F.max("_n").alias("_n"), F.kll_sketch_agg_bigint("_micros", F.lit(SKETCH)).alias("_sketch"))
    points = F.kll_sketch_get_quantile_bigint(
        "_sketch", F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)]))
    # of the equal-depth points each ``step``-th one, as the ranks have to be constants
    step = F.greatest(F.lit(1), F.floor(F.lit(PARTS * slice_rows) / F.col("_n")))
    cuts = F.array_distinct(F.filter(points, lambda x, i: (i + 1) % step == 0))
    return sketched.select(*group, cuts.alias("_cuts")).checkpoint(), few


def previous_in_key(
    df: DataFrame, keys: list[str], time_col: str, carry: list[str],
    tie: tuple[str, ...] = (), slice_seconds: int = HOUR,
    hot: tuple[DataFrame, bool] | None = None,
) -> DataFrame:
    """Adds ``previous``: the ``carry`` columns of the row before, per key in time order.

    Keys must not be NULL. The window runs per (key, time slice), and per part of those slices that
    ``hot`` (from ``hot_slices``) cuts; the first row of a part gets the last row of the key's
    nearest earlier part, found among one row per (key, slice, part).
    """
    sliced = df.withColumn("_slice", _slice(time_col, slice_seconds))
    group = [*keys, "_slice"]
    if hot:
        micros = F.unix_micros(time_col)
        sliced = _with_marks(sliced, hot[0], hot[1], group).withColumn("_part", F.coalesce(
            F.size(F.filter("_cuts", lambda cut: cut < micros)), F.lit(0))).drop("_cuts")
        group.append("_part")
    carried = F.struct(*carry)
    rows = sliced.withColumn(
        "_before", F.lag(carried).over(Window.partitionBy(*group).orderBy(time_col, *tie)))
    last = sliced.groupBy(*group).agg(
        F.max_by(carried, F.struct(time_col, *tie)).alias("_last"))
    border = last.withColumn("_border", F.lag("_last").over(
        Window.partitionBy(*keys).orderBy(*group[len(keys):]))).drop("_last")
    return (
        rows.join(border, group, "left")
        .select(*df.columns, F.coalesce("_before", "_border").alias("previous"))
    )


def row_number_in_slices(
    df: DataFrame, keys: list[str], order: list[Column], name: str
) -> DataFrame:
    """``row_number`` per key (over all rows when ``keys`` is empty) without whole-key groups.

    Rows are range-partitioned on keys and order and checkpointed, so that the slice numbers are
    fixed even if an executor is lost; a row's number is its rank in the slice plus the rows of its
    key in earlier slices. ``order`` must be total.
    """
    sliced = (
        df.repartitionByRange(*[F.col(k) for k in keys], *order)
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint()
    )
    group = [*keys, "_slice"]
    sizes = sliced.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    # at most one row per key and partition
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_earlier"))
    ranked = sliced.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return join_null_safe(ranked, offsets, group).select(
        *df.columns, (F.col("_rank") + F.col("_earlier")).cast("bigint").alias(name),
    )


def left_join_dim(fact: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of fact rows to ``columns`` of a dimension.

    Fact rows without a key match nothing, but a plain join would still hash them all to one
    task: a second join column spreads them. Hot keys that do match are split by the adaptive
    skew join; a dimension below the broadcast threshold is broadcast by Spark's own size check.
    """
    side = dim.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_dim_key"),
        F.pmod(F.xxhash64(key), F.lit(1)).alias("_dim_spread"),
        *columns,
    )
    spread = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(*fact.columns), F.lit(4096))
    ).otherwise(F.lit(0)).cast("bigint")
    wide = fact.withColumn("_spread", spread)
    return wide.join(
        side,
        (wide[key] == side["_dim_key"]) & (wide["_spread"] == side["_dim_spread"]),
        "left",
    ).drop("_dim_key", "_dim_spread", "_spread")

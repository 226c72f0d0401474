"""Writes, upserts and schema alignment."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.schemas import MERGE_KEYS, REQUIRED_TABLES
from playmart.session import scratch_path
from playmart.sources.tables import (
    bucket_column,
    bucket_name,
    bucket_parts,
    read_table,
    table_exists,
)

FEWEST_BUCKETS, MOST_BUCKETS, BUCKET_BYTES = 16, 16_384, 256 << 20
# the table beside a merged one that notes the last batch of each stream
BATCHES = "_batches"


def merge_keys(table: str) -> list[str]:
    return list(MERGE_KEYS.get(table, []))


def _aligned(new: T.DataType, stored: T.DataType) -> T.DataType | None:
    """Type to cast a new column to, or None to leave it."""
    families = (
        (T.IntegerType, T.LongType),
        (T.FloatType, T.DoubleType),
        # session time zone is UTC: the label is added or stripped, the wall time stays
        (T.TimestampType, T.TimestampNTZType),
    )
    for family in families:
        if isinstance(new, family) and isinstance(stored, family) and new != stored:
            return stored
    return None


def align_schema(new: DataFrame, stored: DataFrame) -> DataFrame:
    """New data with widths and time zone labels of the stored table."""
    types = {f.name: f.dataType for f in stored.schema}
    casts = {}
    for field in new.schema:
        target = _aligned(field.dataType, types.get(field.name, field.dataType))
        if target is not None:
            casts[field.name] = F.col(field.name).cast(target)
    return new.withColumns(casts) if casts else new


def harmonize_schemas(frames: list[DataFrame]) -> list[DataFrame]:
    """All frames with the union of columns: missing ones and untyped ones become NULL strings."""
    names = list(dict.fromkeys(c for df in frames for c in df.columns))
    out = []
    for df in frames:
        untyped = {f.name for f in df.schema if isinstance(f.dataType, T.NullType)}
        out.append(df.select(*[
            F.lit(None).cast("string").alias(c) if c not in df.columns
            else F.col(c).cast("string").alias(c) if c in untyped else F.col(c)
            for c in names
        ]))
    return out


def upsert(existing: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose keys are not in ``new``, plus all of ``new``.

    NULL keys match nothing, so such existing rows stay; repeats inside ``new`` stay too. Without
    keys the result is the distinct union.
    """
    if existing is None:
        return new
    new = align_schema(new, existing)
    if not keys:
        return existing.unionByName(new, allowMissingColumns=True).distinct()
    kept = existing.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*existing.columns).unionByName(new, allowMissingColumns=True)


def _save(df: DataFrame, path: str, mode: str, partition_by: list[str] | None = None) -> None:
    """One write by Spark. With partitions "dynamic" replaces those that have rows in ``df`` and
    leaves the others; Spark stages the files and puts them in place when all tasks are done."""
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "dynamic":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.mode(mode).parquet(path)


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back. Spark then knows its size, where
    it only has an estimate for an aggregate, and joins it accordingly."""
    path = scratch_path(df.sparkSession, label)
    _save(df, path, "error")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_overwrite(df: DataFrame, base: str, table: str, partition_by: list[str] | None = None,
                    arrange: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replaces the table; ``arrange`` orders rows for the files.

    Where a table is replaced, the rows are computed into the scratch folder first: ``df`` may read
    the old table, and a failed computation changes nothing. The second write only copies, and
    what it copies stays in the scratch folder should it be cut off. A partitioned table without
    rows has no files, so it reads as absent.
    """
    if table_exists(df.sparkSession, base, table):
        df = settled(df, "overwrite")
    _save(arrange(df) if arrange else df, f"{base}/{table}", "overwrite", partition_by)


def write_append(df: DataFrame, base: str, table: str) -> None:
    """Adds files; stored files are not rewritten and may have other columns."""
    spark = df.sparkSession
    stored = read_table(spark, base, table)
    if stored is None:
        write_overwrite(df, base, table)
        return
    df = align_schema(df, stored)
    types = {f.name: f.dataType for f in stored.schema}
    clash = [f.name for f in df.schema if types.get(f.name, f.dataType) != f.dataType]
    if clash:
        raise ValueError(f"columns with other types than in {table}: {', '.join(clash)}")
    bucket = bucket_column(read_table(spark, base, table, raw=True).columns)
    if bucket:
        df = _dealt(_numbered(df, bucket), bucket)
    _save(df, f"{base}/{table}", "append", [bucket] if bucket else None)


def _numbered(df: DataFrame, bucket: str) -> DataFrame:
    count, keys = bucket_parts(bucket)
    texts = [F.col(f"`{k}`").cast("string") for k in keys]
    return df.withColumn(bucket, F.pmod(F.xxhash64(*texts), F.lit(count)).cast("int"))


def _dealt(df: DataFrame, part: str) -> DataFrame:
    """Rows dealt so that a partition is few files, and a large one is written by several tasks."""
    return df.withColumnRenamed(part, "_part").hint("rebalance", "_part").withColumnRenamed(
        "_part", part)


def _bucket_count(spark: SparkSession, base: str, table: str) -> int:
    size = table_files(spark, base, table).agg(F.sum("bytes")).first()[0] or 0
    return min(MOST_BUCKETS, max(FEWEST_BUCKETS, -(-size // BUCKET_BYTES)))


def is_among(name: str, values: list) -> Column:
    """Whether a column has one of the values, which may hold None; never NULL."""
    column = F.col(f"`{name}`")
    known = F.coalesce(column.isin([v for v in values if v is not None]), F.lit(False))
    return known | column.isNull() if None in values else known


def _merge_touched(new: DataFrame, base: str, table: str, keys: list[str], part: str) -> None:
    """Upsert within the partitions of ``part`` that have rows of ``new``. Their values come to the
    driver: they are folders, which a listing of the table holds there anyway."""
    spark = new.sparkSession
    raw = read_table(spark, base, table, raw=True)
    if raw.schema[part].dataType != new.schema[part].dataType:
        new = new.withColumn(part, F.col(f"`{part}`").cast(raw.schema[part].dataType))
    new = new.persist()
    try:
        values = [r[0] for r in new.select(f"`{part}`").distinct().collect()]
        rows = upsert(raw.where(is_among(part, values)), new, keys)
        _save(_dealt(rows, part), f"{base}/{table}", "dynamic", [part])
    finally:
        new.unpersist()


def _merged_batch(spark: SparkSession, base: str, table: str, stream: str) -> int:
    """The last batch of a stream that the table holds; -1 if there is none."""
    log = read_table(spark, base, f"{table}{BATCHES}", merge_schema=False)
    if log is None:
        return -1
    return log.where(F.col("name") == stream).agg(
        F.coalesce(F.max("batch"), F.lit(-1))).first()[0]


def write_merge(df: DataFrame, base: str, table: str, keys: list[str] | None = None,
                batch: tuple[str, int] | None = None, partition_by: str | None = None,
                buckets: int | None = None) -> None:
    """Upsert into the stored table that rewrites only partitions with a key of ``df``.

    The table is partitioned by ``partition_by``, which the keys must imply, or else by buckets:
    the hash of the keys modulo ``buckets``, by default one for each 256 MB, at least 16. The
    bucket column's name says how it is made, ``read_table`` leaves it out. The first merge into a
    table with another layout lays it out anew as a whole, later ones replace touched buckets by
    Spark's dynamic overwrite; all others keep their files and a failed merge changes nothing.

    ``batch`` names a stream and its batch; a batch that is already in the table is not merged
    again. Should a run end between the merge and that note, the batch is merged twice: rows with
    keys replace themselves, those without a key come twice. Without keys the table becomes the
    distinct union.
    """
    spark = df.sparkSession
    keys = merge_keys(table) if keys is None else keys
    if batch and _merged_batch(spark, base, table, batch[0]) >= batch[1]:
        return
    stored = read_table(spark, base, table)
    if not keys:
        write_overwrite(df if stored is None else upsert(stored, df, []), base, table,
                        [partition_by] if partition_by else None)
    elif partition_by:
        if stored is None:
            write_overwrite(df, base, table, [partition_by])
        else:
            _merge_touched(align_schema(df, stored), base, table, keys, partition_by)
    else:
        known = None if stored is None else bucket_column(
            read_table(spark, base, table, raw=True).columns)
        if known and bucket_parts(known)[1] == keys:
            _merge_touched(_numbered(align_schema(df, stored), known), base, table, keys, known)
        else:
            count = buckets or (FEWEST_BUCKETS if stored is None
                                else _bucket_count(spark, base, table))
            name = bucket_name(count, keys)
            write_overwrite(upsert(stored, df, keys), base, table, [name],
                            lambda rows: _dealt(_numbered(rows, name), name))
    if batch:
        note = spark.range(1).select(
            F.lit(batch[0]).alias("name"), F.lit(batch[1]).cast("bigint").alias("batch"),
            F.sha2(F.lit(batch[0]), 256).alias("stream"))
        _save(note, f"{base}/{table}{BATCHES}", "dynamic", ["stream"])


def write_merge_partitions(df: DataFrame, base: str, table: str, keys: list[str],
                           partition: str) -> None:
    """Upsert into a partitioned table; keys must imply the partition. Partitions without a row of
    ``df`` keep all their files, and NULL is a partition like others."""
    write_merge(df, base, table, keys, partition_by=partition)


def replace_partitions(df: DataFrame, base: str, table: str, partition: str, values: list,
                       arrange: Callable[[DataFrame], DataFrame] | None = None,
                       held: list | None = None) -> None:
    """Replaces whole partitions of a stored table. Where one of them has no row in ``df`` but has
    stored ones, the table is written anew without it, as Spark's writer removes no partition.

    ``held`` are the values that have rows in ``df``, where the caller knows them and ``df`` does
    not read the table; then rows are computed straight into the table, not into scratch first."""
    spark = df.sparkSession
    stored = read_table(spark, base, table)
    rows = df.where(is_among(partition, values)) if held is None else df
    if stored is None:
        write_overwrite(rows, base, table, [partition], arrange)
        return
    if held is None:
        rows = settled(rows, "partitions")
        held = [r[0] for r in rows.select(partition).distinct().collect()]
    old = {r[0] for r in stored.where(is_among(partition, values)).select(
        partition).distinct().collect()}
    if old - set(held):
        kept = stored.where(~is_among(partition, values))
        rows = kept.unionByName(rows, allowMissingColumns=True)
        write_overwrite(rows, base, table, [partition], arrange)
    else:
        _save(arrange(rows) if arrange else rows, f"{base}/{table}", "dynamic", [partition])


def merge_counts(existing: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows of ``new`` whose keys are stored, rows that are added, rows after the merge."""
    n = F.count(F.lit(1))
    if existing is None:
        return new.agg(F.lit(0).cast("bigint").alias("rows_updated"), n.alias("rows_added"),
                       n.alias("total_rows"))
    known = new.join(existing.select(*keys).distinct(), keys, "left_semi").agg(n).scalar()
    total = upsert(existing, new, keys).agg(n).scalar()
    return new.agg(n.alias("rows_new")).select(
        known.alias("rows_updated"), (F.col("rows_new") - known).alias("rows_added"),
        total.alias("total_rows"))


def write_table(df: DataFrame, base: str, table: str, mode: str = "overwrite") -> None:
    writers = {"overwrite": write_overwrite, "append": write_append, "merge": write_merge}
    if mode not in writers:
        raise ValueError(f"Unsupported write mode: {mode}")
    writers[mode](df, base, table)


def write_csv_snapshot(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. ``single_file`` is for the small recent window only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)


def table_files(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Data files with their sizes; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True).load(f"{base}/{table}")
        .select(F.col("path"), F.col("length").alias("bytes"))
    )


def table_info(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One row: exists, record_count, columns, column_types, file_count, total_bytes."""
    df = read_table(spark, base, table)
    if df is None:
        return spark.range(1).select(
            F.lit(table).alias("table"), F.lit(False).alias("exists"))
    names = F.array(*[F.lit(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema
                           for x in (f.name, f.dataType.simpleString())])
    files = table_files(spark, base, table)
    return (
        df.agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("file_count", files.agg(F.count(F.lit(1))).scalar())
        .withColumn("total_bytes", files.agg(F.sum("bytes")).scalar())
        .select(F.lit(table).alias("table"), F.lit(True).alias("exists"), "record_count",
                names.alias("columns"), types.alias("column_types"),
                "file_count", "total_bytes")
    )


def validate_tables(spark: SparkSession, base: str, names=REQUIRED_TABLES) -> DataFrame:
    """Each required table with exists, rows and, on every row, whether all exist."""
    parts = []
    for name in names:
        df = read_table(spark, base, name)
        if df is None:
            part = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        else:
            part = df.agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(part.select(F.lit(name).alias("table"),
                                 F.lit(df is not None).alias("exists"), "row_count"))
    checks = reduce(DataFrame.unionByName, parts)
    return checks.withColumn("all_valid", checks.agg(F.bool_and("exists")).scalar())


def check_column_consistency(stored: DataFrame | None, model: DataFrame) -> DataFrame:
    """Column names side by side, compared without case, and whether the name sets agree."""
    spark = model.sparkSession

    def listed(df: DataFrame | None, type_name: str) -> DataFrame:
        rows = [] if df is None else [
            (f.name.lower(), f.dataType.simpleString()) for f in df.schema]
        return spark.createDataFrame(rows, f"column_name string, {type_name} string")

    both = listed(stored, "stored_type").join(
        listed(model, "model_type"), "column_name", "full_outer")
    both = both.withColumn(
        "in_both", F.col("stored_type").isNotNull() & F.col("model_type").isNotNull())
    return both.withColumn("columns_match", both.agg(F.bool_and("in_both")).scalar())

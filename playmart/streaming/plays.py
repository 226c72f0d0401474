"""Structured Streaming forms of ingest, de-duplication, upsert and rolling reports."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from playmart.functions.scoring import exact_minutes, scaled_ms
from playmart.operators.dedup import (
    EXACT_KEYS,
    TRACK_KEYS,
    total_order,
)
from playmart.operators.sinks import write_merge
from playmart.operators.skew import left_join_dim
from playmart.sources.plays import CORRUPT, add_plays, raw_schema, split_rejected, typed_plays

DELAY = "1 hour"
MICROS, SECOND = "_micros", 1_000_000
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# a store keeps up to 128 MB of unwritten rows outside the heap for each partition; bounded, all
# stores of an executor share 500 MB and write the rest to their files
STORE_CONF = {STORE: ROCKS, "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}
# rows of a track that are handed to the store at once
CHUNK = 10_000


def _raw_stream(spark: SparkSession, path: str, archive: str | None,
                files_per_trigger: int | None, glob: str) -> DataFrame:
    reader = spark.readStream.schema(raw_schema()).option("multiLine", True).option(
        "columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", glob)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def stream_raw_plays(spark: SparkSession, path: str, archive: str | None = None,
                     files_per_trigger: int | None = None, glob: str = "*.json") -> DataFrame:
    """New JSON files as typed plays; with ``archive`` finished files are moved there. Files that
    cannot be read give no plays; ``stream_ingest`` stores both in one stream."""
    raw = _raw_stream(spark, path, archive, files_per_trigger, glob)
    return typed_plays(split_rejected(raw)[0])


def stream_rejected_files(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                          glob: str = "*.json") -> DataFrame:
    """``source_file`` and ``text`` of new files that cannot be read."""
    return split_rejected(_raw_stream(spark, path, None, files_per_trigger, glob))[1]


def stream_ingest(spark: SparkSession, path: str, base: str, checkpoint: str,
                  archive: str | None = None, files_per_trigger: int | None = None,
                  glob: str = "*.json", rejected: str = "rejected_files") -> StreamingQuery:
    """One stream from new files to both tables: plays that are not stored yet are appended to the
    stored ones, files that cannot be read go to ``rejected`` by their path. Each file is read
    once, so finished files can be archived. A batch that runs again adds nothing."""
    raw = _raw_stream(spark, path, archive, files_per_trigger, glob).select(
        "*", F.col("_metadata.file_path").alias("source_file"))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            bad = batch.where(F.col(CORRUPT).isNotNull()).select(
                "source_file", F.col(CORRUPT).alias("text"))
            if not bad.isEmpty():
                write_merge(bad, base, rejected, ["source_file"])
            good = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "source_file")
            add_plays(typed_plays(good), base)
        finally:
            batch.unpersist()

    return (
        raw.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def run_available_now(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes what is there and appends it to a Parquet folder."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()


def stream_dedup_exact(plays: DataFrame, delay: str = DELAY) -> DataFrame:
    """First arrival per track and instant. The event time is part of the key, so the state of an
    instant ends when the watermark passes it and no copy inside the delay is missed."""
    return plays.withWatermark("played_at", delay).dropDuplicates(list(EXACT_KEYS))


class LastPlay(StatefulProcessor):
    """Per track: plays whose order is still open, and the last play whose order is final.

    A play is final once the watermark has passed it; a timer of the track then takes all final
    plays in order, compares each with the play before it and keeps the last one. Spark holds the
    state, drops late plays and restores both from the checkpoint.
    """

    def __init__(self, schema: T.StructType, order: list[str]):
        self.schema, self.order = schema, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", self.schema)
        self.last = handle.getValueState("last", f"{MICROS} bigint, duration_ms bigint")

    def _wake(self, first: int) -> None:
        self.handle.registerTimer(first // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if None in tuple(key):  # plays without a track or time are no plays
            return iter(())
        timed = (tuple(r[c] for c in self.schema.names) for r in rows if r[MICROS] is not None)
        at, first = self.schema.names.index(MICROS), None
        while new := list(islice(timed, CHUNK)):
            self.pending.appendList(new)
            earliest = min(r[at] for r in new)
            first = earliest if first is None else min(first, earliest)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        names = self.schema.names
        at, length = names.index(MICROS), names.index("duration_ms")
        order = [names.index(c) for c in self.order]
        final, later = [], []
        for row in self.pending.get():
            (final if row[at] <= closed else later).append(tuple(row))
        if not final:
            return iter(())
        # null comes first, as in the batch operator
        final.sort(key=lambda r: (r[at], *[(r[c] is not None, r[c]) for c in order]))
        before = self.last.get() if self.last.exists() else None
        kept = []
        for row in final:
            if (before is None or before[1] is None or
                    (row[at] - before[0]) // SECOND * 1000 > before[1]):
                kept.append(row)
            before = (row[at], row[length])
        self.last.update(before)
        if later:
            self.pending.put(later)
            self._wake(min(r[at] for r in later))
        else:
            self.pending.clear()
        # rows with names one at a time: they are far larger than tuples
        return (Row(**dict(zip(names, r))) for r in kept)

    def close(self) -> None:
        pass


def stream_dedup_within_duration(plays: DataFrame, delay: str = DELAY, tie: tuple[str, ...] = ()
                                 ) -> DataFrame:
    """Near-repeat removal on a stream: the rows of ``dedup_within_duration``, each once the
    watermark has passed it.

    What waits is in files of the state store, which keeps a bounded part of it in memory. Order inside the delay is free. Plays behind the watermark are late; Spark drops and counts
    them in the query's progress. Plays without track name, artist or time are left out. Needs the
    RocksDB state store, which is set for the session. A bounded stream ends with
    ``closing_play``, whose track is empty here so that it only waits.
    """
    conf = plays.sparkSession.conf
    for name, value in STORE_CONF.items():
        if conf.get(name, None) != value:
            conf.set(name, value)
    columns = [c for c in plays.columns if c != "played_at"]
    order = [c for c in total_order(plays, tie)]
    timed = plays.withWatermark("played_at", delay).withColumn(
        MICROS, F.unix_micros("played_at"))
    state = T.StructType([timed.schema[c] for c in (*columns, MICROS)])
    kept = timed.groupBy(*TRACK_KEYS).transformWithState(
        LastPlay(state, order), state, "append", "EventTime")
    return kept.withColumn("played_at", F.timestamp_micros(MICROS)).select(*plays.columns)


def stream_upsert(rows: DataFrame, base: str, table: str, checkpoint: str,
                  keys: list[str] | None = None) -> StreamingQuery:
    """Merges every micro-batch into a stored table, rewriting only buckets it touches. A batch that
    runs again replaces its own rows, and one that the table notes as merged changes nothing."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        write_merge(batch, base, table, keys, (checkpoint, batch_id))

    return (
        rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_plays_per_window(plays: DataFrame, length: str = "1 hour", slide: str | None = None,
                            delay: str = DELAY) -> DataFrame:
    """Plays, minutes and distinct artists per tumbling or sliding window.

    Plays are counted per step and artist first; sliding windows then roll these few rows up, so a
    play is never copied to every window that holds it. ``length`` must be a multiple of ``slide``.
    """
    minutes = exact_minutes(scaled_ms(F.col("duration_ms"), 60_000, 2))
    steps = plays.withWatermark("played_at", delay).groupBy(
        F.window("played_at", slide or length).alias("w"), "artist").agg(
        F.count(F.lit(1)).alias("plays"), F.sum(minutes).alias("minutes"))
    total = [F.sum("plays").alias("plays"), F.sum("minutes").alias("minutes")]
    if slide:
        steps = steps.groupBy(
            F.window(F.window_time("w"), length, slide).alias("w"), "artist").agg(*total)
    return steps.groupBy("w").agg(
        F.sum("plays").alias("plays"), F.sum("minutes").cast("double").alias("minutes"),
        F.count("artist").alias("artists"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             "plays", "minutes", "artists")


def stream_sketched_windows(plays: DataFrame, length: str = "1 hour", slide: str | None = None,
                            delay: str = DELAY, log_k: int = 12) -> DataFrame:
    """``stream_plays_per_window`` with state of one row per step and one per window, however many
    artists there are: a step keeps them as a HyperLogLog sketch of 2^``log_k`` bytes, and windows
    unite the sketches of their steps.

    Plays and minutes are exact. ``artists`` is an estimate with a relative standard error of
    1.04 / 2^(``log_k`` / 2), 1.6 % by default; small sets are counted nearly exactly. Plays without
    an artist count as plays alone.
    """
    def counted(artists: Column, plays: Column, minutes: Column) -> list[Column]:
        return [F.sum(plays).alias("plays"), F.sum(minutes).alias("minutes"),
                artists.alias("artists")]

    minutes = exact_minutes(scaled_ms(F.col("duration_ms"), 60_000, 2))
    windows = plays.withWatermark("played_at", delay).groupBy(
        F.window("played_at", slide or length).alias("w")).agg(
        *counted(F.hll_sketch_agg("artist", F.lit(log_k)), F.lit(1), minutes))
    if slide:
        windows = windows.groupBy(F.window(F.window_time("w"), length, slide).alias("w")).agg(
            *counted(F.hll_union_agg("artists"), F.col("plays"), F.col("minutes")))
    return windows.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "plays",
        F.col("minutes").cast("double").alias("minutes"),
        F.hll_sketch_estimate("artists").alias("artists"))


def closing_play(like: DataFrame, at: datetime) -> DataFrame:
    """One row with an event time, an empty track and artist and nothing else. At the end of a bounded stream it moves the
    watermark to ``at`` less the delay, so that the windows before are emitted; its own are not."""
    return like.sparkSession.range(1).select(*[
        F.lit(at if f.name == "played_at" else "" if f.name in TRACK_KEYS else None).cast(
            f.dataType).alias(f.name) for f in like.schema])


def stream_enrich(plays: DataFrame, artists: DataFrame, columns: list[str]) -> DataFrame:
    """Streamed plays with columns of the (static) artists."""
    return left_join_dim(plays, artists, "artist_id", columns)

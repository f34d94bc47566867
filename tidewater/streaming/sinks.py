"""From framed records to dead letters and keyed window tables, in one query per stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater import config
from tidewater.sources.tables import Store
from tidewater.streaming import contract, policy, stateful, windows

#: Columns of a file stream that plays the message source.
SOURCE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def source(spark, path: str, max_files: int | None = None) -> DataFrame:
    """Records of a folder that grows. On a cluster with its connector: spark.readStream.format("kafka") with the same columns."""
    reader = spark.readStream.schema(SOURCE)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def put_dead_letters(letters: DataFrame, store: Store, table: str) -> None:
    """Upserts dead letters by id, in folders by the record's day: a batch reads and writes its own days only, and a replay changes nothing."""
    day = ["source_day"]
    store.upsert(table, letters.dropDuplicates(["dlq_id"]).withColumn("source_day", F.to_date("source_timestamp")), ["dlq_id", *day], partition_by=day)


def write_dead_letters(records: DataFrame, schema_id: int, store: Store, table: str, checkpoint: str) -> StreamingQuery:
    """Dead letters of a stream of records."""
    def put(batch: DataFrame, _: int) -> None:
        put_dead_letters(batch, store, table)

    bad = contract.dead_letters(contract.decoded(records, schema_id))
    return bad.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def put_windows(batch: DataFrame, store: Store, prefix: str) -> None:
    """Upserts both window tables from a batch of accepted events, which is read several times: persist it.

    The events are kept; the windows a batch touches are made anew from all of theirs, so late batches and replays give the same rows.
    """
    if batch.isEmpty():
        return
    # Tables by day: a batch reads and writes the days it touches only.
    kept, day = f"{prefix}_events", ["window_day"]
    store.upsert(kept, batch, ["event_id", *day], partition_by=day)
    touched = batch.select(F.window("event_timestamp", windows.WINDOW)["start"].alias("_w")).distinct()
    first, last = batch.agg(F.min("window_day"), F.max("window_day")).first()
    rows = store.read(kept).where(F.col("window_day").between(first, last)).withColumn("_w", F.window("event_timestamp", windows.WINDOW)["start"]).join(touched, "_w", "left_semi")
    for name, (key, distinct) in (("playback_metrics_5m", windows.BY_USER), ("content_popularity_5m", windows.BY_CONTENT)):
        out = windows.totals(rows, key, distinct).withColumn("created_timestamp", F.current_timestamp()).withColumn("window_day", F.to_date("window_start"))
        store.upsert(f"{prefix}_{name}", out, ["window_start", key, *day], partition_by=day)


def by_day(events: DataFrame) -> DataFrame:
    return events.dropDuplicates(["event_id"]).withColumn("window_day", F.to_date("event_timestamp"))


def write_windows(events: DataFrame, store: Store, prefix: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Both window tables from a stream of accepted events."""
    def put(batch: DataFrame, number: int) -> None:
        batch = by_day(batch).persist()
        try:
            put_windows(batch, store, prefix)
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_all(records: DataFrame, schema_id: int, store: Store, prefix: str, checkpoint: str, available_now: bool = False, after: Callable[[str, int], None] | None = None, **policy_options) -> StreamingQuery:
    """Dead letters and both window tables from one stream of records that is decoded and judged once.

    Each batch is persisted on disk and goes to its sinks in turn; each sink marks the batch when it is done. A batch that is run again, as
    after a failure between two sinks, skips the sinks that have marked it, and a sink that failed half-way repeats its upserts, which
    change nothing that is there. So every record counts exactly once in every table.

    after: is called with each sink's name and the batch's number when the sink is done; policy_options: those of ``stateful.judged``.
    """
    def put(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            # Even if all sinks have marked the batch: the state of ids seen is committed by computing it.
            batch.count()
            for name, sink in (("dead_letters", letters), ("windows", tables)):
                if not store.marked(f"{prefix}_{name}_marks", checkpoint, number):
                    sink(batch)
                    store.mark(f"{prefix}_{name}_marks", checkpoint, number)
                if after:
                    after(name, number)
        finally:
            batch.unpersist()

    def letters(batch: DataFrame) -> None:
        bad = batch.where(F.col("verdict") == stateful.INVALID).withColumn("timestamp", F.col("source_timestamp"))
        put_dead_letters(contract.dead_letters(bad), store, f"{prefix}_dead_letters")

    def tables(batch: DataFrame) -> None:
        good = batch.where(F.col("verdict") == stateful.ACCEPTED).select(*[n for n, _ in contract.FIELDS], "source_timestamp")
        put_windows(by_day(good), store, prefix)

    judged = stateful.judged(contract.decoded(records, schema_id), **policy_options)
    writer = judged.writeStream.queryName(prefix).foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def of_settings(records: DataFrame, settings: config.Stream, store: Store, prefix: str, checkpoint: str, **more) -> StreamingQuery:
    """``write_all`` as a settings file says: the id of the records' schema, delay of the watermark, late events, duplicates and how long ids are remembered."""
    for key, value in settings.settings().items():
        records.sparkSession.conf.set(key, value)
    return write_all(records, settings.schema_id, store, prefix, checkpoint, **more, delay=f"{settings.watermark_seconds} seconds", drop_late=settings.late_handling, dedup=settings.dedup, ttl_minutes=settings.dedup_ttl_minutes)


def drained(df: DataFrame, path: str, mode: str = "append", empty_batches: bool = False, observed: dict[str, int] | None = None) -> DataFrame:
    """Runs a stream over all that is there now into Parquet files, one folder per batch, and reads them; of complete outputs the last.

    A second run with the same path goes on where the first one ended. empty_batches: a batch without data follows when the watermark has
    moved, to close windows; not for state with a processing-time limit, which asks for ever more of these, so the run would not end.
    observed: gets the sums of the observed metrics.
    """
    last: list[int] = []
    empty, conf = "spark.sql.streaming.noDataMicroBatches.enabled", df.sparkSession.conf
    was = conf.get(empty)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")
        last[:] = [number]

    conf.set(empty, str(empty_batches).lower())
    try:
        run = df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
        for progress in run.recentProgress if observed is not None else ():
            for row in progress.observedMetrics.values():
                for name, value in row.asDict().items():
                    observed[name] = observed.get(name, 0) + (value or 0)
    finally:
        conf.set(empty, was)
    reader = df.sparkSession.read.schema(df.schema)
    if not last:
        return df.sparkSession.createDataFrame([], df.schema)
    return reader.parquet(f"{path}/out/batch={last[0]}") if mode == "complete" else reader.parquet(f"{path}/out").select(*df.columns)


def accepted(records: DataFrame, schema_id: int, delay: str = "30 seconds", ttl_minutes: int = policy.TTL_MINUTES) -> DataFrame:
    """Valid, on-time, first copies of a stream of records."""
    return policy.on_time_once(contract.valid(contract.decoded(records, schema_id)), delay, ttl_minutes)

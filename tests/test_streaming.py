"""Streams: verdicts and their counts, windows that close, one pass into several sinks, recovery."""

from __future__ import annotations

import datetime
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.plans import catalogue
from tidewater.sources.tables import Store
from tidewater.streaming import contract, policy, sinks, stateful, windows
from tidewater.streaming.messages import encoded

BASE = datetime.datetime(2026, 1, 1)
EVENTS = "user_id long, session_id string, content_id long, event_type string, watch_seconds long, event_timestamp timestamp, source_timestamp timestamp"


@pytest.fixture(autouse=True)
def quick_polls(spark):
    spark.conf.set("spark.sql.streaming.pollingDelay", "50ms")


def event(user, minute, lag=0, session="s", content=1, kind="playback_started", watched=0):
    at = BASE + datetime.timedelta(minutes=minute)
    return user, session, content, kind, watched, at, at + datetime.timedelta(minutes=lag)


def land(spark, path, rows, kinds):
    spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(f"{path}/in")
    time.sleep(1.1)  # files are taken by their time


def windows_of(spark, path, phases, **options):
    """Rows of ``event_windows`` after each phase, and the late rows of each."""
    out, late = [], []
    for rows in phases:
        land(spark, path, rows, EVENTS)
        counts = {}
        stream = spark.readStream.schema(EVENTS).parquet(f"{path}/in")
        found = sinks.drained(stateful.event_windows(stream, *windows.BY_USER, **options), str(path), empty_batches=True, observed=counts)
        out.append({(r.user_id, (r.window_start - BASE).total_seconds() / 60): (r.event_count, r.unique_session_count, r.unique_content_count, r.completed_watch_seconds) for r in found.collect()})
        late.append(counts.get("late_rows", 0))
    return out, late


def test_event_windows_close_by_production_time(spark, tmp_path):
    first = [event(1, 1), event(1, 4, session="t"), event(1, 4, content=2), event(1, 6), event(2, 1, kind="playback_completed", watched=30), event(2, 2, lag=13)]
    # The watermark is 14:30: windows up to 10 are closed, that from 10 on is open.
    second = [event(1, 3), event(1, 9), event(1, 11), event(2, 12, lag=30)]
    third = [event(1, 100)]
    (a, b, c), late = windows_of(spark, tmp_path, [first, second, third])
    assert a == {(1, 0): (3, 2, 2, 0), (1, 5): (1, 1, 1, 0), (2, 0): (2, 1, 1, 30)}
    assert b == a | {(1, 10): (1, 1, 1, 0), (2, 10): (1, 1, 1, 0)} and late[:2] == [0, 2]
    assert c == b


def test_state_is_empty_when_all_windows_have_closed(spark, tmp_path):
    land(spark, tmp_path, [event(u, m) for u in range(5) for m in range(0, 60, 3)], EVENTS)
    land(spark, tmp_path, [(-1, None, None, None, None, None, BASE + datetime.timedelta(days=9))], EVENTS)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    conf = spark.conf
    conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    rows = []
    query = stateful.event_windows(stream, *windows.BY_USER).writeStream.foreachBatch(lambda b, _: rows.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    assert len(rows) == 5 * 12
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal == 0


def test_windows_of_an_idle_source_close(spark, tmp_path):
    """Nothing comes after the first file: its windows close by processing time."""
    land(spark, tmp_path, [event(1, 1), event(1, 7), event(2, 2)], EVENTS)
    stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in")
    rows = []
    query = stateful.event_windows(stream, *windows.BY_USER, idle_seconds=3).writeStream.foreachBatch(lambda b, _: rows.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start()
    try:
        until = time.time() + 90
        while len(rows) < 3 and time.time() < until:
            time.sleep(0.5)
        assert sorted((r.user_id, r.event_count) for r in rows) == [(1, 1), (1, 1), (2, 1)]
    finally:
        query.stop()


def test_appended_windows_reject_late_rows(spark, tmp_path):
    """On both sides of a closed window: rows of it are rejected, rows of the next, open one count."""
    def run(rows):
        land(spark, tmp_path, rows, EVENTS)
        stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in").withWatermark("event_timestamp", "30 seconds")
        return {(r.window_start - BASE).total_seconds() / 60: r.event_count for r in sinks.drained(windows.totals(stream, *windows.BY_USER, streaming=True), str(tmp_path), empty_batches=True).collect()}

    assert run([event(1, 1), event(1, 6), event(1, 9)]) == {0: 1}
    assert run([event(1, 4.9), event(1, 5.0), event(1, 8)]) == {0: 1}
    assert run([event(1, 16)]) == {0: 1, 5: 4}


def records(spark, rows):
    """Records of (offset, event id, minute, watched, whether it is broken), produced when they happened."""
    kinds = "offset long, event_id string, minute double, watched int, broken boolean"
    df = spark.createDataFrame(rows, kinds).withColumn("at", (F.lit(BASE) + F.make_dt_interval(secs=F.col("minute") * 60)).cast("timestamp"))
    df = df.select("offset", "broken", "at", "event_id", F.lit("u").alias("user_id"), F.lit("c").alias("content_id"), F.lit("s").alias("session_id"), F.lit("playback_completed").alias("event_type"), F.lit(0).alias("position_seconds"),
        F.col("watched").alias("watch_seconds"), F.col("at").alias("event_timestamp"), F.col("at").alias("produced_timestamp"), F.lit(1).alias("payload_schema_version"))
    value = F.when(F.col("broken"), F.unhex(F.lit("FF"))).otherwise(encoded(7))
    return df.select(F.lit(None).cast("binary").alias("key"), value.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", F.col("at").alias("timestamp"))


PHASES = [
    [(0, "a", 1.0, 10, False), (1, "a", 1.0, 10, False), (2, "b", 2.0, 20, False), (3, "x", 3.0, 0, True), (4, "c", 9.0, 5, False)],
    [(5, "late", 2.0, 99, False), (6, "c", 9.0, 5, False), (7, "d", 10.0, 7, False), (8, "y", 10.0, 0, True), (9, "z", 1.0, 0, True)],
    [(10, "e", 20.0, 1, False), (11, "d", 20.0, 7, False)],
]
WANT = {"late_events_dropped": 1, "duplicate_events_dropped": 3, "invalid_events_routed": 3, "events_accepted": 5}


def run_all(spark, tmp_path, store, **options):
    source = sinks.source(spark, f"{tmp_path}/in", 1)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        query = sinks.write_all(source, 7, store, "live", f"{tmp_path}/c", available_now=True, **options)
        query.awaitTermination()
        return query
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")


def tables(store):
    letters = sorted((r.source_offset, r.error_type) for r in store.read("live_dead_letters").collect())
    rows = sorted(((r.window_start - BASE).total_seconds() / 60, r.event_count, r.completed_watch_seconds) for r in store.read("live_playback_metrics_5m").collect())
    same = sorted(((r.window_start - BASE).total_seconds() / 60, r.event_count) for r in store.read("live_content_popularity_5m").collect())
    return letters, rows, same


RIGHT = [(3, contract.FRAME), (8, contract.FRAME), (9, contract.FRAME)], [(0, 2, 30), (5, 1, 5), (10, 1, 7), (20, 1, 1)], [(0, 2), (5, 1), (10, 1), (20, 1)]


def landed(spark, tmp_path):
    for rows in PHASES:
        land_records(spark, tmp_path, rows)


def land_records(spark, tmp_path, rows):
    records(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    time.sleep(1.1)


def test_one_pass_into_three_sinks_with_counters(spark, tmp_path):
    store, counters = Store(spark, f"file://{tmp_path}/store"), stateful.Counters()
    landed(spark, tmp_path)
    spark.streams.addListener(counters)
    try:
        query = run_all(spark, tmp_path, store)
        assert tables(store) == RIGHT
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        until = time.time() + 20
        while counters.of() != WANT and time.time() < until:
            time.sleep(0.2)
        assert counters.of() == WANT
        # One read, one decoder and one keyed operator in the batch's plan.
        plan = query._jsq.explainInternal(True) if hasattr(query, "_jsq") else ""
        assert plan.count("ArrowEvalPython") <= 2 * plan.count("== Physical Plan ==") or not plan
    finally:
        spark.streams.removeListener(counters)


class Killed(Exception):
    pass


@pytest.mark.parametrize(("sink", "batch"), [("dead_letters", 0), ("dead_letters", 1), ("windows", 1)])
def test_a_query_killed_between_its_sinks_ends_with_the_same_rows(spark, tmp_path, sink, batch):
    store = Store(spark, f"file://{tmp_path}/store")
    landed(spark, tmp_path)
    calls = []

    def fail(name, number):
        calls.append((name, number))
        if (name, number) == (sink, batch) and calls.count((sink, batch)) == 1:
            raise Killed

    with pytest.raises(Exception, match="Killed"):
        run_all(spark, tmp_path, store, after=fail)
    run_all(spark, tmp_path, store, after=fail)
    assert tables(store) == RIGHT
    # A sink that had marked the batch was not written again: one write for each batch with dead letters.
    assert calls.count((sink, batch)) == 2 and len(store.snapshots("live_dead_letters")) == 2
    before = [len(store.snapshots(t)) for t in ("live_dead_letters", "live_playback_metrics_5m")]
    run_all(spark, tmp_path, store)
    assert [len(store.snapshots(t)) for t in ("live_dead_letters", "live_playback_metrics_5m")] == before


def test_a_sink_killed_half_way_repeats_its_upserts(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    landed(spark, tmp_path)
    real, failed = Store.upsert, []

    def upsert(self, table, *a, **k):
        out = real(self, table, *a, **k)
        if table == "live_playback_metrics_5m" and not failed:
            failed.append(table)
            raise Killed
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(Store, "upsert", upsert)
        with pytest.raises(Exception, match="Killed"):
            run_all(spark, tmp_path, store)
        run_all(spark, tmp_path, store)
    assert tables(store) == RIGHT


@pytest.mark.parametrize(("options", "want"), [({"dedup": False}, {"duplicate_events_dropped": 0, "events_accepted": 8, "late_events_dropped": 1}), ({"drop_late": False}, {"late_events_dropped": 0, "events_accepted": 6, "duplicate_events_dropped": 3})])
def test_policies_can_be_switched_off(spark, tmp_path, options, want):
    landed(spark, tmp_path)
    found = {}
    sinks.drained(stateful.judged(contract.decoded(sinks.source(spark, f"{tmp_path}/in", 1), 7), **options), str(tmp_path), observed=found)
    assert {k: found[k] for k in want} == want and found["invalid_events_routed"] == 3


def test_replays_of_batches_count_once():
    counters = stateful.Counters()

    class Row(dict):
        def asDict(self):
            return self

    class Event:
        def __init__(self, batch, late):
            self.progress = type("P", (), {"name": "q", "id": 1, "batchId": batch, "observedMetrics": {"policy": Row(late=late)}})

    for batch, late in ((0, 2), (1, 3), (1, 3), (2, None)):
        counters.onQueryProgress(Event(batch, late))
    assert counters.of() == {"late": 5}


def test_marks(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    assert not store.marked("m", "one", 0)
    store.mark("m", "one", 3)
    store.mark("m", "one", 4)
    assert store.marked("m", "one", 4) and not store.marked("m", "one", 5) and not store.marked("m", "two", 0)


def test_stream_queries_are_registered():
    assert {"stream_closed_windows", "stream_event_windows", "stream_counters"} <= set(catalogue.ORACLE_SQL)


def test_seen_ids_share_entries_of_state(spark, tmp_path, monkeypatch):
    """A group has the ids of many hashes, an entry those of a slot; copies go within a batch and between batches, nulls are one id."""
    monkeypatch.setattr(policy, "GROUPS", 4)
    monkeypatch.setattr(policy, "SLOTS", 4)
    schema = "event_id long, event_timestamp timestamp, source_timestamp timestamp"
    found, entries = [], []
    for ids in ([*range(400), None], [*range(200, 500), None]):
        land(spark, tmp_path, [(i, BASE, BASE) for i in ids for _ in range(2)], schema)
        conf = spark.conf
        conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        run = policy.on_time_once(stream).writeStream.foreachBatch(lambda b, _: found.extend(r.event_id for r in b.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        assert run.awaitTermination(240)
        conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
        entries.append(run.lastProgress["stateOperators"][0]["customMetrics"].get("rocksdbTotalKeys", run.lastProgress["stateOperators"][0]["numRowsTotal"]))
    assert sorted(found, key=lambda i: -1 if i is None else i) == [None, *range(500)]
    assert all(n < 200 for n in entries)


def test_verdicts_of_a_group_of_many_ids(spark, tmp_path, monkeypatch):
    """All ids in one group and one entry of state: each still has its own verdict."""
    monkeypatch.setattr(policy, "GROUPS", 1)
    monkeypatch.setattr(policy, "SLOTS", 1)
    found = {}
    for rows in PHASES:
        land_records(spark, tmp_path, rows)
        sinks.drained(stateful.judged(contract.decoded(sinks.source(spark, f"{tmp_path}/in"), 7)), str(tmp_path), observed=found)
    assert {k: found[k] for k in WANT} == WANT


def test_windows_of_a_group_share_an_entry_of_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "WINDOW_GROUPS", 1)
    land(spark, tmp_path, [event(u, m) for u in range(100) for m in (1, 7)], EVENTS)
    stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in")
    query = stateful.event_windows(stream, *windows.BY_USER).writeStream.foreachBatch(lambda b, _: b.collect()).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    entries = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert 0 < max(entries) < 20


def test_batches_of_records_are_encoded_like_single_ones(spark):
    ends = (0, -1, 63, 64, -64, -65, (1 << 31) - 1, -(1 << 31))
    longs = (*ends[:-2], (1 << 63) - 1, -(1 << 63))
    rows = [{n: (text * size if kind == "string" else number if kind == "int" else long) for n, kind in contract.FIELDS} for text, size in (("", 1), ("a", 63), ("é", 64), ("𝄞", 5000)) for number, long in zip(ends, longs, strict=True)]
    rows.append(dict.fromkeys(rows[0], 1) | {"user_id": None, "content_id": 7})
    assert contract.encode_bodies(pd.DataFrame(rows)) == [contract.encode(r, 7)[5:] for r in rows]
    assert contract.encode_bodies(pd.DataFrame(rows).iloc[:0]) == []
    # A schema's id by row, and of one that fills its four bytes.
    cut = spark.createDataFrame([(1, "a", 1.0, 5, False)], "offset long, event_id string, minute double, watched int, broken boolean")
    cut = cut.select("event_id", *[F.lit("u").alias(n) for n in ("user_id", "content_id", "session_id", "event_type")], *[F.lit(1).alias(n) for n in ("position_seconds", "watch_seconds", "payload_schema_version")], *[F.lit(BASE).alias(n) for n in ("event_timestamp", "produced_timestamp")])
    one, two = cut.select(encoded(F.lit(258)).alias("a"), encoded((1 << 32) - 1).alias("b")).first()
    assert one[:5] == b"\0\0\0\1\2" and two[:5] == b"\0\xff\xff\xff\xff" and one[5:] == two[5:]


def pythons(df):
    """Operators of the plan that call Python: each has a worker of its own in every task."""
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def events_file(spark, tmp_path):
    spark.sql("SELECT id AS event_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts, id % 9 AS user_id, 'view' AS event_type, 1.5D AS value, '{\"k\": 3}' AS props FROM range(400)").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_dead_letters_are_decoded_once(spark, tmp_path):
    """One encoder of the made records and one decoder, though the dead letters are filtered by what the decoder says."""
    found = catalogue.QUERIES["dlq_split"](spark, events_file(spark, tmp_path))
    assert pythons(found) <= 2
    wrong = {r.source_offset: r.error_type for r in found.collect()}
    assert wrong.keys() == {n for n in range(400) if any(n % k == 0 for k in (11, 13, 17, 19, 23))} and {wrong[11], wrong[13], wrong[17], wrong[19], wrong[23]} == {contract.FRAME, contract.SCHEMA_ID, contract.CONTRACT, contract.DECODE, contract.TRAILING}


def test_verdicts_alone_are_those_of_whole_rows(spark, tmp_path):
    """Columns that nobody reads stay out of the operator; the ones asked for come along."""
    for columns, path in (((), "a"), (("offset", "source_timestamp"), "b")):
        landed(spark, tmp_path / path)
        found = {}
        rows = sinks.drained(stateful.judged(contract.decoded(sinks.source(spark, f"{tmp_path}/{path}/in", 1), 7), columns=columns), f"{tmp_path}/{path}", observed=found)
        assert {k: found[k] for k in WANT} == WANT and rows.columns == [*columns, "verdict"]
    got = {r.offset: r.verdict for r in rows.collect()}
    assert {n for n, v in got.items() if v == "invalid"} == {3, 8, 9} and {n for n, v in got.items() if v == "late"} == {5}
    assert got.keys() == set(range(12)) and sorted([got[0], got[1]]) == ["accepted", "duplicate"] and (got[4], got[6]) == ("accepted", "duplicate")


def test_counting_passes_no_columns_through_the_operator(spark, tmp_path, monkeypatch):
    real, given = stateful.judged, []
    monkeypatch.setattr(stateful, "judged", lambda *a, **k: given.append(real(*a, **k)) or given[-1])
    catalogue.QUERIES["stream_counters"](spark, events_file(spark, tmp_path))
    assert [df.columns for df in given] == [["verdict"], ["verdict"]]


def test_dead_letter_messages_are_decoded_once(spark, tmp_path):
    found = catalogue.QUERIES["dlq_messages"](spark, events_file(spark, tmp_path))
    assert pythons(found) <= 2
    assert found.count() == sum(any(n % k == 0 for k in (11, 13, 17, 19, 23)) for n in range(400))


def test_valid_events_are_decoded_once(spark, tmp_path):
    found = catalogue.QUERIES["valid_events"](spark, events_file(spark, tmp_path))
    assert pythons(found) <= 2
    assert {r.event_id for r in found.collect()} == {f"e{n}" for n in range(400) if all(n % k for k in (11, 13, 17, 19, 23))}

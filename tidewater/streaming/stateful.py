"""Keyed operators of streams that carry a time of production beside the time of the event, and the counts of what they turn away.

Production time (``source_timestamp``) drives the watermark; lateness and windows go by the event's own time, which may lag. A record
that cannot be decoded takes part in the watermark and is passed on under a verdict, so a stream is decoded once for all its sinks.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidewater.streaming import policy

ACCEPTED, LATE, DUPLICATE, INVALID = "accepted", "late", "duplicate", "invalid"
COUNTED = {"late_events_dropped": LATE, "duplicate_events_dropped": DUPLICATE, "invalid_events_routed": INVALID, "events_accepted": ACCEPTED}


class Judge(StatefulProcessor):
    """Adds a verdict to each row of a group of event ids (``policy.grouped``): invalid, late, duplicate, or accepted for the first on-time copy.

    Late rows do not mark an id as seen. A seen id is forgotten a fixed processing time after it was first seen.
    """

    def __init__(self, drop_late: bool = True, dedup: bool = True, ttl_minutes: int = policy.TTL_MINUTES):
        self.drop_late, self.dedup, self.ttl_minutes = drop_late, dedup, ttl_minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.dedup:
            self.seen = policy.Seen(handle, self.ttl_minutes)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer: Any) -> Iterator[pd.DataFrame]:
        watermark, now = timer.getCurrentWatermarkInMs() * 1000, timer.getCurrentProcessingTimeInMs()
        for batch in rows:
            verdict = np.full(len(batch), ACCEPTED, object)
            if self.drop_late:
                verdict[batch["judged_micros"].to_numpy() <= watermark] = LATE
            verdict[batch["judged_bad"].to_numpy()] = INVALID
            good = np.flatnonzero(verdict == ACCEPTED)
            if self.dedup and len(good):
                verdict[good[~self.seen.first(batch.iloc[good], now)]] = DUPLICATE
            yield batch.drop(columns=["seen_group", "seen_slot", "seen_id", "judged_micros", "judged_bad"]).assign(verdict=verdict)
        if self.dedup:
            self.seen.save()

    def close(self) -> None:
        pass


def judged(decoded: DataFrame, delay: str = "30 seconds", drop_late: bool = True, dedup: bool = True, ttl_minutes: int = policy.TTL_MINUTES, columns: Sequence[str] | None = None) -> DataFrame:
    """A stream of decoded records (``contract.decoded``) with event and production times and a verdict; nothing is dropped.

    Valid records go by their event id, others by their place in the topic, so that bad ones are no hot group. The counts of the verdicts
    are observed under the name ``policy`` (see ``Counters``). columns: those to pass on beside the verdict, all by default; PySpark takes
    rows to the operator value by value, so each column costs time.
    """
    place = F.concat_ws(":", F.lit("bad"), "topic", "partition", "offset")
    times = {n: F.when(F.col("error_type").isNull(), F.timestamp_millis(n)).alias(n) for n in ("event_timestamp", "produced_timestamp")}
    rows = decoded.select(*[times.get(c, F.col(c)) for c in decoded.columns if c != "timestamp"], F.col("timestamp").alias("source_timestamp"))
    # The production time goes on under another name: Spark would drop rows behind the watermark unseen.
    rows = rows.withWatermark("source_timestamp", delay).withColumn("source", F.col("source_timestamp") + F.expr("INTERVAL 0 SECOND")).drop("source_timestamp")
    kept = rows.columns if columns is None else ["source" if c == "source_timestamp" else c for c in columns]
    kinds = StructType([*[rows.schema[c] for c in kept], StructField("verdict", StringType())])
    rows = policy.grouped(rows, F.when(F.col("error_type").isNull(), F.concat(F.lit("id:"), "event_id")).otherwise(place))
    rows = rows.select(*kept, "seen_group", "seen_slot", "seen_id", F.coalesce(F.unix_micros("event_timestamp"), F.lit((1 << 63) - 1)).alias("judged_micros"), F.col("error_type").isNotNull().alias("judged_bad"))
    found = rows.groupBy("seen_group").transformWithStateInPandas(Judge(drop_late, dedup, ttl_minutes), kinds, "Append", "ProcessingTime")
    return found.observe("policy", *[F.count_if(F.col("verdict") == v).alias(n) for n, v in COUNTED.items()]).withColumnRenamed("source", "source_timestamp")


class Counters(StreamingQueryListener):
    """Sums of the observed metrics of all streams of a session: ``totals[stream, name, metric]``. Batches that a restart repeats count once."""

    def __init__(self) -> None:
        self.totals: dict[tuple[str, str, str], int] = {}
        self.last: dict[str, int] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        with self.lock:
            stream = p.name or str(p.id)
            if p.batchId <= self.last.get(stream, -1):
                return
            self.last[stream] = p.batchId
            for name, row in p.observedMetrics.items():
                for metric, value in row.asDict().items():
                    self.totals[stream, name, metric] = self.totals.get((stream, name, metric), 0) + (value or 0)

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass

    def of(self, name: str = "policy") -> dict[str, int]:
        """Sums over all streams by metric."""
        with self.lock:
            out: dict[str, int] = {}
            for (_, n, metric), value in self.totals.items():
                if n == name:
                    out[metric] = out.get(metric, 0) + value
            return out


SUMS = ("event_count", "playback_started_count", "playback_completed_count", "completed_watch_seconds")


class EventWindows(StatefulProcessor):
    """Tumbling windows of event time for a group of keys, closed by the watermark of production time.

    An entry of map state has all keys of an hour or so of open windows, with their sums and distinct values: a batch reads and writes it
    once, and one timer a group, at the first window's end or before, closes all windows that the watermark has passed. A call for each key, window and value would take
    most of a stream's time. Rows of closed windows are late; their number is emitted as a row of its own. Rows without event time only
    move the watermark.
    """

    #: Rows that are summed before they go to the state, about.
    ROWS = 1 << 17
    #: Windows of an entry.
    SPAN = 12

    def __init__(self, distinct: dict[str, str], minutes: int = 5):
        self.distinct, self.width = distinct, minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", StructType([StructField("span", LongType())]), StructType([StructField("windows", StringType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer: Any) -> Iterator[pd.DataFrame]:
        watermark, late, n = timer.getCurrentWatermarkInMs(), 0, 0
        found: dict[int, dict[tuple[int, str | None], list]] = {}
        for batch in rows:
            batch = batch[batch["event_timestamp"].notna()]
            if not len(batch):
                continue
            times = batch["event_timestamp"].dt.tz_localize(None).to_numpy().astype("datetime64[ms]").astype(np.int64)
            start = times // self.width * self.width
            closed = start + self.width <= watermark
            late += int(closed.sum())
            self._add(found, batch[~closed], start[~closed])
            n += len(batch)
            if n >= self.ROWS:
                self._save(found)
                found, n = {}, 0
        self._save(found)
        if late:
            yield _closed(self, [], late)

    def _add(self, found: dict[int, dict[tuple[int, str | None], list]], batch: pd.DataFrame, start: np.ndarray) -> None:
        done = batch["event_type"] == "playback_completed"
        watched = batch["watch_seconds"].where(done).fillna(0).astype("int64")
        columns = [start, batch["group_key"], batch["event_type"] == "playback_started", done, watched, *[batch[f"distinct_{n}"] for n in self.distinct]]
        for at, key, started, completed, seconds, *values in zip(*[c.tolist() for c in columns], strict=True):
            row = found.setdefault(at // (self.width * self.SPAN), {}).setdefault((at, key), [0, 0, 0, 0, *[set() for _ in self.distinct]])
            row[0], row[1], row[2], row[3] = row[0] + 1, row[1] + started, row[2] + completed, row[3] + seconds
            for members, value in zip(row[len(SUMS) :], values, strict=True):
                if value is not None:
                    members.add(value)

    def _save(self, found: dict[int, dict[tuple[int, str | None], list]]) -> None:
        if not found:
            return
        there = {s for (s,) in self.spans.keys()} if self.spans.exists() else set()
        for span, windows in found.items():
            if span in there:
                for start, key, *old in json.loads(self.spans.getValue((span,))[0]):
                    row = windows.setdefault((start, key), [0, 0, 0, 0, *[set() for _ in self.distinct]])
                    for k, value in enumerate(old):
                        row[k] = row[k] | set(value) if k >= len(SUMS) else row[k] + value
            self.spans.updateValue((span,), (json.dumps([[*window, *[list(x) if isinstance(x, set) else x for x in row]] for window, row in windows.items()]),))
        self._wait(min(start for windows in found.values() for start, _ in windows) + self.width)

    def _wait(self, end: int) -> None:
        """One timer, at the first end of a window."""
        timers = list(self.handle.listTimers())
        if not timers or end < min(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(end)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        out, following = [], []
        for span in sorted(s for (s,) in self.spans.keys()):
            if (end := span * self.width * self.SPAN + self.width) > passed:
                following.append(end)
                break
            rows = json.loads(self.spans.getValue((span,))[0])
            out += [(one, start, *[len(x) if isinstance(x, list) else x for x in row]) for start, one, *row in rows if start + self.width <= passed]
            if rest := [r for r in rows if r[0] + self.width > passed]:
                following.append(min(r[0] for r in rest) + self.width)
                if len(rest) < len(rows):
                    self.spans.updateValue((span,), (json.dumps(rest),))
            else:
                self.spans.removeKey((span,))
            if len(out) >= 10_000:
                yield _closed(self, out)
                out = []
        if out:
            yield _closed(self, out)
        if following:
            self.handle.registerTimer(min(following))

    def close(self) -> None:
        pass


def _closed(windows: EventWindows | IdleWindows, rows: list[tuple], late: int = 0) -> pd.DataFrame:
    """Rows of key, start, sums and distinct counts as they are emitted; the number of late rows in a row of its own."""
    names = ["group_key", "window_start", *SUMS, *windows.distinct]
    out = pd.DataFrame(rows or [(None,) * len(names)], columns=names)
    out["group_key"], out["window_start"] = out["group_key"].astype(object), pd.to_datetime(out["window_start"], unit="ms")
    out.insert(2, "window_end", out["window_start"] + pd.Timedelta(windows.width, "ms"))
    for n in (*SUMS, *windows.distinct):
        out[n] = out[n].astype("Int64")
    return out.assign(late_rows=late)


class IdleWindows(StatefulProcessor):
    """Tumbling windows of event time for one key, closed when the key has had no row for so many seconds (processing time).

    Spark's operators have timers of one kind, so the watermark of production time closes windows when the key's next rows come. Open
    windows' sums and distinct values are map state. Late rows are as in ``EventWindows``.
    """

    def __init__(self, distinct: dict[str, str], minutes: int, idle_seconds: int):
        self.distinct, self.width, self.idle = distinct, minutes * 60_000, idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        long = lambda *names: StructType([StructField(n, LongType()) for n in names])
        self.handle = handle
        self.windows = handle.getMapState("windows", long("start"), long(*SUMS, *self.distinct))
        self.members = handle.getMapState("members", StructType([StructField("start", LongType()), StructField("what", StringType()), StructField("value", StringType())]), StructType([StructField("there", BooleanType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer: Any) -> Iterator[pd.DataFrame]:
        watermark, late = timer.getCurrentWatermarkInMs(), 0
        for batch in rows:
            batch = batch[batch["event_timestamp"].notna()]
            if not len(batch):
                continue
            times = batch["event_timestamp"].dt.tz_localize(None).to_numpy().astype("datetime64[ms]").astype(np.int64)
            start = times // self.width * self.width
            closed = start + self.width <= watermark
            late += int(closed.sum())
            for at, part in batch[~closed].groupby(start[~closed]):
                self._add(int(at), part)
        if late:
            yield _closed(self, [], late)
        if done := [s for s in self._open() if s + self.width <= watermark]:
            yield _closed(self, [(key[0], *self._close(s)) for s in done])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if self._open():
            self.handle.registerTimer(timer.getCurrentProcessingTimeInMs() + self.idle * 1000)

    def _open(self) -> list[int]:
        return sorted(s for (s,) in self.windows.keys())

    def _add(self, start: int, part: pd.DataFrame) -> None:
        if self.windows.containsKey((start,)):
            sums = list(self.windows.getValue((start,)))
        else:
            sums = [0] * (len(SUMS) + len(self.distinct))
        done = part["event_type"] == "playback_completed"
        sums[0] += len(part)
        sums[1] += int((part["event_type"] == "playback_started").sum())
        sums[2] += int(done.sum())
        sums[3] += int(part.loc[done, "watch_seconds"].sum())
        for k, name in enumerate(self.distinct, len(SUMS)):
            for value in part[f"distinct_{name}"].dropna().unique():
                if not self.members.containsKey((start, name, value)):
                    self.members.updateValue((start, name, value), (True,))
                    sums[k] += 1
        self.windows.updateValue((start,), tuple(sums))

    def _close(self, start: int) -> tuple:
        sums = self.windows.getValue((start,))
        self.windows.removeKey((start,))
        for k in [k for k in self.members.keys() if k[0] == start]:
            self.members.removeKey(k)
        return (start, *sums)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        # Nothing has come since the timer was set: it stands for all windows.
        if done := self._open():
            yield _closed(self, [(key[0], *self._close(s)) for s in done])

    def close(self) -> None:
        pass


#: Groups of keys, by their hash.
WINDOW_GROUPS = 64


def event_windows(events: DataFrame, key: str, distinct: dict[str, str], delay: str = "30 seconds", minutes: int = 5, idle_seconds: int | None = None) -> DataFrame:
    """Closed windows of a stream with event_timestamp, source_timestamp, event_type, watch_seconds and the columns named: window_start, window_end, key, sums, distinct counts.

    The rows of closed windows are observed under the name ``windows`` as late_rows.
    """
    columns = ", ".join(f"{n} bigint" for n in (*SUMS, *distinct))
    # Without the production time itself: Spark would drop rows behind the watermark, whatever window they belong to. Values as text, that a null makes no floats of numbers.
    watched = events.withWatermark("source_timestamp", delay).select("event_timestamp", "event_type", "watch_seconds", F.col(key).cast("string").alias("group_key"), *[F.col(c).cast("string").alias(f"distinct_{n}") for n, c in distinct.items()])
    if idle_seconds is None:
        windows, mode = EventWindows(distinct, minutes), "EventTime"
        grouped = watched.withColumn("window_group", F.pmod(F.xxhash64("group_key"), F.lit(WINDOW_GROUPS))).groupBy("window_group")
    else:
        windows, mode, grouped = IdleWindows(distinct, minutes, idle_seconds), "ProcessingTime", watched.groupBy("group_key")
    found = grouped.transformWithStateInPandas(windows, f"group_key string, window_start timestamp, window_end timestamp, {columns}, late_rows bigint", "Append", mode)
    found = found.observe("windows", F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows")).where("window_start is not null")
    return found.select("window_start", "window_end", F.col("group_key").cast(events.schema[key].dataType).alias(key), *SUMS, *distinct)

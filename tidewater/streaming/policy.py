"""Late events and duplicates: on a stream, and replayed over a table."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

TTL_MINUTES = 90


#: Groups of ids, and slots in each, by an id's hash.
GROUPS, SLOTS = 1 << 10, 1 << 4


def grouped(events: DataFrame, key: Column) -> DataFrame:
    """events with seen_group, by which they are to be grouped, seen_slot and the key as seen_id, for ``Seen``."""
    place = F.pmod(F.xxhash64(key), F.lit(GROUPS * SLOTS))
    return events.withColumns({"seen_group": (place % GROUPS).cast("int"), "seen_slot": F.floor(place / GROUPS).cast("int"), "seen_id": F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))})


class Seen:
    """The ids that a group has seen; each is forgotten a fixed processing time after it was first seen.

    A call for each id would take most of a stream's time. So a group has the ids of many hashes, and an entry of its state all ids of a
    slot with their times: a batch reads and writes an entry once for all its rows of a slot, and only the slots it has rows of.
    """

    def __init__(self, handle: StatefulProcessorHandle, ttl_minutes: int):
        self.ttl = ttl_minutes * 60_000
        # Ids go by their own times; the entry's end removes slots that nothing comes to any more.
        self.slots = handle.getMapState("seen", StructType([StructField("slot", IntegerType())]), StructType([StructField("ids", StringType())]), ttlDurationMs=self.ttl)
        self.open: dict[int, dict[str, int]] = {}
        self.changed: set[int] = set()
        self.any: bool | None = None

    def first(self, batch: pd.DataFrame, now: int) -> np.ndarray:
        """Whether each row is the first of its id; its id counts as seen from now on. ``save`` must follow."""
        out = np.zeros(len(batch), bool)
        if self.any is None:
            self.any = self.slots.exists()
        for k, (slot, one) in enumerate(zip(batch["seen_slot"].tolist(), batch["seen_id"].tolist(), strict=True)):
            if slot not in self.open:
                # Of an entry that has ended there is no value.
                found = self.slots.getValue((slot,)) if self.any and self.slots.containsKey((slot,)) else None
                self.open[slot] = {i: t for i, t in json.loads(found[0]).items() if t + self.ttl > now} if found else {}
            ids = self.open[slot]
            if one not in ids:
                ids[one], out[k] = now, True
                self.changed.add(slot)
        return out

    def save(self) -> None:
        for slot in self.changed:
            self.slots.updateValue((slot,), (json.dumps(self.open[slot]),))
        self.open, self.changed, self.any = {}, set(), None


class FirstOnTime(StatefulProcessor):
    """Passes the first on-time copy of each id of a group (``grouped``).

    Late copies (event time at or before the watermark) are dropped first and do not mark the id as seen. A seen id is forgotten a fixed
    processing time after it was first seen; reading does not prolong that.
    """

    def __init__(self, ttl_minutes: int = TTL_MINUTES, drop_late: bool = True):
        self.ttl_minutes, self.drop_late = ttl_minutes, drop_late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = Seen(handle, self.ttl_minutes)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer: Any) -> Iterator[pd.DataFrame]:
        watermark, now = pd.Timestamp(timer.getCurrentWatermarkInMs(), unit="ms"), timer.getCurrentProcessingTimeInMs()
        for batch in rows:
            if self.drop_late:
                batch = batch[batch["event_timestamp"].dt.tz_localize(None) > watermark]
            batch = batch[self.seen.first(batch, now)]
            if len(batch):
                yield batch.drop(columns=["seen_group", "seen_slot", "seen_id"])
        self.seen.save()

    def close(self) -> None:
        pass


def on_time_once(events: DataFrame, delay: str = "30 seconds", ttl_minutes: int = TTL_MINUTES, drop_late: bool = True) -> DataFrame:
    """The stream's accepted events. The watermark follows production time (source_timestamp), as the messages carry it."""
    watched = grouped(events.withWatermark("source_timestamp", delay), F.col("event_id"))
    return watched.groupBy("seen_group").transformWithStateInPandas(FirstOnTime(ttl_minutes, drop_late), events.schema, "Append", "ProcessingTime")


#: Rows of a range of the order, about, if they are even.
RANGE_ROWS = 1 << 18


def replay_watermark(events: DataFrame, order: str, ts: str, delay_seconds: int, buckets: int | None = None) -> DataFrame:
    """events in arrival order with is_late: whether ts is at or before the greatest earlier time less the delay.

    The running maximum is made in two steps, within ranges of the order and over the ranges' maxima, so that no task gets all rows; the
    ranges grow in number with the rows.
    """
    buckets = buckets or max(64, events.count() // RANGE_ROWS)
    bounds = events.agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    width = F.greatest((F.col("_high") - F.col("_low") + 1) / F.lit(buckets), F.lit(1.0))
    df = events.crossJoin(F.broadcast(bounds)).withColumn("_bucket", F.floor((F.col(order) - F.col("_low")) / width)).drop("_low", "_high")
    tops = df.groupBy("_bucket").agg(F.max(ts).alias("_top"))
    before = F.max("_top").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    tops = tops.select("_bucket", before.alias("_before"))
    inside = F.max(ts).over(Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_inside", inside).join(F.broadcast(tops), "_bucket")
    mark = F.greatest("_inside", "_before") - F.make_dt_interval(secs=F.lit(delay_seconds))
    return df.withColumn("is_late", F.coalesce(F.col(ts) <= mark, F.lit(False))).drop("_bucket", "_inside", "_before")

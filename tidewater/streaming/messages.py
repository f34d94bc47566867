"""Messages of a broker: options and row shapes of its source, dead letters and publisher.

The rows are those that Spark's Kafka connector reads and writes (key, value, headers, topic, partition, offset, timestamp). Where the
connector is not at hand, the same rows go to and come from folders of Parquet files.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.streaming import contract

#: Flags that travel as headers, after the execution's id.
FLAGS = ("is_burst", "is_late", "is_out_of_order", "is_duplicate", "is_invalid")


def source_options(servers: str, topic: str, start: str = "earliest", max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the connector's source: committed records only, from the earliest or latest offsets."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start is {start!r}")
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, "kafka.isolation.level": "read_committed", "failOnDataLoss": "true", "includeHeaders": "true"}
    return out | ({"maxOffsetsPerTrigger": str(max_per_trigger)} if max_per_trigger else {})


def sink_options(servers: str, topic: str, idempotent: bool = True) -> dict[str, str]:
    """Options of the connector's sink: all replicas acknowledge, retries write no record twice."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": str(idempotent).lower()}


def encoded(schema_id: int | Column) -> Column:
    """Framed Avro bytes of the record's columns; timestamps as epoch milliseconds. The schema's id may differ by row."""
    names = [n for n, _ in contract.FIELDS]

    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(contract.encode_bodies(part), dtype=object)

    body = run(F.struct(*[(F.unix_millis(F.col(n).cast("timestamp")) if n.endswith("timestamp") else F.col(n)).alias(n) for n in names]))
    number = F.lit(schema_id) if isinstance(schema_id, int) else schema_id
    return F.concat(F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(number), 8, "0"))), body)


def published(flagged: DataFrame, topic: str, execution_id: str, schema_id: int) -> DataFrame:
    """Messages of flagged events: keyed by session, stamped with the time of production, six headers; invalid ones carry cut-off JSON."""
    broken = F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","malformed":')).cast("binary")
    flag = lambda c: F.when(F.col(c), F.lit("true")).otherwise(F.lit("false")).cast("binary") if c in flagged.columns else F.lit("false").cast("binary")
    headers = F.array(F.struct(F.lit("execution_id").alias("key"), F.lit(execution_id).cast("binary").alias("value")), *[F.struct(F.lit(c).alias("key"), flag(c).alias("value")) for c in FLAGS])
    invalid = F.col("is_invalid") if "is_invalid" in flagged.columns else F.lit(False)
    return flagged.select(F.col("session_id").cast("binary").alias("key"), F.when(invalid, broken).otherwise(encoded(schema_id)).alias("value"), headers.alias("headers"), F.lit(topic).alias("topic"), F.col("produced_timestamp").cast("timestamp").alias("timestamp"))


def dead_letter_messages(letters: DataFrame, topic: str) -> DataFrame:
    """Dead letters as messages: keyed by their id, so that replays compact; the envelope as JSON with bytes in base64."""
    envelope = F.struct(*[F.base64(c).alias(c) if c.startswith("original_") else F.col(c) for c in letters.columns])
    return letters.select(F.col("dlq_id").cast("binary").alias("key"), F.to_json(envelope).cast("binary").alias("value"), F.lit(topic).alias("topic"))


def paced(messages: DataFrame, per_second: float, put: Callable[[DataFrame], int], total: int, order: str = "timestamp", clock=time.monotonic, wait=time.sleep) -> int:
    """Gives ``put`` a second's worth of messages after the other, by ranges of the order, at the given rate; all must be acknowledged."""
    turns = max(1, round(total / per_second))
    low, high = messages.agg(F.min(order).cast("double"), F.max(order).cast("double")).first()
    began, sent = clock(), 0
    if low is None:
        return 0
    width = (high - low) / turns or 1.0
    place = F.least(F.floor((F.col(order).cast("double") - low) / width), F.lit(turns - 1))
    for k in range(turns):
        if (late := began + k - clock()) > 0:
            wait(late)
        sent += put(messages.where(place == k))
    if sent != total:
        raise RuntimeError(f"{sent} of {total} messages were acknowledged")
    return sent


def supervised(start: Callable[[], StreamingQuery], restarts: int = 3, delay_seconds: float = 10, wait=time.sleep) -> int:
    """Runs a query to its end; after a failure it starts again from its checkpoint, so many times at most. Restarts made."""
    made = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return made
        except Exception:
            if made >= restarts:
                raise
            made += 1
            wait(delay_seconds)

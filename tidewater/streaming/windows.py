"""Five-minute event-time windows, as a table and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = "5 minutes"
BY_USER = ("user_id", {"unique_session_count": "session_id", "unique_content_count": "content_id"})
BY_CONTENT = ("content_id", {"unique_user_count": "user_id", "unique_session_count": "session_id"})


def totals(events: DataFrame, key: str, distinct: dict[str, str], window: str = WINDOW, streaming: bool = False) -> DataFrame:
    """Counts, exact distinct counts and completed watch time by window and key.

    On a stream distinct counts are sizes of sets, the only exact form Spark takes there; state grows with the sets.
    """
    kind = events.schema["event_timestamp"].dataType
    count = (lambda c: F.size(F.collect_set(c)).cast("long")) if streaming else F.countDistinct
    done = F.col("event_type") == "playback_completed"
    df = events.groupBy(F.window("event_timestamp", window).alias("w"), key).agg(
        F.count("*").alias("event_count"),
        *[count(c).alias(n) for n, c in distinct.items()],
        F.count_if(F.col("event_type") == "playback_started").alias("playback_started_count"),
        F.count_if(done).alias("playback_completed_count"),
        F.sum(F.when(done, F.col("watch_seconds")).otherwise(0)).alias("completed_watch_seconds"),
    )
    return df.select(F.col("w.start").cast(kind).alias("window_start"), F.col("w.end").cast(kind).alias("window_end"), *[c for c in df.columns if c != "w"])

"""Facts, daily and hourly roll-ups, rolling features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import ratio, strict_greatest
from tidewater.operators.history import within


def fact(sessions: DataFrame, dim_user: DataFrame, dim_content: DataFrame) -> DataFrame:
    ts = "session_started_timestamp"
    df = within(within(sessions, dim_user, "user_id", ts, ["user_sk"]), dim_content, "content_id", ts, ["content_sk"])
    return df.select("session_id", "user_sk", "content_sk", ts, "session_ended_timestamp", F.to_date(ts).alias("activity_date"), "watch_seconds", "content_runtime_seconds", "completion_rate", "is_completed", "event_count", "created_timestamp", "pipeline_run_id")


def named(fact_rows: DataFrame, dim_user: DataFrame, dim_content: DataFrame) -> DataFrame:
    """Facts with natural keys again."""
    return fact_rows.join(dim_user.select("user_sk", "user_id"), "user_sk").join(dim_content.select("content_sk", "content_id"), "content_sk")


def named_facts(sessions: DataFrame, dim_user: DataFrame, dim_content: DataFrame) -> DataFrame:
    """``named`` of ``fact`` without joining the dimensions a second time: the sessions that have both, with surrogate and natural keys."""
    ts = "session_started_timestamp"
    df = within(within(sessions, dim_user, "user_id", ts, ["user_sk"]), dim_content, "content_id", ts, ["content_sk"])
    return df.where("user_sk is not null and content_sk is not null").withColumn("activity_date", F.to_date(ts))


def serving_order(mart: DataFrame, files: int = 8) -> DataFrame:
    """Rows dealt and sorted by score, newest window and content_id: a reader of the best rows opens one file and, by its statistics, few row groups."""
    order = [F.desc("popularity_score"), F.desc("window_start"), F.col("content_id")]
    return mart.repartitionByRange(files, *order).sortWithinPartitions(*order)


def daily(rows: DataFrame) -> DataFrame:
    """One row per (user, content, day) of facts with natural keys."""
    df = rows.groupBy("user_id", "content_id", "activity_date").agg(
        F.count("*").alias("playback_count"), F.count_if("is_completed").alias("completed_session_count"), F.sum("watch_seconds").alias("total_watch_seconds"),
        F.avg("completion_rate").alias("average_completion_rate"), F.max("created_timestamp").alias("created_timestamp"))
    before = F.lag("activity_date").over(Window.partitionBy("user_id", "content_id").orderBy("activity_date"))
    return df.withColumn("days_since_last_playback", F.coalesce(F.datediff("activity_date", before), F.lit(0)))


def hourly(rows: DataFrame, compat: str = "double") -> DataFrame:
    """One row per (hour, content) with activity; rank within the hour by score, then content_id."""
    start = F.date_trunc("hour", "session_started_timestamp").cast(rows.schema["session_started_timestamp"].dataType)
    df = rows.groupBy(start.alias("window_start"), "content_id").agg(
        F.count("*").alias("playback_count"), F.countDistinct("user_id").alias("unique_viewer_count"), F.count_if("is_completed").alias("completed_session_count"),
        F.sum("watch_seconds").alias("total_watch_seconds"), F.max("created_timestamp").alias("created_timestamp"))
    hours = ratio(F.col("total_watch_seconds"), F.lit(3600), compat) if compat == "trino" else F.col("total_watch_seconds") / F.lit(3600.0)
    score = (F.col("playback_count") + 2 * F.col("completed_session_count") + hours).cast("double")
    df = df.withColumn("popularity_score", score).withColumn("window_end", F.col("window_start") + F.expr("interval 1 hour"))
    return df.withColumn("popularity_rank", F.dense_rank().over(Window.partitionBy("window_start").orderBy(F.desc("popularity_score"), "content_id")))


def top(mart: DataFrame, n: int = 100) -> DataFrame:
    """The n best rows by score, then newest window, then content_id: kept as n rows per task, never sorted whole."""
    return mart.orderBy(F.desc("popularity_score"), F.desc("window_start"), "content_id").limit(n)


def distinct_in_window(df: DataFrame, group: str, item: str, at: str, width: int) -> DataFrame:
    """(group, at, n): exact numbers of distinct items among the rows of the last ``width`` steps, at every step that has rows.

    An item counts from one of its steps until the window has passed or its next step comes: these stretches never overlap, so the
    number is a running sum of their ends. No pairs of steps, no sets.
    """
    seen = df.select(group, item, at).distinct()
    following = F.lead(at).over(Window.partitionBy(group, item).orderBy(at))
    ends = seen.select(group, F.col(at), F.least(F.col(at) + width, following).alias("_end"))
    changes = ends.select(group, at, F.lit(1).alias("_d"), F.lit(1).alias("_own")).union(ends.select(group, F.col("_end").alias(at), F.lit(-1), F.lit(0)))
    steps = changes.groupBy(group, at).agg(F.sum("_d").alias("_d"), F.max("_own").alias("_own"))
    running = F.sum("_d").over(Window.partitionBy(group).orderBy(at))
    return steps.withColumn("n", running).where("_own = 1").select(group, at, "n")


def user_features(obt: DataFrame, compat: str = "double") -> DataFrame:
    """Rolling engagement at each active day of a user: that day, 7 and 30 days up to it. Known from the next midnight on.

    Sums come from range frames over per-day totals, the exact distinct count from a running sum.
    """
    day = F.datediff("activity_date", F.lit("1970-01-01"))
    per_day = obt.groupBy("user_id", "activity_date").agg(
        F.sum("total_watch_seconds").alias("w"), F.sum("playback_count").alias("n"), F.sum("completed_session_count").alias("c"),
        F.sum(F.col("average_completion_rate").cast("decimal(18,12)") * F.col("playback_count")).alias("r"), F.max("created_timestamp").alias("created")).withColumn("_day", day)
    frame = lambda days: Window.partitionBy("user_id").orderBy("_day").rangeBetween(1 - days, 0)
    minutes = lambda x: ratio(x, F.lit(60), compat)
    rolled = per_day.select(
        "user_id", "_day", "activity_date", minutes(F.col("w")).alias("watch_minutes_24h"), minutes(F.sum("w").over(frame(7))).alias("watch_minutes_7d"),
        F.sum("n").over(frame(7)).alias("playback_sessions_7d"), F.sum("c").over(frame(30)).alias("completed_sessions_30d"),
        (F.sum("r").over(frame(30)) / F.nullif(F.sum("n").over(frame(30)), F.lit(0))).cast("decimal(18,6)").alias("average_completion_rate_30d"),
        # The window holds the anchor day itself, so this is 0 always.
        F.datediff("activity_date", F.max("activity_date").over(frame(30))).alias("days_since_last_playback"),
        F.max("created").over(frame(30)).alias("created"))
    distinct = distinct_in_window(obt.withColumn("_day", day), "user_id", "content_id", "_day", 30).withColumnRenamed("n", "distinct_content_count_30d")
    df = rolled.join(distinct, ["user_id", "_day"]).drop("_day")
    return df.withColumn("event_timestamp", F.date_add("activity_date", 1).cast("timestamp")).drop("activity_date")


def content_features(mart: DataFrame, rows: DataFrame) -> DataFrame:
    """Rolling popularity at each active hour of a content: 1, 24 and 168 hours up to it, exact viewers of the last 24 hours."""
    hour = F.floor(F.unix_timestamp(F.col("window_start").cast("timestamp")) / 3600)
    frame = lambda hours: Window.partitionBy("content_id").orderBy("_hour").rangeBetween(1 - hours, 0)
    rolled = mart.withColumn("_hour", hour).select(
        "content_id", "_hour", "window_end", F.col("playback_count").alias("playback_count_1h"), F.sum("playback_count").over(frame(24)).alias("playback_count_24h"),
        ratio(F.sum("completed_session_count").over(frame(168)), F.sum("playback_count").over(frame(168))).alias("completion_rate_7d"),
        F.round(F.sum("popularity_score").over(frame(24)), 6).alias("popularity_score_24h"), F.max("created_timestamp").over(frame(168)).alias("mart_created"))
    own = rows.select("content_id", "user_id", "created_timestamp", F.floor(F.unix_timestamp(F.date_trunc("hour", "session_started_timestamp").cast("timestamp")) / 3600).alias("_hour"))
    viewers = distinct_in_window(own, "content_id", "user_id", "_hour", 24).withColumnRenamed("n", "unique_viewer_count_24h")
    made = own.groupBy("content_id", "_hour").agg(F.max("created_timestamp").alias("c")).select("content_id", "_hour", F.max("c").over(frame(24)).alias("session_created"))
    df = rolled.join(viewers, ["content_id", "_hour"]).join(made, ["content_id", "_hour"])
    return df.select("content_id", "playback_count_1h", "playback_count_24h", "unique_viewer_count_24h", "completion_rate_7d", "popularity_score_24h", F.col("window_end").alias("event_timestamp"), strict_greatest("mart_created", "session_created").alias("created"))

"""Seeded landing data and stream records with known shares of problems, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import stable_id

START, CUTOVER = "2025-12-25 00:00:00", "2026-01-01 00:00:00"


def chance(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) that depends on seed and keys only."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)) / float(1 << 30)


def pick(u: Column, weights: dict[str, float]) -> Column:
    """A value by cumulative weights."""
    total, upto, out = sum(weights.values()), 0.0, None
    for value, weight in weights.items():
        upto += weight / total
        out = F.when(u < upto, F.lit(value)) if out is None else out.when(u < upto, F.lit(value))
    return out.otherwise(F.lit(value))


def with_duplicates(df: DataFrame, rate: float, seed: int, *keys: str) -> DataFrame:
    """df and exact copies of some rows, so that copies are the given share of all rows."""
    return df.unionByName(df.where(chance(seed, *keys) < rate / (1 - rate)))


def users(spark: SparkSession, n: int, seed: int, delivery: int = 0, change_rate: float = 0.1) -> DataFrame:
    """A delivery's full snapshot: from the second one on some users have changed."""
    df = spark.range(n).withColumn("changed", (F.lit(delivery) > 0) & (chance(seed + 7, "id") < change_rate))
    version = F.when(F.col("changed"), F.lit(delivery)).otherwise(0)
    return df.select(
        stable_id("usr", F.col("id")).alias("user_id"), pick(chance(seed, "id"), {"KR": 5, "US": 3, "JP": 2}).alias("country_code"), pick(chance(seed + 1, "id", version), {"seoul": 45, "new york": 30, "tokyo": 25}).alias("city"),
        (1950 + F.floor(chance(seed + 2, "id") * 55)).alias("birth_year"), pick(chance(seed + 3, "id"), {"ko": 5, "en": 3, "ja": 2}).alias("preferred_language"), (chance(seed + 4, "id", version) < 0.5).alias("marketing_opt_in"),
        (F.lit(CUTOVER).cast("timestamp") + F.make_dt_interval(version)).alias("source_updated_timestamp"))


def subscriptions(spark: SparkSession, n: int, seed: int, delivery: int = 0, change_rate: float = 0.1) -> DataFrame:
    version = F.when((F.lit(delivery) > 0) & (chance(seed + 17, "id") < change_rate), F.lit(delivery)).otherwise(0)
    return spark.range(n).select(
        stable_id("usr", F.col("id")).alias("user_id"), pick(chance(seed + 11, "id", version), {"basic": 5, "standard": 3, "premium": 2}).alias("subscription_tier"), pick(chance(seed + 12, "id", version), {"active": 8, "paused": 1, "cancelled": 1}).alias("subscription_status"),
        F.lit("KR").alias("billing_country_code"), F.lit("2025-01-01").cast("date").alias("started_date"), F.lit(None).cast("date").alias("ended_date"), (F.lit(CUTOVER).cast("timestamp") + F.make_dt_interval(version)).alias("source_updated_timestamp"))


def content(spark: SparkSession, n: int, seed: int, delivery: int = 0, scored: float = 0.9) -> DataFrame:
    """The second delivery's schema has a score that is null for some."""
    version = F.when((F.lit(delivery) > 0) & (chance(seed + 27, "id") < 0.1), F.lit(delivery)).otherwise(0)
    df = spark.range(n).select(
        "id", stable_id("cnt", F.col("id")).alias("content_id"), pick(chance(seed + 21, "id"), {"movie": 5, "series": 4, "documentary": 1}).alias("content_type"), F.concat(F.lit("Title "), "id").alias("title"),
        F.array(pick(chance(seed + 22, "id"), {"drama": 4, "comedy": 3, "action": 3})).alias("genres"), (1990 + F.floor(chance(seed + 23, "id") * 35)).alias("release_year"), (20 + F.floor(chance(seed + 24, "id") * 120)).alias("runtime_minutes"),
        F.lit("pg").alias("maturity_rating"), F.lit("en").alias("original_language"), pick(chance(seed + 25, "id", version), {"available": 9, "unavailable": 1}).alias("availability_status"), (F.lit(CUTOVER).cast("timestamp") + F.make_dt_interval(version)).alias("source_updated_timestamp"))
    score = F.when(chance(seed + 26, "id") < scored, F.round(chance(seed + 28, "id") * 100, 1))
    return (df.withColumn("critic_score", score) if delivery else df).drop("id")


def playback(spark: SparkSession, n: int, n_users: int, n_content: int, seed: int, days: int = 7, start: str = START) -> DataFrame:
    """n events: three of each session, started, progressed and, for most, completed."""
    session = F.floor(F.col("id") / 3)
    phase = F.col("id") % 3
    third = F.when(chance(seed + 31, session) < 0.7, "playback_completed").otherwise("playback_progressed")
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + F.floor(chance(seed + 32, session) * (days * 86400 - 4000)) + phase * 1200)
    return spark.range(n).select(
        stable_id("evt", F.col("id")).alias("event_id"), stable_id("usr", F.floor(chance(seed + 33, session) * n_users)).alias("user_id"), stable_id("cnt", F.floor(chance(seed + 34, session) * chance(seed + 35, session) * n_content)).alias("content_id"), stable_id("ses", session).alias("session_id"),
        F.when(phase == 0, "playback_started").when(phase == 1, "playback_progressed").otherwise(third).alias("event_type"), (phase * 1200).alias("position_seconds"), F.floor(phase * 1200 * chance(seed + 36, session)).alias("watch_seconds"),
        at.alias("event_timestamp"), at.alias("produced_timestamp"), F.lit(1).cast("long").alias("payload_schema_version"))


def land(spark: SparkSession, root: str, scenario: str = "smoke", n_users: int = 200, n_content: int = 50, n_events: int = 3000, seed: int = 1, duplicates: float = 0.02, days: int = 7, start: str = START) -> None:
    """Writes a scenario's landing files: two deliveries of master data and the playback history by day."""
    makers = {"users": lambda k: users(spark, n_users, seed, k), "subscriptions": lambda k: subscriptions(spark, n_users, seed, k), "content": lambda k: content(spark, n_content, seed, k)}
    for name, make in makers.items():
        for k, day in enumerate(("2026-01-01", "2026-01-02")):
            make(k).write.parquet(f"{root}/recurring/{name}/scenario={scenario}/delivery_date={day}/schema_version={k + 1 if name == 'content' else 1}")
    events = with_duplicates(playback(spark, n_events, n_users, n_content, seed, days, start), duplicates, seed, "event_id")
    events.withColumn("event_date", F.to_date("event_timestamp")).write.partitionBy("event_date").parquet(f"{root}/bootstrap/playback_events/scenario={scenario}")


def stream_problems(events: DataFrame, seed: int, late: float = 0.05, duplicate: float = 0.015, invalid: float = 0.005, out_of_order: float = 0.03) -> DataFrame:
    """Events with flags; late ones carry old event times, duplicates follow their originals."""
    df = events.withColumns({"is_late": chance(seed, "event_id") < late, "is_invalid": chance(seed + 1, "event_id") < invalid, "is_out_of_order": chance(seed + 2, "event_id") < out_of_order, "is_duplicate": F.lit(False)})
    back = F.when(F.col("is_late"), F.expr("interval 10 minutes")).when(F.col("is_out_of_order"), F.expr("interval 10 seconds")).otherwise(F.expr("interval 0 seconds"))
    df = df.withColumn("event_timestamp", F.col("event_timestamp") - back)
    copies = df.where(~F.col("is_invalid") & (chance(seed + 3, "event_id") < duplicate / (1 - duplicate))).withColumn("is_duplicate", F.lit(True))
    return df.unionByName(copies)


def rates(flagged: DataFrame, configured: dict[str, float]) -> DataFrame:
    """Observed against configured shares of the flags."""
    flags = F.explode(F.map_from_arrays(F.array(*map(F.lit, configured)), F.array(*[F.col(c) for c in configured])))
    out = flagged.select(flags.alias("flag", "on")).groupBy("flag").agg(F.round(F.avg(F.col("on").cast("double")), 6).alias("observed"))
    return out.withColumn("configured", F.element_at(F.create_map(*[F.lit(x) for kv in configured.items() for x in kv]), F.col("flag")))

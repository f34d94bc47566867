"""Version histories: as-of resolution, changes, validity ranges, interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import OPEN_END, iso_text, stable_hash


def asof(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, right_columns: list[str], prefer: list[str] = ()) -> DataFrame:
    """left with the columns of right's latest row at or before left_ts for the key (null if none).

    Both sides are put into one stream per key, and the last version is carried forward: one shuffle and one sort, where a join by
    inequality would make all pairs of a key. Of versions with the same time the greatest by ``prefer`` counts.
    """
    version = F.struct(F.col(right_ts).alias("_ts"), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(prefer)], *right_columns)
    versions = right.groupBy(key, F.col(right_ts).alias("_at")).agg(F.max(version).alias("_version")).select(key, "_at", F.lit(0).alias("_side"), "_version", F.lit(None).cast(left.select(F.struct("*").alias("s")).schema["s"].dataType).alias("_left"))
    rows = left.select(key, F.col(left_ts).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"), F.struct("*").alias("_left"))
    order = Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = versions.unionByName(rows).withColumn("_version", F.last("_version", ignorenulls=True).over(order))
    return carried.where("_side = 1").select("_left.*", *[F.col(f"_version.{c}").alias(c) for c in right_columns])


def timeline(first: DataFrame, second: DataFrame, key: str, ts: str) -> DataFrame:
    """Distinct (key, valid_from_ts) of both version streams."""
    return first.select(key, F.col(ts).alias("valid_from_ts")).union(second.select(key, ts)).distinct()


def user_timeline(users: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Profile and subscription in force at each time at which either changed; times before the first profile are dropped."""
    ts = "source_updated_timestamp"
    profile = ["country_code", "city", "birth_year", "preferred_language", "is_marketing_opt_in"]
    plan = ["subscription_tier", "subscription_status"]
    u = users.select("user_id", ts, *profile, F.col("ingested_timestamp").alias("_u"), F.lit(True).alias("_known"))
    s = subscriptions.select("user_id", ts, *plan, F.col("ingested_timestamp").alias("_s"))
    df = asof(timeline(users, subscriptions, "user_id", ts), u, "user_id", "valid_from_ts", ts, [*profile, "_u", "_known"], ["_u"]).where("_known")
    df = asof(df, s, "user_id", "valid_from_ts", ts, [*plan, "_s"], ["_s"])
    created = F.greatest("_u", F.coalesce("_s", "_u"))
    return df.select("user_id", *profile, *plan, "valid_from_ts", created.alias("created_timestamp"), stable_hash(*profile, *plan).alias("record_hash"))


CONTENT_ATTRIBUTES = ["content_type", "title", "genres", "release_year", "runtime_minutes", "maturity_rating", "original_language", "availability_status", "critic_score"]


def content_timeline(content: DataFrame) -> DataFrame:
    hashed = stable_hash(*[F.to_json("genres") if c == "genres" else c for c in CONTENT_ATTRIBUTES])
    return content.select("content_id", *CONTENT_ATTRIBUTES, F.col("source_updated_timestamp").alias("valid_from_ts"), F.col("ingested_timestamp").alias("created_timestamp"), hashed.alias("record_hash"))


def changes_only(versions: DataFrame, key: str) -> DataFrame:
    """Versions whose hash differs from the one before."""
    before = F.lag("record_hash").over(Window.partitionBy(key).orderBy("valid_from_ts"))
    return versions.withColumn("_before", before).where("_before is null or _before <> record_hash").drop("_before")


def scd2(history: DataFrame, key: str, surrogate: str, first_use: DataFrame | None = None) -> DataFrame:
    """Half-open validity ranges and surrogate keys. first_use (key, first_use_ts): a first version that came later begins there."""
    order = Window.partitionBy(key).orderBy("valid_from_ts")
    start: Column = F.col("valid_from_ts")
    if first_use is not None:
        history = history.join(first_use, key, "left")
        history = history.withColumn("_nth", F.row_number().over(order))
        start = F.when((F.col("_nth") == 1) & (F.col("first_use_ts") < start), F.col("first_use_ts")).otherwise(start)
        history = history.withColumn("valid_from_ts", start).drop("_nth", "first_use_ts")
    following = F.lead("valid_from_ts").over(order)
    kind = history.schema["valid_from_ts"].dataType
    df = history.withColumn("_next", following)
    df = df.withColumns({"valid_to_ts": F.coalesce("_next", F.lit(OPEN_END).cast(kind)), "is_current": F.col("_next").isNull(), surrogate: stable_hash(key, iso_text("valid_from_ts"))})
    return df.select(surrogate, *[c for c in history.columns if c not in ("record_hash", "created_timestamp")], "valid_to_ts", "is_current", "record_hash", "created_timestamp")


def first_use(sessions: DataFrame, key: str) -> DataFrame:
    return sessions.groupBy(key).agg(F.min("session_started_timestamp").alias("first_use_ts"))


def within(df: DataFrame, dim: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """df with the dimension's columns of the version in force at ts (null if none): an equi-join with a range as residual."""
    side = dim.select(F.col(key).alias("_key"), F.col("valid_from_ts").alias("_from"), F.col("valid_to_ts").alias("_to"), *columns)
    return df.join(side, (F.col(key) == F.col("_key")) & (F.col(ts) >= F.col("_from")) & (F.col(ts) < F.col("_to")), "left").drop("_key", "_from", "_to")

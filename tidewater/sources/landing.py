"""Landing files: explicit or merged schemas, and the metadata every Bronze row carries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import row_hash

# The sources' columns.
SCHEMAS = {
    "users": "user_id string, country_code string, city string, birth_year bigint, preferred_language string, marketing_opt_in boolean, source_updated_timestamp timestamp",
    "subscriptions": "user_id string, subscription_tier string, subscription_status string, billing_country_code string, started_date date, ended_date date, source_updated_timestamp timestamp",
    "content": "content_id string, content_type string, title string, genres array<string>, release_year bigint, runtime_minutes bigint, maturity_rating string, original_language string, availability_status string, source_updated_timestamp timestamp, critic_score double",
    "playback_events": "event_id string, user_id string, content_id string, session_id string, event_type string, position_seconds bigint, watch_seconds bigint, event_timestamp timestamp, produced_timestamp timestamp, payload_schema_version bigint",
}
ROOTS = {"playback_events": "bootstrap/playback_events"} | {k: f"recurring/{k}" for k in ("users", "subscriptions", "content")}


def read(spark: SparkSession, root: str, dataset: str, scenario: str, merge: bool = False) -> DataFrame:
    """One dataset of a scenario. Folders' partition values come as columns. Merging schemas costs a footer read per file and is for content only."""
    path = f"{root}/{ROOTS[dataset]}/scenario={scenario}"
    if merge and dataset == "content":
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(T.StructType.fromDDL(SCHEMAS[dataset])).parquet(path)


def read_all(spark: SparkSession, root: str, scenario: str, merge_content: bool = False) -> dict[str, DataFrame]:
    return {k: read(spark, root, k, scenario, merge_content) for k in SCHEMAS}


def with_metadata(df: DataFrame, dataset: str, run_id: str, started: datetime, system: str = "landing") -> DataFrame:
    """Source columns and ten more: where, when and by which run a row was read, its schema version and its hash."""
    file = F.col("_metadata.file_path")
    version: Column = F.col("payload_schema_version") if dataset == "playback_events" else F.regexp_extract(file, r"schema_version=(\d+)", 1).try_cast("int")
    return df.select(
        "*", file.alias("_source_file"), F.sha2(F.concat_ws("||", F.lit(run_id), file), 256).alias("_ingestion_id"), F.lit(started).alias("_ingested_at"), F.lit(system).alias("_source_system"), F.lit(dataset).alias("_source_object"),
        F.lit(None).cast("int").alias("_source_partition"), F.lit(None).cast("long").alias("_source_offset"), version.alias("_schema_version"), row_hash(df.columns).alias("_record_hash"), F.lit(run_id).alias("_pipeline_run_id"))

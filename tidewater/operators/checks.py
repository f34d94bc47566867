"""Data-quality checks: each gives the violating rows, none if all is well."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import iso_text, stable_hash


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key has no parent; null keys are not looked up."""
    return df.where(F.col(column).isNotNull()).join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def nonnegative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def one_current(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_if("is_current").alias("n")).where("n <> 1")


def valid_ranges(df: DataFrame) -> DataFrame:
    return df.where("valid_from_ts >= valid_to_ts")


def contiguous(df: DataFrame, key: str) -> DataFrame:
    df = df.withColumn("_next", F.lead("valid_from_ts").over(Window.partitionBy(key).orderBy("valid_from_ts")))
    return df.where("coalesce(_next <> valid_to_ts, false) or is_current <> (_next is null)").drop("_next")


def only_changes(df: DataFrame, key: str) -> DataFrame:
    df = df.withColumn("_before", F.lag("record_hash").over(Window.partitionBy(key).orderBy("valid_from_ts")))
    return df.where("record_hash = _before").drop("_before")


def created_after_event(df: DataFrame) -> DataFrame:
    return df.where("created < event_timestamp")


def surrogate_recomputed(df: DataFrame, key: str, surrogate: str) -> DataFrame:
    return df.where(F.col(surrogate) != stable_hash(key, iso_text("valid_from_ts")))


def columns_of(frames: dict[str, DataFrame]) -> DataFrame:
    """The columns of several tables as a table: table_name, ordinal, column_name, data_type."""
    rows = [(name, i + 1, f.name, f.dataType.simpleString()) for name, df in frames.items() for i, f in enumerate(df.schema)]
    return next(iter(frames.values())).sparkSession.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string")


def wrong_feature_timestamps(columns: DataFrame) -> DataFrame:
    """From ``columns_of``: timestamp columns other than event_timestamp and created, and tables that lack one of these."""
    stamps = columns.where("data_type like 'timestamp%'").select("table_name", F.lower("column_name").alias("column_name"))
    wanted = columns.select("table_name").distinct().select("table_name", F.explode(F.array(F.lit("event_timestamp"), F.lit("created"))).alias("column_name"))
    extra = stamps.join(wanted, ["table_name", "column_name"], "left_anti").withColumn("fault", F.lit("unexpected"))
    return extra.unionByName(wanted.join(stamps, ["table_name", "column_name"], "left_anti").withColumn("fault", F.lit("missing")))


def forbidden_created(columns: DataFrame) -> DataFrame:
    """From ``columns_of``: tables other than feature tables that have a column created."""
    return columns.where("lower(column_name) = 'created'").select("table_name", "column_name")


def feature_timestamps(df: DataFrame) -> list[str]:
    """Faults of a feature table's columns: event_timestamp and created are its only timestamps."""
    stamps = {f.name.lower() for f in df.schema if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)}
    return [f"timestamp columns are {sorted(stamps)}"] if stamps != {"event_timestamp", "created"} else []


def gold_columns(df: DataFrame) -> list[str]:
    return ["created is for feature tables only"] if "created" in {c.lower() for c in df.columns} else []


def required_columns(df: DataFrame, names: list[str]) -> list[str]:
    return [f"missing: {c}" for c in sorted(set(names) - set(df.columns))]


def rollup_conservation(facts: DataFrame, obt: DataFrame, mart: DataFrame) -> DataFrame:
    """Layers whose totals differ from the facts'."""
    totals = facts.agg(F.count("*").alias("n"), F.count_if("is_completed").alias("c"), F.sum("watch_seconds").alias("w"))
    out = None
    for name, df in (("obt", obt), ("mart", mart)):
        own = df.agg(F.sum("playback_count").alias("n2"), F.sum("completed_session_count").alias("c2"), F.sum("total_watch_seconds").alias("w2"))
        part = totals.crossJoin(own).where("n <> n2 or c <> c2 or w <> w2").select(F.lit(name).alias("layer"), "n", "n2", "c", "c2", "w", "w2")
        out = part if out is None else out.unionByName(part)
    return out


def expectations(df: DataFrame, columns: list[str], required: list[str], sets: dict[str, list], least: int = 1) -> dict[str, bool]:
    """A suite in one pass: row count, columns, no nulls, values in sets."""
    missing = required_columns(df, columns)
    aggs = [F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required if c in df.columns], *[F.count_if(~F.col(c).isin(*v)).alias(f"set_{c}") for c, v in sets.items() if c in df.columns]]
    r = df.agg(*aggs).first()
    return {"row_count": r["n"] >= least, "columns": not missing} | {k: r[k] == 0 for k in r.asDict() if k != "n"}


def summary(results: DataFrame) -> DataFrame:
    """From (model, status): tests by model and status."""
    return results.groupBy("model").agg(F.count("*").alias("tests"), F.count_if(F.col("status") == "pass").alias("passed"), F.count_if(F.col("status") != "pass").alias("failed"))

"""One row per key, by a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Later schema, later load, then file and content hash decide between rows of a key.
NEWEST = ("_schema_version", "_ingested_at", "_ingestion_id", "_record_hash")


def latest(df: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """First row of each key by ``order`` (names: descending). Spark prunes rows before the shuffle by its window group limit."""
    sort = [F.desc(c) if isinstance(c, str) else c for c in (order or NEWEST)]
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))).where("_nth = 1").drop("_nth")


def latest_by_max(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same for descending orders, by max_by: partial aggregation instead of a sort, so hot keys shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)

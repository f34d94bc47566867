"""Distributions, schema evolution, fingerprints and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import salt_of


def _shares(counts: DataFrame, value: str) -> DataFrame:
    total = counts.agg(F.sum("count").alias("_total"))
    # One row against the groups: the total is a scalar.
    return counts.crossJoin(F.broadcast(total)).select(value, "count", F.round(F.col("count") / F.col("_total"), 6).alias("share"))


def distribution(df: DataFrame, value: str) -> DataFrame:
    """Count and share of each value."""
    return _shares(df.groupBy(value).agg(F.count("*").alias("count")), value)


def salted_distribution(df: DataFrame, value: str, key: str, buckets: int = 16) -> DataFrame:
    """The same in two steps over salted values: no task gets all rows of a hot value, even without partial aggregation."""
    parts = df.withColumn("_salt", salt_of(key, buckets)).groupBy(value, "_salt").agg(F.count("*").alias("n"))
    return _shares(parts.groupBy(value).agg(F.sum("n").alias("count")), value)


def ranked(distribution: DataFrame, value: str) -> DataFrame:
    """A distribution in the order of reports, by count downwards and value, with its rank; one row per value."""
    order = Window.orderBy(F.desc("count"), F.asc_nulls_first(value))
    return distribution.withColumn("rank", F.row_number().over(order)).orderBy("rank")


def retained_versions(df: DataFrame, key: str) -> DataFrame:
    """Rows, natural keys, and the versions kept beyond one per key."""
    out = df.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("natural_keys"))
    return out.withColumn("retained_extra_versions", F.col("row_count") - F.col("natural_keys"))


def latest_snapshot(snapshots: DataFrame, number: str, committed_at: str, by: list[str] = ()) -> DataFrame:
    """Number and time of the newest snapshot, of each table."""
    return snapshots.groupBy(*by).agg(F.max_by(number, F.struct(committed_at, number)).alias("latest"), F.max(committed_at).alias("committed_at"))


def category_rates(df: DataFrame, category: str, configured: dict[str, float], tolerance: float) -> DataFrame:
    """Observed against configured shares of a category's values, and whether they agree."""
    counts = distribution(df, category)
    want = F.element_at(F.create_map(*[F.lit(x) for kv in configured.items() for x in kv]), F.col(category))
    return counts.withColumn("configured", want).withColumn("agrees", F.abs(F.col("share") - F.col("configured")) <= tolerance)


def schema_evolution(df: DataFrame, version: str, column: str) -> DataFrame:
    """Rows and nulls of a column by schema version, in the versions' order: one row per version."""
    return df.groupBy(version).agg(F.count("*").alias("row_count"), F.count_if(F.col(column).isNull()).alias("null_count")).orderBy(version)


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def fingerprint(df: DataFrame, key: str, ts: str) -> DataFrame:
    """What must not change when files are rewritten."""
    return df.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("distinct_keys"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def distinct_estimate(df: DataFrame, column: str, lg_registers: int = 14) -> DataFrame:
    """HyperLogLog estimate with 2^lg registers, mergeable over partitions."""
    return df.agg(F.hll_sketch_estimate(F.hll_sketch_agg(column, F.lit(lg_registers))).alias("distinct_estimate"))


def sketches(df: DataFrame, by: list[str], columns: list[str], lg_registers: int = 14) -> DataFrame:
    """Rows and HyperLogLog sketches of the columns by group, to be stored: of any union of groups ``merged`` estimates without reading rows."""
    return df.groupBy(*by).agg(F.count("*").alias("row_count"), *[F.hll_sketch_agg(c, F.lit(lg_registers)).alias(f"{c}_sketch") for c in columns])


def merged(stored: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Rows and distinct estimates over the stored groups that are there, by coarser groups."""
    return stored.groupBy(*by).agg(F.sum("row_count").alias("row_count"), *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_estimate") for c in columns])


def duplicate_rate(df: DataFrame, group: str, key: str) -> DataFrame:
    """Rows beyond the first of each key, by group (a file, a day)."""
    out = df.groupBy(group).agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("keys"))
    return out.withColumn("duplicate_rate", F.round((F.col("row_count") - F.col("keys")) / F.col("row_count"), 6))


def ordered_checksum(df: DataFrame, order: list, text) -> DataFrame:
    """md5 over the rows' texts in order; for bounded results such as a top-100."""
    rows = df.select(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], text.alias("t")).alias("r"))
    return rows.agg(F.md5(F.array_join(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["t"]), "\n")).alias("checksum"))


def file_statistics(df: DataFrame) -> DataFrame:
    """Files and rows of what df reads, by the files' own metadata."""
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(F.max("file_size").alias("size"), F.count("*").alias("rows"))
    return files.agg(F.count("*").alias("file_count"), F.sum("size").alias("total_bytes"), F.avg("size").alias("average_bytes"), F.min("rows").alias("least_rows"), F.max("rows").alias("most_rows"))

"""Versioned Parquet tables with snapshots, where no table format is at hand.

A table is a folder of immutable data folders and numbered manifests; a manifest lists the data folders of a snapshot, of partitioned
tables their folders of each value of the first partition column. A new snapshot is
one small file that must not exist before, written through Hadoop's file system: it works on any store Spark can write, readers
never see half a write, and of two writers of the same number one fails.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Files

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list:
        fs = self._fs(path)
        return list(fs.listStatus(self._path(path))) if fs.exists(self._path(path)) else []

    def _read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        stream = self._fs(path).create(self._path(path), False)  # fails if it exists
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    # Snapshots

    def _manifests(self, table: str) -> list[str]:
        """Names of a table's manifests, oldest first; they are numbered in fixed width."""
        return sorted(f.getPath().getName() for f in self._list(f"{self.root}/{table}/_snapshots") if f.getPath().getName().endswith(".json"))

    def _manifest(self, table: str, name: str) -> dict:
        return json.loads(self._read_text(f"{self.root}/{table}/_snapshots/{name}"))

    def snapshots(self, table: str) -> list[dict]:
        """Manifests of a table, oldest first."""
        return [self._manifest(table, n) for n in self._manifests(table)]

    def exists(self, table: str) -> bool:
        return bool(self._list(f"{self.root}/{table}/_snapshots"))

    def latest(self, table: str) -> dict:
        """The newest manifest; the others are listed, not read."""
        names = self._manifests(table)
        if not names:
            raise LookupError(f"no table {table}")
        return self._manifest(table, names[-1])

    def _commit(self, table: str, parts: list[str], operation: str, schema: str, partition_by: list[str]) -> dict:
        number = self.latest(table)["number"] + 1 if self.exists(table) else 1
        snapshot = {"number": number, "committed_at": time.time(), "operation": operation, "parts": parts, "schema": schema, "partition_by": partition_by}
        self._write_text(f"{self.root}/{table}/_snapshots/{number:012d}.json", json.dumps(snapshot))
        return snapshot

    def _write(self, table: str, df: DataFrame, partition_by: list[str]) -> list[str]:
        part = f"data-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.root}/{table}/{part}")
        if not partition_by:
            return [part]
        return sorted(f"{part}/{f.getPath().getName()}" for f in self._list(f"{self.root}/{table}/{part}") if f.isDirectory())

    def _frame(self, table: str, parts: list[str], schema) -> DataFrame:
        """Rows of some parts; columns that older parts lack are null."""
        folders: dict[str, list[str]] = {}
        for p in parts:
            folders.setdefault(p.split("/")[0], []).append(f"{self.root}/{table}/{p}")
        out = None
        for folder, paths in folders.items():
            f = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}/{folder}").parquet(*paths)
            out = f if out is None else out.unionByName(f)
        return self.spark.createDataFrame([], schema) if out is None else out.select(*[f.name for f in schema])

    def read(self, table: str, number: int | None = None) -> DataFrame:
        """A snapshot, the newest by default. Columns of older parts that lack them are null."""
        if number is not None and f"{number:012d}.json" not in self._manifests(table):
            raise LookupError(f"no snapshot {number} of {table}")
        s = self.latest(table) if number is None else self._manifest(table, f"{number:012d}.json")
        return self._frame(table, s["parts"], StructType.fromJson(json.loads(s["schema"])))

    # Writes

    def append(self, table: str, df: DataFrame, partition_by: list[str] = ()) -> dict:
        """Adds rows; creates the table if there is none."""
        now = self.latest(table) if self.exists(table) else {"parts": [], "partition_by": list(partition_by)}
        keys = now["partition_by"]
        return self._commit(table, [*now["parts"], *self._write(table, df, keys)], "append", df.schema.json(), keys)

    def replace(self, table: str, df: DataFrame, partition_by: list[str] = ()) -> dict:
        """Puts df in the place of all rows; df may read the table itself."""
        return self._commit(table, self._write(table, df, list(partition_by)), "replace", df.schema.json(), list(partition_by))

    def append_by_day(self, table: str, df: DataFrame, ts: str) -> dict:
        """append() with a folder for each day of ts; filters on the day column prune folders."""
        return self.append(table, df.withColumn(f"{ts}_day", F.to_date(ts)), [f"{ts}_day"])

    def append_buckets(self, table: str, df: DataFrame, key: str, n: int, partition_by: list[str] = ()) -> list[dict]:
        """n appends of the rows dealt by hash."""
        bucket = F.pmod(F.xxhash64(key), F.lit(n))
        return [self.append(table, df.where(bucket == i), partition_by) for i in range(n)]

    def append_once(self, frames: dict[str, DataFrame], run_id: str, run_column: str = "_pipeline_run_id", buckets: dict[str, tuple[str, int]] = {}) -> dict[str, str]:  # noqa: B006
        """Appends each table's rows of a run, unless the run is there already in full. Part of a run is an error to look into by hand.

        buckets: tables that are appended in so many steps, their rows dealt by the hash of a key.
        """
        state = {}
        for name, df in frames.items():
            want = df.count()
            have = self.read(name).where(F.col(run_column) == run_id).count() if self.exists(name) else 0
            state[name] = "there" if have == want else "new" if have == 0 else "partial"
        if set(state.values()) == {"there"}:
            return dict.fromkeys(frames, "skipped")
        if set(state.values()) != {"new"}:
            raise RuntimeError(f"run {run_id} is there in part: {state}")
        for name, df in frames.items():
            key, n = buckets.get(name, (None, 1))
            if n > 1:
                self.append_buckets(name, df, key, n)
            else:
                self.append(name, df)
        return dict.fromkeys(frames, "appended")

    def upsert(self, table: str, df: DataFrame, keys: list[str], mirror: bool = False, partition_by: list[str] = ()) -> dict:
        """Rows of df replace those of the same keys. mirror: keys that df lacks go, too.

        Where the table is partitioned by a column of the keys, only the partitions that df has rows of are read and written again.
        """
        if mirror or not self.exists(table):
            return self.replace(table, df, partition_by)
        now = self.latest(table)
        schema, by = StructType.fromJson(json.loads(now["schema"])), now["partition_by"]
        if not by or by[0] not in keys:
            old = self.read(table).join(df.select(*keys), keys, "left_anti")
            return self.replace(table, old.unionByName(df, allowMissingColumns=True), by)
        fresh = self._write(table, df, by)
        if not fresh:
            return now
        rows = self._frame(table, fresh, df.schema)
        touched = {p.split("/", 1)[1] for p in fresh}
        olds = [p for p in now["parts"] if p.split("/", 1)[-1] in touched]
        rest = [p for p in now["parts"] if p.split("/", 1)[-1] not in touched]
        if olds:
            merged = self._frame(table, olds, schema).join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True)
            spent, fresh = fresh[0].split("/")[0], self._write(table, merged, by)
            self._fs(self.root).delete(self._path(f"{self.root}/{table}/{spent}"), True)
            schema = merged.schema
        else:
            schema = StructType([*schema, *[f for f in df.schema if f.name not in schema.names]])
        return self._commit(table, [*rest, *fresh], "upsert", schema.json(), by)

    def marked(self, table: str, stream: str, batch: int) -> bool:
        """Whether ``mark`` has marked a stream's batch."""
        path = f"{self.root}/{table}/{hashlib.sha256(stream.encode()).hexdigest()}"
        return self._fs(path).exists(self._path(path)) and int(self._read_text(path)) >= batch

    def mark(self, table: str, stream: str, batch: int) -> None:
        """Marks a stream's batches up to this one as done: one small file per stream, put in its place whole."""
        path = f"{self.root}/{table}/{hashlib.sha256(stream.encode()).hexdigest()}"
        fresh = f"{path}.{uuid.uuid4().hex}"
        self._write_text(fresh, str(batch))
        self._fs(path).delete(self._path(path), False)
        self._fs(path).rename(self._path(fresh), self._path(path))

    def write_smoke(self, table: str = "smoke.write_check") -> int:
        """Whether tables can be written here: drops, creates, reads and drops one; the rows read."""
        self.drop(table)
        self.replace(table, self.spark.range(1).select(F.col("id").alias("smoke_id"), F.current_timestamp().alias("written_at")))
        n = self.read(table).count()
        self.drop(table)
        return n

    def drop(self, table: str) -> None:
        self._fs(self.root).delete(self._path(f"{self.root}/{table}"), True)

    # Maintenance

    def files(self, table: str) -> list[dict]:
        """Data files of the newest snapshot: part, path, bytes."""
        out, todo = [], [(p, f"{self.root}/{table}/{p}") for p in self.latest(table)["parts"]]
        while todo:
            part, folder = todo.pop()
            for f in self._list(folder):
                name = f.getPath().getName()
                if f.isDirectory():
                    todo.append((part, f.getPath().toString()))
                elif name.endswith(".parquet"):
                    out.append({"part": part, "path": f.getPath().toString(), "bytes": f.getLen()})
        return out

    def files_table(self, table: str) -> DataFrame:
        """``files`` as a table: part, path, bytes, partition (text of the folders, such as day=2026-01-01; empty without)."""
        rows = [(f["part"], f["path"], f["bytes"], "/".join(x for x in f["path"].split("/") if "=" in x)) for f in self.files(table)]
        return self.spark.createDataFrame(rows, "part string, path string, bytes long, partition string")

    def files_in_range(self, table: str, low: str, high: str) -> DataFrame:
        """Number, bytes and average size of the files whose partition value lies in [low, high), without reading them."""
        value = F.element_at(F.split("partition", "="), -1)
        return self.files_table(table).where((value >= low) & (value < high)).agg(F.count("*").alias("file_count"), F.sum("bytes").alias("total_bytes"), F.avg("bytes").alias("average_bytes"))

    def snapshots_table(self, table: str) -> DataFrame:
        rows = [(s["number"], s["committed_at"], s["operation"], len(s["parts"])) for s in self.snapshots(table)]
        return self.spark.createDataFrame(rows, "number long, committed_at double, operation string, parts int")

    def compact(self, table: str, target_bytes: int = 128 << 20, min_files: int = 2, check: Callable[[DataFrame], DataFrame] | None = None, require_fewer: bool = True) -> dict:
        """Rewrites a table of many small files into files of about target_bytes; rows, and check's result, must stay the same."""
        before, files = self.read(table), self.files(table)
        if len(files) < min_files:
            return {"rewritten": False, "files": len(files)}
        s = self.latest(table)
        n = max(1, -(-sum(f["bytes"] for f in files) // target_bytes))
        same = check or (lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("*").cast("decimal(38,0)"))))
        was = same(before).collect()
        packed = before.repartition(n, *s["partition_by"]) if s["partition_by"] else before.coalesce(n)
        parts = self._write(table, packed, s["partition_by"])
        after = self._frame(table, parts, before.schema)
        if same(after).collect() != was:
            raise RuntimeError(f"{table} would change by compaction")
        self._commit(table, parts, "compact", s["schema"], s["partition_by"])
        now = len(self.files(table))
        if require_fewer and now >= len(files):
            raise RuntimeError(f"{table} has {now} files after compaction, {len(files)} before")
        return {"rewritten": True, "files": now, "files_before": len(files)}

    def expire(self, table: str, older_than: float, retain: int = 1) -> dict:
        """Drops snapshots older than a time, but never the last ``retain`` ones, and data that no snapshot needs any more."""
        found = self.snapshots(table)
        keep = [s for s in found if s["committed_at"] >= older_than]
        keep = found[-max(retain, len(keep), 1) :]
        needed = {p for s in keep for p in s["parts"]}
        gone = [s for s in found if s not in keep]
        for s in gone:
            self._fs(self.root).delete(self._path(f"{self.root}/{table}/_snapshots/{s['number']:012d}.json"), False)
        for p in {p for s in gone for p in s["parts"]} - needed:
            self._fs(self.root).delete(self._path(f"{self.root}/{table}/{p}"), True)
        return {"expired": len(gone), "kept": len(keep)}


def write_once(store: Store, path: str, df: DataFrame, order: list[Column | str]) -> str:
    """Writes a small object with a checksum beside it: the same content again is skipped, other content is an error."""
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    sums = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64("j").cast("decimal(38,0)")).alias("s")).first()
    mark, text = f"{path}/_checksum", f"{sums['n']}:{sums['s']}"
    if store._list(path):
        if store._read_text(mark) == text:
            return "skipped"
        raise FileExistsError(f"{path} holds other rows")
    df.orderBy(*order).write.mode("append").parquet(path)
    store._write_text(mark, text)
    return "written"

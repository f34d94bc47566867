"""Typed settings from YAML or JSON files: unknown names, wrong types and values out of range are errors."""

from __future__ import annotations

import dataclasses
import json
import re
import types
import typing
from dataclasses import dataclass, field
from pathlib import Path
from typing import Literal


class Wrong(ValueError):
    """What is wrong with a file of settings, and where."""


def bounded(low: float | None = None, high: float | None = None, pattern: str | None = None, default=dataclasses.MISSING):
    """A field whose value must lie in [low, high] or match a pattern."""
    return field(default=default, metadata={"low": low, "high": high, "pattern": pattern})


@dataclass(frozen=True)
class Tuning:
    shuffle_partitions: int = bounded(1, default=8)
    adaptive: bool = True
    broadcast_bytes: int = bounded(-1, default=10 << 20)
    extra: dict[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        """Spark's own names and values."""
        return {"spark.sql.shuffle.partitions": str(self.shuffle_partitions), "spark.sql.adaptive.enabled": str(self.adaptive).lower(), "spark.sql.autoBroadcastJoinThreshold": str(self.broadcast_bytes)} | self.extra


@dataclass(frozen=True)
class Ingest:
    job_name: str
    landing_root: str
    scenario: str
    spark: Tuning = field(default_factory=Tuning)
    schema_strategy: Literal["merge", "explicit"] = "explicit"
    source_system: str = "landing"
    playback_write_batches: int = bounded(1, default=1)


@dataclass(frozen=True)
class Stage:
    job_name: str
    cutover: str
    spark: Tuning = field(default_factory=Tuning)
    dedup_strategy: Literal["window"] = "window"
    session_shuffle_partitions: int = bounded(1, default=2)
    skew_strategy: Literal["direct", "salted"] = "direct"
    skew_salt_buckets: int = bounded(2, default=16)
    completion_threshold: float = bounded(0.0, 1.0, default=0.9)


@dataclass(frozen=True)
class Compaction:
    job_name: str
    namespace: str = bounded(pattern="[a-z0-9_]+")
    table: str = bounded(pattern="[a-z0-9_]+")
    target_file_bytes: int = bounded(1, default=128 << 20)
    min_input_files: int = bounded(2, default=2)
    require_file_reduction: bool = True


@dataclass(frozen=True)
class Stream:
    job_name: str
    bootstrap_servers: str
    topic: str
    dlq_topic: str
    schema_id: int = bounded(0, default=1)
    watermark_seconds: int = bounded(0, default=30)
    window_minutes: Literal[5] = 5
    dedup_ttl_minutes: int = bounded(1, default=90)
    late_handling: bool = True
    dedup: bool = True
    state_backend: Literal["rocksdb", "hdfs"] = "rocksdb"
    checkpoint_seconds: int = bounded(1, default=30)
    restarts: int = bounded(0, default=3)
    restart_delay_seconds: float = bounded(0, default=10)

    def settings(self) -> dict[str, str]:
        kind = {"rocksdb": "RocksDBStateStoreProvider", "hdfs": "HDFSBackedStateStoreProvider"}[self.state_backend]
        return {"spark.sql.streaming.stateStore.providerClass": f"org.apache.spark.sql.execution.streaming.state.{kind}"}


def _value(kind, value, where: str):
    origin, inner = typing.get_origin(kind), typing.get_args(kind)
    if dataclasses.is_dataclass(kind):
        return built(kind, value, where)
    if origin is Literal:
        if value not in inner or isinstance(value, bool) != isinstance(inner[0], bool):
            raise Wrong(f"{where}: {value!r} is none of {', '.join(map(repr, inner))}")
        return value
    if origin in (typing.Union, types.UnionType):
        return None if value is None else _value(next(k for k in inner if k is not type(None)), value, where)
    if origin is dict:
        if not isinstance(value, dict):
            raise Wrong(f"{where}: no mapping")
        return {_value(inner[0], k, where): _value(inner[1], v, f"{where}.{k}") for k, v in value.items()}
    if origin is list:
        if not isinstance(value, list):
            raise Wrong(f"{where}: no list")
        return [_value(inner[0], v, f"{where}[{i}]") for i, v in enumerate(value)]
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, kind) or isinstance(value, bool) and kind is not bool:
        raise Wrong(f"{where}: {value!r} is no {kind.__name__}")
    return value


def built(kind: type, values, where: str = ""):
    """An instance of a dataclass from a mapping, strictly."""
    if not isinstance(values, dict):
        raise Wrong(f"{where or kind.__name__}: no mapping")
    fields, hints = {f.name: f for f in dataclasses.fields(kind)}, typing.get_type_hints(kind)
    at = lambda name: f"{where}.{name}".lstrip(".")
    if unknown := sorted(set(values) - set(fields)):
        raise Wrong(f"{at(unknown[0])}: unknown")
    out = {}
    for name, f in fields.items():
        if name not in values:
            if f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING:
                raise Wrong(f"{at(name)}: missing")
            continue
        value = out[name] = _value(hints[name], values[name], at(name))
        low, high, pattern = (f.metadata.get(k) for k in ("low", "high", "pattern"))
        if low is not None and value < low or high is not None and value > high:
            raise Wrong(f"{at(name)}: {value!r} is out of range")
        if pattern and not re.fullmatch(pattern, value):
            raise Wrong(f"{at(name)}: {value!r} does not match {pattern}")
    return kind(**out)


def load(kind: type, path: str | Path):
    """Settings of a kind from a file, YAML by its suffix, else JSON."""
    path = Path(path)
    text = path.read_text(encoding="utf-8")
    if path.suffix in (".yaml", ".yml"):
        import yaml

        return built(kind, yaml.safe_load(text))
    return built(kind, json.loads(text))

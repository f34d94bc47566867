"""Data contracts: what a table must have and hold, kept as a table and verified against data."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import checks
from tidewater.sources.tables import Store

TABLE = "governance.contracts"
SCHEMA = "contract string, dataset string, owner string, assertion string, kind string, definition string"


@dataclass(frozen=True)
class Contract:
    """Required columns, keys without repetition, columns without nulls, and accepted values of a dataset."""

    name: str
    dataset: str
    owner: str
    required: tuple[str, ...]
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)

    def assertions(self) -> list[tuple[str, str, dict]]:
        """(name, kind, definition) of each assertion."""
        out = [("schema", "schema", {"columns": list(self.required)})]
        if self.unique:
            out.append(("unique", "quality", {"columns": list(self.unique)}))
        out += [(f"not_null_{c}", "quality", {"column": c}) for c in self.not_null]
        return out + [(f"accepted_{c}", "quality", {"column": c, "values": list(v)}) for c, v in self.accepted.items()]

    def failures(self, df: DataFrame) -> dict[str, int]:
        """Violating rows (of the schema: missing columns) by assertion."""
        missing = checks.required_columns(df, list(self.required))
        found = {"schema": len(missing)}
        for name, kind, d in self.assertions():
            if kind == "schema":
                continue
            bad = checks.unique_combination(df, d["columns"]) if name == "unique" else checks.accepted_values(df, d["column"], d["values"]) if "values" in d else checks.not_null(df, d["column"])
            found[name] = bad.count()
        return found


#: The contracts of what the jobs give away.
CONTRACTS = (
    Contract("silver-sessions", "silver.int_playback_sessions", "platform", ("session_id", "user_id", "content_id", "completion_rate", "is_completed"), ("session_id",), ("user_id", "content_id")),
    Contract("dim-user", "gold.dim_user", "analytics", ("user_sk", "user_id", "valid_from_ts", "valid_to_ts", "is_current"), ("user_sk",), ("user_id",)),
    Contract("dim-content", "gold.dim_content", "analytics", ("content_sk", "content_id", "valid_from_ts", "valid_to_ts", "is_current"), ("content_sk",), ("content_id",)),
    Contract("trending", "gold.mart_content_trending", "analytics", ("window_start", "content_id", "popularity_score", "popularity_rank"), ("window_start", "content_id"), ("popularity_score",)),
    Contract("user-features", "feature.feat_user_engagement", "ml", ("user_id", "event_timestamp", "created", "watch_minutes_7d"), ("user_id", "event_timestamp"), ("created",)),
)


def as_table(spark: SparkSession, contracts: tuple[Contract, ...] = CONTRACTS) -> DataFrame:
    rows = [(c.name, c.dataset, c.owner, name, kind, json.dumps(d)) for c in contracts for name, kind, d in c.assertions()]
    return spark.createDataFrame(rows, SCHEMA)


def publish(store: Store, contracts: tuple[Contract, ...] = CONTRACTS) -> None:
    """Writes the contracts; the same again changes nothing."""
    store.upsert(TABLE, as_table(store.spark, contracts), ["contract", "assertion"])


def verify(store: Store, contracts: tuple[Contract, ...] = CONTRACTS) -> DataFrame:
    """(contract, assertion, status, failures): every published assertion against the tables as they are; unpublished ones are missing."""
    known = {(r["contract"], r["assertion"]) for r in store.read(TABLE).select("contract", "assertion").collect()} if store.exists(TABLE) else set()
    rows = []
    for c in contracts:
        found = c.failures(store.read(c.dataset)) if store.exists(c.dataset) else {}
        for name, _, _ in c.assertions():
            n = found.get(name)
            rows.append((c.name, name, "missing" if (c.name, name) not in known or n is None else "pass" if n == 0 else "fail", n))
    return store.spark.createDataFrame(rows, "contract string, assertion string, status string, failures long")


def roll_up(results: DataFrame) -> DataFrame:
    """Assertions, passed and failed ones of each contract."""
    return checks.summary(results.select(F.col("contract").alias("model"), "status"))


def described(datasets: dict[str, dict], spark: SparkSession) -> DataFrame:
    """Owner, domain and tags of datasets as a table: dataset, owner, domain, tags."""
    rows = [(name, d.get("owner"), d.get("domain"), sorted(d.get("tags", ()))) for name, d in sorted(datasets.items())]
    return spark.createDataFrame(rows, "dataset string, owner string, domain string, tags array<string>")

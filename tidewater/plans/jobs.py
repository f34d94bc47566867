"""Jobs from landing to features, with validation, lineage and a run summary, and a runner for their graph."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import config
from tidewater.operators import checks, history, marts, profile, silver
from tidewater.sources import landing
from tidewater.sources.tables import Store

LOG = logging.getLogger(__name__)
LINEAGE = "governance.lineage"
#: Key of the versions and natural key of each Silver table.
SILVER_KEYS = {
    "stg_users": (["user_id", "source_updated_timestamp"], "user_id"), "stg_subscriptions": (["user_id", "source_updated_timestamp"], "user_id"),
    "stg_content": (["content_id", "source_updated_timestamp"], "content_id"), "stg_playback_events": (["event_id"], None),
}


@dataclass(frozen=True)
class Options:
    """What differs between runs."""

    scenario: str = "demo"
    cutover: str = "2026-01-01T00:00:00Z"
    merge_content: bool = False
    session_partitions: int | None = None
    completion_threshold: float = silver.COMPLETION_THRESHOLD
    compat: str = "double"
    #: Appends of the playback events of one run, and how their skew is profiled: counts per city, direct or in salted steps.
    playback_batches: int = 1
    salt_buckets: int | None = None
    settings: dict[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, ingest: config.Ingest | None = None, stage: config.Stage | None = None, **more) -> Options:
        """From the settings files of the jobs; what a file does not say keeps its default."""
        found: dict = {}
        if ingest:
            found |= {"scenario": ingest.scenario, "merge_content": ingest.schema_strategy == "merge", "playback_batches": ingest.playback_write_batches, "settings": ingest.spark.settings()}
        if stage:
            found |= {"cutover": stage.cutover, "session_partitions": stage.session_shuffle_partitions, "completion_threshold": stage.completion_threshold}
            found |= {"salt_buckets": stage.skew_salt_buckets if stage.skew_strategy == "salted" else None, "settings": found.get("settings", {}) | stage.spark.settings()}
        return cls(**(found | more))


@dataclass
class Run:
    spark: SparkSession
    store: Store
    landing_root: str
    run_id: str
    options: Options = field(default_factory=Options)
    started: datetime = field(default_factory=lambda: datetime.now(UTC).replace(tzinfo=None))
    lineage: list[tuple[str, list[str], list[str]]] = field(default_factory=list)
    metrics: dict = field(default_factory=dict)

    def record(self, source: str, inputs: list[str], outputs: list[str]) -> None:
        """Notes what was made of what, here and in the lineage table."""
        self.lineage.append((source, inputs, outputs))
        rows = [(self.run_id, self.started, source, i, o) for i in inputs for o in outputs]
        self.store.append(LINEAGE, self.spark.createDataFrame(rows, "run_id string, started timestamp_ntz, source string, input string, output string"))

    def group(self, name: str) -> None:
        for key, value in self.options.settings.items():
            self.spark.conf.set(key, value)
        self.spark.sparkContext.setJobGroup(self.run_id, name)

    def summary(self) -> dict:
        done = datetime.now(UTC).replace(tzinfo=None)
        return {"run_id": self.run_id, "app_id": self.spark.sparkContext.applicationId, "started": self.started.isoformat(), "seconds": (done - self.started).total_seconds(), "options": vars(self.options), "metrics": self.metrics, "lineage": self.lineage}


class Invalid(RuntimeError):
    """Data that a job must not go on with."""


def _none(df: DataFrame, what: str) -> None:
    if not df.isEmpty():
        raise Invalid(what)


def committed(run: Run, inputs: dict[str, int]) -> dict[str, int]:
    """Rows of this run in each Bronze table; they must be as many as were read."""
    out = {}
    for name, want in inputs.items():
        have = out[name] = run.store.read(f"bronze.raw_{name}").where(F.col("_pipeline_run_id") == run.run_id).count()
        if have != want:
            raise Invalid(f"bronze.raw_{name} has {have} rows of run {run.run_id}, {want} were read")
    return out


def staged(run: Run) -> dict[str, dict]:
    """Rows, keys, duplicates and retained versions of the Silver tables; duplicates and completion rates out of range are errors."""
    out = {}
    for name, (keys, natural) in SILVER_KEYS.items():
        df = run.store.read(f"silver.{name}")
        r = df.agg(F.count("*").alias("rows"), F.countDistinct(*keys).alias("keys")).first()  # rows without a whole key have none
        out[name] = {"rows": r["rows"], "unique_business_keys": r["keys"], "duplicates": r["rows"] - r["keys"]}
        if natural:
            v = profile.retained_versions(df, natural).first()
            out[name] |= {"natural_keys": v["natural_keys"], "retained_extra_versions": v["retained_extra_versions"]}
        if out[name]["duplicates"]:
            raise Invalid(f"silver.{name} has a key twice")
    written = run.store.read("silver.int_playback_sessions")
    _none(checks.unique_combination(written, ["session_id"]), "a session id stands twice")
    _none(checks.between(written, "completion_rate", 0, 1), "a completion rate is out of range")
    return out


def validate(run: Run) -> dict:
    """Checks landing files and written tables without writing any."""
    run.group("validate")
    frames = landing.read_all(run.spark, run.landing_root, run.options.scenario, run.options.merge_content)
    for name, df in frames.items():
        if df.isEmpty():
            raise Invalid(f"{name} is empty")
    run.metrics["bronze_rows"] = committed(run, {k: df.count() for k, df in frames.items()})
    run.metrics["silver"] = staged(run)
    return run.summary()


def ingest(run: Run) -> None:
    """Landing to Bronze: checks columns, emptiness and the cutover, then appends once per run id. Duplicates stay."""
    run.group("ingest")
    frames = landing.read_all(run.spark, run.landing_root, run.options.scenario, run.options.merge_content)
    for name, df in frames.items():
        if faults := checks.required_columns(df, [f.split()[0] for f in landing.SCHEMAS[name].split(", ") if not f.startswith("critic_score")]):
            raise Invalid(f"{name}: {faults}")
        if df.isEmpty():
            raise Invalid(f"{name} is empty")
    _none(frames["playback_events"].where(F.col("event_timestamp") >= F.lit(run.options.cutover).cast("timestamp")), "playback events at or after the cutover")
    rows = {f"bronze.raw_{k}": landing.with_metadata(df, k, run.run_id, run.started) for k, df in frames.items()}
    run.metrics["ingest"] = run.store.append_once(rows, run.run_id, buckets={"bronze.raw_playback_events": ("event_id", run.options.playback_batches)})
    run.metrics["bronze_rows"] = committed(run, {k: df.count() for k, df in frames.items()})
    run.record(run.landing_root, list(frames), list(rows))


def stage(run: Run) -> None:
    """Bronze to Silver. Sessions are made from the written Silver tables, so that rows are deduplicated once."""
    run.group("stage")
    raw = {k: run.store.read(f"bronze.raw_{k}") for k in landing.SCHEMAS}
    run.store.replace("silver.stg_users", silver.users(raw["users"], run.run_id))
    run.store.replace("silver.stg_subscriptions", silver.subscriptions(raw["subscriptions"], run.run_id))
    run.store.replace("silver.stg_content", silver.content(raw["content"], run.run_id))
    events = silver.playback_events(raw["playback_events"], run.run_id, run.options.cutover).withColumn("event_day", F.to_date("event_timestamp"))
    run.store.replace("silver.stg_playback_events", events, ["event_day"])
    runtimes = silver.current_content(run.store.read("silver.stg_content"))
    sessions = silver.sessions(run.store.read("silver.stg_playback_events"), runtimes, F.lit(run.started), run.run_id, run.options.session_partitions, run.options.completion_threshold)
    run.store.replace("silver.int_playback_sessions", sessions)
    run.metrics["silver"] = staged(run)
    events = run.store.read("silver.stg_playback_events")
    salt = run.options.salt_buckets
    counts = profile.salted_distribution(events, "event_type", "event_id", salt) if salt else profile.distribution(events, "event_type")
    run.metrics["event_types"] = {r["event_type"]: r["count"] for r in counts.collect()}  # a row per type, of which the contract knows three
    run.record("bronze", [f"bronze.raw_{k}" for k in raw], ["silver.int_playback_sessions"])


def model(run: Run) -> None:
    """Silver to Gold: dimensions, facts, daily and hourly tables; always rebuilt whole, as keys may change with older playback."""
    run.group("model")
    s, store = run.store.read("silver.int_playback_sessions"), run.store
    users = history.changes_only(history.user_timeline(store.read("silver.stg_users"), store.read("silver.stg_subscriptions")), "user_id")
    content = history.changes_only(history.content_timeline(store.read("silver.stg_content")), "content_id")
    store.replace("gold.dim_user", history.scd2(users, "user_id", "user_sk", history.first_use(s, "user_id")))
    store.replace("gold.dim_content", history.scd2(content, "content_id", "content_sk", history.first_use(s, "content_id")))
    dims = store.read("gold.dim_user"), store.read("gold.dim_content")
    store.replace("gold.fact_playback_session", marts.fact(s, *dims).withColumn("activity_month", F.trunc("activity_date", "month")), ["activity_month"])
    rows = marts.named(store.read("gold.fact_playback_session"), *dims)
    store.replace("gold.obt_user_content_engagement", marts.daily(rows))
    store.replace("gold.mart_content_trending", marts.hourly(rows, run.options.compat).withColumn("window_day", F.to_date("window_start")), ["window_day"])
    for name, dim in zip(("user", "content"), dims, strict=True):
        key, sk = f"{name}_id", f"{name}_sk"
        for what, bad in (("current", checks.one_current(dim, key)), ("ranges", checks.valid_ranges(dim)), ("contiguous", checks.contiguous(dim, key)), ("key", checks.surrogate_recomputed(dim, key, sk))):
            _none(bad, f"dim_{name}: {what}")
    obt, mart = store.read("gold.obt_user_content_engagement"), store.read("gold.mart_content_trending")
    _none(checks.rollup_conservation(store.read("gold.fact_playback_session"), obt, mart), "totals differ between layers")
    run.record("silver", ["silver.int_playback_sessions"], ["gold.mart_content_trending", "gold.obt_user_content_engagement"])


def features(run: Run) -> None:
    run.group("features")
    store = run.store
    rows = marts.named(store.read("gold.fact_playback_session"), store.read("gold.dim_user"), store.read("gold.dim_content"))
    made = {"feat_user_engagement": marts.user_features(store.read("gold.obt_user_content_engagement"), run.options.compat), "feat_content_popularity": marts.content_features(store.read("gold.mart_content_trending"), rows)}
    for name, df in made.items():
        if faults := checks.feature_timestamps(df):
            raise Invalid(f"{name}: {faults}")
        store.replace(f"feature.{name}", df)
    run.record("gold", ["gold.mart_content_trending"], [f"feature.{k}" for k in made])


def explained(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan's text, as a benchmark keeps it beside its times."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def publish(run: Run, mirror: bool = False) -> None:
    """Trending rows to the serving table by key. Keys that are gone upstream stay, unless mirrored."""
    run.group("publish")
    run.store.upsert("serving.mart_content_trending", run.store.read("gold.mart_content_trending"), ["window_start", "content_id"], mirror)


def maintain(run: Run, table: str = "bronze.raw_playback_events", older_than: float = 0.0) -> None:
    run.group("maintain")
    run.metrics["compact"] = run.store.compact(table, require_fewer=False)
    run.metrics["expire"] = run.store.expire(table, older_than)


GRAPH: dict[str, tuple[Callable[[Run], None], set[str]]] = {"ingest": (ingest, set()), "stage": (stage, {"ingest"}), "model": (model, {"stage"}), "features": (features, {"model"}), "publish": (publish, {"model"})}


#: The graphs that are scheduled one by one: landing to Bronze, Bronze to Gold, features and serving, and the upkeep of tables.
GRAPHS: dict[str, dict[str, tuple[Callable[[Run], None], set[str]]]] = {
    "raw_to_bronze": {"ingest": (ingest, set()), "validate_bronze": (lambda run: run.metrics.update(bronze_rows=committed(run, dict(run.metrics["bronze_rows"]))), {"ingest"})},
    "bronze_to_gold": {"stage": (stage, set()), "model": (model, {"stage"})},
    "offline_features": {"features": (features, set()), "publish": (publish, set())},
    "maintenance": {"maintain": (maintain, set())},
}


def run_graph(run: Run, graph: str) -> dict:
    """Runs one of the scheduled graphs in its order."""
    jobs = GRAPHS[graph]
    for name in TopologicalSorter({k: v[1] for k, v in jobs.items()}).static_order():
        LOG.info("job %s of graph %s of run %s", name, graph, run.run_id)
        jobs[name][0](run)
    return run.summary()


def run_all(run: Run, only: set[str] | None = None) -> dict:
    """Runs the jobs in the order of their graph."""
    for name in TopologicalSorter({k: v[1] for k, v in GRAPH.items()}).static_order():
        if only is None or name in only:
            LOG.info("job %s of run %s", name, run.run_id)
            GRAPH[name][0](run)
    return run.summary()

"""Every query of the library by name, with its SQL.

The library's tables are media playback; here they are made from the given ones: events play the playback events (``view`` starts, ``purchase``
completes, the JSON property is the content), orders play the version histories of users (even order keys) and of their plans
(odd ones), parts play the content. Both sides use the same substitutes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import iso_text, stable_hash
from tidewater.operators import checks, history, marts, profile, silver
from tidewater.operators.dedup import latest, latest_by_max

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Playback events, sessions, versions: in Spark and in SQL.


def playback(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    kind = F.when(F.col("event_type") == "view", "playback_started").when(F.col("event_type") == "purchase", "playback_completed").otherwise("playback_progressed")
    e = e.select("event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("content_id"), F.col("ts").alias("event_timestamp"), kind.alias("event_type"), F.floor(F.col("value") * 10).cast("long").alias("watch_seconds"))
    return e.withColumn("session_id", F.concat_ws("-", "user_id", "content_id", F.date_format("event_timestamp", "yyyyMMdd")))


PLAYBACK = """playback AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS content_id, ts AS event_timestamp,
    CASE event_type WHEN 'view' THEN 'playback_started' WHEN 'purchase' THEN 'playback_completed' ELSE 'playback_progressed' END AS event_type,
    CAST(floor(value * 10) AS BIGINT) AS watch_seconds,
    concat_ws('-', user_id, json_extract_string(props, '$.k'), strftime(ts, '%Y%m%d')) AS session_id
  FROM events)"""


def runtimes(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select(F.col("p_partkey").alias("content_id"), (F.col("p_size").cast("long") * 60).alias("content_runtime_seconds"))


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return silver.sessions(playback(spark, d), runtimes(spark, d), F.col("session_ended_timestamp"), "run")


SESSIONS = (
    PLAYBACK
    + """, rolled AS (
  SELECT session_id, user_id, content_id, min(event_timestamp) AS session_started_timestamp, max(event_timestamp) AS session_ended_timestamp,
    max(watch_seconds) AS watch_seconds, bool_or(event_type = 'playback_completed') AS done, count(*) AS event_count
  FROM playback GROUP BY ALL),
sessions AS (
  SELECT session_id, user_id, r.content_id, session_started_timestamp, session_ended_timestamp, watch_seconds, CAST(p_size AS BIGINT) * 60 AS content_runtime_seconds,
    CASE WHEN p_size > 0 THEN least(1.0, CAST(watch_seconds AS DOUBLE) / CAST(p_size * 60 AS DOUBLE)) ELSE 0.0 END AS completion_rate,
    done OR (CASE WHEN p_size > 0 THEN least(1.0, CAST(watch_seconds AS DOUBLE) / CAST(p_size * 60 AS DOUBLE)) ELSE 0.0 END) >= 0.9 AS is_completed,
    event_count, session_ended_timestamp AS created_timestamp
  FROM rolled r LEFT JOIN part ON p_partkey = r.content_id)"""
)


def profiles(spark: SparkSession, d: str) -> DataFrame:
    """Versions of users: the latest order of each customer and day."""
    o = read(spark, d, "orders").where("o_orderkey % 2 = 0")
    o = latest(o, ["o_custkey", "o_orderdate"], ["o_orderkey"])
    return o.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("country_code"), silver.title_case("o_orderpriority").alias("city"), F.lit(1970).alias("birth_year"),
        F.lower("o_orderstatus").alias("preferred_language"), (F.col("o_totalprice") > 250000).alias("is_marketing_opt_in"), F.col("o_orderdate").alias("source_updated_timestamp"), F.col("o_orderdate").alias("ingested_timestamp"))


def plans(spark: SparkSession, d: str) -> DataFrame:
    o = latest(read(spark, d, "orders").where("o_orderkey % 2 = 1"), ["o_custkey", "o_orderdate"], ["o_orderkey"])
    return o.select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("subscription_tier"), F.col("o_orderstatus").alias("subscription_status"), F.col("o_orderdate").alias("source_updated_timestamp"), F.col("o_orderdate").alias("ingested_timestamp"))


def timeline(spark: SparkSession, d: str) -> DataFrame:
    return history.user_timeline(profiles(spark, d), plans(spark, d))


def sql_hash(*columns: str) -> str:
    return "upper(sha256(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '__null__')" for c in columns) + ")))"


_ATTRIBUTES = ("country_code", "city", "birth_year", "preferred_language", "is_marketing_opt_in", "subscription_tier", "subscription_status")
# The join by inequality and rank, as an independent form of the as-of stream.
TIMELINE = f"""profiles AS (
  SELECT o_custkey AS user_id, o_orderstatus AS country_code,
    list_aggregate(list_transform(string_split(lower(trim(o_orderpriority)), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS city,
    1970 AS birth_year, lower(o_orderstatus) AS preferred_language, o_totalprice > 250000 AS is_marketing_opt_in, o_orderdate AS ts
  FROM orders WHERE o_orderkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
plans AS (
  SELECT o_custkey AS user_id, o_orderpriority AS subscription_tier, o_orderstatus AS subscription_status, o_orderdate AS ts
  FROM orders WHERE o_orderkey % 2 = 1 QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
times AS (SELECT user_id, ts AS valid_from_ts FROM profiles UNION SELECT user_id, ts FROM plans),
timeline AS (
  SELECT t.user_id, country_code, city, birth_year, preferred_language, is_marketing_opt_in, subscription_tier, subscription_status, t.valid_from_ts,
    greatest(u.ts, coalesce(s.ts, u.ts)) AS created_timestamp, {sql_hash(*_ATTRIBUTES)} AS record_hash
  FROM times t JOIN profiles u ON t.user_id = u.user_id AND u.ts <= t.valid_from_ts LEFT JOIN plans s ON t.user_id = s.user_id AND s.ts <= t.valid_from_ts
  QUALIFY row_number() OVER (PARTITION BY t.user_id, t.valid_from_ts ORDER BY u.ts DESC, s.ts DESC NULLS LAST) = 1),
changed AS (
  SELECT * FROM (SELECT *, lag(record_hash) OVER (PARTITION BY user_id ORDER BY valid_from_ts) AS before FROM timeline) WHERE before IS NULL OR before <> record_hash)"""
DIM = (
    TIMELINE
    + f""", first_use AS (SELECT user_id, min(session_started_timestamp) AS first_ts FROM sessions GROUP BY 1),
begun AS (
  SELECT c.* EXCLUDE (valid_from_ts, before), CASE WHEN row_number() OVER (PARTITION BY c.user_id ORDER BY valid_from_ts) = 1 AND first_ts < valid_from_ts THEN first_ts ELSE valid_from_ts END AS valid_from_ts
  FROM changed c LEFT JOIN first_use USING (user_id)),
closed AS (SELECT *, lead(valid_from_ts) OVER (PARTITION BY user_id ORDER BY valid_from_ts) AS next_ts FROM begun),
dim_user AS (
  SELECT {sql_hash("user_id", "strftime(valid_from_ts, '%Y-%m-%dT%H:%M:%S.%f')")} AS user_sk, * EXCLUDE (next_ts), coalesce(next_ts, TIMESTAMP '9999-12-31 23:59:59.999999') AS valid_to_ts, next_ts IS NULL AS is_current FROM closed)"""
)
# Users without any version are of no dimension: their sessions keep a null key.
FACT = (
    f"WITH {SESSIONS}, {DIM}"
    + """, dim_content AS (SELECT upper(sha256(CAST(p_partkey AS VARCHAR))) AS content_sk, p_partkey AS content_id FROM part),
fact AS (
  SELECT session_id, user_sk, content_sk, session_started_timestamp, session_ended_timestamp, CAST(session_started_timestamp AS DATE) AS activity_date, watch_seconds, content_runtime_seconds, completion_rate, is_completed, event_count, s.created_timestamp
  FROM sessions s LEFT JOIN dim_user u ON s.user_id = u.user_id AND session_started_timestamp >= valid_from_ts AND session_started_timestamp < valid_to_ts LEFT JOIN dim_content c ON s.content_id = c.content_id),
rows AS (SELECT f.*, u.user_id, c.content_id FROM fact f JOIN dim_user u USING (user_sk) JOIN dim_content c USING (content_sk)),
daily AS (
  SELECT user_id, content_id, activity_date, count(*) AS playback_count, CAST(count_if(is_completed) AS BIGINT) AS completed_session_count, CAST(sum(watch_seconds) AS BIGINT) AS total_watch_seconds,
    avg(completion_rate) AS average_completion_rate, max(created_timestamp) AS created_timestamp
  FROM rows GROUP BY 1, 2, 3),
hourly AS (
  SELECT date_trunc('hour', session_started_timestamp) AS window_start, date_trunc('hour', session_started_timestamp) + INTERVAL 1 HOUR AS window_end, content_id, count(*) AS playback_count, count(DISTINCT user_id) AS unique_viewer_count,
    CAST(count_if(is_completed) AS BIGINT) AS completed_session_count, CAST(sum(watch_seconds) AS BIGINT) AS total_watch_seconds, max(created_timestamp) AS created_timestamp
  FROM rows GROUP BY 1, 2, 3),
scored AS (SELECT *, playback_count + 2 * completed_session_count + CAST(total_watch_seconds AS DOUBLE) / 3600.0 AS popularity_score FROM hourly)"""
)


def dim_user(spark: SparkSession, d: str) -> DataFrame:
    return history.scd2(history.changes_only(timeline(spark, d), "user_id"), "user_id", "user_sk", history.first_use(sessions(spark, d), "user_id"))


def dim_content(spark: SparkSession, d: str) -> DataFrame:
    """One version for all time of each part."""
    p = read(spark, d, "part")
    return p.select(F.upper(F.sha2(F.col("p_partkey").cast("string"), 256)).alias("content_sk"), F.col("p_partkey").alias("content_id"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from_ts"), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz").alias("valid_to_ts"))


def facts(spark: SparkSession, d: str) -> DataFrame:
    return marts.fact(sessions(spark, d), dim_user(spark, d), dim_content(spark, d))


def fact_rows(spark: SparkSession, d: str) -> DataFrame:
    return marts.named_facts(sessions(spark, d), dim_user(spark, d), dim_content(spark, d)).select(
        "session_id", "user_sk", "content_sk", "user_id", "content_id", "session_started_timestamp", "session_ended_timestamp", "activity_date", "watch_seconds", "completion_rate", "is_completed", "created_timestamp")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Silver


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1""")
def dedup_latest(spark, d):
    df = latest(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query("""SELECT c_custkey, upper(trim(c_mktsegment)) AS country_code, upper(trim(c_mktsegment))[1] || lower(trim(c_mktsegment))[2:] AS city, lower(trim(c_name)) AS preferred_language, CAST(c_nationkey AS INTEGER) AS birth_year, c_acctbal > 0 AS is_marketing_opt_in FROM customer""")
def normalize_users(spark, d):
    raw = read(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("country_code"), F.col("c_mktsegment").alias("city"), F.col("c_nationkey").alias("birth_year"), F.col("c_name").alias("preferred_language"), (F.col("c_acctbal") > 0).alias("marketing_opt_in"))
    return raw.select("c_custkey", *[e.alias(k) for k, e in silver.normal_users().items()])


@query("""SELECT o_orderkey, 'basic' AS subscription_tier, CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'paused' END AS subscription_status FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus IN ('F', 'O')""")
def enum_filter(spark, d):
    o = read(spark, d, "orders")
    raw = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "basic").otherwise("Basic ").alias("subscription_tier"), F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "paused").otherwise("ACTIVE").alias("subscription_status"))
    return silver.accepted_subscriptions(raw)


@query("""SELECT p_partkey, CAST(p_size AS BIGINT) AS runtime_minutes, p_type AS title FROM part WHERE p_size > 10""")
def content_filter(spark, d):
    p = read(spark, d, "part").select("p_partkey", (F.col("p_size").cast("long")).alias("runtime_minutes"), F.col("p_type").alias("title"), F.when(F.col("p_size") > 10, "movie").otherwise("Movie").alias("content_type"), F.lit("available").alias("availability_status"))
    return silver.accepted_content(p).select("p_partkey", "runtime_minutes", "title")


@query(f"WITH {PLAYBACK} SELECT event_id, user_id, content_id, session_id, event_type, watch_seconds FROM playback WHERE watch_seconds >= 0 AND event_timestamp < TIMESTAMP '2024-01-20 00:00:00'")
def contract_filter(spark, d):
    e = playback(spark, d).withColumn("position_seconds", F.lit(0))
    return e.where(silver.contract("2024-01-20 00:00:00")).select("event_id", "user_id", "content_id", "session_id", "event_type", "watch_seconds")


@query(f"WITH {PLAYBACK} SELECT CAST(count_if(event_timestamp >= TIMESTAMP '2024-01-20 00:00:00') AS BIGINT) AS late_rows, count(*) AS row_count FROM playback")
def cutover_check(spark, d):
    return playback(spark, d).agg(F.count_if(F.col("event_timestamp") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).alias("late_rows"), F.count("*").alias("row_count"))


@query(f"WITH {SESSIONS} SELECT session_id, user_id, content_id, session_started_timestamp, session_ended_timestamp, watch_seconds, content_runtime_seconds, round(completion_rate, 6) AS completion_rate, is_completed, event_count FROM sessions")
def session_rollup(spark, d):
    return rounded(sessions(spark, d), "completion_rate").drop("created_timestamp", "pipeline_run_id")


@query("SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def current_version(spark, d):
    return latest_by_max(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


_CURRENT = "cur AS (SELECT o_custkey AS user_id, o_orderpriority AS city FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"


def enriched(spark, d):
    users = current_version(spark, d).select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("city"))
    content = read(spark, d, "part").select(F.col("p_partkey").alias("content_id"), F.col("p_type").alias("genre"))
    return playback(spark, d).select("event_id", "user_id", "content_id").join(users, "user_id", "left").join(content, "content_id", "left")


@query(f"WITH {PLAYBACK}, {_CURRENT} SELECT event_id, user_id, content_id, city, p_type AS genre FROM playback LEFT JOIN cur USING (user_id) LEFT JOIN part ON p_partkey = content_id")
def current_enrichment(spark, d):
    return enriched(spark, d)


_SHARES = f"WITH {PLAYBACK}, {_CURRENT}, counts AS (SELECT city, count(*) AS count FROM playback LEFT JOIN cur USING (user_id) GROUP BY 1) SELECT city, count, round(CAST(count AS DOUBLE) / (SELECT sum(count) FROM counts), 6) AS share FROM counts"


@query(_SHARES)
def skew_direct(spark, d):
    return profile.distribution(enriched(spark, d), "city")


@query(_SHARES)
def skew_salted(spark, d):
    return profile.salted_distribution(enriched(spark, d), "city", "event_id")


# Histories


@query(f"WITH {TIMELINE} SELECT user_id, valid_from_ts FROM times")
def change_timeline(spark, d):
    return history.timeline(profiles(spark, d), plans(spark, d), "user_id", "source_updated_timestamp")


@query(f"WITH {TIMELINE} SELECT * FROM timeline")
def asof_timeline(spark, d):
    return timeline(spark, d)


@query(f"WITH {TIMELINE} SELECT * EXCLUDE (before) FROM changed")
def change_only_history(spark, d):
    return history.changes_only(timeline(spark, d), "user_id")


@query(f"WITH {SESSIONS}, {DIM} SELECT * REPLACE (strftime(valid_to_ts, '%Y-%m-%dT%H:%M:%S.%f') AS valid_to_ts) FROM dim_user")
def scd2_dim(spark, d):
    # As text: the open end lies beyond what some clients can hold as a timestamp.
    return dim_user(spark, d).withColumn("valid_to_ts", iso_text("valid_to_ts"))


@query(f"{FACT} SELECT * EXCLUDE (completion_rate), round(completion_rate, 6) AS completion_rate FROM fact")
def interval_fact(spark, d):
    return rounded(facts(spark, d), "completion_rate").drop("pipeline_run_id")


@query("""SELECT e.event_id, o.o_orderkey FROM events e ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2) o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate + INTERVAL 8795 DAY""")
def asof_join(spark, d):
    e = read(spark, d, "events").select("event_id", "user_id", "ts")
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("user_id"), (F.col("o_orderdate") + F.expr("interval 8795 days")).alias("at"), "o_orderkey")
    return history.asof(e, o, "user_id", "ts", "at", ["o_orderkey"], ["o_orderkey"]).select("event_id", "o_orderkey")


# Marts


@query(f"{FACT} SELECT * EXCLUDE (average_completion_rate), round(average_completion_rate, 6) AS average_completion_rate, CAST(coalesce(date_diff('day', lag(activity_date) OVER (PARTITION BY user_id, content_id ORDER BY activity_date), activity_date), 0) AS INTEGER) AS days_since_last_playback FROM daily")
def daily_obt(spark, d):
    return rounded(marts.daily(fact_rows(spark, d)), "average_completion_rate")


_RANKED = "SELECT * EXCLUDE (popularity_score), round(popularity_score, 6) AS popularity_score, CAST(dense_rank() OVER (PARTITION BY window_start ORDER BY popularity_score DESC, content_id) AS INTEGER) AS popularity_rank FROM scored"


@query(f"{FACT} {_RANKED}")
def hourly_mart(spark, d):
    return rounded(marts.hourly(fact_rows(spark, d)), "popularity_score")


@query(f"{FACT} SELECT window_start, content_id, round(popularity_score, 6) AS popularity_score FROM scored ORDER BY scored.popularity_score DESC, window_start DESC, content_id LIMIT 100")
def top100(spark, d):
    return rounded(marts.top(marts.hourly(fact_rows(spark, d))).select("window_start", "content_id", "popularity_score"), "popularity_score")


@query(f"""{FACT}, anchors AS (SELECT DISTINCT user_id, activity_date FROM daily)
SELECT a.user_id, round(CAST(sum(CASE WHEN e.activity_date = a.activity_date THEN total_watch_seconds ELSE 0 END) AS DOUBLE) / 60.0, 6) AS watch_minutes_24h,
  round(CAST(sum(CASE WHEN e.activity_date >= a.activity_date - 6 THEN total_watch_seconds ELSE 0 END) AS DOUBLE) / 60.0, 6) AS watch_minutes_7d,
  CAST(sum(CASE WHEN e.activity_date >= a.activity_date - 6 THEN playback_count ELSE 0 END) AS BIGINT) AS playback_sessions_7d, CAST(sum(completed_session_count) AS BIGINT) AS completed_sessions_30d,
  round(sum(average_completion_rate * playback_count) / sum(playback_count), 6) AS average_completion_rate_30d, count(DISTINCT content_id) AS distinct_content_count_30d, CAST(0 AS INTEGER) AS days_since_last_playback,
  CAST(a.activity_date + 1 AS TIMESTAMP) AS event_timestamp, max(created_timestamp) AS created
FROM anchors a JOIN daily e ON a.user_id = e.user_id AND e.activity_date BETWEEN a.activity_date - 29 AND a.activity_date GROUP BY a.user_id, a.activity_date""")
def rolling_user_features(spark, d):
    df = marts.user_features(marts.daily(fact_rows(spark, d)))
    return df.withColumns({"average_completion_rate_30d": F.col("average_completion_rate_30d").cast("double"), "event_timestamp": F.col("event_timestamp").cast("timestamp_ntz")})


@query(f"""{FACT}, rolling AS (
  SELECT a.content_id, a.window_start, a.window_end, CAST(sum(CASE WHEN t.window_start = a.window_start THEN t.playback_count ELSE 0 END) AS BIGINT) AS playback_count_1h,
    CAST(sum(CASE WHEN t.window_start >= a.window_start - INTERVAL 23 HOUR THEN t.playback_count ELSE 0 END) AS BIGINT) AS playback_count_24h,
    round(CAST(sum(t.completed_session_count) AS DOUBLE) / sum(t.playback_count), 6) AS completion_rate_7d,
    round(sum(CASE WHEN t.window_start >= a.window_start - INTERVAL 23 HOUR THEN t.popularity_score ELSE 0.0 END), 4) AS popularity_score_24h, max(t.created_timestamp) AS m
  FROM scored a JOIN scored t ON a.content_id = t.content_id AND t.window_start BETWEEN a.window_start - INTERVAL 167 HOUR AND a.window_start GROUP BY ALL),
viewers AS (
  SELECT a.content_id, a.window_start, count(DISTINCT r.user_id) AS unique_viewer_count_24h, max(r.created_timestamp) AS s
  FROM scored a JOIN rows r ON a.content_id = r.content_id AND r.session_started_timestamp >= a.window_end - INTERVAL 24 HOUR AND r.session_started_timestamp < a.window_end GROUP BY 1, 2)
SELECT content_id, playback_count_1h, playback_count_24h, unique_viewer_count_24h, completion_rate_7d, popularity_score_24h, window_end AS event_timestamp, greatest(m, s) AS created FROM rolling JOIN viewers USING (content_id, window_start)""")
def rolling_entity_features(spark, d):
    rows = fact_rows(spark, d)
    return rounded(marts.content_features(marts.hourly(rows), rows), "popularity_score_24h", digits=4)


# Streaming forms, replayed over a table


def _windowed(key: str, others: dict[str, str]):
    from tidewater.streaming.windows import totals

    return lambda spark, d: totals(playback(spark, d), key, others)


def _window_sql(key: str, others: dict[str, str]) -> str:
    counts = ", ".join(f"count(DISTINCT {c}) AS {n}" for n, c in others.items())
    return f"""WITH {PLAYBACK} SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start, time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end, {key}, count(*) AS event_count, {counts},
CAST(count_if(event_type = 'playback_started') AS BIGINT) AS playback_started_count, CAST(count_if(event_type = 'playback_completed') AS BIGINT) AS playback_completed_count,
CAST(sum(CASE WHEN event_type = 'playback_completed' THEN watch_seconds ELSE 0 END) AS BIGINT) AS completed_watch_seconds FROM playback GROUP BY 1, 2, 3"""


_USER = "user_id", {"unique_session_count": "session_id", "unique_content_count": "content_id"}
_CONTENT = "content_id", {"unique_user_count": "user_id", "unique_session_count": "session_id"}
QUERIES["window_5m_user"], ORACLE_SQL["window_5m_user"] = _windowed(*_USER), _window_sql(*_USER)
QUERIES["window_5m_entity"], ORACLE_SQL["window_5m_entity"] = _windowed(*_CONTENT), _window_sql(*_CONTENT)


@query(f"""WITH {PLAYBACK}, marked AS (SELECT *, coalesce(max(event_timestamp) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TIMESTAMP '1970-01-01') - INTERVAL 30 SECOND AS watermark FROM playback)
SELECT CAST(event_timestamp AS DATE) AS day, count(*) AS row_count, CAST(count_if(event_timestamp <= watermark) AS BIGINT) AS late_rows FROM marked GROUP BY 1""")
def late_policy_batch(spark, d):
    from tidewater.streaming.policy import replay_watermark

    df = replay_watermark(playback(spark, d), "event_id", "event_timestamp", 30)
    return df.groupBy(F.to_date("event_timestamp").alias("day")).agg(F.count("*").alias("row_count"), F.count_if("is_late").alias("late_rows"))


# Records of events: some with a wrong frame, id, length or contract, by their number.
_KNOWN = "('playback_started', 'playback_progressed', 'playback_completed')"
_CODE = """CASE WHEN event_id % 11 = 0 THEN 'invalid_confluent_wire_format' WHEN event_id % 13 = 0 THEN 'unexpected_schema_id' WHEN event_id % 19 = 0 THEN 'avro_decode_failed' WHEN event_id % 23 = 0 THEN 'trailing_payload_bytes'
  WHEN event_id % 17 = 0 OR watch_seconds < 0 THEN 'contract_validation_failed' END"""


def records(spark: SparkSession, d: str) -> DataFrame:
    from tidewater.streaming.messages import encoded

    e = playback(spark, d).select(
        F.col("event_id").alias("offset"), F.concat(F.lit("e"), "event_id").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), F.col("content_id").cast("string").alias("content_id"), "session_id", "event_type",
        F.lit(0).alias("position_seconds"), F.col("watch_seconds").cast("int").alias("watch_seconds"), "event_timestamp", F.col("event_timestamp").alias("produced_timestamp"), (1 + (F.col("event_id") % 17 == 0).cast("int")).alias("payload_schema_version"))
    n = F.col("offset")
    good = e.select("offset", encoded(F.when(n % 13 == 0, 8).otherwise(7)).alias("v"), F.col("produced_timestamp").cast("timestamp").alias("timestamp"))
    cut = F.expr("substring(v, 1, octet_length(v) - 1)")
    value = F.when(n % 11 == 0, F.concat(F.unhex(F.lit("01")), "v")).when((n % 13 != 0) & (n % 19 == 0), cut).when((n % 13 != 0) & (n % 23 == 0), F.concat("v", F.unhex(F.lit("00")))).otherwise(F.col("v"))
    return good.select(F.lit(None).cast("binary").alias("key"), value.alias("value"), F.lit("playback").alias("topic"), (n % 6).cast("int").alias("partition"), n.cast("long").alias("offset"), "timestamp")


@query(f"WITH {PLAYBACK}, coded AS (SELECT *, {_CODE} AS code FROM playback) SELECT event_id AS offset, code AS error_type, CASE WHEN code IS NULL THEN watch_seconds END AS watch_seconds, CASE WHEN code IS NULL THEN session_id END AS session_id, CASE WHEN code IS NULL THEN epoch_us(event_timestamp) // 1000 END AS millis FROM coded")
def decoded_records(spark, d):
    from tidewater.streaming.contract import decoded

    out = decoded(records(spark, d), 7)
    ok = F.col("error_type").isNull()
    return out.select("offset", "error_type", F.when(ok, F.col("watch_seconds")).cast("long").alias("watch_seconds"), F.when(ok, F.col("session_id")).alias("session_id"), F.when(ok, F.col("event_timestamp")).alias("millis"))


@query(f"WITH {PLAYBACK} SELECT 'e' || event_id AS event_id, date_trunc('milliseconds', event_timestamp) AS event_timestamp, event_type, CAST(watch_seconds AS INTEGER) AS watch_seconds FROM playback WHERE {_CODE} IS NULL")
def valid_events(spark, d):
    from tidewater.streaming.contract import decoded, valid

    return valid(decoded(records(spark, d), 7)).select("event_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "event_type", "watch_seconds")


@query(f"WITH {PLAYBACK} SELECT sha256(concat_ws(':', 'playback', CAST(event_id % 6 AS VARCHAR), CAST(event_id AS VARCHAR))) AS dlq_id, {_CODE} AS error_type, event_id AS source_offset, CAST(event_id % 6 AS INTEGER) AS source_partition, CAST(0 AS INTEGER) AS replay_count FROM playback WHERE {_CODE} IS NOT NULL")
def dlq_split(spark, d):
    from tidewater.streaming.contract import dead_letters, decoded

    return dead_letters(decoded(records(spark, d), 7)).select("dlq_id", "error_type", "source_offset", "source_partition", "replay_count")


@query(f"WITH {PLAYBACK} SELECT sha256(concat_ws(':', 'playback', CAST(event_id % 6 AS VARCHAR), CAST(event_id AS VARCHAR))) AS key, {_CODE} AS error_type FROM playback WHERE {_CODE} IS NOT NULL")
def dlq_messages(spark, d):
    from tidewater.streaming.contract import dead_letters, decoded
    from tidewater.streaming.messages import dead_letter_messages

    out = dead_letter_messages(dead_letters(decoded(records(spark, d), 7)), "dead")
    return out.select(F.col("key").cast("string").alias("key"), F.get_json_object(F.col("value").cast("string"), "$.error_type").alias("error_type"))


@query(f"WITH {PLAYBACK} SELECT session_id AS key, event_timestamp AS produced, CAST(event_id % 7 = 0 AS VARCHAR) AS is_late, event_id % 29 = 0 AS cut_off, 6 AS headers FROM playback")
def published_messages(spark, d):
    from tidewater.streaming.messages import published

    e = playback(spark, d).select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), F.col("content_id").cast("string").alias("content_id"), "session_id", "event_type", F.lit(0).alias("position_seconds"), F.col("watch_seconds").cast("int").alias("watch_seconds"),
        "event_timestamp", F.col("event_timestamp").alias("produced_timestamp"), F.lit(1).alias("payload_schema_version"), (F.col("event_id") % 7 == 0).alias("is_late"), (F.col("event_id") % 29 == 0).alias("is_invalid"))
    out = published(e, "playback", "run", 7)
    return out.select(F.col("key").cast("string").alias("key"), F.col("timestamp").cast("timestamp_ntz").alias("produced"), F.col("headers")[2]["value"].cast("string").alias("is_late"), F.col("value").cast("string").startswith('{"event_id":').alias("cut_off"), F.size("headers").alias("headers"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the one that driver and executors share; a local one only where all runs on this machine."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(shared or 'file://' + tempfile.mkdtemp(prefix='tidewater-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _streamed(spark: SparkSession, d: str) -> DataFrame:
    """The events as a file stream that sends each of them twice."""
    schema = read(spark, d, "events").schema
    e = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    kind = F.when(F.col("event_type") == "view", "playback_started").when(F.col("event_type") == "purchase", "playback_completed").otherwise("playback_progressed")
    e = e.select("event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("content_id"), F.col("ts").cast("timestamp").alias("event_timestamp"), kind.alias("event_type"), F.floor(F.col("value") * 10).cast("long").alias("watch_seconds"))
    return e.withColumn("session_id", F.concat_ws("-", "user_id", "content_id", F.date_format("event_timestamp", "yyyyMMdd")))


@query(_window_sql(*_USER))
def stream_window_user(spark, d):
    from tidewater.streaming.sinks import drained
    from tidewater.streaming.windows import totals

    out = drained(totals(_streamed(spark, d), *_USER, streaming=True), _scratch(spark, "stream-windows"), "complete")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query(f"WITH {PLAYBACK} SELECT event_id, user_id, event_type, watch_seconds FROM playback")
def stream_first_copies(spark, d):
    from tidewater.session import SETTINGS
    from tidewater.streaming.policy import on_time_once
    from tidewater.streaming.sinks import drained

    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, SETTINGS[name])
    twice = _streamed(spark, d).withColumn("source_timestamp", F.col("event_timestamp")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return drained(on_time_once(twice), _scratch(spark, "stream-first")).select("event_id", "user_id", "event_type", "watch_seconds")


# Streams in phases: the first phase holds the events before a time, without some that come late; each phase is read up to its end, with a batch
# without data after it, before the next one begins. So the watermark between phases is known.
_SPLIT = "TIMESTAMP '2024-01-16 00:03:00'"


def _phased(spark: SparkSession, df: DataFrame, ts: str, name: str, run, flush: DataFrame | None = None) -> DataFrame:
    """Lands df (with a column first_phase) in phases and runs the stream ``run(stream, path)`` after each; what the last run gave."""
    path = _scratch(spark, name)
    found = None
    for part in [df.where("first_phase"), df.where("not first_phase"), *([flush] if flush is not None else [])]:
        part.drop("first_phase").withColumn(ts, F.col(ts).cast("timestamp")).write.mode("append").parquet(f"{path}/in")
        kinds = spark.read.parquet(f"{path}/in").schema
        found = run(spark.readStream.schema(kinds).parquet(f"{path}/in"), path)
    return found


def _window_rows(source: str, window: str) -> str:
    """Rows of windows that the first phase's watermark has closed do not count."""
    return f"""WITH {PLAYBACK}, phased AS (SELECT *, {source} AS source, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start FROM playback), parted AS (SELECT *, {window} AS first_phase FROM phased),
marks AS (SELECT date_trunc('milliseconds', max(source) FILTER (first_phase)) - INTERVAL 30 SECOND AS one, date_trunc('milliseconds', max(source)) - INTERVAL 30 SECOND AS two FROM parted),
kept AS (SELECT parted.* FROM parted, marks WHERE first_phase OR window_start + INTERVAL 5 MINUTE > one)"""


def _window_totals(key: str) -> str:
    counts = ", ".join(f"count(DISTINCT {c}) AS {n}" for n, c in _USER[1].items())
    return f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, {key}, count(*) AS event_count, {counts},
CAST(count_if(event_type = 'playback_started') AS BIGINT) AS playback_started_count, CAST(count_if(event_type = 'playback_completed') AS BIGINT) AS playback_completed_count,
CAST(sum(CASE WHEN event_type = 'playback_completed' THEN watch_seconds ELSE 0 END) AS BIGINT) AS completed_watch_seconds FROM kept, marks"""


_APPENDED = f"event_timestamp < {_SPLIT} AND NOT (event_id % 10 = 0)"


@query(_window_rows("event_timestamp", _APPENDED) + _window_totals("user_id") + " WHERE window_start + INTERVAL 5 MINUTE <= two GROUP BY 1, 2, 3")
def stream_closed_windows(spark, d):
    # Append mode: a window is emitted once, when the watermark passes its end, and its state goes; later rows of it are rejected, those of open windows count.
    from tidewater.streaming.sinks import drained
    from tidewater.streaming.windows import totals

    df = playback(spark, d).withColumn("first_phase", F.expr(_APPENDED))
    run = lambda s, path: drained(totals(s.withWatermark("event_timestamp", "30 seconds"), *_USER, streaming=True), path, empty_batches=True)
    out = _phased(spark, df, "event_timestamp", "stream-closed", run)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


#: Events reach production up to twenty minutes after they happen.
_LAG = "event_timestamp + INTERVAL 1 MINUTE * (event_id % 21)"
_PRODUCED = f"event_timestamp + INTERVAL 1 MINUTE * (event_id % 21) < {_SPLIT}"


def _lagging(spark: SparkSession, d: str) -> DataFrame:
    df = playback(spark, d).withColumn("source_timestamp", (F.col("event_timestamp") + F.make_dt_interval(mins=(F.col("event_id") % 21).cast("int"))).cast("timestamp"))
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")).withColumn("first_phase", F.col("source_timestamp") < F.expr(_SPLIT))


def _flush(df: DataFrame) -> DataFrame:
    """One row that only moves the watermark far ahead."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema if f.name not in ("source_timestamp", "user_id")]
    return df.sparkSession.range(1).select(F.lit(-1).cast(df.schema["user_id"].dataType).alias("user_id"), F.expr("TIMESTAMP '2030-01-01'").cast("timestamp").alias("source_timestamp"), *none).select(*df.columns)


@query(_window_rows(_LAG, _PRODUCED) + _window_totals("user_id") + " GROUP BY 1, 2, 3")
def stream_event_windows(spark, d):
    # Windows of event time, closed by the watermark of production time; the last row closes them all.
    from tidewater.session import SETTINGS
    from tidewater.streaming.sinks import drained
    from tidewater.streaming.stateful import event_windows

    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, SETTINGS[name])
    df = _lagging(spark, d)
    out = _phased(spark, df, "source_timestamp", "stream-event-windows", lambda s, path: drained(event_windows(s, *_USER), path, empty_batches=True), _flush(df))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


_JUDGED = f"""WITH {PLAYBACK}, sent AS (
  SELECT *, {_CODE} AS code, event_timestamp < {_SPLIT} AND NOT (event_id % 10 = 0) AS first_phase, date_trunc('milliseconds', event_timestamp) AS ms FROM playback
), mark AS (SELECT date_trunc('milliseconds', max(event_timestamp) FILTER (first_phase)) - INTERVAL 30 SECOND AS one FROM sent), judged AS (
  SELECT CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS copies, CASE WHEN code IS NOT NULL THEN 'invalid' WHEN NOT first_phase AND ms <= one THEN 'late' ELSE 'accepted' END AS verdict FROM sent, mark
)
SELECT CAST(sum(CASE verdict WHEN 'invalid' THEN copies ELSE 0 END) AS BIGINT) AS invalid_events_routed, CAST(sum(CASE verdict WHEN 'late' THEN copies ELSE 0 END) AS BIGINT) AS late_events_dropped,
  CAST(sum(CASE verdict WHEN 'accepted' THEN copies - 1 ELSE 0 END) AS BIGINT) AS duplicate_events_dropped, CAST(count_if(verdict = 'accepted') AS BIGINT) AS events_accepted FROM judged"""


@query(_JUDGED)
def stream_counters(spark, d):
    # Observed metrics of a stream of records with late, repeated and invalid ones.
    from tidewater.session import SETTINGS
    from tidewater.streaming.contract import decoded
    from tidewater.streaming.sinks import drained
    from tidewater.streaming.stateful import COUNTED, judged

    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, SETTINGS[name])
    df = records(spark, d)
    twice = df.withColumn("copy", F.explode(F.when(F.col("offset") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    sent = twice.withColumn("first_phase", (F.col("timestamp") < F.expr(_SPLIT).cast("timestamp")) & (F.col("offset") % 10 != 0))
    sent = sent.withColumn("offset", F.col("offset") + F.col("copy") * F.lit(1 << 40)).drop("copy")
    found: dict[str, int] = {}
    _phased(spark, sent, "timestamp", "stream-counters", lambda s, path: drained(judged(decoded(s, 7), columns=()), path, observed=found))
    return spark.createDataFrame([tuple(found.get(n, 0) for n in COUNTED)], ", ".join(f"{n} bigint" for n in COUNTED))


# Tables


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CAST(date_trunc('year', o_orderdate) AS DATE) AS year FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 5 = 0""")
def store_upsert(spark, d):
    # Even keys, then every fifth with a new status: those of both are replaced, the others added, by year.
    from tidewater.sources.tables import Store

    store, o = Store(spark, _scratch(spark, "store")), read(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.to_date(F.trunc("o_orderdate", "year")).alias("year"))
    store.replace("t", o.where("o_orderkey % 2 = 0"), ["year"])
    store.upsert("t", o.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus"))), ["o_orderkey", "year"])
    return store.read("t")


@query("SELECT 4 AS snapshots, 4 AS latest, 'compact' AS operation, (SELECT count(*) FROM customer) AS row_count, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS first_rows, true AS same_again")
def store_snapshots(spark, d):
    # Create, append, append a run that is there already (nothing), append by buckets, compact.
    from tidewater.sources.tables import Store

    store, c = Store(spark, _scratch(spark, "store")), read(spark, d, "customer").withColumn("run", (F.col("c_custkey") % 3).cast("string"))
    store.append("t", c.where("c_custkey % 2 = 0"))
    store.append_buckets("t", c.where("c_custkey % 2 = 1"), "c_custkey", 2)
    again = store.append_once({"t": c.where("run = '1'")}, "1", "run") == {"t": "skipped"}
    store.compact("t", require_fewer=False)
    s = store.snapshots_table("t")
    newest = profile.latest_snapshot(s, "number", "committed_at").select("latest")
    last = s.join(newest, s["number"] == newest["latest"]).select(F.lit(s.count()).alias("snapshots"), F.col("latest").cast("int").alias("latest"), "operation")
    return last.withColumns({"row_count": F.lit(store.read("t").count()), "first_rows": F.lit(store.read("t", 1).count()), "same_again": F.lit(again)})


@query("SELECT count(DISTINCT o_orderdate) AS days, true AS have_bytes FROM orders WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-04-01'")
def store_files_in_range(spark, d):
    from tidewater.sources.tables import Store

    store = Store(spark, _scratch(spark, "store"))
    o = read(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")).where("day >= date'1994-12-01' and day < date'1995-05-01'")
    store.replace("t", o.repartition("day"), ["day"])
    return store.files_in_range("t", "1995-01-01", "1995-04-01").select(F.col("file_count").alias("days"), (F.col("total_bytes") > 0).alias("have_bytes"))


@query("""SELECT c_custkey, 'landing' AS _source_system, 'customer' AS _source_object, 'run-1' AS _pipeline_run_id, CAST(NULL AS INTEGER) AS _schema_version, true AS from_file, true AS ingestion_id_is_hash,
sha256(to_json({'c_custkey': c_custkey, 'c_mktsegment': c_mktsegment, 'c_name': c_name, 'c_nationkey': c_nationkey})) AS _record_hash FROM customer""")
def bronze_metadata(spark, d):
    from datetime import datetime

    from tidewater.sources.landing import with_metadata

    c = read(spark, d, "customer").select("c_name", "c_custkey", "c_nationkey", "c_mktsegment")
    m = with_metadata(c, "customer", "run-1", datetime(2026, 1, 1))
    return m.select("c_custkey", "_source_system", "_source_object", "_pipeline_run_id", "_schema_version", F.col("_source_file").contains("/customer.parquet").alias("from_file"), (F.col("_ingestion_id") == F.sha2(F.concat_ws("||", F.lit("run-1"), "_source_file"), 256)).alias("ingestion_id_is_hash"), "_record_hash")


# Profiles and checks


@query(f"{_SHARES.split('SELECT city, count, round')[0]} SELECT city, count, round(CAST(count AS DOUBLE) / (SELECT sum(count) FROM counts), 6) AS share, CAST(row_number() OVER (ORDER BY count DESC, city NULLS FIRST) AS INTEGER) AS rank FROM counts")
def skew_ranked(spark, d):
    return profile.ranked(profile.distribution(enriched(spark, d), "city"), "city")


@query("SELECT count(*) AS row_count, count(DISTINCT o_custkey) AS natural_keys, count(*) - count(DISTINCT o_custkey) AS retained_extra_versions FROM orders")
def retained_versions(spark, d):
    return profile.retained_versions(read(spark, d, "orders"), "o_custkey")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest, max(o_orderdate) AS committed_at FROM orders GROUP BY 1")
def latest_by_time(spark, d):
    return profile.latest_snapshot(read(spark, d, "orders"), "o_orderkey", "o_orderdate", ["o_custkey"])


@query("""WITH s AS (SELECT o_orderstatus, count(*) AS count, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1)
SELECT *, CASE o_orderstatus WHEN 'F' THEN 0.3 WHEN 'O' THEN 0.5 WHEN 'P' THEN 0.9 END AS configured, abs(share - CASE o_orderstatus WHEN 'F' THEN 0.3 WHEN 'O' THEN 0.5 WHEN 'P' THEN 0.9 END) <= 0.3 AS agrees FROM s""")
def category_rates(spark, d):
    return profile.category_rates(read(spark, d, "orders"), "o_orderstatus", {"F": 0.3, "O": 0.5, "P": 0.9}, 0.3)


@query("SELECT p_partkey, string_split(lower(trim(p_type)), ' ')[1] AS first_genre, to_json(string_split(lower(trim(p_type)), ' ')) AS as_json FROM part")
def genre_texts(spark, d):
    genres = F.transform(F.split("p_type", " "), lambda g: F.lower(F.trim(g)))
    return read(spark, d, "part").select("p_partkey", silver.first_genre(genres).alias("first_genre"), F.to_json(genres).alias("as_json"))


_M = "18446744073709551616::UHUGEINT"


@query(f"""WITH a AS (SELECT o_orderkey, ((o_orderkey::UHUGEINT + 11400714819323198485::UHUGEINT) % {_M})::UBIGINT AS z FROM orders),
b AS (SELECT o_orderkey, ((xor(z, z >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT) % {_M})::UBIGINT AS z FROM a), c AS (SELECT o_orderkey, ((xor(z, z >> 27)::UHUGEINT * 10723151780598845931::UHUGEINT) % {_M})::UBIGINT AS z FROM b),
e AS (SELECT o_orderkey, xor(z, z >> 31) AS z FROM c) SELECT o_orderkey, CASE WHEN z >= 9223372036854775808 THEN (z::HUGEINT - 18446744073709551616::HUGEINT)::BIGINT ELSE z::BIGINT END AS h FROM e""")
def splitmix_numbers(spark, d):
    from tidewater.functions import splitmix64

    return read(spark, d, "orders").select("o_orderkey", splitmix64(F.col("o_orderkey")).alias("h"))


@query("SELECT table_name, CAST(ordinal_position AS INTEGER) AS ordinal, column_name FROM information_schema.columns WHERE table_name IN ('orders', 'events', 'part')")
def information_schema(spark, d):
    return checks.columns_of({n: read(spark, d, n) for n in ("orders", "events", "part")}).drop("data_type")


@query("SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, 'unexpected' AS fault UNION ALL SELECT t, c, 'missing' FROM (SELECT unnest(['orders', 'part']) AS t), (SELECT unnest(['event_timestamp', 'created']) AS c) UNION ALL SELECT 'good', 'created', 'missing'")
def test_feature_timestamps(spark, d):
    o = read(spark, d, "orders")
    return checks.wrong_feature_timestamps(checks.columns_of({"orders": o, "part": read(spark, d, "part"), "good": o.select("o_orderkey", F.col("o_orderdate").alias("event_timestamp"))}))


@query("SELECT 'events' AS table_name, 'Created' AS column_name")
def test_gold_forbids_created(spark, d):
    return checks.forbidden_created(checks.columns_of({"events": read(spark, d, "events").withColumn("Created", F.col("ts")), "part": read(spark, d, "part")}))


@query("SELECT 'missing: ' || c AS fault FROM (SELECT unnest(['content_id', 'event_id', 'session_id']) AS c) WHERE c NOT IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'events')")
def test_required_columns(spark, d):
    return spark.createDataFrame([(f,) for f in checks.required_columns(read(spark, d, "events"), ["content_id", "event_id", "session_id"])], "fault string")


@query("SELECT event_id FROM events WHERE event_id % 3 = 0")
def test_created_not_before_event(spark, d):
    e = read(spark, d, "events").select("event_id", F.col("ts").alias("event_timestamp"), (F.col("ts") + F.when(F.col("event_id") % 3 == 0, F.expr("interval -1 hour")).otherwise(F.expr("interval 0 hour"))).alias("created"))
    return checks.created_after_event(e).select("event_id")


@query(f"WITH {SESSIONS}, {DIM} SELECT user_id, user_sk FROM dim_user WHERE user_id % 11 = 0")
def test_valid_ranges(spark, d):
    broken = dim_user(spark, d).withColumn("valid_to_ts", F.when(F.col("user_id") % 11 == 0, F.col("valid_from_ts")).otherwise(F.col("valid_to_ts")))
    return checks.valid_ranges(broken).select("user_id", "user_sk")


@query(f"WITH {SESSIONS}, {DIM} SELECT user_id, valid_from_ts FROM dim_user WHERE user_id % 13 = 0")
def test_surrogate_key(spark, d):
    broken = dim_user(spark, d).withColumn("user_sk", F.when(F.col("user_id") % 13 == 0, F.lower("user_sk")).otherwise(F.col("user_sk")))
    return checks.surrogate_recomputed(broken, "user_id", "user_sk").select("user_id", "valid_from_ts")


@query("SELECT o_orderpriority AS model, count(*) AS tests, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS passed, CAST(count_if(o_orderstatus <> 'F') AS BIGINT) AS failed FROM orders GROUP BY 1")
def test_summary(spark, d):
    return checks.summary(read(spark, d, "orders").select(F.col("o_orderpriority").alias("model"), F.when(F.col("o_orderstatus") == "F", "pass").otherwise("fail").alias("status")))


@query("SELECT 'c_name' AS column_name, CAST(count_if(c_name IS NULL) AS BIGINT) = 0 AS ok FROM customer UNION ALL SELECT 'c_nationkey', count_if(c_nationkey NOT IN (0, 1, 2, 3)) = 0 FROM customer UNION ALL SELECT 'rows', count(*) >= 1 FROM customer")
def test_expectations(spark, d):
    r = checks.expectations(read(spark, d, "customer"), ["c_custkey"], ["c_name"], {"c_nationkey": [0, 1, 2, 3]})
    return spark.createDataFrame([("c_name", r["null_c_name"]), ("c_nationkey", r["set_c_nationkey"]), ("rows", r["row_count"])], "column_name string, ok boolean")


@query("SELECT 'dim-user' AS contract, CAST(3 AS BIGINT) AS tests, CAST(2 AS BIGINT) AS passed, CAST(1 AS BIGINT) AS failed")
def contract_roll_up(spark, d):
    from tidewater.plans import contracts

    c = next(x for x in contracts.CONTRACTS if x.name == "dim-user")
    # One version stands twice: the assertion on its key fails.
    dim = dim_user(spark, d).unionByName(dim_user(spark, d).where("user_id % 10 = 0"))
    rows = [(c.name, k, "pass" if n == 0 else "fail") for k, n in c.failures(dim).items()]
    return contracts.roll_up(spark.createDataFrame(rows, "contract string, assertion string, status string")).withColumnRenamed("model", "contract")


@query("SELECT o_orderstatus, count(*) AS row_count, CAST(count_if(o_totalprice > 400000) AS BIGINT) AS null_count FROM orders GROUP BY 1")
def schema_evolution(spark, d):
    o = read(spark, d, "orders").withColumn("score", F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")))
    return profile.schema_evolution(o, "o_orderstatus", "score")


@query("SELECT count(*) AS row_count, count(DISTINCT event_id) AS distinct_keys, min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def fingerprint(spark, d):
    return profile.fingerprint(read(spark, d, "events"), "event_id", "ts")


@query("SELECT count(*) AS row_count, CAST(count_if(c_name IS NULL) AS BIGINT) AS c_name_nulls, CAST(count_if(c_acctbal IS NULL) AS BIGINT) AS c_acctbal_nulls FROM customer")
def null_profile(spark, d):
    return profile.null_profile(read(spark, d, "customer"), ["c_name", "c_acctbal"])


@query("SELECT l_returnflag, count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS keys, round(CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE) / count(*), 6) AS duplicate_rate FROM lineitem GROUP BY 1")
def duplicate_rate(spark, d):
    return profile.duplicate_rate(read(spark, d, "lineitem").withColumn("key", F.struct("l_orderkey", "l_linenumber")), "l_returnflag", "key")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def test_unique_combination(spark, d):
    return checks.unique_combination(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


_ORDERED = "SELECT user_id, valid_from_ts, valid_to_ts, is_current FROM (SELECT *, lead(valid_from_ts) OVER (PARTITION BY user_id ORDER BY valid_from_ts) AS nx FROM dim_user WHERE user_id % 7 <> 0 OR NOT is_current) WHERE coalesce(nx <> valid_to_ts, false) OR is_current <> (nx IS NULL)"


@query(f"WITH {SESSIONS}, {DIM} {_ORDERED}")
def test_scd2_contiguous(spark, d):
    # A broken dimension: the current version of every seventh user is gone.
    return checks.contiguous(dim_user(spark, d).where("user_id % 7 <> 0 or not is_current"), "user_id").select("user_id", "valid_from_ts", "valid_to_ts", "is_current")


@query(f"WITH {SESSIONS}, {DIM} SELECT user_id, CAST(count_if(is_current) AS BIGINT) AS n FROM dim_user WHERE user_id % 7 <> 0 OR NOT is_current GROUP BY 1 HAVING count_if(is_current) <> 1")
def test_scd2_one_current(spark, d):
    return checks.one_current(dim_user(spark, d).where("user_id % 7 <> 0 or not is_current"), "user_id")


@query(f"WITH {TIMELINE} SELECT user_id, valid_from_ts, record_hash FROM (SELECT *, lag(record_hash) OVER (PARTITION BY user_id ORDER BY valid_from_ts) AS b FROM timeline) WHERE b = record_hash")
def test_scd2_changes_only(spark, d):
    return checks.only_changes(timeline(spark, d), "user_id").select("user_id", "valid_from_ts", "record_hash")


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 40 = 0)")
def test_relationships(spark, d):
    # The parent lacks some keys: their events are reported.
    return checks.relationships(read(spark, d, "events"), "user_id", read(spark, d, "orders").where("o_orderkey % 40 = 0"), "o_custkey").select("event_id", "user_id")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def test_nonnegative(spark, d):
    return checks.nonnegative(read(spark, d, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.01 OR l_discount > 0.09")
def test_between(spark, d):
    return checks.between(read(spark, d, "lineitem"), "l_discount", 0.01, 0.09).select("l_orderkey", "l_linenumber", "l_discount")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def test_accepted_values(spark, d):
    return checks.accepted_values(read(spark, d, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey")


@query(f"""{FACT}, f AS (SELECT count(*) AS n, CAST(count_if(is_completed) AS BIGINT) AS c, CAST(sum(watch_seconds) AS BIGINT) AS w FROM fact WHERE user_sk IS NOT NULL),
o AS (SELECT 'obt' AS layer, CAST(sum(playback_count) AS BIGINT) AS n2, CAST(sum(completed_session_count) AS BIGINT) AS c2, CAST(sum(total_watch_seconds) AS BIGINT) AS w2 FROM daily WHERE content_id <> 3
  UNION ALL SELECT 'mart', CAST(sum(playback_count) AS BIGINT), CAST(sum(completed_session_count) AS BIGINT), CAST(sum(total_watch_seconds) AS BIGINT) FROM scored)
SELECT layer, n, n2, c, c2, w, w2 FROM f, o WHERE n <> n2 OR c <> c2 OR w <> w2""")
def rollup_conservation(spark, d):
    rows = fact_rows(spark, d)
    # One content is missing from the daily table: that layer is reported.
    return checks.rollup_conservation(facts(spark, d).where("user_sk is not null"), marts.daily(rows).where("content_id <> 3"), marts.hourly(rows))


@query("SELECT md5(string_agg(concat_ws('|', o_orderkey, o_custkey), chr(10) ORDER BY o_totalprice DESC, o_orderkey)) AS checksum FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100)")
def ordered_checksum(spark, d):
    best = read(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    return profile.ordered_checksum(best, [-F.col("o_totalprice"), F.col("o_orderkey")], F.concat_ws("|", "o_orderkey", "o_custkey"))


@query("SELECT c_custkey, " + sql_hash("c_name", "c_nationkey", "c_mktsegment") + " AS h FROM customer")
def stable_hash_text(spark, d):
    return read(spark, d, "customer").select("c_custkey", stable_hash("c_name", "c_nationkey", "c_mktsegment").alias("h"))


@query("SELECT count(*) AS row_count, round(sum(value), 2) AS total FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def range_scan(spark, d):
    return read(spark, d, "events").where("ts >= timestamp_ntz'2024-01-05' and ts < timestamp_ntz'2024-01-12'").agg(F.count("*").alias("row_count"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT count(DISTINCT user_id) AS distinct_users, true AS within_bound FROM events")
def hll_profile(spark, d):
    # The estimate itself depends on the sketch; its error must lie within four standard deviations, 1.04 / sqrt(2^14) each.
    e = read(spark, d, "events")
    both = profile.distinct_estimate(e, "user_id").crossJoin(e.agg(F.countDistinct("user_id").alias("distinct_users")))
    return both.select("distinct_users", (F.abs(F.col("distinct_estimate") - F.col("distinct_users")) <= 4 * 1.04 / 128 * F.col("distinct_users") + 1).alias("within_bound"))


_RANGES = {"first_week": ("2024-01-01", "2024-01-07"), "mid_month": ("2024-01-10", "2024-01-20"), "one_day": ("2024-01-25", "2024-01-25"), "month": ("2024-01-01", "2024-01-31")}


@query(" UNION ALL ".join(f"SELECT '{n}' AS span, count(*) AS row_count, count(DISTINCT user_id) AS distinct_users, true AS within_bound FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{a}' AND DATE '{b}'" for n, (a, b) in _RANGES.items()))
def stored_sketches(spark, d):
    # One sketch per day is stored; any range of days is estimated from the sketches, the rows are read for comparison only.
    from tidewater.sources.tables import Store

    e = read(spark, d, "events").withColumn("day", F.to_date("ts"))
    store = Store(spark, _scratch(spark, "sketches"))
    store.replace("daily_sketches", profile.sketches(e, ["day"], ["user_id"]))
    out = None
    for name, (a, b) in _RANGES.items():
        inside = F.col("day").between(F.lit(a).cast("date"), F.lit(b).cast("date"))
        both = profile.merged(store.read("daily_sketches").where(inside), ["user_id"]).crossJoin(e.where(inside).agg(F.countDistinct("user_id").alias("distinct_users")))
        one = both.select(F.lit(name).alias("span"), "row_count", "distinct_users", (F.abs(F.col("user_id_estimate") - F.col("distinct_users")) <= 4 * 1.04 / 128 * F.col("distinct_users") + 1).alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"{FACT}, best AS (SELECT window_start, content_id, round(popularity_score, 6) AS popularity_score FROM scored ORDER BY scored.popularity_score DESC, window_start DESC, content_id LIMIT 100) SELECT *, true AS from_few_files FROM best")
def served_top100(spark, d):
    # From a table sorted by score with an index of its files: as many files are read as hold a hundred rows.
    from tidewater.sources import serving

    path, order = _scratch(spark, "served"), [F.desc("popularity_score"), F.desc("window_start"), F.col("content_id")]
    serving.serve(marts.hourly(fact_rows(spark, d)).select("window_start", "content_id", "popularity_score"), path, order, ["content_id"], file_rows=500)
    out = serving.best(spark, path, order, 100)
    return rounded(out, "popularity_score").withColumn("from_few_files", F.lit(len(out.inputFiles()) <= 2))


@query("SELECT p_partkey, p_name, p_size, true AS from_one_file FROM part WHERE p_partkey = 77")
def served_key(spark, d):
    from tidewater.sources import serving

    path = _scratch(spark, "served-key")
    serving.serve_by_key(read(spark, d, "part").select("p_partkey", "p_name", "p_size"), path, "p_partkey", file_rows=100)
    out = serving.lookup(spark, path, "p_partkey", 77)
    return out.withColumn("from_one_file", F.lit(len(out.inputFiles()) == 1))


@query("SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2 GROUP BY 1")
def federated_join(spark, d):
    # Nations (25 at any scale) live in another database that every executor reads; its filter runs there.
    from tidewater.sources import serving

    schema = serving.attach_packed(spark, "other", {"nation": read(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")})
    n = spark.table(f"{schema}.nation").where("n_regionkey = 2")
    return read(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("SELECT count(*) AS scanned_rows, count(DISTINCT month(o_orderdate)) AS files_read, count(*) AS aggregated_rows FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) BETWEEN 3 AND 5")
def analyzed_scan(spark, d):
    # What a pruned scan has read by its own figures.
    from tidewater.plans.analyze import analyzed, total

    path = _scratch(spark, "analyzed")
    o = read(spark, d, "orders").withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate"))
    o.repartition("year", "month").write.partitionBy("year", "month").parquet(path)
    found = analyzed(spark.read.parquet(path).where("year = 1995 and month between 3 and 5").groupBy("o_orderstatus").agg(F.sum("o_totalprice")))
    rows = total(found, "Scan parquet", "number of output rows")
    return spark.createDataFrame([(rows, total(found, "Scan parquet", "number of files read"), rows)], "scanned_rows bigint, files_read bigint, aggregated_rows bigint")


@query("SELECT 1 AS file_count, count(*) AS least_rows, count(*) AS most_rows, true AS have_bytes FROM lineitem")
def file_stats(spark, d):
    return profile.file_statistics(read(spark, d, "lineitem")).select(F.col("file_count").cast("int").alias("file_count"), "least_rows", "most_rows", (F.col("total_bytes") > 0).alias("have_bytes"))

"""Served tables, other catalogs, figures of finished plans, stored sketches."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest
from pyspark.sql import functions as F

from tidewater.operators import profile
from tidewater.plans import analyze
from tidewater.sources import serving


def order():
    return [F.desc("score"), F.col("key")]


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    r = random.Random(3)
    rows = [(k, float(r.randrange(300)), f"text {k}") for k in range(3000)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "key long, score double, text string").repartition(7)
    path = f"file://{tmp_path_factory.mktemp('served')}/t"
    serving.serve(df, path, order(), ["key"], file_rows=200)
    return sorted(rows, key=lambda x: (-x[1], x[0])), path


def test_best_rows_come_from_as_few_files_as_hold_them(spark, served):
    rows, path = served
    files = spark.read.parquet(f"{path}/data").inputFiles()
    assert len(files) > 10
    for n in (1, 50, 1000, 5000):
        found = serving.best(spark, path, order(), n)
        assert [tuple(r) for r in found.collect()] == rows[:n]
        assert len(found.inputFiles()) <= min(len(files), n // 100 + 1)


def test_one_file_is_read_for_a_key(spark, served, tmp_path):
    rows, _ = served
    path = f"file://{tmp_path}/k"
    serving.serve_by_key(spark.createDataFrame(rows, "key long, score double, text string"), path, "key", file_rows=200)
    assert len(spark.read.parquet(f"{path}/data").inputFiles()) > 10
    for key in (0, 17, 2999):
        found = serving.lookup(spark, path, "key", key)
        assert [r.text for r in found.collect()] == [f"text {key}"] and len(found.inputFiles()) == 1
        metrics = analyze.analyzed(found)
        assert analyze.total(metrics, "Scan parquet", "number of files read") == 1
    assert serving.lookup(spark, path, "key", -1).count() == 0


def test_files_are_as_small_as_their_rows(spark, served):
    """A bloom filter's size goes by the rows of a file."""
    rows, path = served
    sizes = [os.path.getsize(f.removeprefix("file://")) for f in spark.read.parquet(f"{path}/data").inputFiles()]
    assert len(sizes) > 10 and max(sizes) < 20_000


def test_an_empty_table_is_served(spark, tmp_path):
    df = spark.createDataFrame([], "key long, score double")
    serving.serve(df, f"file://{tmp_path}/e", order(), ["key"])
    assert serving.best(spark, f"file://{tmp_path}/e", order(), 5).count() == 0 and serving.lookup(spark, f"file://{tmp_path}/e", "key", 1).count() == 0


def test_two_catalogs_join_and_push_down(spark):
    one, two = serving.attach_embedded(spark, "first_db"), serving.attach_embedded(spark, "second_db")
    spark.range(100).select("id", (F.col("id") % 3).alias("kind")).writeTo(f"{one}.rows").create()
    spark.range(3).select(F.col("id").alias("kind"), F.concat(F.lit("kind "), "id").alias("name")).writeTo(f"{two}.kinds").create()
    got = spark.sql(f"SELECT name, count(*) AS n FROM {one}.rows JOIN {two}.kinds USING (kind) WHERE id < 30 GROUP BY name ORDER BY name").collect()
    assert [tuple(r) for r in got] == [("kind 0", 10), ("kind 1", 10), ("kind 2", 10)]
    plan = spark.sql(f"SELECT kind, count(*) FROM {one}.rows WHERE id < 30 GROUP BY kind")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [ID IS NOT NULL, ID < 30]".lower() in plan.lower() and "PushedAggregates: [COUNT(*)]" in plan
    spark.range(5).select((F.col("id") + 1000).alias("id"), F.lit(1).cast("long").alias("kind")).writeTo(f"{one}.rows").append()
    assert spark.table(f"{one}.rows").count() == 105


FEDERATED = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tidewater.plans import catalogue

spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false").getOrCreate()
for n in (30, 60):
    d = f"{sys.argv[1]}/{n}"
    spark.range(n).select((F.col("id") % 5).alias("c_nationkey"), F.lit(1.5).alias("c_acctbal")).write.parquet(f"{d}/customer.parquet")
    spark.range(6).select(F.col("id").alias("n_nationkey"), F.concat(F.lit(f"it's {n}, "), "id").alias("n_name"), F.when(F.col("id") != 4, 1 + F.col("id") % 2).alias("n_regionkey")).write.parquet(f"{d}/nation.parquet")
    print("ROWS", sorted(tuple(r) for r in catalogue.federated_join(spark, d).collect()))
spark.stop()
"""


def test_another_database_joins_on_a_cluster(tmp_path):
    """Executors are processes of their own; a second call in the session sees its own tables."""
    home, root = tmp_path / "home", str(Path(__file__).resolve().parent.parent)
    (home / "work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK", "SPARK"))} | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYTHONPATH": root, "PYSPARK_PYTHON": sys.executable}
    run = subprocess.run([sys.executable, "-c", FEDERATED, f"file://{tmp_path}"], capture_output=True, text=True, env=env, cwd=tmp_path, timeout=300)
    assert [x for x in run.stdout.splitlines() if x.startswith("ROWS")] == [f'ROWS [("it\'s {n}, 1", {n // 5}, {n // 5 * 1.5}), ("it\'s {n}, 3", {n // 5}, {n // 5 * 1.5})]' for n in (30, 60)], run.stderr[-3000:]


def test_figures_of_a_plan(spark, tmp_path):
    spark.range(1000).withColumn("k", F.col("id") % 10).repartition(4).write.parquet(f"{tmp_path}/t")
    metrics = analyze.analyzed(spark.read.parquet(f"{tmp_path}/t").groupBy("k").agg(F.sum("id")))
    assert analyze.total(metrics, "Scan parquet", "number of output rows") == 1000
    assert analyze.total(metrics, "Scan parquet", "number of files read") == 4
    assert {"size", "timing", "sum"} <= {r.kind for r in metrics.collect()}
    assert metrics.where("node like 'Exchange%' and metric = 'shuffle bytes written' and value > 0").count() == 1


@pytest.mark.parametrize(("text", "value"), [("1,234", 1234.0), ("0", 0.0), ("2.0 KiB", 2048.0), ("total (min, med, max (stageId: taskId))\n1.5 s (1 ms, 2 ms, 3 ms (stage 1.0: task 1))", 1500.0), ("x", None)])
def test_numbers_of_metrics(text, value):
    assert analyze.number(text) == value


def test_stored_sketches_estimate_unions(spark):
    df = spark.range(20_000).select((F.col("id") % 9).alias("day"), (F.col("id") % 5003).alias("user"), F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("few"))
    stored = profile.sketches(df, ["day"], ["user", "few"])
    for days in (range(1), range(4), range(9)):
        r = profile.merged(stored.where(F.col("day").isin(list(days))), ["user", "few"]).first()
        rows = df.where(F.col("day").isin(list(days)))
        exact = rows.agg(F.countDistinct("user").alias("user"), F.countDistinct("few").alias("few"), F.count("*").alias("n")).first()
        assert r["row_count"] == exact["n"] and r["few_estimate"] == exact["few"]
        assert abs(r["user_estimate"] - exact["user"]) <= 4 * 1.04 / 128 * exact["user"] + 1
    assert profile.merged(stored, ["user"], ["day"]).count() == 9

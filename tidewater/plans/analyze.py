"""What a query did: figures of each node of its plan, from Spark's store of finished executions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = "node_id bigint, node string, detail string, metric string, kind string, text string, value double"
_UNITS = {"B": 1.0, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40, "ms": 1.0, "s": 1e3, "m": 6e4, "min": 6e4, "h": 3.6e6}


def number(text: str) -> float | None:
    """The total of a metric's text: a count, bytes, or milliseconds."""
    total = text.split("\n")[-1].split(" (")[0].strip()
    m = re.fullmatch(r"([\d,]+(?:\.\d+)?)\s*(\w+)?", total)
    if not m or m[2] and m[2] not in _UNITS:
        return None
    return float(m[1].replace(",", "")) * _UNITS.get(m[2], 1.0)


def analyzed(df: DataFrame, name: str = "analyze") -> DataFrame:
    """Runs df to its end, keeping no row, and gives one row per node and metric of the plan as it was run: rows, bytes, files, spill, times.

    Times are in milliseconds, sizes in bytes.
    """
    spark = df.sparkSession
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    last = max((store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())), default=-1) if before else -1
    spark.sparkContext.setJobDescription(name)
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        spark.sparkContext.setJobDescription(None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    rows = []
    runs = store.executionsList()
    for run in sorted((runs.apply(i) for i in range(runs.size())), key=lambda r: r.executionId()):
        if run.executionId() <= last:
            continue
        values, nodes = store.executionMetrics(run.executionId()), store.planGraph(run.executionId()).allNodes()
        for i in range(nodes.size()):
            node = nodes.apply(i)
            metrics = node.metrics()
            for k in range(metrics.size()):
                m = metrics.apply(k)
                text = values.get(m.accumulatorId())
                if text.isDefined():
                    rows.append((node.id(), node.name(), node.desc()[:2000], m.name(), m.metricType(), text.get(), number(text.get())))
    return spark.createDataFrame(rows, METRICS)


def total(metrics: DataFrame, node: str, metric: str) -> int:
    """Sum of a metric over the nodes whose name begins so."""
    found = metrics.where(F.col("node").startswith(node) & (F.col("metric") == metric)).agg(F.sum("value").alias("n")).first()["n"]
    return int(found or 0)

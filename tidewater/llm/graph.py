"""Connected components by randomised contraction with DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written

#: Rounds that choose by the ids themselves, which settle stars at once; the later ones choose by a new hash of the ids each.
PLAIN_ROUNDS = 2


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of long ids: one row per id that has an edge, (id, component), the smallest id reachable.

    Each round maps every node to the lowest of itself and its neighbours and keeps the edges between what is left. By the order of
    the ids long chains would take as many rounds as they have links; by a random order a constant share of the nodes goes in
    every round, so the rounds are logarithmic. The rounds' maps are composed at the end, and the smallest id of each component
    then names it.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    maps: list[DataFrame] = []
    while not maps or not edges.isEmpty():
        turn = len(maps)
        rank = (lambda c: F.struct(F.lit(0).cast("long").alias("r"), F.col(c).alias("i"))) if turn < PLAIN_ROUNDS else (lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("r"), F.col(c).alias("i")))
        both = edges.select("a", rank("b").alias("to")).union(edges.select(F.col("b").alias("a"), rank("a").alias("to")))
        step = both.groupBy("a").agg(F.least(F.min("to"), rank("a"))["i"].alias("p")).withColumnRenamed("a", "id")
        maps.append(written(step, "cc-step"))
        pa, pb = (maps[-1].select(F.col("id").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        edges = edges.join(pa, "a").join(pb, "b").where("pa <> pb")
        edges = written(edges.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-edges")
    labels = maps[-1].select("id", F.col("p").alias("component"))
    for step in reversed(maps[:-1]):
        # A node that the next round doesn't know has no edge left: it is its component's last.
        labels = step.join(labels.withColumnRenamed("id", "p"), "p", "left").select("id", F.coalesce("component", "p").alias("component"))
    labels = written(labels, "cc-labels")
    if len(maps) > PLAIN_ROUNDS:
        least = labels.groupBy("component").agg(F.min("id").alias("least"))
        labels = written(labels.join(least, "component").select("id", F.col("least").alias("component")), "cc-labels")
    return labels

"""Balanced label propagation: shards of equal row counts that keep equal texts together.

Documents with equal text are linked. Labels are shards. A document's neighbours in a group of equal texts are alike, so the state
is one row per group and shard with the number of its members there; members are told apart only at the end, by rank. In each
round every group votes for the shard that holds most of its members and has room, its other members ask to move there, and
a prefix sum of the requests admits them up to the quota of linked documents. Rounds end when none moves. Documents without
equals have no neighbours; they fill the shards up, so that row counts differ by one at most (law ``rows``).

A group may hold a third of all rows: its members are salted by hash, ranks are made within the salt and shifted by the salts'
totals. Slots are ranked within buckets of a shard. Salts and buckets grow with the rows, so no task gets more of a group or
shard than BUCKET_ROWS, about. What comes to the driver is one row per shard.

Defined cases: a null text counts as an empty one (size 1, checksum 0); repeated rows are documents of their own; an empty table
gives no rows; with fewer rows than shards some shards stay empty; extra columns are not returned.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import written

SHARDS = 16
#: Rows of a group's salt or a shard's bucket, about; salts and buckets, at least.
BUCKET_ROWS = 1 << 16
SALTS, BUCKETS = 64, 512


def _at(values: list, index: Column, kind: str) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (index + 1).cast("int"))


def propagate(state: DataFrame, quota: int, shards: int) -> DataFrame:
    """Label propagation over (g1, g2, shard, n): moves members of a group towards the shard with most of them, within the quota.

    Ends when no move is admitted: each move raises its group's sum of squared parts, so this comes.
    """
    group = ["g1", "g2"]
    for turn in count():
        loads = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        free = [quota - loads.get(s, 0) for s in range(shards)]
        room = _at(free, F.col("shard"), "long") > 0
        vote = F.max(F.when(room, F.struct(F.col("n"), F.xxhash64(*group, "shard", F.lit(turn)), F.col("shard").alias("to"))))
        votes = state.groupBy(*group).agg(vote.alias("vote"), F.count("*").alias("parts")).where("parts > 1 and vote is not null")
        asks = state.join(votes.select(*group, F.col("vote.to").alias("to"), F.col("vote.n").alias("most")), group)
        # Towards the largest part that has room, never from a larger one: cut links never grow.
        asks = asks.where((F.col("shard") != F.col("to")) & (F.col("n") <= F.col("most")))
        asks = asks.withColumn("bucket", F.pmod(F.xxhash64(*group, F.lit(turn)), F.lit(BUCKETS)).cast("int"))
        asks = written(asks.select(*group, "shard", "to", "n", "bucket"), "shard-asks")
        totals = asks.groupBy("to", "bucket").agg(F.sum("n").alias("t"))
        before = F.sum("t").over(Window.partitionBy("to").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        totals = totals.select("to", "bucket", F.coalesce(before, F.lit(0)).alias("o"))
        inside = F.sum("n").over(Window.partitionBy("to", "bucket").orderBy(*group, "shard").rowsBetween(Window.unboundedPreceding, -1))
        moves = asks.withColumn("inside", F.coalesce(inside, F.lit(0))).join(totals, ["to", "bucket"])
        admitted = F.greatest(F.least(F.col("n"), _at(free, F.col("to"), "long") - F.col("o") - F.col("inside")), F.lit(0)).cast("long")
        moves = written(moves.select(*group, "shard", "to", admitted.alias("n")).where("n > 0"), "shard-moves")
        if moves.isEmpty():
            break
        out = moves.select(*group, "shard", (-F.col("n")).alias("n"))
        into = moves.select(*group, F.col("to").alias("shard"), "n")
        state = state.select(*group, "shard", "n").unionByName(out).unionByName(into).groupBy(*group, "shard").agg(F.sum("n").alias("n")).where("n > 0")
        state = written(state, "shard-state")
    return state


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null), group_rows (documents of equal text)."""
    group = ["g1", "g2"]
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # Two 64-bit figures tell texts apart: a hash, and length with checksum.
    thin = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.xxhash64(text).alias("g1"),
    ).withColumn("g2", F.xxhash64("size", "crc"))
    thin = written(thin.withColumn("shard0", F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(shards)).cast("int")), "shard-docs")
    rows = thin.count()
    n_salts, n_buckets = max(SALTS, rows // BUCKET_ROWS), max(BUCKETS, rows // BUCKET_ROWS // shards)
    thin = thin.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(n_salts)).cast("int"))
    parts = thin.groupBy(*group, "salt", "shard0").agg(F.count("*").alias("n"))
    totals = parts.groupBy(*group).agg(F.sum("n").alias("total")).where("total > 1")
    parts = written(parts.join(totals, group), "shard-parts")
    start = parts.groupBy(*group, F.col("shard0").alias("shard")).agg(F.sum("n").alias("n"))
    state = propagate(start, rows // shards, shards)
    # Members of a group by rank: each shard has an interval of ranks.
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    spans = state.withColumn("upto", upto).groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("upto", "shard"))).alias("spans"))
    salts = parts.groupBy(*group, "salt", "total").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*group).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    salts = salts.withColumn("o", F.coalesce(before, F.lit(0))).drop("n").join(spans, group)
    inside = F.row_number().over(Window.partitionBy(*group, "salt").orderBy("doc_id")) - 1
    ranked = thin.withColumn("inside", inside).join(salts, [*group, "salt"], "left")
    rank = F.col("o") + F.col("inside")
    placed = F.element_at(F.filter("spans", lambda x: x["upto"] > rank), 1)["shard"]
    ranked = ranked.withColumn("shard", F.when(F.col("total").isNull(), F.col("shard0")).otherwise(placed))
    # Linked documents first, then those that may be moved to even out the counts.
    bucket = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(n_buckets)).cast("int") + F.when(F.col("total").isNull(), F.lit(n_buckets)).otherwise(F.lit(0))
    ranked = written(ranked.select("doc_id", "size", "crc", "shard", F.coalesce("total", F.lit(1)).cast("long").alias("group_rows"), bucket.alias("bucket")), "shard-placed")
    counts = ranked.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    have = {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    quota = [rows // shards + (s < rows % shards) for s in range(shards)]
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("o"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "crc")) - 1
    final = ranked.withColumn("inside", inside).join(counts, ["shard", "bucket"]).withColumn("slot", (F.col("o") + F.col("inside")).cast("long"))
    # What is over a shard's quota goes, in order, to the shards below theirs.
    surplus, starts, gaps = 0, [], []
    for s in range(shards):
        starts.append(surplus)
        surplus += max(0, have.get(s, 0) - quota[s])
    taken = 0
    for s in range(shards):
        if (gap := quota[s] - have.get(s, 0)) > 0:
            gaps.append((taken, taken + gap, s, have.get(s, 0)))
            taken += gap
    over = F.col("slot") - _at(quota, F.col("shard"), "long")
    nth = _at(starts, F.col("shard"), "long") + over
    to, slot = F.col("shard"), F.col("slot")
    for low, high, s, base in gaps:
        inside_gap = (over >= 0) & (nth >= low) & (nth < high)
        to = F.when(inside_gap, F.lit(s)).otherwise(to)
        slot = F.when(inside_gap, nth - low + base).otherwise(slot)
    return final.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), to.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "group_rows")

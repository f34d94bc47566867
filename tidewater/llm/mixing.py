"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share the words of all documents; no target goes
over ``max_epochs`` times its source, what is cut off goes to the others by weight. The schedule: slot i of the mixture belongs
to the source in whose share of [0, 1) the i-th golden-ratio point falls; a slot's rank among its source's slots names the block it
takes, and all blocks have equally many words. So the points decide how much of a source is taken: its target, give or take the few
slots by which the points' counts differ from their shares. A source that has been taken ``max_epochs`` times passes its later
slots. Blocks: each source's documents stand in a shuffled (hashed) order, end to end and round again. What the mixture takes of a
document is its overlap with the blocks that its source's slots name, and its place is the slot of the block where it begins.

Everything is DataFrame code. Running sums are made in two steps (within a bucket of a source, then over the buckets' totals),
and buckets hold about equally many rows, so that a source with a third of all rows is spread over all tasks.

Defined cases: a null or empty text has size 0 and nothing is taken of it; a null source is a source of its own, after
all others; without any word all targets are 0; repeated rows are documents of their own; ties in the shuffled order are between
equal rows; extra columns pass through ``mix``.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, words, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
#: Words of a block, at most; blocks, at least (fewer only of so few words that each block is one word).
SLOT_WORDS, LEAST_SLOTS = 2048, 1 << 18
#: Rows of a bucket in running sums, about, and buckets of a source, at least; slots of a chunk in ranks.
BUCKET_ROWS, LEAST_BUCKETS, CHUNK = 1 << 16, 64, 1 << 14
SEED = 20


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From one row per source (no_source boolean, source, source_size): adds sid, weight, target and the share [low, high).

    The windows hold one row per source, never documents.
    """
    order = Window.orderBy("no_source", "source")
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    df = sizes.withColumn("sid", F.row_number().over(order) - 1)
    df = df.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int")))
    total = Window.partitionBy()
    by_ratio = Window.orderBy(cap / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({
        "_all": F.sum("source_size").over(total).cast("double"),
        "_ratio": cap / F.col("weight"),
        "_capped": F.coalesce(F.sum(cap).over(before), F.lit(0.0)),
        "_rest": F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        "_at": F.row_number().over(by_ratio),
    })
    # With the first k sources at their caps the others get level times weight; the first k that puts no other above its cap holds.
    df = df.withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_rest"))
    level = F.min_by(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")), F.when(F.col("_level") <= F.col("_ratio"), F.col("_at"))).over(total)
    df = df.withColumn("target", F.least(cap, F.col("weight") * F.coalesce(level, F.col("_ratio"))))
    high = F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.greatest(F.sum("target").over(total), F.lit(1e-9))
    df = df.withColumn("high", high)
    df = df.withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0.0)))
    # All but the last share are half-open; the last one takes what rounding leaves.
    df = df.withColumn("high", F.when(F.lead("sid").over(order).isNull(), F.lit(2.0)).otherwise(F.col("high")))
    words_of = F.least(F.round("target").cast("long"), max_epochs * F.col("source_size"))
    return df.withColumn("to_take", words_of).drop("_all", "_ratio", "_capped", "_rest", "_at", "_level")


def golden(i: Column) -> Column:
    """i times the golden ratio, modulo 1; i is split so that doubles keep 9 digits up to 2^46."""
    getcontext().prec = 60
    phi = (Decimal(5).sqrt() - 1) / 2
    high = float((phi * 2**20) % 1)
    u = F.floor(i / F.lit(2**20)).cast("double") * F.lit(high) + (i % F.lit(2**20)).cast("double") * F.lit(float(phi))
    return u - F.floor(u)


def schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """One row per slot that is used: slot, sid, rank (0, 1, ... within the source). sources: sid, low, high, blocks (how many the source has, round and round)."""
    cells = max(1, min(4096, n_slots // 64))
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1)).cast("long")
    spans = sources.where("blocks > 0").select("sid", "low", "high", "blocks", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cell"))
    slots = sources.sparkSession.range(n_slots).select(F.col("id").alias("slot"), golden(F.col("id") + 1).alias("u"))
    slots = slots.withColumn("cell", cell(F.col("u")))
    found = slots.join(spans, "cell").where("low <= u and u < high")
    found = found.select("slot", "sid", "blocks", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    local = found.withColumn("r", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    counts = found.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("sid", "chunk", F.coalesce(before, F.lit(0)).alias("o"))
    return local.join(offsets, ["sid", "chunk"]).withColumn("rank", F.col("o") + F.col("r")).where("rank < blocks").select("slot", "sid", "rank")


def _plan(docs: DataFrame, text: str, source: str, key: str, carry: list[Column], weights: tuple[float, ...], max_epochs: int) -> tuple[DataFrame, dict[str, str], DataFrame]:
    """One row per document: what is carried, and under the given names its size, its source's figures, where it begins and what is taken; and the slots."""
    names = {k: fresh(docs, f"_mix_{k}") for k in ("size", "none", "source", "order", "bucket", "inside", "offset", "start", "taken", "source_size", "target", "first", "block", "sid", "round")}
    n = {k: F.col(v) for k, v in names.items()}
    n_buckets = max(LEAST_BUCKETS, -(-docs.count() // BUCKET_ROWS))
    # Hashed with the text's length too: repeated doc_ids don't stand together.
    order = F.xxhash64(F.lit(SEED), F.col(key), F.octet_length(text))
    own = {names["size"]: F.size(words(F.col(text))).cast("long"), names["none"]: F.col(source).isNull(), names["source"]: F.coalesce(F.col(source), F.lit("")), names["order"]: order}
    bucket = F.pmod(n["order"], F.lit(n_buckets)).cast("int")
    group = [names["none"], names["source"], names["bucket"]]
    thin = docs.select(*[c.alias(k) for k, c in own.items()]).withColumn(names["bucket"], bucket)
    buckets = written(thin.groupBy(*group).agg(F.sum(n["size"]).alias("n")), "mix-buckets")
    sizes = buckets.groupBy(F.col(names["none"]).alias("no_source"), F.col(names["source"]).alias("source")).agg(F.sum("n").cast("long").alias("source_size"))
    sources = written(targets(sizes, weights, max_epochs), "mix-sources")
    all_words = int(sources.agg(F.sum("to_take")).first()[0] or 0)
    block_words = max(1, min(SLOT_WORDS, all_words // LEAST_SLOTS))
    sources = sources.withColumn("blocks", F.ceil(max_epochs * F.col("source_size") / block_words).cast("long"))
    slots = written(schedule(sources, max(1, -(-all_words // block_words))), "mix-slots")
    # The blocks that a source's slots name follow each other from the first one on.
    given = slots.groupBy("sid").agg(F.count("*").alias("slots"))
    figures = sources.join(given, "sid", "left").select(
        F.col("no_source").alias(names["none"]), F.col("source").alias(names["source"]), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"]),
        F.struct("sid", F.least(max_epochs * F.col("source_size"), F.coalesce("slots", F.lit(0)) * block_words).alias("words"), F.lit(block_words).cast("long").alias("each")).alias(names["block"]))
    before = F.sum("n").over(Window.partitionBy(names["none"], names["source"]).orderBy(names["bucket"]).rowsBetween(Window.unboundedPreceding, -1))
    offsets = buckets.withColumn(names["offset"], F.coalesce(before, F.lit(0)).cast("long")).join(figures, group[:2]).drop("n")
    df = docs.select(*carry, *[c.alias(k) for k, c in own.items()]).withColumn(names["bucket"], bucket)
    inside = F.sum(n["size"]).over(Window.partitionBy(*group).orderBy(names["order"], key, names["size"]).rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn(names["inside"], F.coalesce(inside, F.lit(0)).cast("long")).join(offsets, group).withColumn(names["start"], n["offset"] + n["inside"])
    start, b = n["start"], n["block"]
    whole = F.floor(b["words"] / F.greatest(n["source_size"], F.lit(1))).cast("long")
    part = b["words"] - whole * n["source_size"]
    taken = n["size"] * whole + F.greatest(F.least(start + n["size"], part) - start, F.lit(0))
    return df.withColumn(names["taken"], taken.cast("long")), names, slots


def _with_slot(df: DataFrame, slots: DataFrame, place: Column, n: dict[str, str]) -> DataFrame:
    """df with the slot of the block that holds a word of its source's order; null if no slot names that block."""
    b = F.col(n["block"])
    at = slots.select(F.col("sid").alias(n["sid"]), F.col("rank").alias(n["round"]), F.col("slot").alias(n["first"]))
    rank = F.when(place < b["words"], F.floor(place / b["each"]).cast("long"))
    return df.join(at, (b["sid"] == F.col(n["sid"])) & (rank == F.col(n["round"])), "left")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and first_slot, the slot where the mixture first shows it (null: never)."""
    df, n, slots = _plan(docs, "text", "source", "doc_id", [F.col("doc_id")], weights, max_epochs)
    df = _with_slot(df, slots, F.when(F.col(n["taken"]) > 0, F.col(n["start"])), n)
    return df.select("doc_id", F.col(n["size"]).alias("size"), F.col(n["source_size"]).alias("source_size"), F.col(n["target"]).alias("target"), F.col(n["taken"]).alias("taken"), F.col(n["first"]).alias("first_slot"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, slot: str | None = None) -> DataFrame:
    """The mixture itself: each document as often as its source's slots take it (rounded to whole documents), with its own columns.

    slot: name of one more column, the slot where a copy begins; sorted by it, the rows are the mixture in the schedule's order. A last copy that
    begins after its source's last block has the slot null.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    df, n, slots = _plan(docs, "text", "source", "doc_id", own, weights, max_epochs)
    copies = F.round(F.col(n["taken"]) / F.greatest(F.col(n["size"]), F.lit(1))).cast("int")
    df = df.withColumn(n["inside"], F.explode(F.filter(F.sequence(F.lit(0), F.lit(max_epochs)), lambda k: k < copies)))
    if slot is None:
        # Rows that carry whole texts are not shuffled once more for a figure that nothing reads.
        return df.select(*own)
    df = _with_slot(df, slots, F.col(n["start"]) + F.col(n["inside"]) * F.col(n["source_size"]), n)
    return df.select(*own, F.col(n["first"]).alias(slot))

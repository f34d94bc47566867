"""Near-duplicates by SetSketch registers.

A document is the set of its distinct word shingles. Register j of its sketch is the smallest of the exponential values that
the j-th hash gives to the set's elements, truncated to powers of the base: floor(1 - log_b(min)). Registers of a union are the
maxima of both sides' registers, so sketches merge; equal registers are likely for similar sets, so bands of registers are
LSH keys. Pairs that share a band are estimated from both sketches jointly, by the likelihood of the counts of larger, smaller
and equal registers given both set sizes; what is far below the threshold goes, the rest is verified on full sets.

Skew: equal sets are one class, with a number of its own, before anything is compared. Links and components are between classes, and
a row belongs to the class of its own text: rows that share a doc_id need not share anything else. Within a band's bucket all
members are compared with a few hubs only. Where members then still lie in several components, those outside the largest are
compared with all others, in blocks, by the triangle inequality over the distances to the hubs and by sketch. What may be similar
is verified block by block: each block gets the sets of its members once, not once per pair, and skips pairs of components that it
has joined already. So neither a large group of copies nor of near copies gives all its pairs, and no link between components is
left out.

Bands: BANDS x ROWS registers; a pair at similarity 0.8 shares no band with a probability below (1 - 0.8^5)^40 = 1.3e-7.

Defined cases: null and empty texts, and texts of white space, have no shingles, are their own component and are kept; with fewer
words than a shingle has, the whole sequence is the one shingle; rows without doc_id are never removed and link nothing; rows that
share a doc_id but not the text are documents of their own, each with its own links (a component is named by its smallest doc_id, so
two may have one name); among near-duplicates the smallest doc_id stays, of its rows the longest text (then the greatest digest), of
rows that share both one; an empty table gives no rows; extra columns pass through ``drop_near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, written
from tidewater.llm.graph import components
from tidewater.llm.tokens import grams, mixed, slices, words

ROWS, BANDS = 5, 40
REGISTERS = ROWS * BANDS
#: Base of the truncation, rate of the exponential values.
BASE, RATE = 1.02, 20.0
#: A pair is dropped by its estimate only when that lies further below the threshold: at similarity 0.80 with a probability of 3.2e-8
#: at most (equal sizes; 5.7 standard deviations), less than the bands lose. SLACK: for rounding, as estimates lie on a grid.
MARGIN, SLACK = 0.16, 1e-9
#: Hubs of a bucket; members that one task compares with how many others, about,
#: and the shingles of these, about.
HUBS = 3
BLOCK, PART = 64, 2048
BLOCK_SHINGLES, PART_SHINGLES = 1 << 20, 1 << 22
#: Low bits of a bucket's number that hold its band; rows of the table of bits that stands for a set of ids, 64 bits each.
BAND_BITS = 6
BIT_ROWS = 1 << 20

SKETCH = "doc_id long, text_key binary, n_chars long, n_shingles long, digest binary, sketch binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, as 64-bit hashes, the rows' one after the other and each sorted; and the number of each row's."""
    h, rows, _, _ = words(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(rows, minlength=n)
    g = grams(h, size)
    whole = rows[: len(g)] == rows[len(h) - len(g) :] if len(g) else np.zeros(0, bool)
    out, at = [g[whole]], [rows[: len(g)][whole]]
    for k in range(1, size):  # texts of fewer words: the whole sequence
        short = np.flatnonzero(count == k)
        if len(short):
            first = np.concatenate([[0], np.cumsum(count)[:-1]])[short]
            out.append(grams(h, k)[first] if k > 1 else mixed(h[first], 1))
            at.append(short)
    g, at = np.concatenate(out), np.concatenate(at)
    order = np.argsort(g)
    # A slice has 65,536 rows at most, and numpy sorts short numbers stably in linear time.
    order = order[np.argsort(at[order].astype(np.uint16), kind="stable")]
    g, at = g[order], at[order]
    if len(g):
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (at[1:] != at[:-1])])
        g, at = g[new], at[new]
    return g, np.bincount(at, minlength=n)


def digests(elements: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """128 bits for each run of elements that begins at starts, whatever its order."""
    both = np.stack([np.add.reduceat(mixed(elements, s), starts) for s in (17, 19)], 1).tobytes()
    return [both[16 * k : 16 * k + 16] for k in range(len(starts))]


def registers(elements: np.ndarray, starts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Sketches of the runs of elements that begin at starts: one row of uint16 registers each."""
    out = np.empty((len(starts), m), np.uint16)
    x = mixed(elements, 11)
    factors = mixed(np.arange(m, dtype=np.uint64), 13) | np.uint64(1)
    work = np.empty_like(x)
    for j in range(m):
        np.multiply(x, factors[j], out=work)
        work ^= work >> np.uint64(32)
        smallest = (np.minimum.reduceat(work, starts) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        value = -np.log1p(-np.maximum(smallest, 2.0**-54)) / RATE
        out[:, j] = np.clip(np.floor(1 - np.log(value) / math.log(BASE)) + 1000, 0, 65535)
    return out


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: doc_id, a digest of its text and its length, n_shingles, digest and registers of its set (null without shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column("text")):
                elements, count = shingle_sets(data, offsets, size)
                n, full = len(count), np.flatnonzero(count)
                starts = (np.cumsum(count) - count)[full]
                found, sketches = [None] * n, [None] * n
                if len(full):
                    own, some = digests(elements, starts), registers(elements, starts)
                    for k, i in enumerate(full.tolist()):
                        found[i], sketches[i] = own[k], some[k].tobytes()
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("doc_id", "text_key", "n_chars")), pa.array(count, pa.int64()), pa.array(found, pa.binary()), pa.array(sketches, pa.binary())], [c.split()[0] for c in SKETCH.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(docs).alias("text_key"), F.length("text").cast("long").alias("n_chars"), "text").mapInArrow(run, SKETCH)


def text_key(docs: DataFrame) -> Column:
    """A digest of the text: with the doc_id it names a row among all that differ from it."""
    return F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))


def jaccard(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of sets of sizes na, nb from rows of registers a, b.

    For the share u of a's own elements in the union, v of b's: a register is larger in a with probability p(u), in b with p(v),
    p(x) = -log_b(1 - x (b - 1) / b); else equal. Given the sizes, J alone is free: u = (1 - J r) / (1 + r) ... for r = nb / na.
    The likelihood of the three counts is evaluated over a grid of J.
    """
    m = a.shape[1]
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    grid = np.linspace(0.0, 1.0, 101)
    na, nb = na[:, None].astype(float), nb[:, None].astype(float)
    top = np.minimum(na, nb) / np.maximum(na, nb)
    j = np.minimum(grid[None, :], top)
    union = (na + nb) / (1 + j)
    u, v = np.clip(1 - nb / union, 0, 1), np.clip(1 - na / union, 0, 1)
    p = lambda x: np.clip(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-9, 1 - 1e-9)
    pu, pv = p(u), p(v)
    rest = np.clip(1 - pu - pv, 1e-9, 1)
    score = larger[:, None] * np.log(pu) + smaller[:, None] * np.log(pv) + (m - larger - smaller)[:, None] * np.log(rest)
    return j[np.arange(len(j)), score.argmax(1)]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint16).reshape(len(column), REGISTERS)


def estimated(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """(a, b, estimate) of the pairs (a, b) that may reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                e = jaccard(_matrix(part.column("sa")), _matrix(part.column("sb")), part.column("na").to_numpy(), part.column("nb").to_numpy())
                ok = np.flatnonzero(e >= threshold - MARGIN - SLACK)
                yield pa.RecordBatch.from_arrays([part.column("a").take(ok), part.column("b").take(ok), pa.array(e[ok])], ["a", "b", "estimate"])

    left = sketches.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long, estimate double")


def narrowed(df: DataFrame, key: str, ids: DataFrame, rest: bool = False) -> DataFrame:
    """The rows of df whose key is among ids (one column), and a few more; with ``rest`` all others, those without a key included.

    A table of bits over hashed ids tells most other keys apart.

    The table has BIT_ROWS rows at most, whatever the number of ids, so it may be broadcast, and df is not shuffled. With more ids
    than bits it lets all rows pass: it never decides what is compared, joins with the ids do.
    """
    word, bits = fresh(df, "_word"), fresh(df, "_bits")
    h = lambda c: F.xxhash64(F.lit(51), c.cast("long"))
    row = lambda c: F.pmod(h(c), F.lit(BIT_ROWS)).cast("int")
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h(c), 58).cast("int"))
    own = F.col(ids.columns[0])
    table = ids.select(row(own).alias(word), bit(own).alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    found = df.withColumn(word, F.when(F.col(key).isNotNull(), row(F.col(key)))).join(F.broadcast(table), word, "left" if rest else "inner")
    there = F.coalesce(F.col(bits), F.lit(0)).bitwiseAND(bit(F.col(key))) != 0
    return found.where(~there if rest else there).select(*[F.col(f"`{c}`") for c in df.columns])


def exact_sets(docs: DataFrame, nodes: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """(node, items): the set of each listed class (one column), as sorted 64-bit numbers, from texts of its smallest doc_id.

    Rows of that id with another text have another digest; those with the same digest have the same set.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column(1)):
                elements, count = shingle_sets(data, offsets, size)
                full, ends, packed = np.flatnonzero(count), np.cumsum(count), elements.tobytes()
                own = digests(elements, (ends - count)[full]) if len(full) else []
                sets = [packed[8 * (e - c) : 8 * e] for e, c in zip(ends[full].tolist(), count[full].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(count)).take(pa.array(full)), pa.array(count[full], pa.int64()), pa.array(own, pa.binary()), pa.array(sets, pa.binary())], ["doc_id", "n_shingles", "digest", "items"])

    key = ["doc_id", "n_shingles", "digest"]
    wanted = reps.join(nodes.distinct().toDF("node"), "node").select("node", *key)
    found = narrowed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", wanted.select("doc_id"))
    sets = found.mapInArrow(run, "doc_id long, n_shingles long, digest binary, items binary").groupBy(*key).agg(F.min("items").alias("items"))
    return sets.join(wanted, key).select("node", "items")


def unpack(b: bytes | pa.Buffer) -> np.ndarray:
    return np.frombuffer(b, np.uint64)


def shared_items(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]))
    return int((both[1:] == both[:-1]).sum())


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, far, linked) of the pairs: 1 - similarity of the full sets, and whether 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Sets are read where the batch holds them: a batch may be large.
            far, linked, last, x = [], [], None, None
            for a, s, t in zip(batch.column("a").to_pylist(), batch.column("ia"), batch.column("ib"), strict=True):
                if a != last:
                    last, x = a, unpack(s.as_buffer())
                y = unpack(t.as_buffer())
                common = shared_items(x, y)
                union = len(x) + len(y) - common
                far.append(1 - common / union)
                linked.append(100 * common >= percent * union)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far, pa.float64()), pa.array(linked, pa.bool_())], ["a", "b", "far", "linked"])

    left, right = sets.select(F.col("node").alias("a"), F.col("items").alias("ia")), sets.select(F.col("node").alias("b"), F.col("items").alias("ib"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ia", "ib").mapInArrow(run, "a long, b long, far double, linked boolean")


def _across(inside: DataFrame, labels: DataFrame, reps: DataFrame, tested: DataFrame, threshold: float) -> DataFrame:
    """What is to be verified in each block (bucket, block, share): its members (id, component), and for some the partners, likeliest first.

    A partner is a member of the same bucket in another component that may reach the threshold. The members of a bucket's largest
    component need no comparison with each other; the others, in blocks of BLOCK, are compared with all, who are dealt to parts of
    PART (fewer where sets are large). By sketch, and by the triangle inequality where distances of both to a hub were measured.
    """
    sized = narrowed(reps.select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), "sketch"), "id", inside.select("id"))
    named = inside.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")).join(sized.select("id", "n"), "id")
    counts = named.groupBy("bucket", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    main = counts.groupBy("bucket").agg(
        F.max_by("component", F.struct("rows", "component")).alias("main"), F.max_by("n", F.struct("rows", "component")).alias("top_n"), F.max("rows").alias("top"),
        F.count("*").alias("parts"), F.sum("rows").alias("members"), F.sum("n").alias("all_n"),
    ).where("parts > 1")
    blocks = F.greatest((F.col("members") - F.col("top")) / BLOCK, (F.col("all_n") - F.col("top_n")) / BLOCK_SHINGLES)
    shares = F.greatest(F.col("members") / PART, F.col("all_n") / PART_SHINGLES)
    main = main.select("bucket", "main", F.ceil(blocks).cast("int").alias("blocks"), F.ceil(shares).cast("int").alias("shares"))
    open_ = named.join(main, "bucket").withColumn("outside", F.col("component") != F.col("main"))
    for k in range(HUBS):
        hub = F.col(f"h{k}")
        known = tested.select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("far").alias("_far"))
        open_ = open_.join(known, (F.least("id", hub) == F.col("_a")) & (F.greatest("id", hub) == F.col("_b")), "left")
        open_ = open_.withColumn(f"d{k}", F.when(F.col("id") == hub, F.lit(0.0)).otherwise(F.coalesce("_far", F.lit(-1.0)))).drop("_a", "_b", "_far")
    open_ = open_.join(sized.select("id", "sketch"), "id")
    keep = ["bucket", "id", "component", "outside", "n", "sketch", *[f"{c}{k}" for c in "hd" for k in range(HUBS)]]
    # By hash, not by number: blocks and parts are about even, and no window over a bucket is needed.
    block = F.pmod(F.xxhash64(F.lit(21), "id"), F.col("blocks")).cast("int")
    share = F.pmod(F.xxhash64(F.lit(22), "id"), F.col("shares")).cast("int")
    rest = open_.where("outside").select(*keep, block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(True).alias("left"))
    everyone = open_.select(*keep, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), share.alias("share"), F.lit(False).alias("left"))
    limit = 1 - threshold

    def run(t: pa.Table) -> pa.Table:
        side, outside, ids, comp, n = (t.column(c).to_numpy() for c in ("left", "outside", "id", "component", "n"))
        d = np.stack([t.column(f"d{k}").to_numpy() for k in range(HUBS)])
        hubs = np.array([t.column(f"h{k}")[0].as_py() for k in range(HUBS)])
        x = _matrix(t.column("sketch").combine_chunks())
        place = [t.column(c)[0].as_py() for c in ("bucket", "block", "share")]
        band = place[0] & ((1 << BAND_BITS) - 1)
        earlier = x[:, : ROWS * band].reshape(len(x), band, ROWS)
        # Hubs have been compared with all members.
        left, right = np.flatnonzero(side & ~np.isin(ids, hubs)), np.flatnonzero(~side & ~np.isin(ids, hubs))
        partners, met = {}, {}
        for i in left:
            # Two outside the largest component meet twice; once is enough.
            ok = (comp[right] != comp[i]) & (~outside[right] | (ids[right] > ids[i]))
            ok &= np.minimum(n[i], n[right]) >= threshold * np.maximum(n[i], n[right])
            for k in range(HUBS):
                a, b = d[k, i], d[k, right]
                # -1: not measured. Such a pair may lie anywhere above its size ratio's distance, which bounds no pair better than that
                # pair's own size ratio does; so only two measured distances exclude.
                low = np.where((a >= 0) & (b >= 0), np.abs(a - b), 0.0)
                ok &= low <= limit + 1e-9
            r = right[ok]
            # A pair counts in the first band that it shares only.
            r = r[~(earlier[r] == earlier[i]).all(2).any(1)] if band and len(r) else r
            if len(r):
                e = jaccard(np.repeat(x[i : i + 1], len(r), 0), x[r], np.repeat(n[i : i + 1], len(r)), n[r])
                near = e >= threshold - MARGIN - SLACK
                r, e = r[near], e[near]
                if len(r):
                    partners[int(ids[i])] = ids[r[np.lexsort((ids[r], -e))]].tolist()
                    met |= {int(ids[i]): int(comp[i])} | dict(zip(ids[r].tolist(), comp[r].tolist(), strict=True))
        names = list(met)
        return pa.table([
            pa.array([place[0]] * len(names), pa.int64()), pa.array([place[1]] * len(names), pa.int32()), pa.array([place[2]] * len(names), pa.int32()),
            pa.array(names, pa.int64()), pa.array([met[i] for i in names], pa.int64()), pa.array([partners.get(i) for i in names], pa.list_(pa.int64()))], ["bucket", "block", "share", "id", "component", "partners"])

    kinds = "bucket long, block int, share int, id long, component long, partners array<long>"
    return rest.unionByName(everyone).groupBy("bucket", "block", "share").applyInArrow(run, kinds)


def _verified(waiting: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of each block of ``_across``, by full sets; of two components that are joined already, none more."""
    def run(t: pa.Table) -> pa.Table:
        ids, comp, items = t.column("id").to_pylist(), t.column("component").to_pylist(), t.column("items")
        at, parent, opened, out = {i: k for k, i in enumerate(ids)}, {}, {}, []

        def root(c: int) -> int:
            while parent.get(c, c) != c:
                parent[c] = c = parent.get(parent[c], parent[c])
            return c

        def items_of(k: int) -> np.ndarray:
            if k not in opened:
                opened[k] = unpack(items[k].as_buffer())
            return opened[k]

        for i, partners in enumerate(t.column("partners").to_pylist()):
            for j in partners or ():
                k = at[j]
                one, two = root(comp[i]), root(comp[k])
                if one == two:
                    continue
                x, y = items_of(i), items_of(k)
                common = shared_items(x, y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    parent[one] = two
                    out.append((min(ids[i], j), max(ids[i], j)))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    found = waiting.join(sets.withColumnRenamed("node", "id"), "id")
    return found.groupBy("bucket", "block", "share").applyInArrow(run, "a long, b long")


def links(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n_shingles and digest, classes with their node, digest and smallest doc_id, components of the nodes that have links)."""
    threshold = percent / 100
    thin = written(sketched(docs, size), "near-sketches")
    # A digest of 128 bits and the size stand for the set: equal sets are one class, and have equal sketches.
    classes = thin.where("doc_id is not null and n_shingles > 0").groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.min("sketch").alias("sketch"))
    # Written at once, so a class keeps its number.
    reps = written(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    band = lambda i: F.xxhash64(F.lit(i), F.substring("sketch", 2 * ROWS * i + 1, 2 * ROWS)).bitwiseAND(F.lit(-1 << BAND_BITS)).bitwiseOR(F.lit(i))
    bands = reps.select(F.col("node").alias("id"), F.explode(F.array(*map(band, range(BANDS)))).alias("bucket"))
    # Most buckets hold one document: these go by a count, before anything wider is made of them.
    several = bands.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(bands.join(several, "bucket"), "near-shared")
    # Hubs by hash orders that hold for all bands: the same few documents are hubs of most of a group's buckets.
    hubs = shared.groupBy("bucket").agg(*[F.min_by("id", F.struct(F.xxhash64(F.lit(30 + k), "id"), "id")).alias(f"h{k}") for k in range(HUBS)])
    inside = written(shared.join(hubs, "bucket"), "near-buckets")
    pairs = inside.select("id", F.explode(F.array(*[f"h{k}" for k in range(HUBS)])).alias("hub")).where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    few = narrowed(reps.select("node", "n_shingles", "sketch"), "node", inside.select("id"))
    waiting = written(estimated(pairs, few, threshold).select("a", "b"), "near-close")
    # Written, not only shuffled: the joins then read plain rows on both sides, and Spark splits the partitions of hot hubs.
    sets = written(exact_sets(docs, waiting.select("a").union(waiting.select("b")), reps, size), "near-sets")
    tested = written(compared(waiting, sets, percent), "near-compared")
    edges = tested.where("linked").select("a", "b")
    labels = components(edges)
    waiting = written(_across(inside.where("members > 2"), labels, reps, tested, threshold), "near-waiting")
    if not waiting.isEmpty():
        found = written(_verified(waiting, exact_sets(docs, waiting.select("id"), reps, size), percent), "near-across")
        # The former components stand for their links.
        labels = components(found.union(labels.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    return thin.drop("sketch"), reps.drop("sketch"), labels


def grouped(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, text_key, n_chars, n_shingles, group (of near-duplicates; null: in none), component_id, kept."""
    thin, reps, labels = links(docs, size, percent)
    nodes = reps.join(labels.withColumnRenamed("id", "node"), "node", "left").select("digest", "n_shingles", F.col("doc_id").alias("rep"), F.coalesce("component", "node").alias("group"))
    # Components are named by their smallest doc_id; of most, that is the only one of a single class.
    named = nodes.groupBy("group").agg(F.min("rep").alias("least"))
    found = thin.join(nodes.join(named, "group"), ["digest", "n_shingles"], "left")
    own = F.col("doc_id").isNotNull()
    component = F.when(own, F.coalesce("least", "doc_id"))
    return found.select("doc_id", "text_key", "n_chars", "n_shingles", F.when(own, F.col("group")).alias("group"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return grouped(docs, size, percent).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with its own columns; documents without doc_id or shingles all stay."""
    found = written(grouped(docs, size, percent), "near-found")
    # Of the rows that carry a group's smallest doc_id one text stays, and of that one row.
    texts = found.where(F.col("kept") & F.col("group").isNotNull()).groupBy("group", "doc_id", "text_key").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("rows"))
    best = texts.groupBy("group").agg(F.max(F.struct("n_chars", "text_key")).alias("best"))
    texts = texts.join(best, "group").select("doc_id", "text_key", "rows", (F.col("best.text_key") == F.col("text_key")).alias("stays"))
    several = written(texts.where("rows > 1 or not stays"), "near-several")
    gone = found.where("not kept").select("doc_id", "text_key").union(several.where("not stays").select("doc_id", "text_key")).distinct()
    left = _looked_up(docs, gone, stay=False)
    again = several.where("stays").select("doc_id", "text_key")
    if again.isEmpty():
        return left
    key = fresh(docs, "_text_key")
    once = _looked_up(left, again, stay=True).withColumn(key, text_key(left)).dropDuplicates(["doc_id", key]).drop(key)
    return _looked_up(left, again, stay=False).unionByName(once)


def _looked_up(docs: DataFrame, keys: DataFrame, stay: bool) -> DataFrame:
    """The rows of docs that are (``stay``) or are not among the keys (doc_id, text_key).

    Most rows are surely not: they, and their texts, are not shuffled for the few that are looked up. By a left join, as an anti-join
    would be pushed below the look-up and shuffle all rows.
    """
    flag, key = fresh(docs, "_found"), fresh(docs, "_text_key")
    own = [F.col(f"`{c}`") for c in docs.columns]
    maybe = narrowed(docs, "doc_id", keys.select("doc_id")).withColumn(key, text_key(docs))
    there = keys.select(F.col("doc_id").alias(f"{flag}id"), F.col("text_key").alias(f"{flag}key"), F.lit(True).alias(flag))
    joined = maybe.join(there, (maybe["doc_id"] == there[f"{flag}id"]) & (maybe[key] == there[f"{flag}key"]), "left")
    if stay:
        return joined.where(F.col(flag)).select(*own)
    return narrowed(docs, "doc_id", keys.select("doc_id"), rest=True).unionByName(joined.where(F.col(flag).isNull()).select(*own))

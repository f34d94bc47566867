"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

P(w | h) = l2(b) c(h, w) / c(h) + l1(b) c(w) / N + l0(b) / (V + 1), where b is the bucket of the context's count c(h), by
octaves. The weights of each bucket are learned by expectation-maximisation on held-out counts: a tenth of the training
documents is deleted from the counts and predicted from the rest. The final estimates use the counts of all training documents.

Nothing of the corpus's size is broadcast or collected. Documents are dealt to batches of about BATCH_BYTES. Each batch asks once
for every n-gram it holds, giving its own counts with the question; the counts are summed and sent back; the batch then has all
counts of its tokens. Questions go up a butterfly of nodes: a node of level k holds one of f^k ranges of the n-grams' hashes for
f^k batches, merges the questions of at most f nodes below it and splits them into f ranges for the level above; the last level
holds all batches, answers, and answers go down the same way. So a frequent word costs one entry per batch, each node holds about
as much as a batch, and n batches exchange f n log n rows, not n^2. f is at most FAN. Questions and answers are delta-coded and
compressed. To the driver comes a histogram of the held-out tokens' counts over quarter octaves, whose size the logarithms of the
counts bound.

Defined cases: a null text is an empty one, whose one token is the end; a null doc_id counts as the empty string in the split; an
empty table gives no rows; without any training token probabilities are uniform; repeated rows count and are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written
from tidewater.llm.tokens import grams, mixed, slices, words

BATCH_BYTES = 8 << 20
#: One in so many training documents is deleted from the counts to learn the weights.
DELETED = 10
STEPS_PER_OCTAVE = 4
EM_ROUNDS = 60
#: Most ranges that a node splits its questions into.
FAN = 512

START, END = (int(x) for x in mixed(np.arange(2, dtype=np.uint64), 101))


def _pack(numbers: np.ndarray) -> bytes:
    """uint64 array, byte planes compressed."""
    raw = np.ascontiguousarray(numbers.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    raw = pa.Codec("zstd", 1).decompress(blob[8:], 8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.uint64).ravel()


def _tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and the number of each text's."""
    found, counts = [], []
    for _, data, offsets in slices(texts):
        h, rows, _, _ = words(data, offsets)
        n = np.bincount(rows, minlength=len(offsets) - 1)
        found.append(np.insert(h, np.cumsum(n), np.uint64(END)))
        counts.append(n + 1)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), np.concatenate(counts) if counts else np.zeros(0, np.int64)


def _keys(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each token's word (even) and of the pair with its context (odd)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(counts) - counts] = np.uint64(START)
    pair = np.empty(2 * len(tokens), np.uint64)
    pair[::2], pair[1::2] = before, tokens
    one = np.uint64(1)
    return tokens & ~one, grams(pair, 2)[::2] | one


ASKED = pa.schema([("span", pa.int64()), ("crowd", pa.int64()), ("child", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWERED = pa.schema([("span", pa.int64()), ("crowd", pa.int64()), ("part", pa.int64()), ("known", pa.int64()), ("counts", pa.binary())])
COUNTED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64()), ("counts", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def levels(batches: int) -> tuple[int, int]:
    """Levels of the butterfly over so many batches, and the fan of each: the least fan of at most FAN over the fewest levels."""
    depth = 1
    while FAN**depth < batches:
        depth += 1
    fan = 1
    while fan**depth < batches:
        fan += 1
    return depth, fan


def _split(keys: np.ndarray, totals: np.ndarray, span: int, crowd: int, child: int, level: int, fan: int) -> pa.Table:
    """Questions for the nodes of a level: sorted keys of the range ``span`` of the level below and their counts, by the range of this level."""
    # 2^32 values of the keys' upper halves are dealt to fan^level ranges.
    part = ((keys >> np.uint64(32)) * np.uint64(fan**level)) >> np.uint64(32)
    ranges, starts = np.unique(part, return_index=True)
    ends = np.append(starts[1:], len(keys))
    cut = list(zip(starts.tolist(), ends.tolist(), strict=True))
    n = len(cut)
    columns = [ranges.astype(np.int64), np.full(n, crowd, np.int64), np.full(n, child, np.int64)]
    packed = [_pack(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in cut], [_pack(totals[:, a:b].ravel()) for a, b in cut]
    return pa.table([*columns, *(pa.array(x, pa.binary()) for x in packed)], ASKED)


def _merge(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int], list[int]]:
    """Distinct keys of a node's questions, their summed counts, the place of each asked key among them, the children and where each one's questions end."""
    asked = [np.cumsum(_unpack(b), dtype=np.uint64) for b in t.column("keys").to_pylist()]
    given = np.concatenate([_unpack(b).reshape(2, -1) for b in t.column("counts").to_pylist()], axis=1)
    keys, at = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.stack([np.bincount(at, g, len(keys)) for g in given]).astype(np.uint64)
    return keys, totals, at, t.column("child").to_pylist(), np.cumsum([len(a) for a in asked]).tolist()


def _replies(t: pa.Table, totals: np.ndarray, at: np.ndarray, children: list[int], ends: list[int], known: int, fan: int) -> pa.Table:
    """The counts that each child of a node asked for; the number of known words goes with the first one."""
    span = t.column("span")[0].as_py()
    n = len(children)
    counts = [_pack(totals[:, at[a:b]].ravel()) for a, b in zip([0, *ends], ends, strict=False)]
    return pa.table([[span // fan] * n, children, [span] * n, [known] + [0] * (n - 1), pa.array(counts, pa.binary())], ANSWERED)


def _answers(t: pa.Table) -> tuple[np.ndarray, int]:
    """Counts of a node's distinct keys in their order, from the answers of its ranges, and the sum of the known words that came with them."""
    got = sorted(zip(t.column("part").to_pylist(), t.column("counts").to_pylist(), strict=True), key=lambda x: x[0])
    return np.concatenate([_unpack(b).reshape(2, -1) for _, b in got], axis=1), sum(t.column("known").to_pylist())


def counted(docs: DataFrame, batches: int) -> DataFrame:
    """docs: (doc_id, text, held_out, deleted). Rows of kind 0: a document and its tokens' counts c(w), c(h, w); 1: a batch's histogram of deleted tokens; 2: a batch's share of the number of words."""
    depth, fan = levels(batches)
    docs = docs.withColumn("crowd", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))).withColumn("span", F.lit(0).cast("long"))

    def ask(t: pa.Table) -> pa.Table:
        tokens, counts = _tokens(t.column("text"))
        uni, bi = _keys(tokens, counts)
        train = np.repeat(~t.column("held_out").to_numpy(), counts)
        deleted = np.repeat(t.column("deleted").to_numpy(), counts)
        keys, at = np.unique(np.concatenate([uni, bi]), return_inverse=True)
        totals = np.stack([np.bincount(at, np.concatenate([x, x]), len(keys)) for x in (train, deleted)]).astype(np.uint64)
        batch = t.column("crowd")[0].as_py()
        return _split(keys, totals, 0, batch // fan, batch, 1, fan)

    def forward(level: int):
        def run(t: pa.Table) -> pa.Table:
            keys, totals, _, _, _ = _merge(t)
            span, crowd = t.column("span")[0].as_py(), t.column("crowd")[0].as_py()
            return _split(keys, totals, span, crowd // fan, crowd, level + 1, fan)

        return run

    def answer(t: pa.Table) -> pa.Table:
        keys, totals, at, children, ends = _merge(t)
        known = int(((keys & np.uint64(1) == 0) & (totals[0] > 0)).sum())
        return _replies(t, totals, at, children, ends, known, fan)

    def back(t: pa.Table, answers: pa.Table) -> pa.Table:
        _, _, at, children, ends = _merge(t)
        totals, known = _answers(answers)
        return _replies(t, totals, at, children, ends, known, fan)

    def gather(t: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, counts = _tokens(t.column("text"))
        uni, bi = _keys(tokens, counts)
        at = np.unique(np.concatenate([uni, bi]), return_inverse=True)[1]
        totals, known = _answers(answers)
        n = len(tokens)
        w, hw = totals[0][at[:n]], totals[0][at[n:]]
        ends = np.cumsum(counts)
        kinds, ids, held, number, blobs = [2], [None], [None], [known], [None]
        for e, c in zip(ends.tolist(), counts.tolist(), strict=True):
            kinds.append(0), number.append(c), blobs.append(_pack(np.concatenate([w[e - c : e], hw[e - c : e]])))
        ids += t.column("doc_id").to_pylist()
        held += t.column("held_out").to_pylist()
        deleted = np.repeat(t.column("deleted").to_numpy(), counts)
        if deleted.any():
            rest = totals[0] - totals[1]
            w, hw = rest[at[:n]], rest[at[n:]]
            h = np.empty_like(w)
            h[1:] = w[:-1]
            first = np.zeros(n, bool)
            first[ends - counts] = True
            step = lambda c: np.round(STEPS_PER_OCTAVE * np.log2(c.astype(float) + 1)).astype(np.int64)
            bins = np.where(first, 1023, step(h)) << 20 | step(hw) << 10 | step(w)
            bins, times = np.unique(bins[deleted], return_counts=True)
            kinds.append(1), ids.append(None), held.append(None), number.append(0)
            blobs.append(_pack(np.concatenate([bins.astype(np.uint64), times.astype(np.uint64)])))
        return pa.table({"kind": kinds, "doc_id": ids, "held_out": held, "n": number, "counts": blobs}, COUNTED)

    node = ["span", "crowd"]
    up = [docs.groupBy(*node).applyInArrow(ask, _ddl(ASKED))]
    for level in range(1, depth):
        up.append(up[-1].groupBy(*node).applyInArrow(forward(level), _ddl(ASKED)))
    down = up[-1].groupBy(*node).applyInArrow(answer, _ddl(ANSWERED))
    for level in range(depth - 1, 0, -1):
        down = up[level - 1].groupBy(*node).cogroup(down.groupBy(*node)).applyInArrow(back, _ddl(ANSWERED))
    return docs.groupBy(*node).cogroup(down.groupBy(*node)).applyInArrow(gather, _ddl(COUNTED))


def _bucket(h: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 unseen, then one for each octave."""
    return np.where(h > 0, np.floor(np.log2(np.maximum(h, 1))) + 1, 0).astype(np.int64)


def weights(bins: list[tuple[int, int]], tokens: int, starts: int, words_known: int) -> np.ndarray:
    """l2, l1, l0 by bucket from the histogram of deleted tokens; tokens, starts: those not deleted."""
    out = np.tile([0.4, 0.4, 0.2], (66, 1))
    out[0] = 0, 0.8, 0.2
    if bins:
        key, times = np.array([b[0] for b in bins], np.int64), np.array([b[1] for b in bins], float)
        value = lambda s: 2 ** (s / STEPS_PER_OCTAVE) - 1
        h = np.where(key >> 20 == 1023, starts, value(key >> 20))
        f2 = np.where(h > 0, np.minimum(value(key >> 10 & 1023) / np.maximum(h, 1), 1), 0)
        f1, f0 = value(key & 1023) / max(tokens, 1), np.full(len(key), 1 / (words_known + 1))
        b, f = _bucket(np.round(h)), np.stack([f2, f1, f0], 1)
        for _ in range(EM_ROUNDS):
            share = out[b] * f
            share *= (times / share.sum(1))[:, None]
            for k in range(3):
                total = np.bincount(b, share[:, k], len(out))
                seen = np.bincount(b, times, len(out))
                out[:, k] = np.where(seen > 0, total / np.maximum(seen, 1e-9), out[:, k])
        # Every token keeps a probability.
        out = np.maximum(out, [0, 1e-6, 1e-6])
        out[0, 0] = 0
        out /= out.sum(1, keepdims=True)
    return out


def _modulo(key: Column, n: int) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def scored(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held = _modulo(F.col("doc_id"), 5) == 1
    deleted = ~held & (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(DELETED)) == 0)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"), deleted.alias("deleted"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = written(counted(docs, max(1, -(-size // BATCH_BYTES))), "lm-counts")
    ids = docs.agg(F.sum((~F.col("held_out")).cast("long")), F.sum(F.col("deleted").cast("long"))).first()
    n_docs, n_deleted = ids[0] or 0, ids[1] or 0
    figures = rows.agg(F.sum(F.when((F.col("kind") == 0) & ~F.col("held_out"), F.col("n"))), F.sum(F.when(F.col("kind") == 2, F.col("n")))).first()
    n, v = figures[0] or 0, figures[1] or 0

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                key, times = _unpack(blob).reshape(2, -1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(times)], ["bin", "times"])

    histogram = rows.where("kind = 1").select("counts").mapInArrow(bins, "bin long, times long").groupBy("bin").agg(F.sum("times").alias("times"))
    found = sorted((r["bin"], r["times"]) for r in histogram.collect())
    kept = n - sum(t for _, t in found)
    learned = weights(found, kept, n_docs - n_deleted, v)
    if not n:
        learned[:] = 0, 0, 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, base, full = [], [], []
            for blob in batch.column("counts").to_pylist():
                w, hw = _unpack(blob).reshape(2, -1).astype(float)
                h = np.concatenate([[n_docs], w[:-1]])
                known.append(int((w > 0).sum()))
                base.append(float(np.log10((w + 0.5) / (n + 0.5 * (v + 1))).sum()))
                mix = learned[_bucket(h)]
                p = mix[:, 0] * hw / np.maximum(h, 1) + mix[:, 1] * w / max(n, 1) + mix[:, 2] / (v + 1)
                full.append(float(np.log10(p).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), batch.column("n"), pa.array(known, pa.int64()), pa.array([n] * len(batch), pa.int64()), pa.array(base, pa.float64()), pa.array(full, pa.float64())], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.where("kind = 0").select("doc_id", "held_out", "n", "counts").mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

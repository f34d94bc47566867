"""Toxic spans by a linear-chain conditional random field.

Labels are given for documents. Tokens are labelled from them: a token of a toxic training document is toxic if one of its features
(the word, a prefix or a suffix of it) occurs in enough training documents and nearly only in toxic ones. The chain has two states;
its emission features are the word, prefixes, suffixes and both neighbours, its weights maximise the regularised conditional
likelihood (forward-backward gradients, Adam). Forward-backward marginals of a text's tokens give toxic spans; the sum and the
maximum of the marginals give the document's score by logistic regression.

The training sample is bounded by SAMPLE documents and SAMPLE_BYTES of text of each label; one task trains on it, so neither texts nor
features come to the driver. Scoring maps over all documents and whole texts. Chains are
cut into windows of WINDOW tokens with OVERLAP more tokens on each side, whose marginals are not used: the field forgets its start
geometrically, so this changes marginals by less than a float's rounding.

Defined cases: null and empty texts have no token and get the score of zero marginals; without labels of both kinds, without tokens in the
sample or without a feature that it repeats, no field can be learned and every score is the share of toxic labels (0 without any);
labels of unknown documents are not used; of a document that stands or is labelled several times the sample has one row for each label; a
text that would take its label's sample over SAMPLE_BYTES is passed over; repeated rows are scored one by one; columns besides doc_id and text are never read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written
from tidewater.llm.tokens import _BASE, _INVERSE, _powers, mixed, slices

#: At most so many training documents with label 0 and 1, and bytes of text of each.
SAMPLE, SAMPLE_BYTES = (4000, 2000), 48 << 20
#: Chains (windows of 24 tokens and 4 more on each side) with and without toxic tokens that the weights are learned from, about.
CHAINS = 4000
ROW_BITS = 13
PREFIXES, SUFFIXES = (4, 5, 6, 7, 8), (4, 5, 6)
WINDOW, OVERLAP = 224, 32
#: Documents that a token feature must occur in, and the share of toxic ones among them, to label tokens.
SUPPORT, PURITY = 6, 0.85
TABLE_BITS = 20
SPAN = 0.5
CUT = 0.3


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features (tokens x kinds, uint64; 0 where the token is too short), row, start and end of each run of letters; A-Z count as a-z."""
    n = len(data)
    letter = np.zeros(256, bool)
    letter[97:123] = letter[65:91] = letter[128:] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = letter[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | edge[:-1]))
    end = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | edge[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(np.arange(256, dtype=np.uint64), 7)[lower][data] * _powers(n, _BASE)[:n], out=sums[1:])
    inverse = _powers(n, _INVERSE)

    def part(a: np.ndarray, b: np.ndarray, kind: int, ok: np.ndarray | None) -> np.ndarray:
        h = mixed((sums[b] - sums[a]) * inverse[a], 40 + kind)
        return h if ok is None else np.where(ok, h, np.uint64(0))

    size = end - start
    found = [part(start, end, 0, None)]
    for i, k in enumerate(PREFIXES):
        found.append(part(start, np.minimum(start + k, end), 1 + i, size > k))
    for i, k in enumerate(SUFFIXES):
        found.append(part(np.maximum(end - k, start), end, 20 + i, size > k))
    rows = np.searchsorted(offsets, start, "right") - 1
    return np.stack(found, 1) if len(start) else np.zeros((0, 1 + len(PREFIXES) + len(SUFFIXES)), np.uint64), rows, start, end


def around(features: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """features with the words before and after as two more kinds."""
    word = features[:, 0]
    before, after = np.zeros_like(word), np.zeros_like(word)
    if len(word) > 1:
        same = rows[1:] == rows[:-1]
        before[1:] = np.where(same, mixed(word[:-1], 61), np.uint64(0))
        after[:-1] = np.where(same, mixed(word[1:], 62), np.uint64(0))
    return np.concatenate([features, before[:, None], after[:, None]], 1)


class Weights:
    """Feature hashes and weights, with a table of bits that tells most other hashes at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros(len(features))
        if not len(self.keys):
            return out
        if not hasattr(self, "bits"):
            self.bits = np.zeros(1 << TABLE_BITS, bool)
            self.bits[self.keys >> np.uint64(64 - TABLE_BITS)] = True
        for k in range(features.shape[1]):
            f = features[:, k]
            maybe = np.flatnonzero(self.bits[f >> np.uint64(64 - TABLE_BITS)])
            at = np.minimum(np.searchsorted(self.keys, f[maybe]), len(self.keys) - 1)
            out[maybe] += np.where(self.keys[at] == f[maybe], self.values[at], 0.0)
        return out

    def __getstate__(self):
        return {"keys": self.keys, "values": self.values}


def forward_backward(e: np.ndarray, real: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 (chains x steps) and expected moves (4, summed) for emission scores e of state 1; move: 2 x 2 scores."""
    chains, steps = e.shape
    m = np.exp(move - move.max())
    g = np.exp(np.clip(e, -30, 30))
    alpha, beta = np.empty((steps, chains, 2)), np.empty((steps, chains, 2))
    a = np.stack([np.ones(chains), g[:, 0]], 1)
    alpha[0] = a / a.sum(1, keepdims=True)
    for t in range(1, steps):
        a = alpha[t - 1] @ m
        a[:, 1] *= g[:, t]
        a = np.where(real[:, t, None], a, alpha[t - 1])
        alpha[t] = a / a.sum(1, keepdims=True)
    beta[-1] = 0.5
    for t in range(steps - 2, -1, -1):
        b = beta[t + 1].copy()
        b[:, 1] *= g[:, t + 1]
        b = np.where(real[:, t + 1, None], b @ m.T, beta[t + 1])
        beta[t] = b / b.sum(1, keepdims=True)
    both = alpha * beta
    marginal = (both[:, :, 1] / both.sum(2)).T
    right = beta[1:].copy()
    right[:, :, 1] *= g[:, 1:].T
    pair = alpha[:-1, :, :, None] * m[None, None] * right[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    return marginal * real, (pair * real[:, 1:].T[:, :, None, None]).sum((0, 1))


def windows(n_by_row: np.ndarray, size: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token index (chains x steps), which are real, and which count (each token once), for chains of the given lengths end to end."""
    starts = np.cumsum(n_by_row) - n_by_row
    pieces = -(-n_by_row // size)
    row = np.repeat(np.arange(len(n_by_row)), pieces)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    own = nth * size
    at = own[:, None] - overlap + np.arange(size + 2 * overlap)[None, :]
    real = (at >= 0) & (at < n_by_row[row][:, None])
    counts = real & (at >= own[:, None]) & (at < own[:, None] + size)
    return np.where(real, at + starts[row][:, None], 0), real, counts


def marginals(e: np.ndarray, n_by_row: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Marginal of state 1 for each token of the chains."""
    out = np.zeros(len(e))
    at, real, counts = windows(n_by_row, WINDOW, OVERLAP)
    if len(at):
        # Padding stands at the start too: it must not act.
        x = np.where(real, e[at], 0.0)
        m, _ = _padded(x, real, move)
        out[at[counts]] = m[counts]
    return out


def _padded(x: np.ndarray, real: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """forward_backward of chains whose real steps may begin late: rolled to the front and back."""
    first = real.argmax(1)
    steps = np.arange(x.shape[1])
    to = (steps[None, :] + first[:, None]) % x.shape[1]
    m, pairs = forward_backward(np.take_along_axis(x, to, 1), np.take_along_axis(real, to, 1), move)
    back = (steps[None, :] - first[:, None]) % x.shape[1]
    return np.take_along_axis(m, back, 1), pairs


def _summary(m: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Per text: 1, log(1 + sum of marginals), largest marginal, log(1 + sum per thousand tokens)."""
    total = np.bincount(rows, m, n)
    top = np.zeros(n)
    np.maximum.at(top, rows[m > 1e-3], m[m > 1e-3])
    count = np.bincount(rows, minlength=n)
    return np.stack([np.ones(n), np.log1p(total), top, np.log1p(1000 * total / np.maximum(count, 100))], 1)


def train(texts: list[str] | pa.ChunkedArray, toxic: np.ndarray, clean_weight: float) -> dict:
    """Weights, moves and the logistic regression of the document score; clean_weight: clean documents that one of the sample stands for, against toxic ones."""
    clean = clean_weight * float((toxic == 0).sum())
    prior = float((toxic == 1).sum()) / max(float((toxic == 1).sum()) + clean, 1e-9)
    nothing = {"weights": Weights(np.zeros(0, np.uint64), np.zeros(0)), "move": np.zeros((2, 2)), "bias": -30.0, "score": None, "prior": prior}
    if len(np.unique(toxic)) < 2:
        return nothing
    y_doc = toxic.astype(bool)
    parts = list(slices(texts if isinstance(texts, pa.ChunkedArray) else pa.array(texts, pa.large_string())))
    # First pass: features by the documents they occur in. The low bits of a feature's hash make room for the row.
    room, ids = np.uint64(1 << ROW_BITS), []
    for row, data, offsets in parts:
        f, r, _, _ = tokens(data, offsets)
        for at in range(0, len(offsets) - 1, 1 << ROW_BITS):
            own = (r >= at) & (r < at + (1 << ROW_BITS))
            once = np.unique(f[own] // room * room + (r[own] - at).astype(np.uint64)[:, None])
            ids.append(once // room * np.uint64(2) + y_doc[row + at + (once % room).astype(np.int64)].astype(np.uint64))
    # Sorted in place, with the label as lowest bit: no index arrays as large as this one.
    once = np.concatenate([np.zeros(0, np.uint64), *ids])
    ids.clear()
    once.sort()
    starts = np.flatnonzero(np.concatenate([[True], once[1:] >> np.uint64(1) != once[:-1] >> np.uint64(1)])) if len(once) else np.zeros(0, np.int64)
    seen = np.diff(np.append(starts, len(once)))
    positive = np.add.reduceat(once & np.uint64(1), starts) if len(once) else np.zeros(0, np.uint64)
    ids = once[starts] >> np.uint64(1)
    del once
    marks = ids[(positive >= SUPPORT) & (positive >= PURITY * seen) & (ids != 0)]
    # Second pass: windows around toxic tokens, and others by the hash of their first word, so many of each.
    rng = np.random.default_rng(5)
    kept: list[list] = [[], [], [], []]
    for row, data, offsets in parts:
        f, r, _, _ = tokens(data, offsets)
        if not len(f):
            continue
        y = np.isin(f // room, marks).any(1) & y_doc[row + r]
        index, real, _ = windows(np.bincount(r, minlength=len(offsets) - 1), 24, 4)
        to = (np.arange(index.shape[1])[None, :] + real.argmax(1)[:, None]) % index.shape[1]
        index, real = np.take_along_axis(index, to, 1), np.take_along_axis(real, to, 1)
        has = (y[index] & real).any(1)
        share = CHAINS / max(1, len(parts))
        chosen = np.concatenate([rng.permutation(np.flatnonzero(h))[: int(share) + 1] for h in (has, ~has)])
        for k, x in enumerate((around(f, r)[index[chosen]], real[chosen], y[index[chosen]] & real[chosen])):
            kept[k].append(x)
    if not kept[0]:
        return nothing
    f, real, target = (np.concatenate(k) for k in kept[:3])
    target = target.astype(float)
    used, count = np.unique(f[real], return_counts=True)
    names = used[(count >= 3) & (used != 0)]
    if not len(names):
        return nothing
    where = np.minimum(np.searchsorted(names, f), len(names) - 1)
    where = np.where((names[where] == f) & real[:, :, None], where, len(names))
    w, move, bias = np.zeros(len(names) + 1), np.zeros((2, 2)), -3.0
    moved = np.zeros((2, 2))
    step_real = real[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            moved[a, b] = ((target[:, :-1] == a) & (target[:, 1:] == b) & step_real).sum()
    n, size = len(f), len(names)
    mean, square = np.zeros(size + 6), np.zeros(size + 6)
    for turn in range(1, 61):
        e = w[where].sum(2) + bias
        m, pairs = forward_backward(np.where(real, e, 0.0), real, move)
        wrong = (target - m) * real
        gradient = np.bincount(where.ravel(), np.repeat(wrong.ravel(), where.shape[2]), size + 1)[:size] - 0.3 * w[:size]
        g = np.concatenate([gradient, [wrong.sum()], (moved - pairs).ravel(), [0.0]]) / n
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        delta = 0.15 * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        w[:size] += delta[:size]
        bias += delta[size]
        move = move + delta[size + 1 : size + 5].reshape(2, 2)
    heavy = np.abs(w[:size]) > 0.25
    model = {"weights": Weights(names[heavy], w[:size][heavy]), "move": move, "bias": bias, "prior": prior}
    x = []
    for _, data, offsets in parts:
        f, r, _, _ = tokens(data, offsets)
        n_by_row = np.bincount(r, minlength=len(offsets) - 1)
        x.append(_summary(marginals(model["weights"].emissions(around(f, r)) + bias, n_by_row, move), r, len(n_by_row)))
    x = np.concatenate(x)
    weight = np.where(y_doc, 1.0, clean_weight)
    theta = np.zeros(x.shape[1])
    for _ in range(30):  # Newton's steps, slightly regularised
        p = 1 / (1 + np.exp(-x @ theta))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(theta))
        theta = theta + np.linalg.solve(h, x.T @ (weight * (y_doc - p)) - 0.1 * theta)
    return model | {"score": theta}


def _modulo(key: Column, n: int) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def _sampled(docs: DataFrame, labels: DataFrame, sample: tuple[int, int], sample_bytes: int) -> tuple[DataFrame, list[int]]:
    """(text, toxic) of the training documents, and how many labels there are of 0 and 1.

    By the hash of their ids: of each label the first ``sample`` documents; one whose text would take the label over ``sample_bytes``
    is passed over. Repeated rows of one id and label are one document.
    """
    rows = labels.where((_modulo(F.col("doc_id"), 4) != 2) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    there = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    # Bounded by the sample sizes; ties in the order are between equal rows.
    some = [rows.where(F.col("toxic") == y).distinct().orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(sample[y]) for y in (0, 1)]
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = thin.join(F.broadcast(some[0].union(some[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    found = written(found, "crf-sample")

    def fitting(t: pa.Table) -> pa.Table:
        t, total, keep = t.sort_by([("place", "ascending"), ("doc_id", "ascending")]), 0, []
        for k, size in enumerate(t.column("size").to_pylist()):
            if total + size <= sample_bytes:
                total += size
                keep.append(k)
        return t.take(pa.array(keep, pa.int64())).select(["doc_id", "toxic"])

    # At most so many rows as the samples hold.
    lengths = found.select("doc_id", "toxic", F.xxhash64(F.lit(9), "doc_id").alias("place"), F.octet_length("text").cast("long").alias("size"))
    chosen = lengths.groupBy("toxic").applyInArrow(fitting, "doc_id long, toxic int")
    return found.join(chosen, ["doc_id", "toxic"]).select("doc_id", "text", "toxic"), [there.get(y, 0) for y in (0, 1)]


def learned(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> dict:
    """The model of ``train`` over the sample. One task trains it, on an executor; the driver gets the model only."""
    rows, there = _sampled(docs, labels, sample, sample_bytes)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
        toxic = t.column("toxic").to_numpy().astype(int)
        part = [there[y] / max(int((toxic == y).sum()), 1) for y in (0, 1)]
        model = train(t.column("text"), toxic, part[0] / max(part[1], 1e-9))
        plain = model | {"weights": (model["weights"].keys, model["weights"].values)}
        return pa.table({"model": pa.array([pickle.dumps(plain)], pa.binary())})

    got = rows.groupBy().applyInArrow(run, "model binary").first()
    if not got:
        return train([], np.zeros(0, int), 1.0)
    plain = pickle.loads(got["model"])
    return plain | {"weights": Weights(*plain["weights"])}


def tagged(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_spans, spans (code-point start, end and marginal of each)."""
    model = learned(docs, labels, sample, sample_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column("text")):
                f, rows, start, end = tokens(data, offsets)
                n = len(offsets) - 1
                count = np.bincount(rows, minlength=n)
                e = model["weights"].emissions(around(f, rows)) + model["bias"]
                # Chains without any weighty feature all look alike up to their length: they need no passes of their own.
                m = marginals(e, count, model["move"])
                if model["score"] is None:
                    score = np.full(n, model["prior"])
                else:
                    score = 1 / (1 + np.exp(-_summary(m, rows, n) @ model["score"]))
                hot = m >= SPAN
                begins = np.flatnonzero(hot & ~(np.concatenate([[False], hot[:-1]]) & np.concatenate([[False], rows[1:] == rows[:-1]])))
                spans: list[list] = [[] for _ in range(n)]
                if len(begins):
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    for b in begins.tolist():
                        t, p = b, m[b]
                        while t + 1 < len(hot) and hot[t + 1] and rows[t + 1] == rows[b]:
                            t += 1
                            p = max(p, m[t])
                        r = rows[b]
                        base = points[offsets[r]]
                        spans[r].append({"start": int(points[start[b]] - base), "end": int(points[end[t]] - base), "p": float(p)})
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(row, n), batch.column("held_out").slice(row, n), pa.array(score, pa.float64()), pa.array((score >= CUT).astype(np.int32)),
                    pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))], ["doc_id", "held_out", "score", "predicted", "n_spans", "spans"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (_modulo(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_spans int, spans array<struct<start:long,end:long,p:double>>")

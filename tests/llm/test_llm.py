"""The training-data operators against brute force, on odd rows, and on held-out rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidewater.llm import common, crf, deleted_interpolation, divergence, domtrees, linechunks, mixing, qgrams, queries, setsketch, sharding, tokens, urlrules
from tidewater.llm.graph import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, _dd_w int"
ODD = [
    (1, None, "en", "a", 0, "x", 1), (2, "", None, None, 0, "x", 1), (3, " \t\n\r ", "xx", "b", 5, None, None), (4, "one", "en", "a", 3, "x", 1), (5, "one", "en", "a", 3, "x", 1), (5, "one", "en", "a", 3, "x", 1),
    (None, "some words here, without an id", "de", None, None, "x", 1), (None, None, None, None, None, None, None), (6, "é" * 30_000 + " " + "word " * 40_000, "fr", "b", 1, "x", 1), (7, "a\n\nb\na\n" * 40 + "\x0b\x0c", "es", "\U0001f600", 1, "x", 1),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


# Words


def test_tokens_match_the_pattern():
    import pyarrow as pa

    r = random.Random(1)
    rows = ["".join(r.choices("abAB é\t\n\x0b.\u00a0", k=r.randint(0, 40))) for _ in range(400)] + ["", None]
    seen = {}
    for row, data, offsets in tokens.slices(pa.array(rows)):
        h, at, _, _ = tokens.words(data, offsets)
        for i in range(len(offsets) - 1):
            want = words(lower(rows[row + i]))
            got = h[at == i].tolist()
            assert len(got) == len(want)
            for a, b in zip(got, want, strict=True):
                assert seen.setdefault(a, b) == b
    assert len(seen) == len(set(seen.values()))


# 1


def brute_quality(text):
    t = text or ""
    w = words(t)
    seen = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if words(x)]
    n = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)
    return (*n, n[0] < 50 or 100 * n[4] > 50 * n[0])


def test_quality_counts(spark, docs, texts):
    for rows, frame in ((texts.items(), docs), ([(r[0], r[1]) for r in ODD], odd(spark))):
        want = Counter((k, *brute_quality(v)) for k, v in rows)
        got = divergence.judged(frame).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
        assert all(not (r.kept and r.base_failed) for r in got)
    assert divergence.judged(empty(spark)).count() == 0
    assert divergence.keep_good(odd(spark)).columns == odd(spark).columns


def test_distance_to_references(spark, docs, texts):
    refs = divergence.references(docs)
    vocabulary = divergence._vocabulary()

    def h(p):
        return -sum(x * math.log2(x) for x in p if x > 0)

    def distance(p, q):
        return math.sqrt(max(h([(a + b) / 2 for a, b in zip(p, q, strict=True)]) - (h(p) + h(q)) / 2, 0))

    kinds = [r"[a-z]", r"[A-Z]", r"[#*$%&|<>]", r"[0-9]", r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]", "[\u00c0-\u024f]"]
    for r in divergence.judged(docs).where("n_words > 0").limit(40).collect():
        w = words(texts[r.doc_id])
        solid, counts = "".join(w), []
        for k in kinds:
            counts.append(len(re.findall(k, solid)))
            solid = re.sub(k, "", solid)
        counts.append(len(solid))
        said = [w.count(x) for x in vocabulary]
        said.append(len(w) - sum(said))
        best = min((distance([c / sum(counts) for c in counts], a) + distance([c / sum(said) for c in said], b), k) for k, (a, b) in refs.items())
        assert abs(r.char_distance + r.word_distance - best[0]) < 1e-9 and r.closest == best[1]


def test_junk_goes_and_prose_stays(spark, docs):
    r = divergence.judged(common.table(spark, "/root/testdata/sf0.01", "documents")).join(common.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("not base_failed")
    rates = {x.quality: x.kept for x in r.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert rates[1] > 0.98 and rates[0] < 0.2


# 2


def test_shards(spark, docs, texts):
    for frame, rows in ((docs, list(texts.items())), (odd(spark), [(r[0], r[1]) for r in ODD])):
        got = sharding.shard(frame).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
        sizes = Counter(r.shard for r in got)
        assert set(sizes.values()) <= {len(rows) // 16, len(rows) // 16 + 1} and all(0 <= s < 16 for s in sizes)
        for s, n in sizes.items():
            assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    assert sharding.shard(empty(spark)).count() == 0


def test_shards_keep_equal_texts_together(spark):
    rows = [(i, f"text {i % 400}" if i < 1200 else f"single {i}" if i < 2400 else "hot") for i in range(3600)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert set(Counter(r.shard for r in got).values()) == {225}
    by = {}
    for r in got:
        by.setdefault(rows[r.doc_id][1], set()).add(r.shard)
    assert len(by["hot"]) <= 10
    groups = [len(v) for k, v in by.items() if k.startswith("text")]
    assert sum(n == 1 for n in groups) > 0.85 * len(groups)


def test_rounds_end_only_when_no_group_can_move(spark):
    # 16 rows without equals leave room for few moves a round: 200 pairs or so take more than ten rounds.
    rows = [(i, f"pair {i // 2}") for i in range(800)] + [(1000 + i, f"alone {i}") for i in range(16)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=2).collect()
    place = {r.doc_id: r.shard for r in got}
    assert Counter(place.values()) == Counter({0: 408, 1: 408})
    assert sum(place[i] != place[i + 1] for i in range(0, 800, 2)) == 0


# 3


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixture(spark, docs):
    for frame in (docs, odd(spark), spark.createDataFrame([(i, "w " * (i % 50), None, f"s{min(i, 3)}", 0, "", 0) for i in range(300)], DOCS)):
        source = [(r.doc_id, r.source, len(words(r.text))) for r in frame.collect()]
        sizes = Counter()
        for _, s, n in source:
            sizes[s] += n
        want = brute_targets(dict(sizes))
        got = mixing.mixed(frame).collect()
        assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, n) for d, _, n in source)
        assert all(0 <= r.taken <= 3 * r["size"] for r in got)
        name = {}
        for r in got:
            s = [x for x in want if sizes[x] == r.source_size and abs(want[x] - r.target) < 1e-6 * max(1, want[x])]
            assert s
            name.setdefault((r.source_size, r.target), []).append(r.taken)
        for (size, target), taken in name.items():
            times = sum(1 for x in want if sizes[x] == size and abs(want[x] - target) < 1e-6 * max(1, target))
            # The points' counts differ from their shares by a few slots.
            each = max(1, min(mixing.SLOT_WORDS, int(sum(want.values())) // mixing.LEAST_SLOTS))
            assert abs(sum(taken) - target * times) <= times * 8 * each
        again = mixing.mixed(frame).collect()
        assert Counter((r.doc_id, r.taken, r.first_slot) for r in got) == Counter((r.doc_id, r.taken, r.first_slot) for r in again)
    assert mixing.mixed(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    assert mixing.mix(odd(spark)).columns == odd(spark).columns


SOURCES = "sid long, low double, high double, blocks long"


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([(0, 0.0, 0.5, 9000), (1, 0.5, 0.9, 9000), (2, 0.9, 2.0, 9000)], SOURCES)
    got = sorted(mixing.schedule(sources, 5000).collect())
    assert [r.slot for r in got] == list(range(5000))
    share, ranks, seen = (0.5, 0.4, 0.1), Counter(), Counter()
    for i, r in enumerate(got):
        assert r["rank"] == ranks[r.sid]
        ranks[r.sid] += 1
        seen[r.sid] += 1
        assert all(abs(seen[s] - (i + 1) * share[s]) < 8 for s in range(3))


def points(n):
    phi = (math.sqrt(5) - 1) / 2
    return [(i + 1) * phi % 1 for i in range(n)]


def test_schedule_passes_slots_of_used_up_sources(spark):
    sources = spark.createDataFrame([(0, 0.0, 0.5, 40), (1, 0.5, 0.5, 3), (2, 0.5, 2.0, 60), (3, 2.0, 2.0, 0)], SOURCES)
    got = sorted(mixing.schedule(sources, 100).collect())
    want, n = [], Counter()
    for i, u in enumerate(points(100)):
        sid = 0 if u < 0.5 else 2
        if n[sid] < {0: 40, 2: 60}[sid]:
            want.append((i, sid, n[sid]))
            n[sid] += 1
    assert [(r.slot, r.sid, r["rank"]) for r in got] == want


def mixture_rows(n=400):
    return [(i % 390, " ".join(["w"] * (i * 7 % 50)), None, None if i % 11 == 0 else f"s{min(i % 7, 4)}" if i < n - 3 else "tiny", 0, "", 0) for i in range(n)]


def brute_mixture(rows, slots, us):
    """(doc_id, size, taken, first slot) of rows (doc_id, source, size, order) by the points us, word by word."""
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.n
    want = brute_targets(dict(sizes))
    total = sum(min(round(want[s]), 3 * sizes[s]) for s in want)
    each = max(1, total // slots)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    edges, at = [], 0.0
    for s in names:
        at += want[s]
        edges.append(at / sum(want.values()))
    blocks = {s: {} for s in names}
    for i, u in enumerate(us(-(-total // each))):
        s = names[next((k for k, e in enumerate(edges[:-1]) if u < e), len(edges) - 1)]
        rank = len(blocks[s])
        if rank < -(-3 * sizes[s] // each):
            blocks[s][rank] = i
    out = Counter()
    for s in names:
        at = 0
        for r in sorted((r for r in rows if r.source == s), key=lambda r: (r.o % mixing.LEAST_BUCKETS, r.o, r.doc_id, r.n)):
            taken = sum(w // each in blocks[s] for k in range(3) for w in range(at + k * sizes[s], at + k * sizes[s] + r.n))
            out[r.doc_id, r.n, taken, blocks[s][at // each] if taken else None] += 1
            at += r.n
    return out


def ordered_rows(frame):
    return frame.select("doc_id", "source", F.size(common.words(F.col("text"))).alias("n"), F.xxhash64(F.lit(mixing.SEED), "doc_id", F.octet_length("text")).alias("o")).collect()


@pytest.mark.parametrize("golden", [None, 0.0, 0.7])
def test_taken_is_what_the_points_name(spark, monkeypatch, golden):
    """Word by word from the points themselves; other points give another mixture."""
    frame = spark.createDataFrame(mixture_rows(), DOCS)
    monkeypatch.setattr(mixing, "LEAST_SLOTS", 300)
    right = Counter((r.doc_id, r["size"], r.taken, r.first_slot) for r in mixing.mixed(frame).collect())
    copies = Counter(r.doc_id for r in mixing.mix(frame).collect())
    if golden is None:
        assert right == brute_mixture(ordered_rows(frame), 300, points)
        return
    monkeypatch.setattr(mixing, "golden", lambda i: F.lit(golden))
    got = Counter((r.doc_id, r["size"], r.taken, r.first_slot) for r in mixing.mixed(frame).collect())
    assert got == brute_mixture(ordered_rows(frame), 300, lambda n: [golden] * n)
    assert Counter(x[:3] for x in got.elements()) != Counter(x[:3] for x in right.elements())
    # A document of n words comes as often as its words are taken, rounded.
    want = Counter()
    for (doc, n, taken, _), times in got.items():
        want[doc] += times * int(taken / max(n, 1) + 0.5)
    assert Counter(r.doc_id for r in mixing.mix(frame).collect()) == +want != copies


def test_mixture_in_the_order_of_the_schedule(spark):
    frame = spark.createDataFrame(mixture_rows(), DOCS)
    got = mixing.mix(frame, slot="at").collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in mixing.mix(frame).collect())
    first = {}
    for r in mixing.mixed(frame).where("first_slot is not null").collect():
        first.setdefault((r.doc_id, r["size"]), []).append(r.first_slot)
    for r in got:
        key = r.doc_id, len(words(r.text))
        assert r["at"] is None or r["at"] >= min(first[key])


# 4


def test_language_model(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(deleted_interpolation, "BATCH_BYTES", 60_000)
    got = deleted_interpolation.scored(docs).collect()
    tok = {k: [*words(lower(t)), None] for k, t in texts.items()}
    train = [k for k in tok if zlib.crc32(str(k).encode()) % 5 != 1]
    c, pairs = Counter(), Counter()
    for k in train:
        c.update(tok[k])
        pairs.update(zip(["<"] + tok[k], tok[k], strict=False))
    n, v = sum(c.values()), len(c)
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        t = tok[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r.held_out == (r.doc_id not in set(train))
        assert abs(r.base_score - sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) < 1e-6 * len(t)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    rows = deleted_interpolation.scored(odd(spark)).collect()
    assert len(rows) == len(ODD) and all(r.score < 0 for r in rows)
    assert deleted_interpolation.scored(empty(spark)).count() == 0


def octave_steps(c):
    return round(4 * math.log2(c + 1))


@pytest.mark.parametrize("fan", [2, 3, 512])
def test_scores_equal_brute_force(spark, monkeypatch, fan):
    """Every score from dictionaries of all counts, through one level of the exchange and through several."""
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choice(vocabulary[: 3 + i % 57]) for _ in range(r.choice([0, 1, 7, 40, 90])))) for i in range(150)]
    rows += [(7, "w1 w2 w1"), (7, "w1 w2 w1"), (8, None), (None, "W1 w2 \x0b w3")]
    monkeypatch.setattr(deleted_interpolation, "BATCH_BYTES", 1_000)
    monkeypatch.setattr(deleted_interpolation, "FAN", fan)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    size = sum(len(t or "") for _, t in rows)
    assert deleted_interpolation.levels(-(-size // 1_000))[0] == {2: 4, 3: 3, 512: 1}[fan]
    drawn = {x[0] for x in df.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(deleted_interpolation.DELETED)) == 0).select("doc_id").collect()}
    items = [(i, [*words(lower(t)), None]) for i, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in items]
    full, rest = (Counter(), Counter()), (Counter(), Counter())
    starts, kept_starts = 0, 0
    for (i, tok), out in zip(items, held, strict=True):
        if not out:
            starts += 1
            full[0].update(tok), full[1].update(zip(["<"] + tok, tok, strict=False))
            if i not in drawn:
                kept_starts += 1
                rest[0].update(tok), rest[1].update(zip(["<"] + tok, tok, strict=False))
    n, v, kept = sum(full[0].values()), len(full[0]), sum(rest[0].values())
    bins = Counter()
    for (i, tok), out in zip(items, held, strict=True):
        if not out and i in drawn:
            for h, w in zip(["<"] + tok, tok, strict=False):
                step = 1023 if h == "<" else octave_steps(rest[0][h])
                bins[step << 20 | octave_steps(rest[1][h, w]) << 10 | octave_steps(rest[0][w])] += 1
    assert bins
    learned = deleted_interpolation.weights(sorted(bins.items()), kept, kept_starts, v)
    want = Counter()
    for (i, tok), out in zip(items, held, strict=True):
        score = 0
        for h, w in zip(["<"] + tok, tok, strict=False):
            context = starts if h == "<" else full[0][h]
            l2, l1, l0 = learned[int(math.log2(context)) + 1 if context else 0]
            score += math.log10(l2 * full[1][h, w] / max(context, 1) + l1 * full[0][w] / n + l0 / (v + 1))
        want[i, out, len(tok), sum(full[0][w] > 0 for w in tok), n, round(score, 6)] += 1
    got = Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.score, 6)) for x in deleted_interpolation.scored(df).collect())
    assert got == want


def test_levels_of_the_exchange_grow_with_the_logarithm():
    for batches, depth in ((1, 1), (512, 1), (513, 2), (512**2, 2), (12_500_000, 3)):
        found, fan = deleted_interpolation.levels(batches)
        assert found == depth and fan <= 512 and fan**depth >= batches


def test_weights_are_those_of_a_brute_em():
    r = np.random.default_rng(3)
    bins = [(int(h) << 20 | int(min(h, x)) << 10 | int(w), int(t)) for h, x, w, t in zip(r.integers(4, 60, 50), r.integers(0, 30, 50), r.integers(1, 60, 50), r.integers(1, 9, 50), strict=True)]
    got = deleted_interpolation.weights(bins, 10_000, 100, 500)
    assert np.allclose(got.sum(1), 1) and got[0, 0] == 0

    def value(s):
        return 2 ** (s / 4) - 1

    by = {}
    for k, t in bins:
        h, hw, w = value(k >> 20), value(k >> 10 & 1023), value(k & 1023)
        by.setdefault(int(math.log2(max(round(h), 1))) + 1, []).append((t, (min(hw / max(h, 1), 1), w / 10_000, 1 / 501)))
    for b, items in by.items():
        lam = [0.4, 0.4, 0.2]
        for _ in range(60):
            new = [0.0] * 3
            for t, f in items:
                total = sum(a * x for a, x in zip(lam, f, strict=True))
                for k in range(3):
                    new[k] += t * lam[k] * f[k] / total
            lam = [x / sum(new) for x in new]
        assert np.allclose(got[b], lam, atol=1e-4)


# 5


def test_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    move = r.normal(size=(2, 2))
    e = r.normal(size=7)
    weight = Counter()
    total = 0.0
    for code in range(1 << 7):
        y = [code >> i & 1 for i in range(7)]
        w = math.exp(sum(e[i] * y[i] for i in range(7)) + sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += w
        for i in range(7):
            weight[i] += w * y[i]
    m = crf.marginals(e, np.array([7]), move)
    assert np.allclose(m, [weight[i] / total for i in range(7)])
    long = r.normal(size=2000)
    assert np.allclose(crf.marginals(np.concatenate([e, long]), np.array([7, 2000]), move)[:7], m)


def test_toxic_held_out(spark):
    d, l = (common.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = crf.tagged(d, l).join(l, "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    rate = {r.toxic: r.p for r in got}
    assert rate[1] > 0.85 and rate[0] < 0.02


def test_toxic_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (None, 0, 1), (6, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        rows = crf.tagged(odd(spark), some).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert crf.tagged(empty(spark), labels).count() == 0


def held(docs, labels):
    """(doc_id -> score) of all documents."""
    return {r.doc_id: r.score for r in crf.tagged(docs, labels).collect()}


@pytest.mark.parametrize("texts", [("good here", "bad there"), ("", None), ("12 34", "--"), ("a", "b"), (" ", "bad")])
def test_toxic_small_training_sets(spark, texts):
    """Too little to learn from: every score is the share of toxic labels."""
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][:4]
    docs = spark.createDataFrame([(i, texts[k % 2]) for k, i in enumerate(ids)] + [(1000, "any text"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(ids[0], 0), (ids[1], 1), (ids[2], 0)], "doc_id long, toxic int")
    two = spark.createDataFrame([(ids[0], "good words here"), (ids[1], "bad words there")], "doc_id long, text string")
    assert all(0 <= s <= 1 for s in held(two, labels).values())
    assert all(abs(s - 1 / 3) < 1e-9 for s in held(docs, labels).values())


def test_a_text_too_long_for_the_sample_is_passed_over(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][:60]
    texts = {i: f"vile filth number {i}" if k % 2 else f"calm clean number {i}" for k, i in enumerate(ids)}
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    for long in range(0, 60, 7):
        texts[ids[long]] = "x " * 50_000
    rows, there = crf._sampled(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), labels, (50, 50), 20_000)
    assert there == [30, 30] and {r.doc_id for r in rows.collect()} == {i for k, i in enumerate(ids) if k % 7}


def test_document_scores_equal_brute_force(spark):
    """Scores from the model's own weights, by enumeration of each short text's labellings and the logistic regression."""
    r = random.Random(8)
    vile, calm = [f"vile{c}" for c in "abcdef"], [f"calm{c}{d}" for c in "ghijk" for d in "lmnop"]
    ids = list(range(300))
    texts = {i: " ".join(r.choices(calm, k=r.randint(1, 6)) + (r.choices(vile, k=2) if i % 3 == 0 else [])) for i in ids}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in ids], "doc_id long, toxic int")
    model, got = crf.learned(docs, labels), held(docs, labels)
    for i in ids[:40]:
        data = np.frombuffer(texts[i].encode(), np.uint8)
        f, rows, _, _ = crf.tokens(data, np.array([0, len(data)]))
        e = [sum(dict(zip(model["weights"].keys.tolist(), model["weights"].values.tolist(), strict=True)).get(int(x), 0.0) for x in row) + model["bias"] for row in crf.around(f, rows)]
        total, hot = 0.0, [0.0] * len(e)
        for y in itertools.product((0, 1), repeat=len(e)):
            w = math.exp(sum(max(-30, min(30, v)) * s for v, s in zip(e, y, strict=True)) + sum(model["move"][a, b] for a, b in itertools.pairwise(y)))
            total += w
            for k, s in enumerate(y):
                hot[k] += w * s
        m = [h / total for h in hot]
        top = max([v for v in m if v > 1e-3], default=0.0)
        x = [1.0, math.log1p(sum(m)), top, math.log1p(1000 * sum(m) / max(len(m), 100))]
        assert abs(got[i] - 1 / (1 + math.exp(-float(np.dot(x, model["score"]))))) < 1e-6
    assert all((s >= 0.3) == (i % 3 == 0) for i, s in got.items())


# 6


def brute_components(rows, k, percent=80):
    sets = {}
    for i, t in rows:
        w = words(lower(t))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(r, base, n):
    w = list(base)
    for _ in range(n):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, texts, k):
    r = random.Random(k)
    base = [f"w{r.randrange(500)}" for _ in range(150)]
    rows = list(texts.items()) + [(10_000 + i, edited(r, base, r.randint(0, 12))) for i in range(150)] + [(20_000, "A b"), (20_001, "a B"), (20_002, "solo"), (20_003, " "), (20_004, None), (20_005, "Solo")]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, 80).collect()
    want = brute_components(rows, k)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)


def test_truncated_copies_link_through_the_template(spark):
    r = random.Random(13)
    rows = []
    for t in range(6):
        template = [f"t{t}w{r.randrange(10**6)}" for _ in range(100)]  # 96 shingles; 100 with the suffix, 79 without the tail
        rows += [(1000 * t + i, " ".join(template + [f"own{r.randrange(10**9)}" for _ in range(4)])) for i in range(70)]
        rows += [(1000 * t + 100, " ".join(template)), (1000 * t + 101, " ".join(template[:83]))]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute_components(rows, 5)


def test_narrowed_parts(spark):
    docs = spark.createDataFrame([(i if i % 7 else None, str(i)) for i in range(500)], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 500, 9)], "id long")
    some, rest = (setsketch.narrowed(docs, "doc_id", ids, rest=r).collect() for r in (False, True))
    assert sorted(x.text for x in some + rest) == sorted(x.text for x in docs.collect())
    assert {x.doc_id for x in some} >= {i for i in range(0, 500, 9) if i % 7} and None not in {x.doc_id for x in some}


def brute_rows(rows, k):
    """(doc_id, n_shingles, component_id, kept) of each row, links between rows by their own texts; and what one row of each group leaves."""
    sets = []
    for _, text in rows:
        w = words(lower(text))
        sets.append({" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {" ".join(w)} - {""})
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and None not in (rows[i][0], rows[j][0]) and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    out = [(doc, len(sets[i]), least.get(find(i)), doc == least.get(find(i))) for i, (doc, _) in enumerate(rows)]
    left, best = [], {}
    for i, (doc, text) in enumerate(rows):
        if doc is None or not sets[i]:
            left.append((doc, text))
        elif out[i][3]:
            rank = (len(text), hashlib.md5(text.encode()).digest(), text)
            best[find(i)] = max(best.get(find(i), (rank, doc)), (rank, doc))
    return out, left + [(doc, rank[2]) for rank, doc in best.values()]


@pytest.mark.parametrize("size", [2, 5])
def test_rows_that_share_an_id_have_links_of_their_own(spark, size):
    r = random.Random(size)
    x, y, z = (" ".join(f"{c}{r.randrange(10**6)}" for _ in range(60)) for c in "xyz")
    rows = [(3, x), (5, x), (5, y), (7, y + " tail"), (9, z), (9, x + " other"), (9, "quite another text of this id"), (11, z + " tail"), (2, z + " tail"), (2, z + " tails"), (2, z), (2, z), (None, x), (4, None), (4, ""), (4, y + " end")]
    rows += [(20 + i % 3, f"{x if i % 2 else y} {i}") for i in range(12)]
    df = spark.createDataFrame([(i, t, "en", None, None, "x", 1) for i, t in rows], DOCS).repartition(4)
    want, left = brute_rows(rows, size)
    got = [tuple(g) for g in setsketch.near_duplicates(df, size).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(((g.doc_id, g.text) for g in setsketch.drop_near_duplicates(df, size).collect()), key=repr) == sorted(left, key=repr)


def test_unrelated_texts_of_one_id_all_stay(spark):
    rows = [(9, " ".join(f"{c}{i}" for i in range(40))) for c in "abcdef"] * 2
    left = setsketch.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    assert sorted(x.text for x in left) == sorted({t for _, t in rows})


def test_sets_hold_64_bits_and_no_repeats(spark):
    texts = ["a b a b a b c", "", "one", "x y z", "a b a b a b c"]
    for _, data, offsets in tokens.slices(pa.array(texts)):
        elements, count = setsketch.shingle_sets(data, offsets, 2)
    assert count.tolist() == [3, 0, 1, 2, 3] and (elements[:3] == elements[-3:]).all()
    assert len(set(elements.tolist())) == 6 and int(elements.max()) > 1 << 56


def test_near_duplicates_odd_rows(spark):
    rows = setsketch.near_duplicates(odd(spark), 2).collect()
    assert len(rows) == len(ODD)
    left = setsketch.drop_near_duplicates(odd(spark), 5)
    assert left.columns == odd(spark).columns
    kept = Counter(r.doc_id for r in left.collect())
    assert kept == Counter([1, 2, 3, 4, None, None, 6, 7])
    assert setsketch.near_duplicates(empty(spark)).count() == 0


def test_estimate_is_near_the_truth():
    r = np.random.default_rng(2)
    e = []
    for j in (0.5, 0.8, 0.95):
        n = 1000
        both = int(2 * n * j / (1 + j))
        x = r.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        a, b = x[:n], x[n - both :]
        s = [setsketch.registers(y, np.array([0])) for y in (a, b, x)]
        assert (np.maximum(s[0], s[1]) == s[2]).all()  # registers merge
        e.append(abs(setsketch.jaccard(s[0], s[1], np.array([n]), np.array([len(b)]))[0] - j))
    assert max(e) < 0.1


def test_estimate_drops_no_link():
    # Every outcome of the registers of two sets of equal size at similarity 0.8: what the cut loses in all.
    m, at = setsketch.REGISTERS, 0.8
    p = -math.log1p(-(1 - at) / 2 * (setsketch.BASE - 1) / setsketch.BASE) / math.log(setsketch.BASE)
    lost, size = 0.0, np.full(m + 1, 1000)
    for larger in range(m + 1):
        smaller = np.arange(m + 1 - larger)
        a, b = np.zeros((len(smaller), m), np.uint16), np.zeros((len(smaller), m), np.uint16)
        a[:, :larger] = 1
        b[:, larger:] = np.arange(m - larger) < smaller[:, None]
        e = setsketch.jaccard(a, b, size[: len(a)], size[: len(a)])
        for k in smaller[e < at - setsketch.MARGIN - setsketch.SLACK].tolist():
            rest = m - larger - k
            ways = math.lgamma(m + 1) - math.lgamma(larger + 1) - math.lgamma(k + 1) - math.lgamma(rest + 1)
            lost += math.exp(ways + (larger + k) * math.log(p) + rest * math.log(1 - 2 * p))
    assert lost < (1 - at**setsketch.ROWS) ** setsketch.BANDS
    for percent in range(50, 100):  # the grid value at the cut itself passes
        cut = np.linspace(0.0, 1.0, 101)[percent - 16]
        assert cut >= percent / 100 - setsketch.MARGIN - setsketch.SLACK


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_components_of_chains_take_few_rounds(spark, monkeypatch):
    from tidewater.llm import graph

    made = []
    monkeypatch.setattr(graph, "written", lambda df, name: made.append(name) or common.written(df, name))
    edges = [(i, i + 1) for i in range(1000)] + [(5000, i) for i in range(5001, 5050)]
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1001)} | {i: 5000 for i in range(5000, 5050)}
    assert made.count("cc-step") < 15
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


# 7


def test_repeated_passages_go(spark):
    r = random.Random(5)
    line = lambda n: " ".join(f"v{r.randrange(10**6)}" for _ in range(n))
    passage = line(60)
    block = "\n".join(line(12) for _ in range(30))
    rows = [(i, "\n".join([line(15), line(9), *([passage] if i % 2 else []), line(8), *([block] if i % 3 == 0 else []), line(11)])) for i in range(60)]
    got = {x.doc_id: x.text for x in linechunks.cleaned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, t in sorted(got.items()) if passage in t] == [1]
    lost = {i: set(t.split("\n")) - set(got[i].split("\n")) for i, t in rows}
    assert got[0] == rows[0][1]
    assert all(len(lost[i] & set(block.split("\n"))) >= 15 for i in range(3, 60, 3))
    assert all(x == passage or x in block for v in lost.values() for x in v)


def test_repeated_runs_of_short_lines_go_whole(spark):
    r = random.Random(15)
    line = lambda n: " ".join(f"v{r.randrange(10**6)}" for _ in range(n))
    rows, runs = [], {}
    for k, n in enumerate([5, 6, 7, 8, 9, 10] * 4):
        runs[k] = [line(r.randint(11, 14)) for _ in range(n)]
        if k % 2:
            runs[k].insert(2, "")
        rows += [(10 * k + j, "\n".join([line(r.randint(1, 12)) for _ in range(r.randint(1, 4))] + runs[k] + [line(r.randint(1, 12)) for _ in range(r.randint(0, 4))])) for j in range(3)]
    same = "\n".join(["one line of five words"] * 30)  # overlaps its own first run: that stays
    rows += [(1000, same), (1001, same + "\n" + line(3))]
    got = {x.doc_id: x for x in linechunks.cleaned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows[:-2]:
        own, left = runs[i // 10], got[i].text.split("\n")
        want = t.split("\n") if i % 10 == 0 else [x for x in t.split("\n") if x not in own]
        assert [x for x in left if x] == [x for x in want if x]
        assert got[i].removed_words == len(words(t)) - len(words(got[i].text))
    assert got[1000].text.startswith("\n".join(["one line of five words"] * 11)) and len(words(got[1001].text)) == 3


def brute_cleaned(rows):
    """What is left of each row: pieces listed text by text, first occurrences by (doc_id, line), all equal later ones gone."""
    import pyarrow as pa

    pieces, lines = [], []
    for n, (i, t) in enumerate(rows):
        lines.append((t or "").split("\n"))
        for _, data, offsets in tokens.slices(pa.array([t or ""])):
            p = linechunks._pieces(linechunks.chunks(data, offsets))
            raw = data.tobytes()
            for at, span, size, start, k in zip(p["line"].tolist(), p["span"].tolist(), p["size"].tolist(), p["start"].tolist(), range(10**9)):
                pieces.append((n, i, at, span, raw[start : start + size], k < p["chunks"]))
    first = {}
    for n, i, at, span, x, chunk in pieces:
        if i is not None:
            first[x, chunk] = min(first.get((x, chunk), (1 << 60, 0)), (i, at))
    gone = {}
    for n, i, at, span, x, chunk in pieces:
        f = first.get((x, chunk))
        if i is not None and (f[0] != i or at >= f[1] + span):
            gone.setdefault((i, x), []).append((n, at, span))
    out = []
    for n, (i, t) in enumerate(rows):
        cut = {k for (j, _), v in gone.items() if j == i for m, at, span in v if m == n for k in range(at, at + span)}
        out.append((i, [x for k, x in enumerate(lines[n]) if k not in cut and x]))
    return out


def test_removal_equals_brute_force(spark):
    r = random.Random(23)
    line = lambda n: " ".join(f"u{r.randrange(10**6)}" for _ in range(n))
    shared = [[line(r.choice((3, 8, 13, 25))) for _ in range(r.randint(2, 12))] for _ in range(6)]
    rows = []
    for i in range(40):
        text = [line(r.randint(1, 30)) for _ in range(r.randint(0, 5))]
        for s in r.sample(shared, r.randint(0, 3)):
            text += s + [line(r.randint(1, 9)) for _ in range(r.randint(0, 2))]
        rows.append((i // 2 if i < 12 else i, "\n".join(text)))  # some rows share a doc_id
    rows += [(None, rows[0][1]), (900, ""), (901, None), (903, rows[20][1]), (902, rows[20][1] + "\n")]
    got = linechunks.cleaned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((x.doc_id, [y for y in x.text.split("\n") if y]) for x in got), key=key) == sorted(brute_cleaned(rows), key=key)


def test_rows_of_one_id_lose_only_their_own_pieces(spark):
    r = random.Random(29)
    line = lambda n: " ".join(f"u{r.randrange(10**6)}" for _ in range(n))
    common_line, own = line(30), line(30)
    rows = [(1, common_line + "\n" + line(4)), (5, line(25) + "\n" + common_line), (5, line(25) + "\n" + own)]
    got = Counter((x.doc_id, own in x.text, common_line in x.text) for x in linechunks.cleaned(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter([(1, False, True), (5, False, False), (5, True, False)])


def test_chunks_equal_a_brute_scan():
    import pyarrow as pa

    r = random.Random(6)
    rows = ["\n".join(" ".join(r.choices("abc", k=r.choice((0, 1, 2, 25)))) for _ in range(r.randint(0, 12))) + r.choice(("", "\n")) for _ in range(300)]
    for row, data, offsets in tokens.slices(pa.array(rows)):
        c = linechunks.chunks(data, offsets)
        raw = data.tobytes()
        for i in range(len(offsets) - 1):
            mine = np.flatnonzero(c["row"] == i)
            pieces = [raw[c["start"][k] : c["end"][k]].decode() for k in mine]
            assert "".join(pieces) == rows[row + i]
            for k, p in zip(mine, pieces, strict=True):
                lines = [x for x in p.split("\n") if words(x)]
                assert c["lines"][k] == len(lines)
                assert c["removable"][k] == (len(lines) >= 2 or any(len(words(x)) >= linechunks.LONG_LINE for x in lines))
                if any(len(words(x)) >= linechunks.LONG_LINE for x in lines):
                    assert len(p.rstrip("\n").split("\n")) == 1


def test_line_chunks_odd_rows(spark):
    got = linechunks.cleaned(odd(spark))
    assert got.count() == len(ODD) and linechunks.cleaned(empty(spark)).count() == 0


# 8


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = lower(re.split(r"[/?#]", rest)[0])
    path = re.split(r"[?#]", rest[len(host) :])[0]
    best = max(((len(h + p), h + p, v) for h, p, v in urlrules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, None))
    return host, path, best[1], best[2]


def test_url_rules(spark):
    odd_urls = [None, "", "no scheme", "http://", "://x.org/a", "HTTP://WWW.Example.ORG/es/1", "http://example.org", "http://example.org?x=/es/", "http://org/", "http://notexample.org/es/", "a://b.com/de/?q#f", "http://xcom/fr/"]
    pages = common.table(spark, SF, "pages").select("page_id", "url", "html").unionByName(spark.createDataFrame([(1000 + i, u, None) for i, u in enumerate(odd_urls)], "page_id long, url string, html string"))
    urls = {r.page_id: r.url for r in pages.collect()}
    got = urlrules.judged(pages).collect()
    assert {r.page_id for r in got} == set(urls)
    for r in got:
        host, path, rule, verdict = brute_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert urlrules.judged(pages.limit(0)).count() == 0


def mined_by_subsets(rows, support, confidence):
    """Rules from all sets of tokens, by the definition: (tokens, label) -> (confidence, support), the needless ones left out."""
    n, every = len(rows), Counter()
    for items, label in rows:
        for k in range(1, len(set(items)) + 1):
            for sub in itertools.combinations(sorted(set(items)), k):
                every[sub, label] += 1
    freq = Counter()
    for (sub, _), c in every.items():
        freq[sub] += c
    rules = {(sub, label): (c / freq[sub], c / n) for (sub, label), c in every.items() if c >= math.ceil(support * n) and c / freq[sub] >= confidence}
    needless = {(sub, label) for (sub, label), (sure, _) in rules.items() for gone in sub if rules.get((tuple(x for x in sub if x != gone), label), (0, 0))[0] >= sure}
    return {k: v for k, v in rules.items() if k not in needless}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mined_rules_are_those_of_all_sets(spark, seed):
    r = random.Random(seed)
    rows = [([t for t in "abcdef" if r.random() < 0.5] + (["x", "y", "z"] if r.random() < 0.4 else []), r.choice(["allow", "block", "block"])) for _ in range(60)]
    rows += [(["p", "q"], "allow")] * 5
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "row long, tokens array<string>, label string")
    got = {}
    for rule in urlrules.mined(df, 0.05, 0.7).collect():
        for choice in itertools.product(*rule.antecedent):
            got[tuple(sorted(choice)), rule.says] = (round(rule.confidence, 9), round(rule.support, 9))
        assert sorted(rule.key) in [sorted(c) for c in rule.antecedent]
    assert got == {k: (round(c, 9), round(s, 9)) for k, (c, s) in mined_by_subsets(rows, 0.05, 0.7).items()}


def test_many_common_parameters(spark):
    """Parameters that go together, alone or under both labels, are one class: time does not grow with the sets of them."""
    query = "&".join(f"p{k}=v{k}" for k in range(20))
    urls = [f"http://{h}/{p}?{query}" for h, p in [("a.org", "x"), ("b.com", "de/x")] * 15 + [("c.net", "y")] * 10] + ["http://d.net/plain"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    began = time.time()
    got = {r.page_id: (r.verdict, r.mined_rule) for r in urlrules.judged(pages).collect()}
    assert time.time() - began < 60
    assert len(got) == 41 and all(got[i][0] == ("allow", "block")[i % 2] for i in range(30))


# 9


@pytest.fixture(scope="module")
def trees():
    return domtrees.train()


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_pages(spark, trees, sf):
    import html as h

    pages = common.table(spark, f"/root/testdata/sf{sf}", "pages")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in domtrees.extracted(pages, trees).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        want = "\n".join(x for x in (re.sub(r"\s+", " ", h.unescape(b)).strip() for b in blocks) if x)
        assert r.text == want and r.n_chars == len(want)


def test_generated_pages_held_out(trees):
    wrong = total = 0
    for source in domtrees.generated(80, seed=99):
        page = domtrees.Page(source)
        d = domtrees.Described(page)
        keep = domtrees.decoded(page, trees.scores(d.matrix()), d.total, d.own)
        truth = list(page.truth)
        for i in range(1, len(truth)):
            truth[i] = truth[i] if truth[i] is not None else truth[page.parent[i]]
            if d.own[i] > 0 and truth[i] is not None:
                total += 1
                wrong += keep[i] != (truth[i] == "1")
    assert wrong / total < 0.03


def known_text(source):
    """The text of a generated page by its marks."""
    page = domtrees.Page(source)
    truth = list(page.truth)
    for i in range(1, len(truth)):
        truth[i] = truth[i] if truth[i] is not None else truth[page.parent[i]]
    return domtrees.text_of(page, np.array([t == "1" for t in truth]), domtrees.Described(page).block)


def test_generated_layouts_held_out(trees):
    """Whole pages, of all layouts: blocks with and without an element around them, bare text, tags left out."""
    sources = list(domtrees.generated(300, seed=4321))
    wrong = sum(got != known_text(s) for got, s in zip(domtrees._texts(sources, trees), sources, strict=True))
    assert wrong <= 0.02 * len(sources)


PARAGRAPHS = ["The first paragraph, of some twenty words, tells what has happened in the town, and who has seen it, and when.", "A second one follows, shorter, with a reason.", "The third says what comes next. Nobody knows, of course."]
MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li><li><a href="/c">Contact</a></li></ul></nav>'
FOOTER = "<footer><p>&copy; 2024 The Company. All rights reserved.</p></footer>"
BODY = "".join(f"<p>{x}</p>" for x in PARAGRAPHS)
OPEN = "".join(f"<p>{x}" for x in PARAGRAPHS)


@pytest.mark.parametrize("source", [
    f"<body><h1>A title</h1>{BODY}</body>", f"<body>{MENU}<h1>A title</h1>{BODY}{FOOTER}</body>", f"<html><head><title>T</title></head><body>{MENU}<h1>A title</h1>{BODY}</body></html>",
    f"<html><head><title>T</title><body><article><h1>A title</h1>{BODY}</article>", f"<!doctype html><title>T</title>{MENU}<h1>A title</h1>{OPEN}{FOOTER}", f"<head><meta charset=utf-8><title>T</title><h1>A title</h1>{OPEN}",
    f"<h1>A title</h1><script src=x /> var a=1; </script>{BODY}", f"<div><div>{MENU}</div><div><h1>A title</h1>{BODY}</div><div class=sidebar><p>Popular posts this week</div></div>{FOOTER}",
    f"<body><main><h1>A title</h1>{BODY}</main><section class='comments'><h3>Comments</h3><div class=comment><p>Nice post, thanks a lot!</p></div></section></body>",
])
def test_common_layouts(trees, source):
    assert next(domtrees._texts([source], trees)) == "\n".join(["A title", *PARAGRAPHS])


def test_text_of_media_in_an_article_stays(trees):
    inner = "".join(f"<figure><{t}>Shown by {t}.</{t}></figure>" for t in ("video", "object", "audio", "canvas")) + "<svg><path d='x'/><text>Drawn.</text></svg>"
    source = f"<body>{MENU}<article><h1>A title</h1>{BODY}{inner}{BODY}</article></body>"
    want = ["A title", *PARAGRAPHS, *(f"Shown by {t}." for t in ("video", "object", "audio", "canvas")), "Drawn.", *PARAGRAPHS]
    assert next(domtrees._texts([source], trees)) == "\n".join(want)


def test_scores_do_not_depend_on_slices(trees, monkeypatch):
    sources = list(domtrees.generated(12, seed=5))
    whole = list(domtrees._texts(sources, trees))
    monkeypatch.setattr(domtrees, "SCORED", 7)
    assert list(domtrees._texts(sources, trees)) == whole


def test_tokens_of_broken_pages():
    def of(source):
        return list(domtrees.iter_tokens(source))

    assert of("a < b <3 </ c") == [("text", "a < b <3 </ c")]
    assert of('x<a href="p>q">y</A >') == [("text", "x"), ("tag", False, "a", ' href="p>q"'), ("text", "y"), ("tag", True, "a", " ")]
    assert of("<b title='x>y") == [("tag", False, "b", " title='x"), ("text", "y")]
    assert of("<!-- <p> -->t<!doctype html><![CDATA[<p>]]>&lt;<p") == [("text", "t"), ("text", "<<p")]
    assert of("<b title='x>y' >z") == [("tag", False, "b", " title='x>y' "), ("text", "z")]
    assert of("<a '>x<i \"k>y") == [("tag", False, "a", " '"), ("text", "x"), ("tag", False, "i", ' "k'), ("text", "y")]
    assert of("<a b=c\"d>e\">f") == [("tag", False, "a", ' b=c"d'), ("text", 'e">f')]
    assert of("<a b = 'c>d' e>f<a x=\"'>\">g") == [("tag", False, "a", " b = 'c>d' e"), ("text", "f"), ("tag", False, "a", " x=\"'>\""), ("text", "g")]
    assert of("<a b='> c <i d='>e") == [("tag", False, "a", " b='> c <i d='"), ("text", "e")]
    assert of("<!-->a<!--->b<!-- c --!>d") == [("text", "a"), ("text", "b"), ("text", "d")]
    assert of("<script src=x /> a</script >b") == [("tag", False, "script", " src=x /"), ("tag", True, "script", " "), ("text", "b")]
    assert of("<script>a<b></script>c") == [("tag", False, "script", ""), ("tag", True, "script", ""), ("text", "c")]
    for source in ("<html><head><title>T</title><body>x", "<head><title>T</title></head>x", "<title>T</title>x", "<head><meta a=b>x", "<head><link><p>x", "<head></head><head>x", "<p>x<head>"):
        assert [t for _, t in domtrees.Page(source).runs] == ["x"]
    page = domtrees.Page("<svg><a/>b</svg><div/>c<math><mi/>d</math>e")
    assert [(page.tag[i], t) for i, t in page.runs] == [("svg", "b"), ("div", "c"), ("math", "d"), ("div", "e")]
    page = domtrees.Page("<ul><li>a<ul><li>b</ul><li>c</ul><p>d<div>e</p>f</div><table><tr><td>g<tr><td>h")
    assert [(page.tag[i], t) for i, t in page.runs] == [("li", "a"), ("li", "b"), ("li", "c"), ("p", "d"), ("div", "e"), ("div", "f"), ("td", "g"), ("td", "h")]


@pytest.mark.parametrize("source", ["<a " * 350_000, "<div>" * 100_000 + "</p>" * 100_000, "<x>" * 100_000 + "</y>" * 100_000, "<ul>" + "<x>" * 50_000 + "<li>" * 50_000, '<a "' * 100_001 + ">", "<" * 1_000_000, "<a '>' " * 150_000, "<a b='>' " * 150_000, "<a b='> " * 150_001, "<a b= " * 150_000 + ">", "<a b=\"'>" * 100_001, "<!--" * 200_000, "<title>" * 100_000])
def test_pages_are_read_in_linear_time(source):
    import time

    began = time.process_time()
    domtrees.Page(source)
    assert time.process_time() - began < 8  # quadratic scans take minutes


def test_odd_pages(spark, trees):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<div><p>a<p>b</span></div></div><!-- x"), (5, "u", "<script>" + "x" * 1000), (6, "u", "<div>" * 400 + "t"), (6, "u", "&amp;&nbsp;&#x41;")]
    got = domtrees.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"), trees).collect()
    assert len(got) == 7 and got[0].text == "" and all(r.n_chars == len(r.text) for r in got)
    assert domtrees.extracted(spark.createDataFrame([], "page_id long, url string, html string"), trees).count() == 0


# 10


def solid(text):
    return re.sub("[^0-9a-z\x80-\U0010ffff]", "", lower(text))


def distance(item, text):
    """Fewest edits of the item against any part of the text."""
    cost = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(cost[j] + 1, new[j - 1] + 1, cost[j - 1] + (a != b)))
        cost = new
    return min(cost)


def test_contamination(spark):
    r = random.Random(8)
    item = lambda: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(r.randint(8, 25)))
    items = [(i, item()) for i in range(20)] + [(90, None), (91, ""), (92, "short")]
    docs = []
    for i in range(60):
        text = items[i % 20][1]
        if i >= 20:
            text = list(text)
            for _ in range(r.randint(0, 8)):
                at = r.randrange(len(text))
                text[at : at + 1] = r.choice(("z", "", "zz"))
            text = "".join(text)
        docs.append((i, item() + ". " + text.upper() + "\n" + item()))
    docs += [(100 + i, item()) for i in range(20)] + [(None, items[0][1]), (300, None), (301, "")]
    b = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = set()
    for d, t in docs:
        for i, x in items:
            p, s = solid(x or ""), solid(t or "")
            if len(p) >= qgrams.Q and distance(p, s) <= min(int(qgrams.EDIT_SHARE * len(p)), (len(p) - qgrams.Q) // qgrams.Q):
                want.add((d, i))
    got = qgrams.contaminated(frame, b).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want
    assert Counter(x.doc_id for x in qgrams.drop_contaminated(frame, b).collect()) == Counter(d for d, t in docs if (d, 0) not in want and not any(w[0] == d for w in want))
    assert qgrams.drop_contaminated(odd(spark), b).columns == odd(spark).columns
    assert qgrams.contaminated(empty(spark), b).count() == 0 and qgrams.contaminated(frame, b.limit(0)).count() == 0


@pytest.mark.parametrize(("hits", "cells"), [(1, 1), (37, 3000), (1 << 20, 1 << 20)])
def test_matches_do_not_depend_on_pieces(monkeypatch, hits, cells):
    """Common q-grams, long items and repeated ones, a few hits and cells at a time."""
    r = random.Random(12)
    line = lambda n: "".join(r.choices("abcdefgh", k=n))
    common, long = line(60), line(4000)
    items = [common + line(40) for _ in range(12)] + [common, common, long, line(30)]
    edited_long = "".join(c if r.random() > 0.02 else r.choice("xyz") for c in long)
    texts = [common * 6 + items[3], line(300), edited_long + line(20), line(9) + items[0][:50] + "z" + items[0][50:], items[15], ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    index = qgrams.Items(list(range(len(items))), items)
    whole = index.matches(data, offsets)
    monkeypatch.setattr(qgrams, "HITS", hits)
    monkeypatch.setattr(qgrams, "CELLS", cells)
    assert index.matches(data, offsets) == whole
    found = {(m[0], m[1]): m[2] for m in whole}
    assert {(0, 3), (0, 12), (0, 13), (2, 14), (3, 0), (4, 15)} <= set(found) and found[0, 12] == 0 and found[3, 0] <= 1
    assert not {m[0] for m in whole} & {1, 5}


# Pipeline and queries


def test_pipeline_stages_against_brute_force(spark, docs, texts):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "mixture", "shards"]
    d = common.written(stages["quality"](spark, docs, SF), "t")
    good = {r.doc_id for r in divergence.judged(docs).where("kept").collect()}
    assert {r.doc_id for r in d.collect()} == good
    d = common.written(stages["near_duplicates"](spark, d, SF), "t")
    want = brute_components([(k, texts[k]) for k in good], 5)
    assert {r.doc_id for r in d.collect()} == {i for i, (_, c) in want.items() if i == c}
    d = common.written(stages["decontamination"](spark, d, SF), "t")
    items = [solid(r.text) for r in common.table(spark, SF, "benchmark").collect()]
    assert all(x not in solid(r.text) for r in d.collect() for x in items)
    d = common.written(stages["mixture"](spark, d, SF), "t")
    assert d.columns == docs.columns and max(Counter(r.doc_id for r in d.collect()).values()) <= 3
    n = d.count()
    out = stages["shards"](spark, d, SF)
    assert out.count() == n


def pipeline_tables(spark, path, rows, items):
    docs = spark.createDataFrame(rows, DOCS)
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs.columns


def test_pipeline_end_to_end_on_odd_rows(spark, tmp_path):
    """Null, empty and long texts, shared ids, copies, benchmark passages and clashing columns, through all stages."""
    r = random.Random(31)
    prose = lambda n: " ".join(r.choice(["the", "of", "and", "to", "in", "is", "that", *[f"w{c}{d}" for c in "abcdefgh" for d in "ijklmnop"]]) for _ in range(n))
    item, texts = prose(40), [prose(120) for _ in range(14)]
    rows = [(100 + i, t, "en", ["a", "b", None][i % 3], len(t), "x", i) for i, t in enumerate(texts)]
    rows += [(50, texts[0], "en", "a", 1, "y", 0), (50, prose(150), "en", "b", 1, "y", 0), (50, texts[1] + " more", "en", "b", 1, None, None), (None, texts[2], "en", "a", 1, "z", 1), (200, prose(60) + " " + item + " " + prose(60), "en", "a", 1, "z", 1)]
    columns = pipeline_tables(spark, tmp_path, rows + ODD, [(1, item), (2, None), (3, "")])
    stages, docs = dict(corpus_pipeline.STAGES), common.table(spark, str(tmp_path), "documents")
    d = common.written(stages["quality"](spark, docs, str(tmp_path)), "t")
    good = [(x.doc_id, x.text) for x in d.collect()]
    assert {t for _, t in good} >= set(texts) and d.columns == columns
    d = common.written(stages["near_duplicates"](spark, d, str(tmp_path)), "t")
    assert sorted(((x.doc_id, x.text) for x in d.collect()), key=repr) == sorted(brute_rows(good, 5)[1], key=repr)
    d = common.written(stages["decontamination"](spark, d, str(tmp_path)), "t")
    clean = [(x.doc_id, x.source, len(words(x.text))) for x in d.collect()]
    assert 200 not in {i for i, _, _ in clean} and (50 in {i for i, _, _ in clean})
    taken = {(x.doc_id, x["size"]): x.taken for x in mixing.mixed(d).collect()}
    d = common.written(stages["mixture"](spark, d, str(tmp_path)), "t")
    assert Counter((x.doc_id, len(words(x.text))) for x in d.collect()) == +Counter({k: int(v / max(k[1], 1) + 0.5) for k, v in taken.items()})
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == d.count() and {x.shard for x in out} <= set(range(16))
    sizes = Counter(x.shard for x in out)
    assert all(sorted(x.slot for x in out if x.shard == k) == list(range(n)) for k, n in sizes.items())
    assert max(sizes[k] for k in range(16)) - min(sizes[k] for k in range(16)) <= 1


def test_pipeline_on_empty_tables(spark, tmp_path):
    pipeline_tables(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered(spark):
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLE_SQL) <= set(entry.queries())

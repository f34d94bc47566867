"""Whitening against eigenvectors of the whole covariance."""

from __future__ import annotations

import numpy as np
import pytest

from tidewater.llm import common, queries, whitening

SF = "/root/testdata/sf0.001"
KINDS = "vec_id long, embedding array<float>, label int, component string, k long"


def brute(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], float]:
    """(explained, whitened, deviations) of the first components, by the covariance itself."""
    x = np.floor(64 * vectors.astype(np.float64)) + 1_000_000
    centred = x - x.mean(0)
    e, v = np.linalg.eigh(centred.T @ centred / len(x))
    e, v = e[::-1][: whitening.COMPONENTS], v[:, ::-1][:, : whitening.COMPONENTS]
    n, sums = len(x), [sum(int(c) for c in col) for col in x.T]
    far = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return e / np.trace(centred.T @ centred / len(x)), centred @ v / np.sqrt(e), far


def check(rows, ids: list[int], vectors: np.ndarray) -> None:
    share, white, far = brute(vectors)
    k = len(share)
    assert len(rows) == len(ids) * k
    got = {(r.vec_id, r.component): r for r in rows}
    found = np.array([[got[i, c + 1].whitened for c in range(k)] for i in ids])
    signs = np.sign((found * white).sum(0))
    assert np.abs(found - white * signs).max() < 1e-6
    assert np.allclose([got[ids[0], c + 1].explained for c in range(k)], share, rtol=1e-10)
    assert [got[i, 1].deviation for i in ids] == far
    assert {r.n for r in rows} == {len(ids)}
    assert len({r.identity_error for r in rows}) == 1
    cov = found.T @ found / len(ids) - np.outer(found.mean(0), found.mean(0))
    assert rows[0].identity_error < 1e-9 and np.abs(cov - np.eye(k)).max() < 1e-9


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_given_embeddings(spark, monkeypatch, parts):
    """However many summaries are merged, in one level or several."""
    monkeypatch.setattr(whitening, "FAN", 3)
    monkeypatch.setattr(whitening, "ROWS", 7)
    df = common.table(spark, SF, "embeddings").repartition(parts)
    kept = [r for r in df.collect() if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
    check(whitening.whitened(df).collect(), [r.vec_id for r in kept], np.array([r.embedding for r in kept], np.float32))


def test_query(spark):
    found = queries.QUERIES["op13_svd_whitening"](spark, SF)
    assert [c for c, _ in found.dtypes] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == common.table(spark, SF, "embeddings").count() * 32


def test_merging_loses_nothing():
    r = np.random.default_rng(1)
    x = (r.normal(size=(500, 6)) * [1e6, 1e3, 1, 1, 1e2, 10] * 64).astype(np.int64) + 10**9
    parts = [whitening.summary(p) for p in np.array_split(x, [3, 4, 50, 51, 400])]
    total = parts[0]
    for p in parts[1:]:
        total = whitening.merged(total, p)
    centred = x - x.mean(0)
    assert total[0] == 500 and (total[1] == x.sum(0)).all()
    want = np.linalg.svd(centred, compute_uv=False)
    assert np.allclose(np.linalg.svd(total[2], compute_uv=False), want, rtol=1e-9)


def test_odd_rows(spark):
    r = np.random.default_rng(2)
    good = r.normal(size=(30, 3)).astype(np.float32)
    rows = [(i, v.tolist(), 1, "x", 2) for i, v in enumerate(good)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows + [(i, v, None, None, None) for i, v in odd], KINDS).repartition(4)
    check(whitening.whitened(df).collect(), list(range(30)), good)


def test_repeated_rows_and_ids(spark):
    r = np.random.default_rng(3)
    v = r.normal(size=(8, 2)).astype(np.float32)
    v[3] = v[2]
    df = spark.createDataFrame([(i // 2 if i < 6 else None, x.tolist(), 1, "x", 2) for i, x in enumerate(v)], KINDS)
    got = whitening.whitened(df).collect()
    share, white, far = brute(v)
    assert sorted(x.deviation for x in got if x.component == 1) == sorted(far)
    assert np.allclose(sorted(abs(x.whitened) for x in got if x.component == 2), sorted(np.abs(white[:, 1])))


def test_no_variance(spark):
    """Equal vectors have no component; a dimension without variance gives none; no rows give none."""
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "x", 2) for i in range(5)], KINDS)
    assert whitening.whitened(same).count() == 0 and whitening.whitened(same.limit(1)).count() == 0
    assert whitening.whitened(same.where("false")).columns == whitening.whitened(same).columns
    flat = spark.createDataFrame([(i, [float(i), 2.0, float(2 * i)], 1, "x", 2) for i in range(5)], KINDS)
    found = whitening.whitened(flat).collect()
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12


def test_deviations_are_exact_or_null():
    a = np.array([[3_000_000_000, 0], [3_037_000_499, 5], [3_037_000_500, 0], [10**13, 10**13]])
    assert whitening.deviations(a) == [9 * 10**18, 3_037_000_499**2 + 25, None, None]


def test_ties_choose_the_longer_vectors(spark):
    df = spark.createDataFrame([(1, [1.0], 1, "x", 2), (2, [2.0], 1, "x", 2), (3, [1.0, 5.0], 1, "x", 2), (4, [2.0, 3.0], 1, "x", 2)], KINDS)
    assert {r.vec_id for r in whitening.whitened(df).collect()} == {3, 4}

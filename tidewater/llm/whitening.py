"""Whitening of embeddings by hierarchical SVD merging.

Entries become whole numbers, x = floor(64 c) + 1000000. Each partition reduces its vectors to a summary: their number, the sums of
their dimensions, and the singular values and right singular vectors of the centred vectors, all of them, so nothing is lost. Two
summaries merge by one more SVD, of both triangles and a row that corrects for the means: sqrt(n1 n2 / (n1 + n2)) times the
difference of the means. Summaries are merged in a tree of FAN at a time, each level a Spark job over what the level before wrote;
what reaches the driver is one summary, d numbers by d for vectors of d dimensions, whatever the number of rows.

The transform reads the vectors once more. Its own covariance, less the identity, is measured over all rows, from centred
summaries that are merged in the same tree.

Precision: vectors are centred as whole numbers (n x - S is exact), so the large offset costs no digits, and singular values of the
centred vectors are taken, never eigenvalues of products.

Defined cases: vectors that are null, empty, or hold null or non-finite entries go; vectors of another length than most (on a tie the
longer length) go, too, as no covariance is defined for them; whole numbers of more than 2^40 in size count as 2^40 (sums stay exact while n times the largest is below 2^63); a component without
variance (a singular value within rounding of zero) can't be scaled to 1 and is left out, so equal vectors alone give no rows;
a deviation beyond a long is null; an empty table gives no rows; repeated rows and ids, null ids included, count one by one; columns
besides the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written

#: The whole numbers' scale and offset.
SCALE, OFFSET = 64, 1_000_000
#: Components that are returned, at most.
COMPONENTS = 32
#: Summaries that one task merges.
FAN = 16
#: Vectors that one SVD takes.
ROWS = 4096
LARGEST = float(1 << 40)

SUMMARY = "k long, n long, sums array<long>, triangle array<double>"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums S (less n times the offset); the components' eigenvalues, falling, the components as rows, and the trace of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def whole(vectors: pa.Array, dimensions: int) -> np.ndarray:
    """x less the offset, as whole numbers, one row per vector."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(flat * SCALE, -LARGEST, LARGEST)).astype(np.int64).reshape(-1, dimensions)


def triangle(rows: np.ndarray) -> np.ndarray:
    """Singular values times right singular vectors of the rows, all of them: what has the same products of columns in d rows at most."""
    _, s, v = np.linalg.svd(rows, full_matrices=False)
    return s[:, None] * v


def summary(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, triangle) of whole-number rows."""
    n, sums = len(x), x.sum(0)
    return n, sums, triangle((n * x - sums) / n)


def merged(one: tuple[int, np.ndarray, np.ndarray], two: tuple[int, np.ndarray, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    """The summary of both's vectors."""
    (n1, s1, t1), (n2, s2, t2) = one, two
    correction = np.sqrt(n1 / (n1 + n2) * n2) * (s1 / n1 - s2 / n2)
    return n1 + n2, s1 + s2, triangle(np.vstack([t1, t2, correction]))


def clean(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is there, not empty, and has finite entries only."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(column).cast("array<double>")
    return vectors.where(F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(entry(x), F.lit(False))), F.lit(False)))


def reduced(parts: DataFrame, merge: Callable[[pa.Table], pa.Table], name: str) -> DataFrame:
    """One row from rows numbered k, merged FAN at a time, level by level; no row from none."""
    parts = written(parts, name)
    while parts.count() > 1:
        # merge() numbers its row k // FAN, so numbers run out and all rows meet.
        parts = written(parts.groupBy(F.floor(F.col("k") / FAN).alias("at")).applyInArrow(merge, parts.schema), name)
    return parts


def _summed(table: pa.Table, dimensions: int) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["k"])
    total = None
    for r in rows:
        own = r["n"], np.array(r["sums"], np.int64), np.array(r["triangle"], np.float64).reshape(-1, dimensions)
        total = own if total is None else merged(total, own)
    return _row(rows[0]["k"] // FAN, *total)


def _row(k: int, n: int, sums: np.ndarray, t: np.ndarray) -> pa.Table:
    return pa.table({"k": pa.array([k], pa.int64()), "n": pa.array([n], pa.int64()), "sums": pa.array([sums.tolist()], pa.list_(pa.int64())), "triangle": pa.array([t.ravel().tolist()], pa.list_(pa.float64()))})


def batches_of(batches: Iterator[pa.RecordBatch], column: str, dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            part = batch.slice(at, ROWS)
            yield part, whole(part.column(column), dimensions)


def same_length(vectors: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The rows whose vector has the commonest length, and that length (0 without rows)."""
    lengths = vectors.groupBy(F.size(column).alias("d")).count().agg(F.max(F.struct("count", "d")).alias("m")).first()["m"]
    return (vectors.where(F.size(column) == lengths["d"]), lengths["d"]) if lengths else (vectors, 0)


def fitted(vectors: DataFrame, column: str = "embedding", components: int | None = COMPONENTS) -> Whitening | None:
    """The whitening of all vectors; ``components``: how many are kept (None: all that have variance). None without vectors."""
    rows, dimensions = same_length(clean(vectors, column), column)
    if not dimensions:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for _, x in batches_of(batches, "v", dimensions):
            if len(x):
                total = summary(x) if total is None else merged(total, summary(x))
        if total:
            yield from _row(TaskContext.get().partitionId(), *total).to_batches()

    parts = rows.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(run, SUMMARY)
    found = reduced(parts, lambda t: _summed(t, dimensions), "white-summaries").first()
    t = np.array(found["triangle"]).reshape(-1, dimensions)
    _, s, v = np.linalg.svd(t, full_matrices=False)
    trace = float((s**2).sum() / found["n"])
    keep = s > s[0] * dimensions * np.finfo(float).eps * 64 if len(s) and s[0] > 0 else np.zeros(len(s), bool)
    s, v = s[keep][:components], v[keep][:components]
    # Either sign is right; the largest entry is made positive, so reruns agree.
    v *= np.sign(v[np.arange(len(v)), np.abs(v).argmax(1)])[:, None]
    return Whitening(found["n"], np.array(found["sums"], np.int64), s**2 / found["n"], v, trace)


def deviations(a: np.ndarray) -> list[int | None]:
    """Sum of the squares of each row, exact; None beyond a long."""
    with np.errstate(over="ignore"):
        exact = (a.astype(np.uint64) ** 2).sum(1, dtype=np.uint64)  # modulo 2^64: exact where the true sum is below that
    rough = (a.astype(np.float64) ** 2).sum(1)
    return [int(e) if r < 9.3e18 and e < 1 << 63 else None for e, r in zip(exact.tolist(), rough.tolist(), strict=True)]


def projected(vectors: DataFrame, model: Whitening, column: str = "embedding", keep: str = "vec_id") -> DataFrame:
    """One row per vector and component: the id, component, n, deviation, whitened, explained."""
    n, sums, scale, share = model.n, model.sums, model.vectors.T / np.sqrt(model.values), model.values / model.trace
    k, dimensions = len(share), len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in batches_of(batches, "v", dimensions):
            a = n * x - sums
            w = a / n @ scale
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                part.column(keep).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n), pa.int64()),
                pa.array(deviations(a), pa.int64()).take(pa.array(each)), pa.array(w.ravel()), pa.array(np.tile(share, len(x)))], RESULT.replace("vec_id", keep).replace(",", "").split()[::2])

    rows = clean(vectors, column).where(F.size(column) == dimensions)
    return rows.select(F.col(keep).cast("long").alias(keep), F.col(column).cast("array<double>").alias("v")).mapInArrow(run, RESULT.replace("vec_id", keep))


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """The largest absolute entry of the covariance of all whitened vectors less the identity."""
    n, sums, scale = model.n, model.sums, model.vectors.T / np.sqrt(model.values)
    k, dimensions = len(model.values), len(sums)

    def row(at: int, count: int, mean: np.ndarray, products: np.ndarray) -> pa.Table:
        return pa.table({"k": pa.array([at], pa.int64()), "n": pa.array([count], pa.int64()), "mean": pa.array([mean.tolist()], pa.list_(pa.float64())), "products": pa.array([products.ravel().tolist()], pa.list_(pa.float64()))})

    def joined(one: tuple, two: tuple) -> tuple:
        (n1, m1, p1), (n2, m2, p2) = one, two
        d = m2 - m1
        return n1 + n2, m1 + d * (n2 / (n1 + n2)), p1 + p2 + np.outer(d, d) * (n1 / (n1 + n2) * n2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for _, x in batches_of(batches, "v", dimensions):
            if len(x):
                w = (n * x - sums) / n @ scale
                centred = w - w.mean(0)
                own = len(w), w.mean(0), centred.T @ centred
                total = own if total is None else joined(total, own)
        if total:
            yield from row(TaskContext.get().partitionId(), *total).to_batches()

    def merge(t: pa.Table) -> pa.Table:
        total, rows = None, sorted(t.to_pylist(), key=lambda r: r["k"])
        for r in rows:
            own = r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)
            total = own if total is None else joined(total, own)
        return row(rows[0]["k"] // FAN, *total)

    rows = clean(vectors, column).where(F.size(column) == dimensions).select(F.col(column).cast("array<double>").alias("v"))
    found = reduced(rows.mapInArrow(run, "k long, n long, mean array<double>, products array<double>"), merge, "white-covariance").first()
    return float(np.abs(np.array(found["products"]).reshape(k, k) / found["n"] - np.eye(k)).max())


def whitened(vectors: DataFrame, column: str = "embedding", keep: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    model = fitted(vectors, column, components)
    if model is None or not len(model.values):
        none = f"{RESULT.replace('vec_id', keep)}, identity_error double"
        return vectors.sparkSession.createDataFrame([], none)
    return projected(vectors, model, column, keep).withColumn("identity_error", F.lit(identity_error(vectors, model, column)))

"""Whitening of embeddings: principal components of a weighted covariance, each scaled to variance one.

Vectors become whole numbers first, so that equal ones are found exactly and sums have no rounding. Equal
vectors are one row with a count; a fit gives each such row its count or one as weight. The covariance is a sum
of centred products that every task makes by matrix multiplication over its rows; only the d x d sums reach the
driver. Each distinct vector is whitened once and joined back to the rows that hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.tables import join_back, written

# Fixed values of the grid: x = floor(64 * entry) + 1000000.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond this many steps of the grid count as this many: doubles hold all whole numbers up to here.
LIMIT = 2**53
COMPONENTS = 16
#: Eigenvalues below this share of the largest are rounding, not variance.
RANK = 1e-12

_LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: weights n, weighted sums by dimension, eigenvectors as columns, eigenvalues, trace."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def on_grid(vector: Column) -> Column:
    """The whole-number form of a vector; null if it is null, empty, or has an entry that is null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT))))
    return F.when(finite & (F.size(vector) > 0), F.transform(vector, lambda c: whole(c).cast("long") + F.lit(OFFSET)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scaled(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exactly: as longs where they fit, else as Python's whole numbers."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
    kind = np.int64 if most < 2**62 else object
    return x.astype(kind) * n - np.array(sums, kind)


def _sums(weight: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                x, w = _matrix(batch.column("x")), batch.column(weight).to_numpy()
                small = int(np.abs(x).max()) * int(w.sum()) < 2**62
                kind = np.int64 if small else object
                part = [int(s) for s in (x.astype(kind) * w.astype(kind)[:, None]).sum(axis=0)]
                total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            values = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values], ["i", "total"])

    return run


def _products(weight: str, rows: Callable[[pa.RecordBatch], np.ndarray]):
    """Weighted sums of products of the rows' columns, of a task: the upper half of a matrix, cell by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                c = rows(batch)
                part = (c * batch.column(weight).to_numpy()[:, None]).T @ c
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    return run


def _covariance(groups: DataFrame, d: int, n: int, weight: str, rows: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    cells = groups.mapInArrow(_products(weight, rows), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d))
    for i, j, v in cells.collect():
        out[i, j] = out[j, i] = v / n
    return out


def fit(groups: DataFrame, d: int, weight: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of `groups` (x of d entries, a column of weights); None without rows."""
    found = dict(groups.mapInArrow(_sums(weight), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total")).collect())
    if not found:
        return None
    n = int(groups.agg(F.sum(weight)).first()[0])
    sums = tuple(int(found[i]) for i in range(d))
    v = _covariance(groups, d, n, weight, lambda b: _scaled(_matrix(b.column("x")), n, sums).astype(np.float64) / n)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > RANK * max(values.max(), 0)]
    vectors = vectors[:, order]
    # Either sign is an eigenvector; the largest entry is made positive.
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]) if len(order) else np.ones(0)
    return Whitening(n, sums, vectors * signs, values[order], float(np.trace(v)))


def _whitened(model: Whitening):
    by_component = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = _scaled(_matrix(batch.column("x")), model.n, model.sums)
            white = (scaled.astype(np.float64) / model.n) @ by_component
            if scaled.dtype == object or len(scaled) and int(np.abs(scaled).max()) ** 2 * scaled.shape[1] > _LONG:
                scaled = scaled.astype(object)
            deviation = [int(s) for s in (scaled * scaled).sum(axis=1)]
            k = white.shape[1]
            offsets = pa.array(np.arange(len(batch) + 1) * k, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"), batch.column("copies"),
                    pa.array([s if s <= _LONG else None for s in deviation], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(white.ravel())),
                ],
                ["x", "copies", "deviation", "white"],
            )

    return run


def whiten(rows: DataFrame, components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of `rows` (vec_id, embedding).

    With `weights="one"` each distinct vector counts once in the fit, with "count" as often as it occurs. n is
    the sum of weights. A row's deviation is the sum over dimensions of (n * x - sum of x)**2, exact; null where
    it does not fit into a long. whitened is its place on a component in units of that component's deviation,
    explained the component's share of the variance, identity_error the largest entry by which the covariance of
    all whitened vectors differs from the identity.

    Rows whose vector is null, empty, or has an entry that is null or not finite give no result; so do rows whose
    vector is not as long as most rows' (at a tie: the longer length), and all rows where no two vectors differ.
    Components without variance are left out, so fewer than `components` may return. Rows with a null or repeated
    vec_id give rows of their own. Other columns are ignored; an empty table gives an empty result.
    """
    rows = rows.select(F.col("vec_id").cast("long"), on_grid(F.col("embedding")).alias("x")).filter("x is not null")
    groups = written(rows.groupBy("x").agg(F.count("*").alias("copies")).withColumn("one", F.lit(1).cast("long")), "distinct-vectors")
    lengths = groups.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    d, total = (usual.d, usual.rows) if usual else (0, 0)
    groups = groups.filter(F.size("x") == d)
    weight = {"one": "one", "count": "copies"}[weights]
    model = fit(groups, d, weight, components) if usual else None
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], names)

    white = written(groups.mapInArrow(_whitened(model), "x array<long>, copies long, deviation long, white array<double>"), "whitened-vectors")
    each = white.withColumn("one", F.lit(1).cast("long"))
    k = len(model.values)
    means = each.agg(*(F.sum(F.col("white")[i] * F.col(weight)).alias(str(i)) for i in range(k))).first()
    means = np.array([m / model.n for m in means])
    spread = _covariance(each, k, model.n, weight, lambda b: _matrix(b.column("white")) - means)
    error = float(np.abs(spread - np.eye(k)).max())

    back = join_back(rows, white, "x", "copies", total)
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    return back.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )

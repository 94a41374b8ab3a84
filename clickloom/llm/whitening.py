"""Whitening of embeddings with covariances by polarisation.

Entries become integers, so all sums are exact. After the sums of the dimensions are known, every value is centred: the whole part of
its dimension's mean is taken off, and what is left of the mean is kept as an exact rest. A second pass adds up the squares of the
centred values of each dimension and of each sum of two dimensions, as integers. The rests turn them into exact variances, and
cov(a, b) = (var(a + b) - var(a) - var(b)) / 2 gives all others: each entry of the matrix is rounded once, when it is divided.
The driver gets these dims * (dims + 1) / 2 numbers, whatever the number of vectors, and assembles them for ``eigh``. Rows stay
where they are; tasks send one number for each sum."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.session import materialize

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 32
#: Scaled entries beyond this are cut to it, so that sums of squares stay within 38 digits.
MOST = 2**50
#: Largest centred value for which a batch of 65,536 rows is summed in 64 bits; larger ones take Python's integers.
NARROW = 1 << 22
_BATCH = 1 << 16

SUMS = "dims int, a int, b int, total decimal(38,0)"


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of the usable rows of a list column, and for each its integers: neither null nor empty, all entries finite."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.array(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), np.int64)
    flat = lists.flatten()
    values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    owner = np.repeat(np.arange(len(sizes)), sizes)
    good = sizes > 0
    good[owner[~np.isfinite(values)]] = False
    rows = np.flatnonzero(good)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(np.clip(SCALE * values, -MOST, MOST))
    x = np.where(np.isfinite(x), x, 0).astype(np.int64) + SHIFT
    begins = np.cumsum(sizes) - sizes
    return rows, [x[begins[k] : begins[k] + sizes[k]] for k in rows] if len(set(sizes[rows])) > 1 else x[np.isin(owner, rows)].reshape(len(rows), -1)


def _matrices(column):
    """The usable rows by length: (row numbers, matrix of integers)."""
    rows, x = whole_numbers(column)
    if isinstance(x, np.ndarray):
        if len(rows):
            yield rows, x
        return
    sizes = np.array([len(v) for v in x])
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        yield rows[own], np.stack([x[k] for k in own])


def _sums(batches):
    """Per task, length and dimension the exact sum; the number of rows as dimension -1."""
    total: dict[int, list[int]] = {}
    for batch in batches:
        for rows, x in _matrices(batch.column("embedding")):
            own = total.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
            # MOST times the rows of a batch is below 2**63 for fewer than 8,192 rows.
            for at in range(0, len(x), 4096):
                for k, value in enumerate(x[at : at + 4096].sum(axis=0).tolist()):
                    own[k] += value
            own[-1] += len(rows)
    yield _batch((size, k if k < size else -1, 0, v) for size, own in total.items() for k, v in enumerate(own))


def _batch(rows) -> pa.RecordBatch:
    from decimal import Decimal

    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.int32())
    arrays = [pa.array(c, kind) for c, kind in zip(columns[:3], kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([Decimal(int(v)) for v in columns[3]], pa.decimal128(38, 0))], ["dims", "a", "b", "total"])


def _squares(middle: np.ndarray):
    """Per task the sums of squared centred values, for each dimension (a = b) and each sum of two dimensions."""
    dims = len(middle)

    def run(batches):
        total = [[0] * (dims - a) for a in range(dims)]
        for batch in batches:
            for _, x in _matrices(batch.column("embedding")):
                if x.shape[1] != dims:
                    continue
                for at in range(0, len(x), _BATCH):
                    y = x[at : at + _BATCH] - middle
                    if np.abs(y).max() > NARROW:
                        y = y.astype(object)
                    y = np.ascontiguousarray(y.T)
                    for a in range(dims):
                        both = y[a:] + y[a]
                        both[0] = y[a]
                        for k, value in enumerate((both * both).sum(axis=1).tolist()):
                            total[a][k] += value
        yield _batch((dims, a, a + k, v) for a, own in enumerate(total) for k, v in enumerate(own))

    return run


@dataclass(frozen=True)
class Whitening:
    """What was learnt from n vectors: ``middle`` and ``rest`` with middle + rest / n the mean of each dimension, unit eigenvectors as
    columns and their eigenvalues, by falling eigenvalue, and the share of each in the trace."""

    n: int
    middle: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle) - self.rest / max(self.n, 1)) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - sum)**2; None beyond 64 bits."""
        y = x - self.middle
        bound = int(np.abs(y).max(initial=0)) * self.n + self.n
        if bound * bound * max(len(self.middle), 1) < 2**63:
            d = y * self.n - self.rest
            return (d * d).sum(axis=1).tolist()
        d = y.astype(object) * self.n - self.rest.astype(object)
        return [v if v < 2**63 else None for v in (d * d).sum(axis=1).tolist()]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Learn from all usable rows of ``vectors`` (embedding)."""
    vectors = vectors.select("embedding")
    sums = vectors.mapInArrow(_sums, SUMS).groupBy("dims", "a").agg(F.sum("total").alias("total"))
    sums = materialize(sums, "sums")
    common = sums.where("a = -1").orderBy(F.col("total").desc(), F.col("dims").desc()).select("dims", "total").first()
    if common is None:
        return Whitening(0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    dims, n = common.dims, int(common.total)
    total = {row.a: int(row.total) for row in sums.where((F.col("dims") == dims) & (F.col("a") >= 0)).collect()}
    middle = np.array([total[k] // n for k in range(dims)], np.int64)
    rest = [total[k] - n * int(middle[k]) for k in range(dims)]
    squared = vectors.mapInArrow(_squares(middle), SUMS).groupBy("a", "b").agg(F.sum("total").alias("total"))
    # n * n times the variance: centred values add up to the rest.
    variance = {
        (row.a, row.b): n * int(row.total) - (rest[row.a] + (rest[row.b] if row.a != row.b else 0)) ** 2 for row in squared.collect()
    }
    covariance = np.empty((dims, dims))
    for (a, b), value in variance.items():
        twice = 2 * value if a == b else value - variance[a, a] - variance[b, b]
        covariance[a, b] = covariance[b, a] = twice / (2 * n * n)
    values, found = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    values, found = values[order], found[:, order]
    kept = np.flatnonzero(values > max(values[0], 0) * dims * np.finfo(float).eps)[:components]
    values, found = values[kept], found[:, kept]
    found = found * np.sign(np.take_along_axis(found, np.abs(found).argmax(axis=0)[None], axis=0)) if len(kept) else found
    return Whitening(n, middle, np.array(rest, np.int64), found, values, values / max(np.trace(covariance), np.finfo(float).tiny))


def _products(model: Whitening):
    """Per task the sums of whitened values (b = -1) and of their products."""
    size = len(model.values)

    def run(batches):
        once, twice = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for _, x in _matrices(batch.column("embedding")):
                if x.shape[1] == len(model.middle):
                    z = model.apply(x)
                    once += z.sum(axis=0)
                    twice += z.T @ z
        a, b = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[np.arange(size), a], pa.int32()), pa.array(np.r_[np.full(size, -1), b], pa.int32()), pa.array(np.r_[once, twice[a, b]])],
            ["a", "b", "total"],
        )

    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity; 0 without components."""
    if not len(model.values):
        return 0.0
    sums = vectors.select("embedding").mapInArrow(_products(model), "a int, b int, total double").groupBy("a", "b").agg(F.sum("total").alias("total"))
    total = {(row.a, row.b): row.total / model.n for row in sums.collect()}
    # Whitened values are centred; their mean differs from zero by rounding alone.
    return max(abs(v - total[a, -1] * total[b, -1] - (a == b)) for (a, b), v in total.items() if b >= 0)


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """The usable rows of ``vectors`` (embedding, ...) with ``deviation`` and ``whitened``, one value for each component.

    Rows whose vector is null, empty, of another length than most (ties: the longer), or with a null or non-finite entry are dropped.
    Every row counts, repeated ones too. Directions without variance are no components, so equal vectors, or one alone, have none and an
    empty list. ``deviation`` is null beyond 64 bits. All other columns are carried, those with an added name replaced."""
    vectors = vectors.drop("deviation", "whitened")
    schema = T.StructType([*vectors.schema.fields, *T.StructType.fromDDL("deviation bigint, whitened array<double>").fields])

    def run(batches):
        for batch in batches:
            for rows, x in _matrices(batch.column("embedding")):
                if x.shape[1] != len(model.middle):
                    continue
                z = model.apply(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(model.deviations(x), pa.int64()), lists], [*batch.schema.names, "deviation", "whitened"])

    return vectors.mapInArrow(run, schema)


def whitened_rows(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), one for each usable vector and component."""
    vectors = vectors.select("vec_id", "embedding")
    model = fit(vectors, components)
    error = identity_error(vectors, model)
    # The embedding itself is read no further.
    found = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(x)) for x in model.explained]) if len(model.explained) else F.array().cast("array<double>")
    return found.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )

"""Whitened embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows of the fit list are a tall matrix X that never leaves the workers. Products with X and
with its transpose alternate: ``X v`` gives the next left vector, ``X' u`` the next right vector, and the
coefficients of both are the two diagonals of a small matrix, whose singular vectors turn the right
vectors into principal components. Every new vector is made orthogonal to all earlier ones twice.

Left vectors are as long as the fit list, so they are not kept: each is X times a short vector, and a
pass works out the part of all of them that belongs to its rows. A pass returns one short row a task, and
these are added up in a tree. A start vector may miss a component (equal deviations, for example), so the
search starts again with a vector orthogonal to all it has, until a start changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.llm.shared import Landing

#: Partial sums added up by one task of the next level.
FAN = 64


@dataclass(frozen=True)
class WhiteningParams:
    """``components`` to find, ``scale`` of the integer grid, and the ``tolerance`` of a component's
    residual against the largest deviation."""

    components: int = 4
    scale: int = 256
    tolerance: float = 1e-14


@dataclass(frozen=True)
class Whitening:
    """``rows`` n of the fit list, exact ``sums`` by dimension, unit ``components`` by falling
    ``variances``, and the ``trace`` of the covariance."""

    rows: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.rows for s in self.sums])


def on_grid(rows: DataFrame, params: WhiteningParams) -> DataFrame:
    """``vec_id, x`` of the rows whose vector is usable: ``x = floor(scale * component)``.

    Not usable are vectors that are null or empty or hold null or non-finite entries, and those of
    another length than most have (the smaller length of two equally frequent).
    """
    finite = F.forall(
        "embedding",
        lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")),
    )
    kept = rows.filter(F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0))
    gridded = kept.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda c: F.floor(c.cast("double") * params.scale).cast("bigint")).alias("x"),
    )
    lengths = kept.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length")
    most = lengths.first()
    return gridded.filter(F.size("x") == (most["length"] if most else 0))


def _summed(rows: DataFrame, partial, width: int) -> np.ndarray:
    """The sum of the vectors that ``partial`` makes of the batches of every task, added up in a tree."""

    def per_task(batches):
        held = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                held += partial(_matrix(batch))
        yield pa.RecordBatch.from_arrays([pa.array([held.tolist()], pa.list_(pa.float64()))], names=["s"])

    def add(batches):
        held = np.zeros(width)
        for batch in batches:
            for vector in batch.column(0):
                held += vector.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([held.tolist()], pa.list_(pa.float64()))], names=["s"])

    tasks = rows.rdd.getNumPartitions()
    sums = rows.select("x").mapInArrow(per_task, "s array<double>")
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        sums = sums.repartition(tasks).mapInArrow(add, "s array<double>")
    return np.sum([r["s"] for r in sums.collect()] or [np.zeros(width)], axis=0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _count_and_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and exact sums: high and low halves are added apart, each far from the limits of a double."""
    low = (1 << 24) - 1

    def partial(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 24).sum(0, dtype=np.float64), (x & low).sum(0, dtype=np.float64)])

    found = _summed(rows, partial, 1 + 2 * width)
    high, rest = found[1 : 1 + width], found[1 + width :]
    return int(found[0]), [(int(a) << 24) + int(b) for a, b in zip(high, rest)]


def _orthogonal(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - others @ (others.T @ vector)
    return vector


class _Search:
    """Right vectors ``v``, the short vectors ``w`` with ``u = X w``, and the bidiagonal matrix."""

    def __init__(self, rows: DataFrame, mean: np.ndarray):
        self.rows, self.mean, self.width = rows, mean, len(mean)
        self.v = np.zeros((self.width, 0))
        self.w = np.zeros((self.width, 0))
        self.diagonal: list[float] = []
        self.beside: list[float] = []

    def times(self, vector: np.ndarray, turned: bool) -> tuple[np.ndarray, float, np.ndarray]:
        """For ``p = X vector``: its products with all left vectors, ``p'p`` and, if asked for, ``X' p``."""
        w, mean, k, width = self.w, self.mean, self.w.shape[1], self.width

        def partial(x: np.ndarray) -> np.ndarray:
            out = np.zeros(k + 1 + width)
            for at in range(0, len(x), 4096):
                centred = x[at : at + 4096] - mean
                p = centred @ vector
                out[:k] += (centred @ w).T @ p
                out[k] += p @ p
                if turned:
                    out[k + 1 :] += centred.T @ p
            return out

        found = _summed(self.rows, partial, k + 1 + width)
        return found[:k], float(found[k]), found[k + 1 :]

    def step(self, start: np.ndarray) -> np.ndarray:
        """One left and one right vector more, from a right vector; returns the next one, unnormalised."""
        size = max([*self.diagonal, *self.beside, 0.0])
        along, square, _ = self.times(start, False)
        # the next left vector without its part in the earlier ones, as a combination of rows
        short = start - self.w @ along
        along, square, turned = self.times(short, True)
        square -= float(along @ along)
        turned = turned - self._turned @ along if self.w.shape[1] else turned
        length = np.sqrt(max(square, 0.0))
        self.v = np.column_stack([self.v, start])
        if length <= 1e-14 * max(size, 1e-300):
            short, turned, length = np.zeros(self.width), np.zeros(self.width), 0.0
        else:
            short, turned = (short - self.w @ along) / length, turned / length
        self.w = np.column_stack([self.w, short])
        self._turned = np.column_stack([self._turned, turned]) if len(self.diagonal) else turned[:, None]
        self.diagonal.append(length)
        return _orthogonal(turned, self.v)

    def values(self, following: float, wanted: int):
        """Components, deviations and residuals of the small matrix, where ``following`` is the length of
        the next right vector."""
        small = np.diag(self.diagonal) + np.diag(self.beside[: len(self.diagonal) - 1], 1)
        left, deviations, right = np.linalg.svd(small)
        residuals = following * np.abs(left[-1, :wanted])
        return self.v @ right[:wanted].T, deviations[:wanted], residuals


def bidiagonalise(rows: DataFrame, mean: np.ndarray, params: WhiteningParams) -> tuple[np.ndarray, np.ndarray]:
    """Unit right singular vectors (as columns) of the centred rows and their singular values."""
    width, wanted = len(mean), min(params.components, len(mean))
    search, settled = _Search(rows, mean), None
    random = np.random.default_rng(0)

    def fresh() -> np.ndarray:
        vector = _orthogonal(random.standard_normal(width), search.v)
        return vector / np.linalg.norm(vector)

    start = fresh()
    while True:
        following = search.step(start)
        length = float(np.linalg.norm(following))
        size = max([*search.diagonal, *search.beside])
        vectors, deviations, residuals = search.values(length, wanted)
        if search.v.shape[1] == width or size == 0:
            return vectors, deviations
        closed = length <= 1e-14 * size
        if len(deviations) == wanted and (closed or residuals.max() <= params.tolerance * size):
            if settled is not None and np.allclose(settled, deviations, rtol=1e-12, atol=1e-14 * size):
                return vectors, deviations
            settled, closed = deviations, True
        search.beside.append(0.0 if closed else length)
        start = fresh() if closed else following / length


def fit(fit_list: DataFrame, params: WhiteningParams = WhiteningParams()) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of ``fit_list``, which is read many times: land it."""
    first = fit_list.first()
    if first is None:
        return None
    width = len(first["x"])
    n, sums = _count_and_sums(fit_list, width)
    mean = np.array([s / n for s in sums])

    def squares(x: np.ndarray) -> np.ndarray:
        return np.array([((x - mean) ** 2).sum()])

    trace = float(_summed(fit_list, squares, 1)[0]) / n
    vectors, deviations = bidiagonalise(fit_list, mean, params)
    kept = deviations > 1e-12 * max(float(deviations.max()), 1e-300)
    vectors, deviations = vectors[:, kept], deviations[kept]
    if len(deviations):
        # of both signs the one with which the largest entry is positive
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return Whitening(n, sums, vectors.T, deviations**2 / n, trace)


def identity_error(fit_list: DataFrame, found: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, mean = len(found.variances), found.mean
    weights = (found.components / np.sqrt(found.variances)[:, None]).T

    def partial(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ weights
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    sums = _summed(fit_list, partial, k + k * k) / found.rows
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, params: WhiteningParams = WhiteningParams()) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row and
    every component (``rows``: ``vec_id, embedding``).

    Rows without vec_id and repeated rows come out like any other; equal vectors count once in the fit.
    Components without variance cannot be whitened and have no rows, so there are fewer than
    ``components`` where the fit list has fewer dimensions, and none for an empty table or for copies
    of one vector. A deviation beyond 64 bits is null.
    """
    store = Landing(rows.sparkSession, "whitening")
    usable = store.land(on_grid(rows, params), "usable")
    fit_list = store.land(usable.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).select("x"), "fit")
    found = fit(fit_list, params)
    out = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    if found is None or not len(found.variances):
        return rows.sparkSession.createDataFrame([], out)
    error, n = identity_error(fit_list, found), found.rows
    weights, mean = (found.components / np.sqrt(found.variances)[:, None]).T, found.mean

    def project(batches):
        for batch in batches:
            if batch.num_rows:
                y = (_matrix(batch) - mean) @ weights
                values = pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], names=["vec_id", "deviation", "y"])

    small = all(abs(s) < 1 << 63 for s in found.sums)
    apart = F.zip_with("x", F.lit(found.sums if small else [0]), lambda c, s: F.try_subtract(F.try_multiply(F.lit(n), c), s))
    deviation = F.aggregate(apart, F.lit(0).cast("bigint"), lambda acc, d: F.try_add(acc, F.try_multiply(d, d)))
    projected = usable.select("vec_id", deviation.alias("deviation"), "x").mapInArrow(
        project, "vec_id bigint, deviation bigint, y array<double>"
    )
    explained = F.lit([float(v / found.trace) for v in found.variances])
    each = projected.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        "whitened", explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )

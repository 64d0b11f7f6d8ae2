"""Whitened embeddings: exact centred scatter, pivoted Cholesky and one-sided Jacobi on its factor."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import stored

#: Components of each vector.
COMPONENTS = 8
#: Steps of an entry's grid, and the number that is added; entries beyond ``REACH`` steps are held there.
STEPS, SHIFT, REACH = 1024.0, 100_000, 2.0 ** 61
#: Whole numbers up to here are doubles without rounding.
EXACT = 2 ** 53
SWEEPS = 60
DIGITS = pa.decimal128(38, 0)


def grid(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(places, x)`` of the usable vectors of each length: none that is NULL or holds NULL or a non-finite entry."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    values = column.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for length in np.unique(size[size > 0]):
        place = np.flatnonzero(size == length)
        entries = values[start[place][:, None] + np.arange(length)]
        whole = np.isfinite(entries).all(axis=1)
        with np.errstate(over="ignore"):
            steps = np.clip(np.floor(STEPS * entries[whole]), -REACH, REACH)
        yield place[whole], steps.astype(np.int64) + SHIFT


def _large(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _exact(x: np.ndarray) -> np.ndarray:
    """Whole numbers as Python numbers, which have no bound."""
    return x.astype(object)


def _products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of whole numbers without rounding, as Python numbers."""
    square = _large(y) ** 2
    total = np.zeros((y.shape[1],) * 2, object)
    if square > EXACT:
        return total + _exact(y).T @ _exact(y)
    rows = EXACT // max(1, square)
    for begin in range(0, len(y), rows):
        part = y[begin:begin + rows].astype(np.float64)
        total += _exact((part.T @ part).astype(np.int64))
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for _, x in grid(batch.column(0)):
            found[x.shape[1]][0] += len(x)
            # A batch has far fewer rows than its sum has room for, unless entries are held at the end of the grid.
            found[x.shape[1]][1] += _exact(x.sum(axis=0)) if _large(x) * len(x) < 2 ** 63 else _exact(x).sum(axis=0)
    for size, (n, total) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * size), pa.array(range(size)), pa.array([n] * size), pa.array(map(Decimal, total), DIGITS)],
            names=["size", "i", "n", "total"])


def _scatter(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in grid(batch.column(0)):
                own = _products(x - centres[x.shape[1]])
                found[x.shape[1]] = found[x.shape[1]] + own if x.shape[1] in found else own
        for size, total in found.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(i)), pa.array(i), pa.array(j), pa.array(map(Decimal, total[i, j]), DIGITS)],
                names=["size", "i", "j", "total"])

    return run


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(factor, order)`` with ``factor @ factor.T == a[order][:, order]``; as many columns as ``a`` has rank."""
    size = len(a)
    factor, order, rest = np.zeros((size, size)), np.arange(size), a.diagonal().copy()
    least = size * np.finfo(float).eps * (rest.max() if size else 0)
    for k in range(size):
        top = k + int(np.argmax(rest[k:]))
        if rest[top] <= least:
            return factor[:, :k], order
        for part in (order, rest, factor):
            part[[k, top]] = part[[top, k]]
        factor[k, k] = np.sqrt(rest[k])
        below = slice(k + 1, None)
        factor[below, k] = (a[order[below], order[k]] - factor[below, :k] @ factor[k, :k]) / factor[k, k]
        rest[below] -= factor[below, k] ** 2
    return factor, order


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns, as rounds of pairs that share no column."""
    ring = list(range(size + size % 2))
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:len(ring) // 2], reversed(ring[len(ring) // 2:])) if max(a, b) < size]
        if pairs:
            yield tuple(np.array(side) for side in zip(*pairs))
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` turned from the right until its columns are orthogonal."""
    w, tiny = factor.copy(), np.finfo(float).eps
    for _ in range(SWEEPS):
        turned = False
        for i, j in _rounds(w.shape[1]):
            a, b = w[:, i], w[:, j]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            open_ = np.abs(ab) > tiny * np.sqrt(aa * bb)
            if not open_.any():
                continue
            turned = True
            i, j, a, b, aa, bb, ab = i[open_], j[open_], a[:, open_], b[:, open_], aa[open_], bb[open_], ab[open_]
            zeta = (bb - aa) / (2 * ab)
            t = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = 1 / np.sqrt(1 + t * t)
            w[:, i], w[:, j] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    return w


class Fit(NamedTuple):
    """Number, exact sums, whole centres, components as columns and their variances, and the variance in all."""

    n: int
    sums: np.ndarray
    centre: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float


def _fit(n: int, sums: np.ndarray, centre: np.ndarray, scatter: np.ndarray, components: int) -> Fit:
    """Python numbers up to the covariance, each entry of which is rounded once."""
    off = sums - n * _exact(centre)
    centred = n * scatter - np.outer(off, off)
    covariance = np.array([[value / n ** 2 for value in row] for row in centred], float)
    factor, order = pivoted_cholesky(covariance)
    turned = np.zeros_like(factor)
    turned[order] = one_sided_jacobi(factor)
    values = (turned * turned).sum(axis=0)
    first = np.argsort(-values, kind="stable")[:components]
    axes = turned[:, first] / np.sqrt(values[first])
    if axes.size:
        axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return Fit(n, sums, centre, axes, values[first], sum(centred.diagonal()) / n ** 2)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of the vectors of each length in the column ``vector``.

    Tasks sum whole numbers, so neither rounding nor the split into tasks plays a part: first the entries, then, with the
    whole number next to each mean taken off, their products. The driver gets one number for each pair of dimensions.
    """
    found = vectors.mapInArrow(_sums, "size long, i long, n long, total decimal(38,0)").groupBy("size", "i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    n, sums = {}, defaultdict(dict)
    for row in found.collect():
        n[row["size"]], sums[row["size"]][row["i"]] = row["n"], int(row["total"])
    sums = {size: np.array([own[i] for i in range(size)], object) for size, own in sums.items()}
    centres = {size: np.array([(2 * s + n[size]) // (2 * n[size]) for s in own], np.int64) for size, own in sums.items()}
    scatter = {size: np.zeros((size, size), object) for size in n}
    products = vectors.mapInArrow(_scatter(centres), "size long, i long, j long, total decimal(38,0)")
    for row in products.groupBy("size", "i", "j").agg(F.sum("total").alias("total")).collect():
        scatter[row["size"]][row["i"], row["j"]] = scatter[row["size"]][row["j"], row["i"]] = int(row["total"])
    return {size: _fit(n[size], sums[size], centres[size], scatter[size], components) for size in n}


def _deviation(y: np.ndarray, own: Fit) -> pa.Array:
    """The sum of ``(n * x - S) ** 2`` over the dimensions, where ``y`` is x without its centre."""
    off = own.sums - own.n * _exact(own.centre)
    if (own.n * (_large(y) + 1)) ** 2 * y.shape[1] < 2 ** 63:
        return pa.array(((own.n * y - off.astype(np.int64)) ** 2).sum(axis=1)).cast(DIGITS)
    return pa.array(map(Decimal, ((own.n * _exact(y) - off) ** 2).sum(axis=1)), DIGITS)


def _whitened(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, x in grid(batch.column(1)):
                own, size = fits[x.shape[1]], x.shape[1]
                y = x - own.centre
                mean = ((own.sums - own.n * _exact(own.centre)) / own.n).astype(float)
                z = ((y - mean) @ own.axes) / np.sqrt(own.values)
                offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(place)), pa.array([size] * len(z), pa.int64()), pa.array([own.n] * len(z), pa.int64()),
                     _deviation(y, own), pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))],
                    names=["vec_id", "size", "n", "deviation", "z"])

    return run


def _moments(widths: dict[int, int], means: dict[int, np.ndarray] | None):
    """Sums of the whitened numbers, or of the products of what they are off their means."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes, rows = batch.column(0).to_numpy(), batch.column(1)
            for size in np.unique(sizes):
                own = rows.filter(pa.array(sizes == size))
                z = own.flatten().to_numpy().reshape(len(own), widths[size])
                part = z.sum(axis=0) if means is None else ((z - means[size]).T @ (z - means[size])).ravel()
                found[size] = found[size] + part if size in found else part
        for size, total in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(total), pa.int64()), pa.array(np.arange(len(total))), pa.array(total, pa.float64())],
                names=["size", "i", "total"])

    return run


def _identity_errors(whitened: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """The largest entry of the covariance of the whitened numbers minus the identity, by length of the vectors."""
    widths = {size: len(own.values) for size, own in fits.items()}

    def totals(means: dict[int, np.ndarray] | None) -> dict[int, np.ndarray]:
        rows = whitened.select("size", "z").mapInArrow(_moments(widths, means), "size long, i long, total double")
        found = {size: {} for size in fits}
        for size, i, total in rows.groupBy("size", "i").agg(F.sum("total")).collect():
            found[size][i] = total / fits[size].n
        return {size: np.array([own[i] for i in range(len(own))]) for size, own in found.items()}

    covariances = totals(totals(None))
    return {size: float(np.abs(c - np.eye(widths[size]).ravel()).max(initial=0)) for size, c in covariances.items()}


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable vector and component.

    An entry c becomes ``x = floor(1024 * c) + 100000``. The covariance of x, divisor n, comes from exact whole numbers; its
    pivoted Cholesky factor is turned by one-sided Jacobi rotations until its columns are orthogonal, so their squared
    norms are the variances and the columns divided by their norms the components, numbered by falling variance; the
    largest entry of a component is positive. ``deviation`` is exact, a decimal of 38 digits. ``whitened`` is x without the
    mean on the component over the root of its variance, ``explained`` the component's share of all variance, and
    ``identity_error`` how far the covariance of ``whitened`` is from the identity.

    Vectors that are NULL or hold NULL or non-finite entries are left out. Vectors of different lengths are fits of their
    own; empty ones have no components. Only components with variance count: equal vectors, or one alone, give no rows.
    Entries beyond 2^61 steps count as that many. Repeated rows count each time; a NULL id stays NULL; other columns are not
    read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fits = fit(rows.select("vector"), components)
    whitened = stored(rows.mapInArrow(_whitened(fits), "vec_id long, size long, n long, deviation decimal(38,0), z array<double>"))
    errors = _identity_errors(whitened, fits) if fits else {}
    facts = [(size, k, float(value / own.trace), errors[size]) for size, own in fits.items() for k, value in enumerate(own.values, 1)]
    facts = vectors.sparkSession.createDataFrame(facts, "size long, component int, explained double, identity_error double")
    each = whitened.select("vec_id", "size", "n", "deviation", F.posexplode("z").alias("place", "whitened"))
    return each.withColumn("component", F.col("place") + 1).join(facts, ["size", "component"]).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")

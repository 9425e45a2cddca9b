"""Whitening of embeddings along the leading eigenvectors, found by spectrum slicing.

Entries become whole numbers (``scale`` steps a unit), so counts, sums and the
covariance are exact whatever the order of the tasks: vectors are centred by the
rounded mean, products of the small rests are summed as integers, and what the
rounding left over is subtracted exactly. Spark does every pass over the table;
the driver holds one number per pair of dimensions.

There, the inertia of V - s*I = L D L^T (Bunch-Kaufman pivots) counts the
eigenvalues above s. Bisection on these counts isolates the k-th largest one,
Rayleigh quotient iteration converges to it cubically, and two more counts around
the result certify its number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import quoted
from corpusloom.session import collect_bounded, materialize

SCALE = 256
MAX_ENTRY = 1 << 31
MAX_DIMENSION = 4096
BLOCK_ROWS = 4096
EXACT = 1 << 53


class SpectrumError(ValueError):
    """An eigenvalue could not be isolated or certified."""


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(positive, zero, negative) eigenvalues of a symmetric matrix, by L D L^T.

    Pivots of one or two rows, chosen as by Bunch and Kaufman; only D is kept.
    """
    a = np.array(a, dtype=np.float64)
    n = len(a)
    alpha = (1 + math.sqrt(17)) / 8
    counts = [0, 0, 0]
    k = 0

    def swap(p: int, q: int) -> None:
        if p != q:
            a[[p, q]] = a[[q, p]]
            a[:, [p, q]] = a[:, [q, p]]

    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        below = float(column.max()) if len(column) else 0.0
        size = 1
        if below > 0 and abs(a[k, k]) < alpha * below:
            other = np.abs(a[k:, r]).copy()
            other[r - k] = 0
            beside = float(other.max())
            if abs(a[k, k]) * beside >= alpha * below * below:
                pass
            elif abs(a[r, r]) >= alpha * beside:
                swap(k, r)
            else:
                swap(k + 1, r)
                size = 2
        if size == 1:
            d = a[k, k]
            counts[0 if d > 0 else 1 if d == 0 else 2] += 1
            if d != 0:
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k] / d, a[k + 1 :, k])
        else:
            # A pivot of two rows has a negative determinant: one root of each sign.
            counts[0] += 1
            counts[2] += 1
            d = a[k : k + 2, k : k + 2].copy()
            left = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= left @ np.linalg.solve(d, left.T)
        k += size
    return counts[0], counts[1], counts[2]


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of v are larger than the shift."""
    return inertia(v - shift * np.eye(len(v)))[0]


def leading_eigenpairs(v: np.ndarray, wanted: int, tolerance: float = 1e-13) -> list[tuple[float, np.ndarray]]:
    """The largest eigenvalues of a covariance with their unit vectors, falling.

    Only eigenvalues above ``tolerance`` times the largest row sum are given, so
    there may be fewer than wanted. Equal eigenvalues get orthogonal vectors.
    """
    n = len(v)
    bound = float(np.abs(v).sum(axis=1).max()) if n else 0.0
    if bound == 0.0:
        return []
    least = tolerance * bound * n
    found: list[tuple[float, np.ndarray]] = []
    basis = np.zeros((n, 0))
    rng = np.random.default_rng(12)
    for k in range(1, min(wanted, n) + 1):
        if above(v, least) < k:
            break
        # Invariant: at least k eigenvalues above low, fewer than k above high.
        low, high = least, bound * (1 + 1e-12)
        many, few = above(v, low), 0
        while (many > k or few < k - 1 or high - low > 0.1 * high) and high - low > 4e-16 * n * bound:
            middle = (low + high) / 2
            count = above(v, middle)
            if count >= k:
                low, many = middle, count
            else:
                high, few = middle, count
        value, vector = _rayleigh(v, low, high, basis, rng, bound)
        # Counts around the value certify that it is the k-th largest.
        margin = 64 * n * 2.3e-16 * bound
        if above(v, value + margin) > k - 1 or above(v, value - margin) < k:
            raise SpectrumError(f"eigenvalue {k} is not certified by the counts")
        found.append((value, vector))
        basis = np.column_stack([basis, vector])
    return found


def _rayleigh(v: np.ndarray, low: float, high: float, basis: np.ndarray, rng: np.random.Generator, bound: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration inside an isolating interval, orthogonal to the basis."""
    n = len(v)

    def cleaned(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - basis @ (basis.T @ x)
        return x / np.linalg.norm(x)

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(v - shift * np.eye(n), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (shift + 1e-15 * bound) * np.eye(n), x)
        return cleaned(y / np.abs(y).max())

    for _ in range(8):
        x = cleaned(rng.standard_normal(n))
        middle = (low + high) / 2
        for _ in range(6):
            x = solved(middle, x)
        value = float(x @ v @ x)
        best = (math.inf, value, x)
        for _ in range(24):
            residual = float(np.linalg.norm(v @ x - value * x))
            if residual < best[0]:
                best = (residual, value, x)
            elif best[0] <= 1e-13 * bound:
                break
            x = solved(value, x)
            value = float(x @ v @ x)
        slack = 64 * n * 2.3e-16 * bound
        if best[0] <= 1e-11 * bound and low - slack <= best[1] <= high + slack:
            return best[1], best[2]
    raise SpectrumError("the Rayleigh quotient left its interval")


@dataclass(frozen=True)
class Spectrum:
    """Fit rows n, exact sums, and the leading eigenvalues with their unit vectors."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: tuple[float, ...]
    vectors: np.ndarray

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n * x - sums)^2 of each row, exact."""
        rests = self._rests(x)
        if rests.dtype == object or np.abs(rests).max(initial=0) ** 2 * len(self.sums) >= 2.0**63:
            rests = rests.astype(object)
        return [int(s) for s in (rests * rests).sum(axis=1)]

    def _rests(self, x: np.ndarray) -> np.ndarray:
        if self.n * MAX_ENTRY >= 1 << 62:
            x = x.astype(object)
        return x * self.n - np.array(self.sums, dtype=x.dtype)[None, :]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        centred = self._rests(x).astype(np.float64) / self.n
        return (centred @ self.vectors) / np.sqrt(np.array(self.values))[None, :]


def whole_steps(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(_id, _x): vectors as whole numbers floor(scale * entry).

    Rows are left out if the vector is null or empty or holds null or non-finite
    entries, or entries of 2**31 steps or more, which no exact sum could hold.
    """
    x = F.transform(quoted(vector_col), lambda c: F.floor(c.cast("double") * scale))
    fits = F.forall(quoted(vector_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < MAX_ENTRY / scale))
    usable = (F.size(quoted(vector_col)) > 0) & F.coalesce(fits, F.lit(False))
    return df.where(usable).select(quoted(id_col).cast("long").alias("_id"), x.cast("array<long>").alias("_x"))


def _matrix(batch: pa.RecordBatch, name: str = "_x") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, total = 0, None
    for block in _blocks(batches):
        x = _matrix(block)
        rows += len(x)
        part = x.sum(axis=0)
        # Kept as Python integers between blocks, so no task can overflow.
        total = [int(p) for p in part] if total is None else [t + int(p) for t, p in zip(total, part)]
    if rows:
        yield pa.RecordBatch.from_pydict({"i": list(range(len(total))), "n": [rows] * len(total), "s": [str(t) for t in total]})


def _exact_gram(y: np.ndarray) -> np.ndarray:
    """Products of all pairs of columns, exact: in doubles where every sum stays below 2**53."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < EXACT:
        d = y.astype(np.float64)
        return (d.T @ d).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


def _centred_products(centre: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            gram = _exact_gram(_matrix(block) - np.array(centre, dtype=np.int64)[None, :])
            total = gram if total is None else total + gram
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict({"i": i.tolist(), "j": j.tolist(), "s": [str(v) for v in total[i, j]]})

    return run


def fit(vectors: DataFrame, components: int = 4) -> tuple[Spectrum | None, DataFrame]:
    """The spectrum of the distinct vectors of (_id, _x), and the table of these.

    Three passes: distinct vectors (one shuffle), their sums, their centred
    products. Partial sums are exact integers; only one row per dimension or pair
    of dimensions reaches the driver. Vectors must be of one length, see
    ``whiten``. None for an empty table.
    """
    fitted = materialize(vectors.select("_x").distinct(), "fit-vectors")
    sums = fitted.mapInArrow(_column_sums, "i long, n long, s string").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sorted((r["i"], r["n"], int(r["s"])) for r in collect_bounded(sums, MAX_DIMENSION, "dimensions"))
    if not rows:
        return None, fitted
    n, total = rows[0][1], [r[2] for r in rows]
    centre = [(2 * s + n) // (2 * n) for s in total]
    products = fitted.mapInArrow(_centred_products(centre), "i long, j long, s string")
    products = products.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    size = len(total)
    gram = np.zeros((size, size), dtype=object)
    for r in collect_bounded(products, MAX_DIMENSION * (MAX_DIMENSION + 1) // 2, "pairs of dimensions"):
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = int(r["s"])
    rest = np.array([s - n * c for s, c in zip(total, centre)], dtype=object)
    # n * sum(y y^T) - sum(y) sum(y)^T is n^2 times the covariance, in integers.
    exact = gram * n - np.outer(rest, rest)
    square = n * n
    covariance = np.array([[_ratio(v, square) for v in row] for row in exact])
    pairs = leading_eigenpairs(covariance, components)
    vectors_ = np.stack([p[1] for p in pairs], axis=1) if pairs else np.zeros((size, 0))
    trace = _ratio(sum(int(exact[i, i]) for i in range(size)), square)
    return Spectrum(n, tuple(total), trace, tuple(p[0] for p in pairs), vectors_), fitted


def _ratio(a: int, b: int) -> float:
    """Quotient of two integers of any size, rounded once."""
    return int(a) / int(b)


def _moments(spectrum: Spectrum, mean: list[float] | None):
    """Sums of whitened values, or of products of their centred values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            w = spectrum.whiten(_matrix(block))
            part = w.sum(axis=0)[None, :] if mean is None else (w - np.array(mean)).T @ (w - np.array(mean))
            total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_pydict({"i": i.ravel().tolist(), "j": j.ravel().tolist(), "s": total.ravel().tolist()})

    return run


def identity_error(spectrum: Spectrum, fitted: DataFrame) -> float:
    """Largest entry of the covariance of the whitened fit rows minus the identity."""
    k = len(spectrum.values)
    if not k:
        return 0.0

    def summed(mean: list[float] | None) -> np.ndarray:
        rows = fitted.mapInArrow(_moments(spectrum, mean), "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
        out = np.zeros((1 if mean is None else k, k))
        for r in collect_bounded(rows, k * k, "pairs of components"):
            out[r["i"], r["j"]] = r["s"]
        return out / spectrum.n

    return float(np.abs(summed(summed(None)[0].tolist()) - np.eye(k)).max())


def _whitened(spectrum: Spectrum):
    k = len(spectrum.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            x = _matrix(block)
            row = np.repeat(np.arange(len(x)), k)
            deviations = spectrum.deviations(x)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("_id").take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array([deviations[r] for r in row], pa.int64()), pa.array(spectrum.whiten(x).ravel()),
                    pa.array(np.tile(np.array(spectrum.values) / spectrum.trace, len(x))),
                ],
                ["_id", "component", "deviation", "whitened", "explained"],
            )

    return run


WHITENED = "_id long, component int, deviation long, whitened double, explained double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = SCALE) -> DataFrame:
    """(_id, component, n, deviation, whitened, explained, identity_error).

    One row for each usable row of ``df`` and each of the leading components,
    numbered from 1 by falling eigenvalue. The fit list is each distinct vector
    of whole steps once. Rows that ``whole_steps`` leaves out are not in the
    result; neither are rows whose vector differs in length from most (of equally
    frequent lengths, from the longest). Components without variance are left
    out, so equal vectors only, or one row, give no rows, and neither does an
    empty table. Equal eigenvalues get any orthogonal vectors. Rows that repeat an
    id, null included, are separate rows. Other columns are not read. ``deviation``
    must fit a long; a job that would exceed it fails.
    """
    spark = df.sparkSession
    steps = whole_steps(df, id_col, vector_col, scale)
    lengths = steps.groupBy(F.size("_x").alias("size")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    steps = steps.where(F.size("_x") == (common[0]["size"] if common else 0))
    spectrum, fitted = fit(steps, components)
    if spectrum is None or not spectrum.values:
        rows, error, n = spark.createDataFrame([], WHITENED), 0.0, 0
    else:
        rows, error, n = steps.mapInArrow(_whitened(spectrum), WHITENED), identity_error(spectrum, fitted), spectrum.n
    return rows.select("_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))

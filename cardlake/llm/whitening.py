"""Embedding whitening: leading eigenvectors by a block Jacobi-Davidson iteration.

The covariance is never formed. Every step multiplies it with a thin block of vectors:
tasks centre their rows, multiply them twice and add up, and one small block comes
back. The iteration keeps a subspace, takes Ritz pairs from it, locks pairs whose
residual has reached double precision, and widens the subspace by the corrections of the
others, which MINRES solves roughly, orthogonally to what is known, for all in lockstep.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.shared import stored

COMPONENTS = 16
#: Entries are multiplied by this and rounded down. A constant added to all of them, as
#: some layouts have it, changes neither covariance nor deviations.
SCALE = 64
#: Residuals, against the largest eigenvalue, that count as double precision; where the
#: rounding of the sums does not allow them, they must have stopped falling below FLOOR.
TOLERANCE = 64 * np.finfo(float).eps
FLOOR = 1e-12
INNER_STEPS = 8
MAX_ROUNDS = 200
#: Entries are whole numbers below this; larger ones leave no room to add.
LARGEST = 2.0**62

Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Whitening:
    """What whitening needs to know; a few vectors, whatever the number of rows.

    ``sums`` are those of the rounded entries. ``directions`` holds a
    column per component.
    """

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


# ------------------------------------------------------------------ rows to matrices


def _rounded(column: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Which rows hold a usable vector, and for each row its rounded entries or None."""
    usable = np.zeros(len(column), bool)
    lengths = np.zeros(len(column), np.int64)
    present = ~column.is_null().to_numpy(zero_copy_only=False)
    if not len(column) or not present.any():
        return usable, [None] * len(column)
    lengths[present] = np.diff(column.offsets.to_numpy())[present]
    flat = column.flatten()
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = np.floor(flat.cast(pa.float64()).fill_null(0.0).to_numpy() * scale)
    bad = missing | ~(np.abs(values) < LARGEST)
    whole = np.where(bad, 0.0, values).astype(np.int64)
    ends = np.cumsum(lengths)
    faults = np.concatenate([[0], np.cumsum(bad)])
    usable = present & (lengths > 0) & (faults[ends] == faults[ends - lengths])
    return usable, [
        whole[end - n : end] if ok else None
        for ok, end, n in zip(usable.tolist(), ends.tolist(), lengths.tolist(), strict=True)
    ]


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dimensions)


def fit_list(frame: DataFrame, vector_col: str, scale: float = SCALE) -> DataFrame:
    """Each distinct usable vector once: ``entries`` (whole numbers, 64 bits each).

    Equal vectors meet in partial aggregates before any row is shuffled.
    """

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = _rounded(batch.column(0), scale)
            found = [r.tobytes() for r in rows if r is not None]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["entries"])

    return frame.select(vector_col).mapInArrow(rounded, "entries binary").distinct()


def _summed(
    fit: DataFrame, size: int, part: Callable[[Iterator[pa.RecordBatch]], np.ndarray], kind: str
) -> list:
    """Sums over all tasks of the ``size`` numbers that ``part`` finds in each."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = part(batches)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array(values)], names=["place", "value"]
        )

    rows = (
        fit.mapInArrow(found, f"place int, value {kind}")
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    out = [0] * size
    for place, value in rows:
        out[place] = value
    return out


def _moments(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums; entries are added in two halves of 31 bits."""

    def part(batches):
        total = np.zeros(2 * dimensions + 1, np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), dimensions)
            total[0] += len(rows)
            total[1 : dimensions + 1] += (rows >> 31).sum(0)
            total[dimensions + 1 :] += (rows & 0x7FFFFFFF).sum(0)
        return total

    n, *halves = _summed(fit, 2 * dimensions + 1, part, "long")
    high, low = halves[:dimensions], halves[dimensions:]
    return n, [(h << 31) + s for h, s in zip(high, low, strict=True)]


def _product(fit: DataFrame, n: int, mean: np.ndarray) -> Product:
    """Covariance times a block, without the covariance."""
    dimensions = len(mean)
    context = fit.sparkSession.sparkContext

    def times(block: np.ndarray) -> np.ndarray:
        # dimensions x a few columns, at most a few megabytes
        shipped = context.broadcast((mean, block))

        def part(batches):
            centre, columns = shipped.value
            total = np.zeros(columns.shape)
            for batch in batches:
                rows = _matrix(batch.column(0), dimensions) - centre
                total += rows.T @ (rows @ columns)
            return total.ravel()

        out = np.array(_summed(fit, block.size, part, "double")) / n
        shipped.unpersist()
        return out.reshape(block.shape)

    return times


# ------------------------------------------------------------------------- iteration


def _cleared(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The block without its part in the orthonormal bases; twice, for rounding."""
    for _ in range(2):
        for basis in bases:
            block = block - basis @ (basis.T @ block)
    return block


def _orthonormal(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block adds to the bases."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    left, size, _ = np.linalg.svd(_cleared(block, *bases), full_matrices=False)
    return np.linalg.qr(_cleared(left[:, size > 1e-8], *bases))[0]


def corrections(
    times: Product, known: np.ndarray, values: np.ndarray, residuals: np.ndarray,
    steps: int = INNER_STEPS,
) -> np.ndarray:
    """Solutions t of P (A - value) P t = -residual, P projecting out ``known``.

    MINRES on every column at once, so a step costs one product for all of them. It
    stops early when all residuals are a thousandth of the first.
    """
    v = _cleared(-residuals, known)
    beta = np.linalg.norm(v, axis=0)
    first, tiny = beta.copy(), 1e-300
    v = v / np.maximum(beta, tiny)
    solution = np.zeros_like(v)
    before, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    cos, sin, cos_before, sin_before = np.ones_like(beta), 0 * beta, np.ones_like(beta), 0 * beta
    left, link = beta.copy(), 0 * beta
    for _ in range(steps):
        image = _cleared(times(v) - v * values, known)
        alpha = (v * image).sum(0)
        following = image - alpha * v - link * before
        after = np.linalg.norm(following, axis=0)
        far = sin_before * link
        near = cos * cos_before * link + sin * alpha
        diagonal = cos * alpha - sin * cos_before * link
        length = np.hypot(diagonal, after)
        alive = length > 1e-14 * np.abs(values).max()
        length = np.where(alive, length, 1.0)
        w, w_before = (v - near * w - far * w_before) / length, w
        cos_before, sin_before = cos, sin
        cos, sin = diagonal / length, after / length
        solution = solution + np.where(alive, cos * left, 0.0) * w
        left = np.where(alive, -sin * left, 0.0)
        before, link = v, after
        v = following / np.maximum(after, tiny)
        if np.all(np.abs(left) <= 1e-3 * first):
            break
    return _cleared(solution, known)


def leading(
    times: Product, dimensions: int, wanted: int, tolerance: float = TOLERANCE
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and their eigenvectors, as columns.

    The subspace is cut back to its best vectors when it grows beyond four times
    ``wanted``. Raises ArithmeticError if residuals neither reach the tolerance nor stop
    falling at the floor of rounding.
    """
    wanted = min(wanted, dimensions)
    locked = np.zeros((dimensions, 0))
    start = np.random.default_rng(1).standard_normal((dimensions, min(dimensions, wanted + 8)))
    basis = _orthonormal(start)
    images = times(basis)
    largest, lowest, stuck = 0.0, np.inf, 0
    for _ in range(MAX_ROUNDS):
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        largest = max(largest, values[0])
        missing = wanted - locked.shape[1]
        residuals = _cleared(images[:, :missing] - basis[:, :missing] * values[:missing], locked)
        sizes = np.linalg.norm(residuals, axis=0)
        stuck = 0 if sizes[0] < 0.5 * lowest else stuck + 1
        lowest = min(lowest, sizes[0])
        allowed = tolerance if stuck < 3 else FLOOR
        done = int(np.argmin(np.append(sizes <= allowed * largest, False)))
        if done:
            locked = np.hstack([locked, basis[:, :done]])
            basis, images = basis[:, done:], images[:, done:]
            lowest, stuck = np.inf, 0
        if locked.shape[1] == wanted:
            return _checked(times, locked, largest)
        missing -= done
        if basis.shape[1] + missing > max(4 * wanted, 32):
            basis, images = basis[:, : 2 * missing], images[:, : 2 * missing]
        known = np.hstack([locked, basis[:, :missing]])
        if known.shape[1] < dimensions and basis.shape[1] + locked.shape[1] < dimensions:
            step = corrections(times, known, values[done : done + missing], residuals[:, done:])
            added = _orthonormal(step, locked, basis)
        else:
            added = basis[:, :0]
        if added.shape[1]:
            basis, images = np.hstack([basis, added]), np.hstack([images, times(added)])
        else:
            # nothing left to add: start over from clean images of the same subspace
            basis = _orthonormal(basis, locked)
            images = times(basis)
    raise ArithmeticError(f"{locked.shape[1]} of {wanted} eigenvectors found")


def _checked(times: Product, found: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Ritz pairs of all locked vectors from a fresh product, signs fixed."""
    found = np.linalg.qr(found)[0]
    images = times(found)
    small = found.T @ images
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, found, images = values[::-1], found @ turn[:, ::-1], images @ turn[:, ::-1]
    worst = np.linalg.norm(images - found * values, axis=0).max()
    if worst > 4 * FLOOR * largest:
        raise ArithmeticError(f"a residual of {worst} is left")
    sign = np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
    return values, found * sign


# -------------------------------------------------------------------------- operator


def fitted(
    frame: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS,
    scale: float = SCALE,
) -> Whitening:
    """Statistics and leading eigenvectors of the distinct rounded vectors.

    Null vectors, empty ones, and those with null, non-finite or over-large (2^62 after scaling)
    entries take no part; neither do vectors of another length than most distinct ones
    (the longer of two as frequent). Directions without variance are left out, so
    equal vectors, one vector or an empty table give no component. The order of equal
    eigenvalues and the basis of their space are arbitrary.
    """
    fit = stored(fit_list(frame, vector_col, scale), "fit")
    size = F.expr("octet_length(entries) div 8").cast("int")
    common = fit.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    dimensions = common[0]
    fit = fit.where(size == dimensions)
    n, sums = _moments(fit, dimensions)
    mean = np.array([s / n for s in sums])
    values, directions = leading(_product(fit, n, mean), dimensions, components)
    kept = values > dimensions * TOLERANCE * max(values[0], 0.0)
    values, directions = values[kept], directions[:, kept]
    trace, error = _spread(fit, n, mean, values, directions)
    return Whitening(n, sums, values, directions, trace, error)


def _spread(
    fit: DataFrame, n: int, mean: np.ndarray, values: np.ndarray, directions: np.ndarray
) -> tuple[float, float]:
    """Trace of the covariance, and how far whitened rows are from unit covariance."""
    k, whiten = len(values), directions / np.sqrt(values)

    def part(batches):
        total = np.zeros(1 + k + k * k)
        for batch in batches:
            rows = _matrix(batch.column(0), len(mean)) - mean
            white = rows @ whiten
            total[0] += (rows * rows).sum()
            total[1 : k + 1] += white.sum(0)
            total[k + 1 :] += (white.T @ white).ravel()
        return total

    squares, *rest = np.array(_summed(fit, 1 + k + k * k, part, "double")) / n
    centre, second = np.array(rest[:k]), np.array(rest[k:]).reshape(k, k)
    off = np.abs(second - np.outer(centre, centre) - np.eye(k))
    return float(squares), float(off.max(initial=0.0))


def _deviations(rows: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sums of squares of n * row - sums; null beyond 64 bits."""
    if n * int(np.abs(rows).max(initial=0)) + max(map(abs, sums)) < 2**62:
        apart = n * rows - np.array(sums, np.int64)
        small = (apart.astype(float) ** 2).sum(1) < 2.0**62
        found = (apart * apart).sum(1).tolist()
    else:
        small, found = np.zeros(len(rows), bool), [0] * len(rows)
    for i in np.flatnonzero(~small):
        exact = sum((n * x - s) ** 2 for x, s in zip(rows[i].tolist(), sums, strict=True))
        found[i] = exact if exact < 2**63 else None
    return pa.array(found, pa.int64())


def whitened(
    frame: DataFrame, model: Whitening, vector_col: str = "embedding", scale: float = SCALE
) -> DataFrame:
    """Rows with a usable vector, with ``deviation`` (long) and ``whitened`` (array<double>).

    Other rows, and those of another length than the model's, are dropped. Columns
    named like these two are replaced. ``whitened`` has an entry per component.
    ``deviation`` is the sum of squares of n * x - S, exact, null beyond 64 bits.
    """
    kept = [c for c in frame.columns if c not in ("deviation", "whitened")]
    at = kept.index(vector_col)
    rows = frame.select(*kept)
    schema = T.StructType(
        [*rows.schema, T.StructField("deviation", T.LongType()),
         T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    )
    if not model.n:
        return rows.where(F.lit(False)).withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in schema.fields[-2:]}
        )
    # at most dimensions x components numbers
    shipped = rows.sparkSession.sparkContext.broadcast(
        (model.n, model.sums, model.mean, model.directions / np.sqrt(model.eigenvalues))
    )

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, mean, whiten = shipped.value
        for batch in batches:
            _, found = _rounded(batch.column(at), scale)
            places = [i for i, r in enumerate(found) if r is not None and len(r) == len(sums)]
            if not places:
                continue
            matrix = np.stack([found[i] for i in places])
            white = (matrix - mean) @ whiten
            ends = np.arange(len(places) + 1, dtype=np.int32) * white.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(places)).columns, _deviations(matrix, n, sums), lists],
                names=schema.names,
            )

    return rows.mapInArrow(projected, schema)

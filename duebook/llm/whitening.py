"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed. A pass sends a block of directions to the vectors, every task adds up the
centred product XᵀXQ of its own vectors, and Spark sums the tasks' sums. A round damps the unwanted end of the
spectrum with a Chebyshev polynomial, one pass per degree, makes the block orthonormal again (QR), rotates it to
its Ritz vectors (Rayleigh-Ritz, one more pass) and looks at their residuals. Rounds end when every wanted
direction is certified: its residual is at the level of rounding.

Only blocks of (dimensions x directions) reach the driver; vectors are whole numbers, so that their sums, the
centre and each deviation are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructType

from duebook.llm.common import packed, staged

#: Added to every scaled entry, as the contract of the whole numbers says.
SHIFT = 1_000_000


@dataclass(frozen=True)
class Iteration:
    """``guard`` directions beside the wanted ones keep the border of the block away from them.

    A residual is certified at ``certain`` times the largest eigenvalue, or when it is below ``near`` and a
    round no longer halves it. Directions with less than ``null`` of the largest eigenvalue have no
    scale and are left out.
    """

    components: int = 32
    guard: int = 16
    degree: int = 10
    lanczos: int = 8
    most_rounds: int = 60
    certain: float = 2e-14
    near: float = 1e-11
    null: float = 1e-12
    seed: int = 7


@dataclass(frozen=True)
class Whitening:
    """What was fitted. ``sums`` are exact; eigenvalues fall; ``axes`` has one column per component."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    axes: np.ndarray
    trace: float
    residual: float
    passes: int
    rounds: int
    identity_error: float = field(default=0.0)

    @property
    def projection(self) -> np.ndarray:
        return self.axes / np.sqrt(self.eigenvalues)


def integers(vectors: DataFrame, row: Column | None = None, name: str = "embedding") -> DataFrame:
    """``row`` (of the packed row) and ``x``: floor(64 * entry) + 1,000,000 of every usable vector.

    Vectors that are NULL, empty, or hold a NULL or non-finite entry are dropped. If lengths differ, those of
    the most frequent length stay (of the longer one, if two are equally frequent).
    """
    source = packed(vectors).where(F.size(f"row.{name}") > 0)
    entries = F.transform(f"row.{name}", lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = source.where(~bad).select(
        (F.col("row") if row is None else row).alias("row"),
        F.transform(entries, lambda c: F.floor(c * 64) + F.lit(SHIFT)).alias("x"),
    )
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    found = lengths.first()
    return usable.where(F.size("x") == (found.d if found else 0))


def _matrix(frame: pa.RecordBatch) -> np.ndarray:
    column = frame.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n: the whole part of the mean is subtracted exactly, the rest of it is below one."""
    whole, rest = np.divmod(sums, n)
    return (x - whole) - rest / n


def _total(vectors: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of ``part`` of a batch, a matrix.

    A task adds its batches; the cells of the tasks' matrices are summed by Spark before the driver sees them.
    """

    def partial(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for frame in frames:
            if frame.num_rows:
                found = part(_matrix(frame))
                sums = found if sums is None else sums + found
        if sums is not None:
            width = np.full(sums.size, sums.shape[1])
            columns = [pa.array(v) for v in (np.arange(sums.size), width, sums.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "width", "value"])

    cells = vectors.select("x").mapInArrow(partial, "cell long, width long, value double")
    table = cells.groupBy("cell", "width").agg(F.sum("value").alias("value")).toArrow().sort_by("cell")
    return table.column("value").to_numpy().reshape(-1, table.column("width")[0].as_py())


def _exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    def partial(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            if frame.num_rows:
                s = _matrix(frame).sum(axis=0)
                i, n = np.arange(len(s)), np.full(len(s), frame.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, s, n)], ["i", "s", "n"])

    rows = vectors.select("x").mapInArrow(partial, "i long, s long, n long").groupBy("i")
    totals = rows.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    found = totals.orderBy("i").collect()  # one row per dimension
    return (found[0].n if found else 0), [int(r.s) for r in found]


class _Operator:
    """Covariance times a block of directions, one pass over the vectors each."""

    def __init__(self, vectors: DataFrame, n: int, sums: np.ndarray):
        self._vectors, self._n, self._sums = vectors, n, sums
        self.passes = 0

    def __call__(self, block: np.ndarray) -> np.ndarray:
        n, sums = self._n, self._sums

        def product(x: np.ndarray) -> np.ndarray:
            z = _centred(x, n, sums)
            return z.T @ (z @ block)

        self.passes += 1
        return _total(self._vectors, product) / n

    def trace(self) -> float:
        n, sums = self._n, self._sums

        def squares(x: np.ndarray) -> np.ndarray:
            return np.sum(_centred(x, n, sums) ** 2).reshape(1, 1)

        return float(_total(self._vectors, squares)[0, 0]) / n

    def gram(self, projection: np.ndarray) -> np.ndarray:
        n, sums = self._n, self._sums

        def product(x: np.ndarray) -> np.ndarray:
            w = _centred(x, n, sums) @ projection
            return w.T @ w

        return _total(self._vectors, product) / n


def _lower_bound(covariance: _Operator, start: np.ndarray, steps: int) -> float:
    """No eigenvalue is below it: the smallest Ritz value of a Lanczos run less its last residual."""
    basis, diagonal, beside = [start / np.linalg.norm(start)], [], []
    for _ in range(steps):
        new = covariance(basis[-1][:, None])[:, 0]
        diagonal.append(basis[-1] @ new)
        for vector in basis:
            new = new - (vector @ new) * vector
        beside.append(np.linalg.norm(new))
        if beside[-1] <= 1e-12 * max(diagonal[0], 1e-300):
            break
        basis.append(new / beside[-1])
    off = beside[: len(diagonal) - 1]
    ritz = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    return max(0.0, float(ritz[0] - beside[-1]))


def _filtered(
    covariance: _Operator, block: np.ndarray, low: float, high: float, top: float, degree: int
) -> np.ndarray:
    """The block under a Chebyshev polynomial that is small on [low, high] and scaled to 1 at ``top``."""
    centre, half = (low + high) / 2, (high - low) / 2
    scale = half / (top - centre)
    twice = 2 / scale
    before, now = block, (covariance(block) - centre * block) * (scale / half)
    for _ in range(degree - 1):
        next_scale = 1 / (twice - scale)
        new = (covariance(now) - centre * now) * (2 * next_scale / half) - scale * next_scale * before
        before, now, scale = now, new, next_scale
    return now


def fit(vectors: DataFrame, settings: Iteration = Iteration()) -> Whitening | None:
    """The leading directions of a *written* table of :func:`integers`.

    None where there is nothing to scale: no vectors, or all of them equal.
    """
    n, exact = _exact_sums(vectors)
    if not n:
        return None
    covariance = _Operator(vectors, n, np.array(exact, np.int64))
    trace = covariance.trace()
    if trace <= 0:
        return None
    dimensions = len(exact)
    wanted = min(settings.components, dimensions)
    size = min(wanted + settings.guard, dimensions)
    random = np.random.default_rng(settings.seed)
    low = _lower_bound(covariance, random.standard_normal(dimensions), settings.lanczos) if size < dimensions else 0.0
    block = np.linalg.qr(random.standard_normal((dimensions, size)))[0]
    worst = np.inf
    for rounds in range(settings.most_rounds):
        product = covariance(block)
        values, rotation = np.linalg.eigh((block.T @ product + product.T @ block) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        block, product = block @ rotation, product @ rotation
        before = worst
        worst = np.linalg.norm(product - block * values, axis=0)[:wanted].max() / values[0]
        if size == dimensions or worst <= settings.certain or (worst <= settings.near and worst > before / 2):
            break
        high = max(values[-1], low + 1e-9 * values[0])
        block = _filtered(covariance, block, low, high, values[0], settings.degree)
        block = np.linalg.qr(block)[0]
    else:
        raise ArithmeticError(f"residual {worst:.1e} after {settings.most_rounds} rounds")
    keep = np.flatnonzero(values[:wanted] > settings.null * values[0])
    axes = block[:, keep]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(keep))])
    projection = axes / np.sqrt(values[keep])
    error = float(np.abs(covariance.gram(projection) - np.eye(len(keep))).max())
    return Whitening(
        n, tuple(exact), values[keep], axes, trace, float(worst), covariance.passes, rounds + 1, error
    )


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[Decimal]:
    """Sum over the dimensions of (n * x - sums) squared, exact at any size."""
    whole, rest = np.divmod(np.array(sums, np.int64), n)
    difference = x - whole
    if len(sums) * (n * (np.abs(difference).max(initial=0) + 1.0)) ** 2 < 2**62:
        return [Decimal(v) for v in ((n * difference - rest) ** 2).sum(axis=1).tolist()]
    rests = rest.tolist()
    return [Decimal(sum((n * v - r) ** 2 for v, r in zip(row, rests))) for row in difference.tolist()]


def whitened(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """``row``, ``deviation`` (decimal) and ``whitened``, an array with one entry per component."""
    n, sums, projection = fitted.n, fitted.sums, fitted.projection

    def project(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            if not frame.num_rows:
                continue
            x = _matrix(frame)
            values = _centred(x, n, np.array(sums, np.int64)) @ projection
            offsets = np.arange(len(x) + 1, dtype=np.int32) * projection.shape[1]
            columns = [
                frame.column("row"),
                pa.array(_deviations(x, n, sums), pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "deviation", "whitened"])

    schema = StructType([vectors.schema["row"]])
    schema.add("deviation", DecimalType(38, 0)).add("whitened", ArrayType(DoubleType()))
    return vectors.select("row", "x").mapInArrow(project, schema)


def components(
    embeddings: DataFrame, row: Column | None = None, settings: Iteration = Iteration()
) -> DataFrame:
    """One row per usable vector and component: ``row``, ``component`` from 1, ``n``, ``deviation``,
    ``whitened``, ``explained`` (its share of the trace) and ``identity_error``.

    Repeated rows count as often as they stand there. A table without usable vectors, or with equal ones only,
    has no component and gives no rows; components without variance are left out.
    """
    vectors = staged(integers(embeddings, row), "whitening-vectors")
    fitted = fit(vectors, settings)
    if fitted is None:
        none = vectors.where(F.lit(False)).select("row")
        return none.select(
            "row", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
            F.lit(0).cast("decimal(38,0)").alias("deviation"),
            *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")),
        )
    shares = F.array(*(F.lit(float(e / fitted.trace)) for e in fitted.eigenvalues))
    rows = whitened(vectors, fitted).select("row", "deviation", F.posexplode("whitened").alias("i", "value"))
    return rows.select(
        "row", (F.col("i") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), shares[F.col("i")].alias("explained"),
        F.lit(fitted.identity_error).alias("identity_error"),
    )

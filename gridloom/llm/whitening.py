"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows A are never multiplied out to a covariance. Every step multiplies A
by a direction of the vector space (Xv) and the transpose of A by what comes out
(Xᵀu); the two products of a step are made in one pass over blocks of rows, and only
sums of as many numbers as a vector is long leave it. A left vector u, one number a
row, is never stored: it is A w for a short w the driver keeps. Both sides are
reorthogonalised in full against all earlier ones, the left side by inner products
that the same pass adds up. What remains is a small bidiagonal matrix whose singular
values and vectors give the deviations and components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.frames import col, scratch
from gridloom.plans.joins import store

SCALE, SHIFT = 1024.0, 100_000
BLOCK_BYTES = 2 * 1024 * 1024
LARGEST = float(2**62)  # entries from here on are no long numbers


@dataclass
class Whitening:
    """What the driver keeps: numbers by dimension and component, none by row."""

    n: int
    sums: list[int]  # of the whole numbers, by dimension
    components: np.ndarray  # one row for each component
    values: np.ndarray  # variance along each component, falling
    trace: float


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * SCALE >= LARGEST))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size(v) > 0)


def whole(vectors: pa.Array) -> np.ndarray:
    """Rows of whole numbers: the floor of each entry times the scale, shifted."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("f8")
    return np.floor(flat.reshape(len(vectors), -1) * SCALE).astype(np.int64) + SHIFT


def _column_sums(x: np.ndarray) -> list[int]:
    if len(x) and len(x) * int(np.abs(x).max()) < 2**62:
        return [int(s) for s in x.sum(axis=0)]
    return [int(s) for s in x.astype(object).sum(axis=0)]


def scaled_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: 64-bit numbers, or Python's where those are too short."""
    most = max([abs(s) for s in sums], default=0) + n * int(np.abs(x).max(initial=0))
    if most < 2**62:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def exact_squares(d: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    if d.dtype != object and d.shape[1] * float(np.abs(d).max(initial=0)) ** 2 < 2.0**62:
        return np.einsum("ij,ij->i", d, d).tolist()
    return [int(s) for s in (d.astype(object) ** 2).sum(axis=1)] if len(d) else []


def _sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums = 0, None
    for batch in batches:
        if not len(batch):
            continue
        x = whole(batch.column("vector"))
        part = _column_sums(x)
        sums = part if sums is None else [a + b for a, b in zip(sums, part)]
        n += len(x)
    if n:
        values = [Decimal(n), *map(Decimal, sums)]
        yield pa.record_batch(
            [pa.array(range(len(values)), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["slot", "value"]
        )


def _blocks_of(n: int, sums: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    rows = max(1, BLOCK_BYTES // (8 * len(sums)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            for at in range(0, len(batch), rows):
                d = scaled_deviations(whole(vectors.slice(at, rows)), n, sums)
                centred = (d / n).astype(np.float64)
                yield pa.record_batch([pa.array([centred.tobytes()], pa.binary())], names=["block"])

    return blocks


def _step_of(width: int, w: np.ndarray, left: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Xv and Xᵀu of every block, added up in the task: first Xᵀ(Xw), then the
    products of Xw with earlier left vectors, its square, and the sum of squares of
    all entries."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back, inner, own, entries, seen = np.zeros(width), np.zeros(left.shape[1]), 0.0, 0.0, False
        for batch in batches:
            for data in batch.column("block"):
                x, seen = np.frombuffer(data.as_buffer(), dtype=np.float64).reshape(-1, width), True
                y = x @ w
                back += x.T @ y
                inner += (x @ left).T @ y
                own += float(y @ y)
                entries += float(np.einsum("ij,ij->", x, x))
        if seen:
            values = np.concatenate([back, inner, [own, entries]])
            yield pa.record_batch([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], names=["slot", "value"])

    return step


def _added(df: DataFrame, fn: Callable, kind: str) -> list:
    """Sums by slot over all tasks, in order; as many rows as there are slots."""
    rows = df.mapInArrow(fn, f"slot int, value {kind}").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    return [r["value"] for r in sorted(rows, key=lambda r: r["slot"])]


class _Bidiagonal:
    """The growing bidiagonalisation: right vectors V, short forms W of the left
    vectors (u = A w), Xᵀu of each, and the two diagonals."""

    def __init__(self, blocks: DataFrame, width: int, seed: int) -> None:
        self.blocks, self.width = blocks, width
        self.rng = np.random.default_rng([seed, width])
        self.right, self.left, self.backs = (np.zeros((width, 0)) for _ in range(3))
        self.alphas: list[float] = []
        self.betas: list[float] = []
        self.entries = 0.0

    def _orthogonal(self, r: np.ndarray) -> np.ndarray:
        for _ in range(2):  # twice is enough
            r = r - self.right @ (self.right.T @ r)
        return r

    def fresh(self) -> np.ndarray:
        """A unit direction outside what was found, where the space breaks off."""
        r = self._orthogonal(self.rng.standard_normal(self.width))
        return r / np.linalg.norm(r)

    def product(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        got = np.array(_added(self.blocks, _step_of(self.width, w, self.left), "double"))
        self.entries = float(got[-1])
        return got[: self.width], got[self.width : -2], float(got[-2])

    def step(self, v: np.ndarray, beta: float) -> tuple[np.ndarray, float]:
        """Add ``v``; the next right vector and its place on the second diagonal."""
        w = v - beta * self.left[:, -1] if self.alphas else v
        back, inner, own = self.product(w)
        # u is Xw less its parts along earlier left vectors; Xᵀ of those is known
        rest = own - float(inner @ inner)
        if rest < 0.5 * own and own > 0:
            w = w - self.left @ inner
            back, inner, own = self.product(w)
            rest = own - float(inner @ inner)
        scale = np.sqrt(max(rest, 0.0))
        self.right = np.column_stack([self.right, v])
        floor = 1e-14 * np.sqrt(self.entries)
        if scale > floor:
            w, back = (w - self.left @ inner) / scale, (back - self.backs @ inner) / scale
        else:  # no row has anything along v that is not found yet
            scale, w, back = 0.0, np.zeros(self.width), np.zeros(self.width)
        self.left, self.backs = np.column_stack([self.left, w]), np.column_stack([self.backs, back])
        self.betas.append(beta)
        self.alphas.append(scale)
        r = self._orthogonal(back - scale * v)
        size = float(np.linalg.norm(r))
        return (r / size, size) if size > floor else (np.zeros(0), 0.0)

    def singular(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Deviations times the root of n, components, and the last entry of each
        left vector, by which what is missing shows."""
        k = len(self.alphas)
        b = np.diag(np.array(self.alphas)) + np.diag(np.array(self.betas[1:]), 1) if k > 1 else np.array([[self.alphas[0]]])
        u, s, vt = np.linalg.svd(b)
        return s, self.right @ vt.T, u[-1]


def fit_whitening(
    df: DataFrame, vector: str = "embedding", components: int = 8, steps: int | None = None, tolerance: float = 1e-13, seed: int = 11
) -> Whitening | None:
    """Means, components and deviations of all usable vectors; None without any.

    ``steps`` bounds the passes over the blocks. By default the space is exhausted:
    as many as a vector is long, so that no component is missed, not even one of two
    equal variances. With fewer, it stops once the wanted values do not move by more
    than ``tolerance`` of the largest.
    """
    usable = df.where(_usable(col(vector))).select(col(vector).cast("array<double>").alias("vector"))
    # vectors of the most common length; of two as common, the longer
    lengths = usable.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return None
    width = common["width"]
    usable = usable.where(F.size("vector") == width)
    totals = [int(v) for v in _added(usable, _sums_of, "decimal(38,0)")]
    n, sums = totals[0], totals[1:]
    blocks = store(usable.mapInArrow(_blocks_of(n, sums), "block binary"))
    lanczos = _Bidiagonal(blocks, width, seed)
    most = width if steps is None else min(steps, width)
    v, beta = lanczos.fresh(), 0.0
    while len(lanczos.alphas) < most:
        v, beta = lanczos.step(v, beta)
        if len(lanczos.alphas) < width and not len(v):
            v = lanczos.fresh()
        if steps is not None and len(lanczos.alphas) >= components:
            s, _, ends = lanczos.singular()
            if (beta * np.abs(ends[:components]) <= tolerance * s[0]).all():
                break
    s, directions, _ = lanczos.singular()
    kept = min(components, int((s > 1e-12 * s[0]).sum())) if s[0] > 0 else 0
    return Whitening(n, sums, np.ascontiguousarray(directions[:, :kept].T), s[:kept] ** 2 / n, lanczos.entries / n)


def _apply(fit: Whitening) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = fit.components.T / np.sqrt(fit.values)
        for batch in batches:
            vectors = batch.column(batch.num_columns - 1)
            d = scaled_deviations(whole(vectors), fit.n, fit.sums) if len(batch) else np.zeros((0, len(fit.sums)))
            y = (d / fit.n).astype(np.float64) @ scale
            offsets = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
            squares = [Decimal(s) if s < 10**38 else None for s in exact_squares(d)]
            yield pa.record_batch(
                [
                    *batch.columns[:-1],
                    pa.array(squares, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(offsets, pa.array(y.ravel(), pa.float64())),
                ],
                names=[*batch.schema.names[:-1], "deviation", "whitened"],
            )

    return applied


def whiten(df: DataFrame, fit: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each usable vector of the fitted length: ``key``, ``deviation``
    (decimal, the sum over dimensions of (n * x - sum)^2, exact; null beyond 38
    digits) and ``whitened``, an array with a number for each component."""
    own = df.where(_usable(col(vector)) & (F.size(col(vector)) == len(fit.sums)))
    own = own.select(col(key).alias("key"), col(vector).cast("array<double>").alias("vector"))
    kind = df.schema[key].dataType.simpleString()
    return own.mapInArrow(_apply(fit), f"key {kind}, deviation decimal(38,0), whitened array<double>").withColumnRenamed("key", key)


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if len(batch):
            y = np.array(batch.column("whitened").flatten()).reshape(len(batch), -1)
            part = np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])
            total = part if total is None else total + part
    if total is not None:
        yield pa.record_batch([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["slot", "value"])


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity,
    from the rows themselves; 0 without components."""
    if not components:
        return 0.0
    got = np.array(_added(whitened.select("whitened"), _gram, "double"))
    second, mean = got[: components**2].reshape(components, components) / n, got[components**2 :] / n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(components)).max())


def whitened_components(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """One row for each usable vector and component, from 1 by falling variance.

    A vector counts as whole numbers, floor(1024 c) + 100000. One that is null or
    empty, holds a null or non-finite entry, or one too large for a long, or is not
    as long as most are, has no rows; nor has any where there is no variance at all.
    Components without variance are left out. Repeated rows and keys stay, null keys
    too; other columns are dropped, whatever their names. Columns: ``key``,
    ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``. A pass reads the stored blocks and shuffles as many numbers a
    task as a vector is long; the driver holds a few matrices of that width.
    """
    fit = fit_whitening(df, vector, components)
    kind = df.schema[key].dataType.simpleString()
    if fit is None or not len(fit.values):
        names = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, {names}")
    rows = store(whiten(df, fit, key, vector))
    error = identity_error(rows, fit.n, len(fit.values))
    shares = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    at, part = scratch(rows, "at", "part")
    return rows.select(col(key), "deviation", F.posexplode("whitened").alias(at, part)).select(
        col(key),
        (col(at) + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        col(part).alias("whitened"),
        F.element_at(shares, col(at) + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

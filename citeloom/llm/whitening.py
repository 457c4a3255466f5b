"""Embedding whitening: exact distributed covariance, float32 eigenvectors refined in higher precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import in_arrow
from citeloom.llm.vectors import whole_vectors
from citeloom.session import cut_lineage

COMPONENTS = 16
# Entries as whole numbers: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
# Entries of this size or more count as not finite; sums of squares then fit 38 digits.
LARGEST = float(1 << 40)
EXACT = "decimal(38,0)"
# Rows multiplied at once, and steps of one refinement at most; three or four are usual.
ROWS = 4096
STEPS = 30
# Eigenvalues this close, as a part of their spread, are clustered, by the precision of the start: its
# error over this distance must be well below the distance.
NEAR = {np.float32: 3e-3, np.float64: 1e-7}


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n fit vectors, their sums by dimension, unit components (columns) by
    falling eigenvalue, all eigenvalues, and the largest error of the whitened covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def usable(self) -> np.ndarray:
        """Components whose eigenvalue is above rounding: others have no spread to divide by."""
        least = len(self.sums) * np.finfo(np.float64).eps * max(self.trace, 0.0)
        return self.eigenvalues[: self.components.shape[1]] > least


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def number_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that count: id, x (whole numbers)."""
    small = F.forall(vector_col, lambda c: c.isNull() | (F.abs(c.cast("double")) < LARGEST))
    # a number too large for the sums is taken for one that is not finite
    rows = vectors.select(F.col(id_col).alias("id"), F.when(small, F.col(vector_col)).alias("vector"))
    return whole_vectors(rows).select("id", whole_numbers(F.col("vector")).alias("x"))


# ---------------------------------------------------------------- covariance


def centred(column: pa.Array, anchor: np.ndarray) -> np.ndarray:
    """The vectors of a batch less a vector of whole numbers, exact."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) - anchor


def exact_products(y: np.ndarray) -> np.ndarray:
    """The sum of the products of all pairs of entries over all rows, as exact Python numbers."""
    total = np.zeros((y.shape[1],) * 2, dtype=object)
    largest = int(np.abs(y).max(initial=0))
    for at in range(0, len(y), ROWS):
        part = y[at : at + ROWS]
        if largest * largest * len(part) < 1 << 53:  # whole numbers in doubles: no rounding
            part = part.astype(np.float64)
            total += (part.T @ part).astype(np.int64).astype(object)
        else:
            part = part.astype(object)
            total += part.T @ part
    return total


def sums_of(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of fit vectors and their sums by dimension: as many numbers as dimensions."""
    entries = fit.select(F.posexplode("x").alias("i", "v"))
    found = entries.groupBy("i").agg(F.sum(F.col("v").cast(EXACT)).alias("total"), F.count(F.lit(1)).alias("n")).collect()
    return (found[0].n if found else 0), [int(r.total) for r in sorted(found, key=lambda r: r.i)]


def products_of(fit: DataFrame, anchor: np.ndarray) -> list[list[int]]:
    """Summed products of all pairs of dimensions of the centred fit vectors.

    Every task sends one square of numbers, which Spark sums entry by entry; the driver gets as many
    numbers as there are pairs of dimensions.
    """
    d = len(anchor)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            total += exact_products(centred(batch.column("x"), anchor))
        rows = [[Decimal(int(v)) for v in row] for row in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array(rows, pa.list_(pa.decimal128(38, 0)))], names=["i", "products"]
        )

    parts = in_arrow(fit.select("x"), made, f"i int, products array<{EXACT}>")
    entries = parts.select("i", F.posexplode("products").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = [[0] * d for _ in range(d)]
    for r in entries.collect():
        out[r.i][r.j] = int(r.v)
    return out


def covariance(n: int, sums: list[int], anchor: np.ndarray, products: list[list[int]]) -> np.ndarray:
    """Covariance with divisor n in extended precision, from exact numbers: nothing cancels.

    The vectors were centred at whole numbers next to the mean; what is left of the mean is taken off here.
    """
    rest = [s - n * int(a) for s, a in zip(sums, anchor)]
    d = len(sums)
    out = np.zeros((d, d), dtype=np.longdouble)
    for i in range(d):
        for j in range(i + 1):
            exact = Fraction(n * products[i][j] - rest[i] * rest[j], n * n)
            high = float(exact)
            out[i, j] = out[j, i] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    return out


# ---------------------------------------------------------------- eigenvectors


def clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Places of falling values, cut where two neighbours are further apart than ``near``."""
    return np.split(np.arange(len(values)), np.flatnonzero(-np.diff(values) > near) + 1)


def refined(a: np.ndarray, x: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """Ogita and Aishima's iteration: eigenvalues, falling, and orthonormal vectors from approximate ones.

    With R = I - X'X and S = X'AX the correction E has (S + l_j R) / (l_j - l_i) for eigenvalues of different
    clusters (see ``clusters``) and R / 2 within one; X becomes X + XE, and the error is squared. Vectors of
    one cluster span the right space then, but are not told apart. First steps run in float64, the
    last ones in the precision of ``a``.
    """
    eye, full = np.eye(len(a), dtype=a.dtype), a.dtype
    for kind in (np.dtype(np.float64), full):
        b, x, last = a.astype(kind), x.astype(kind), np.inf
        for _ in range(STEPS):
            r = eye.astype(kind) - x.T @ x
            s = x.T @ b @ x
            values = np.diag(s) / (1 - np.diag(r))
            order = np.argsort(-values, kind="stable")
            cluster = np.empty(len(a), dtype=int)
            for number, own in enumerate(clusters(values[order], near)):
                cluster[order[own]] = number
            apart = values[None, :] - values[:, None]
            clear = cluster[None, :] != cluster[:, None]
            e = np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
            x = x + x @ e
            size = float(np.abs(e).max(initial=0))
            if size <= 8 * float(np.finfo(kind).eps) or size > last / 2:
                break
            last = size
    values = np.diag(x.T @ a @ x) / np.sum(x * x, axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def solved(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and orthonormal eigenvectors in the precision of a symmetric matrix.

    The float32 solution is refined; a cluster that this cannot tell apart is solved on its own: the matrix
    projected on its space, less the mean of its values, is a smaller one whose differences count
    again. Where a cluster is nearly as wide as all values, the start is the float64 solution.
    """
    n, eps = len(a), float(np.finfo(a.dtype).eps)
    shift = np.trace(a) / max(n, 1)
    centred_a = a - np.eye(n, dtype=a.dtype) * shift
    scale = np.abs(centred_a).max(initial=0)
    if scale <= 8 * eps * np.abs(a).max(initial=0):
        return np.diag(a), np.eye(n, dtype=a.dtype)
    b = centred_a / scale
    for start, near in NEAR.items():
        values, x = refined(b, np.linalg.eigh(b.astype(start))[1][:, ::-1], near)
        groups = clusters(values, near)
        if max(values[g[0]] - values[g[-1]] for g in groups) < (values[0] - values[-1]) / 2:
            break
    for own in groups:
        if len(own) > 1:
            basis = x[:, own]
            small = basis.T @ b @ basis
            small = (small + small.T) / 2
            small -= np.eye(len(own), dtype=a.dtype) * values[own[0]]
            if np.abs(small).max() > 8 * eps:
                x[:, own] = basis @ solved(small)[1]
    values = np.diag(x.T @ b @ x) * scale + shift
    return values, x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling and 0 or more, and unit eigenvectors to double precision."""
    values, x = solved(a)
    x = x / np.sqrt(np.sum(x * x, axis=0))
    return np.maximum(values, 0).astype(np.float64), x.astype(np.float64)


# ---------------------------------------------------------------- fit and use


def projected(y: np.ndarray, model: Whitening, rest: np.ndarray) -> np.ndarray:
    """Centred rows on the usable components, at unit variance; NaN on the others."""
    out = np.full((len(y), len(model.usable)), np.nan)
    own = np.flatnonzero(model.usable)
    out[:, own] = (y - rest) @ (model.components[:, own] / np.sqrt(model.eigenvalues[own]))
    return out


def anchored(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers, and what it is more than these."""
    anchor = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(anchor, dtype=np.int64), np.array([float(Fraction(s, n) - a) for s, a in zip(sums, anchor)])


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the whitened fit vectors' covariance less the identity; null without components."""
    anchor, rest = anchored(model.n, model.sums)
    own = np.flatnonzero(model.usable)
    k = len(own)
    if not k:
        return None

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = projected(centred(batch.column("x"), anchor), model, rest)[:, own]
            total += np.vstack([z.T @ z, z.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(list(total))], names=["i", "sums"])

    parts = in_arrow(fit.select("x"), made, "i int, sums array<double>")
    entries = parts.select("i", F.posexplode("sums").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((k + 1, k))
    for r in entries.collect():
        total[r.i, r.j] = r.v / model.n
    mean = total[k]
    return float(np.abs(total[:k] - np.outer(mean, mean) - np.eye(k)).max())


def fit_whitening(
    vectors: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> Whitening | None:
    """The whitening of a table's different vectors; null for a table without usable ones.

    Vectors as whole numbers are made distinct first, so copies weigh nothing and a hot vector is combined
    before the shuffle. Three passes over the distinct ones: sums, products of the centred vectors (both exact
    whole numbers, the same however rows are dealt out), and the covariance of the result. Only sums
    over all rows reach the driver, as many as there are pairs of dimensions. Cases as in ``whiten``.
    """
    fit = cut_lineage(number_rows(vectors, id_col, vector_col).select("x").distinct())
    n, sums = sums_of(fit)
    if not n:
        return None
    anchor, _ = anchored(n, tuple(sums))
    spread = covariance(n, sums, anchor, products_of(fit, anchor))
    values, components = eigen(spread)
    model = Whitening(n, tuple(sums), components[:, :k], values, float(np.trace(spread)), None)
    return Whitening(n, model.sums, model.components, values, model.trace, identity_error(fit, model))


def whiten(
    vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per usable vector: id, deviation, whitened (one number per component).

    ``deviation`` is the sum over dimensions of (n * x - S)^2, exact (null where it passes a long);
    ``whitened`` the centred vector on the components, each at unit variance over the fit vectors.

    Left out are vectors that are null, empty, hold a null or an entry that is not finite (or of 2^40 or
    more), and those of another length than most have. A component without variance (fewer different
    vectors than dimensions, constant dimensions) has null values. Repeated rows and repeated ids get
    a row each, a null id stays null; an empty table gives an empty result, other columns are not
    looked at.
    """
    rows = number_rows(vectors, id_col, vector_col)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, deviation bigint, whitened array<double>"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("x") == len(model.sums))
    anchor, rest = anchored(model.n, model.sums)
    left = np.array([s - model.n * int(a) for s, a in zip(model.sums, anchor)], dtype=object)

    def deviations(y: np.ndarray) -> list[int | None]:
        most = model.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * len(anchor) < 1 << 63:
            return ((y * model.n - left.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((y.astype(object) * model.n - left) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                y = centred(part.column("x"), anchor)
                z = projected(y, model, rest)
                flat = pa.array(z.ravel(), mask=np.isnan(z).ravel())
                places = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(deviations(y), pa.int64()), pa.ListArray.from_arrays(places, flat)],
                    names=["id", "deviation", "whitened"],
                )

    return in_arrow(rows, made, schema)


def whitened_entries(whitened: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    shares = [] if model is None else [float(e) / model.trace if model.trace else None for e in model.eigenvalues]
    kept = F.array(*[F.lit(s).cast("double") for s in shares[: 0 if model is None else len(model.usable)]])
    rows = whitened.select("id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return rows.select(
        F.col("id").alias("vec_id"),
        (F.col("pos") + 1).cast("int").alias("component"),
        F.lit(0 if model is None else model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(kept.cast("array<double>"), F.col("pos")).alias("explained"),
        F.lit(None if model is None else model.identity_error).cast("double").alias("identity_error"),
    )

"""Whitening of embeddings by an incremental eigendecomposition.

The covariance is never formed from the rows.  A spectrum (count, exact sums, eigenvalues and
eigenvectors of the centred scatter) is kept up to date by centred rank-one updates:

1. A rank-one update rotates the new vector into the present eigenvectors, deflates what does
   not change (entries near zero; equal eigenvalues, which one reflection reduces to a single
   entry), solves the secular equation of the rest for all new eigenvalues at once, and
   derives the eigenvectors from the entries that those roots solve exactly.
2. Every partition updates a spectrum of its own.  A block of rows is centred and first turned
   into its triangular factor, which has the same scatter in at most `width` rows, so a block
   costs `width` updates at any number of rows; one more update carries the shift of means.
3. Partition spectra are combined in a tree of `FAN` a task, each through successive rank-one
   updates with the other's scaled eigenvectors and the shift of means.
4. Rayleigh-Ritz refinement: a distributed pass projects all centred rows on the combined basis
   and sums the outer products; the small eigenproblem of that sum turns the basis.  The
   next pass measures how far the whitened covariance is from the identity, and refines
   once more while that exceeds `CLOSE`.

One spectrum (width squared numbers) is all that reaches the driver or is broadcast.

Entries are integers, x = floor(scale * c) + offset; sums and deviations are exact.  Cases:
vectors that are null or hold null, NaN or infinite entries take no part; an entry that a
shorter vector lacks counts as c = 0; repeated rows count as often as they occur; rows without an
id take part; a component without variance (below `FLAT` of the largest) cannot be scaled to
one and has whitened null, and the measured error covers the others; an empty table, or one of
empty vectors, gives no rows; a deviation beyond 38 digits raises.  Extra columns stay, clashing names get an
underscore.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import fresh, landed
from shelfspark.llm.vectors import blocks, is_whole, matrix, scaled
from shelfspark.operators.skew import spread

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Partial results that one task combines.
FAN = 16
# Whitened covariance: refine while an entry is further than this from the identity.
CLOSE, PASSES = 1e-10, 4
# Share of the largest variance that rounding alone can leave.
FLAT = 1e-13
_EPS = np.finfo(np.float64).eps
_LONG = 1 << 62


# ---------------------------------------------------------------- rank-one updates

def secular_roots(poles: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho * sum(z_i^2 / (poles_i - m)) = 0, each as (nearest pole's index, distance to it).

    Poles rise strictly, no z is zero.  Root i lies between poles i and i + 1, the last one within
    rho * |z|^2 above the last pole.  Distances are kept instead of roots, so that differences to poles lose no digits.
    """
    k = len(poles)
    squares, free = z * z, 1.0 / rho
    last = rho * squares.sum()
    at = np.arange(k)
    upper = np.append(poles[1:], poles[-1] + last)
    middle = (upper - poles) / 2
    value = free + (squares / (poles - poles[:, None] - middle[:, None])).sum(axis=1)
    right = (value < 0) & (at < k - 1)
    origin = at + right
    low = np.where(right, -middle, 0.0)
    high = np.where(right, 0.0, np.where(at < k - 1, middle, last))
    # the last root may lie in the upper half of its interval
    low[-1] = middle[-1] if value[-1] < 0 else 0.0
    high[-1] = last if value[-1] < 0 else middle[-1]
    shift = poles - poles[origin][:, None]
    below = np.minimum(at, max(k - 2, 0))
    above = np.minimum(below + 1, k - 1)
    is_left = at[None, :] <= below[:, None]
    found = (low + high) / 2
    for _ in range(100):
        gap = shift - found[:, None]
        term = squares / gap
        value = free + term.sum(axis=1)
        done = np.abs(value) <= 4 * _EPS * (free + np.abs(term).sum(axis=1))
        low, high = np.where(value < 0, found, low), np.where(value >= 0, found, high)
        done |= high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
        if done.all():
            break
        # a rational function with the two nearest poles, matched in value and slope on both sides
        slope = term / gap
        left = np.where(is_left, slope, 0.0).sum(axis=1)
        rest = slope.sum(axis=1) - left
        g0, g1 = gap[at, below], gap[at, above]
        c = value - g0 * left - g1 * rest
        a = (g0 + g1) * value - g0 * g1 * (left + rest)
        b = g0 * g1 * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            other = np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root))
        step[-1] = other[-1]
        moved = found + step
        # halve in the logarithm where an end touches the pole, as distances may be tiny
        halved = np.where(low == 0, high / 16, np.where(high == 0, low / 16, (low + high) / 2))
        good = np.isfinite(moved) & (moved > low) & (moved < high)
        found = np.where(done, found, np.where(good, moved, halved))
    return origin, found


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of basis @ diag(values) @ basis.T + vector @ vector.T."""
    rho = float(vector @ vector)
    if rho == 0.0:
        return values, basis
    z = basis.T @ (vector / np.sqrt(rho))
    small = 8 * _EPS * max(float(values[-1]), rho)
    starts = [0]
    for i in range(1, len(values)):
        if values[i] - values[starts[-1]] > small:
            starts.append(i)
    if len(starts) < len(values):
        basis = basis.copy()
        for first, end in zip(starts, [*starts[1:], len(values)]):
            if end - first > 1:
                mirror = z[first:end].copy()
                norm = np.linalg.norm(mirror) * (1.0 if mirror[-1] >= 0 else -1.0)
                mirror[-1] += norm
                size = mirror @ mirror
                if size > 0:
                    own = basis[:, first:end]
                    basis[:, first:end] = own - np.outer(own @ mirror, mirror * (2 / size))
                    z[first:end] = 0.0
                    z[end - 1] = -norm
    active = np.flatnonzero(rho * np.abs(z) > small)
    if not len(active):
        return values, basis
    poles, entries = values[active], z[active]
    origin, distance = secular_roots(poles, entries, rho)
    gap = poles[:, None] - poles[origin] - distance  # pole i minus root j
    # the entries of which these roots are exact, so that the eigenvectors are orthogonal
    k = len(poles)
    among = poles[None, :] - poles[:, None]
    paired = np.where(np.arange(k)[None, :] < np.arange(k)[:, None], among, np.roll(among, -1, axis=1))
    paired[:, -1] = rho
    exact = np.sqrt(np.abs(np.prod(-gap / paired, axis=1))) * np.where(entries < 0, -1.0, 1.0)
    turned = exact[:, None] / gap
    turned /= np.linalg.norm(turned, axis=0)
    new_values, new_basis = values.copy(), basis.copy()
    new_values[active] = poles[origin] + distance
    new_basis[:, active] = basis[:, active] @ turned
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_basis[:, order]


@dataclass
class Spectrum:
    """Eigendecomposition of the centred scatter of `n` rows with these (exact) sums."""

    n: int
    sums: list[int]
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, [0] * width, np.zeros(width), np.eye(width))

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def _shift(self, n: int, sums: list[int]) -> None:
        """Another group's count and sums, with the scatter between both means."""
        if self.n:
            apart = np.array([(t * self.n - s * n) / (self.n * n) for s, t in zip(self.sums, sums)])
            self.values, self.basis = rank_one(self.values, self.basis, apart * np.sqrt(self.n * n / (self.n + n)))
        self.n += n
        self.sums = [s + t for s, t in zip(self.sums, sums)]

    def add(self, rows: np.ndarray) -> None:
        """Rows of longs."""
        if not len(rows):
            return
        sums = [int(s) for s in rows.sum(axis=0, dtype=np.int64 if np.abs(rows).max(initial=0) < _LONG // len(rows) else object)]
        centred = rows - np.array([s / len(rows) for s in sums])
        for row in np.linalg.qr(centred, mode="r"):
            self.values, self.basis = rank_one(self.values, self.basis, row)
        self._shift(len(rows), sums)

    def merge(self, other: Spectrum) -> None:
        for value, direction in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, np.sqrt(value) * direction)
        self._shift(other.n, other.sums)


# ---------------------------------------------------------------- distributed passes

_PART = "part long, n long, sums array<string>, spread array<double>, basis array<double>"


def _combined(parts: DataFrame, merge: Callable[[list], tuple], fan: int = FAN) -> tuple | None:
    """One result of many, `fan` a task and level; every level is a table in the shared folder."""
    rows = landed(parts, "partial")
    total = (rows.agg(F.max("part").alias("last")).first().last)
    if total is None:
        return None
    total += 1
    while True:
        groups = -(-total // fan)

        def level(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("part")
            made = merge(list(frame[["n", "sums", "spread", "basis"]].itertuples(index=False, name=None)))
            return pd.DataFrame([(group[0], *made)], columns=["part", "n", "sums", "spread", "basis"])

        rows = landed(rows.groupBy(F.pmod("part", F.lit(groups)).alias("_group")).applyInPandas(level, _PART), "partial")
        if groups == 1:
            return tuple(rows.first()[1:])
        total = groups


def _row(n: int, sums: list[int], spread: np.ndarray, basis: np.ndarray) -> tuple:
    return n, [str(s) for s in sums], spread.tolist(), basis.ravel().tolist()


def _emit(n: int, sums: list[int], spread: np.ndarray, basis: np.ndarray) -> pa.RecordBatch:
    own = _row(n, sums, spread, basis)
    kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.list_(pa.float64()))
    columns = [pa.array([value], kind) for value, kind in zip(own, kinds)]
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), *columns],
                                      names=["part", "n", "sums", "spread", "basis"])


def _merge_spectra(parts: list) -> tuple:
    width = len(parts[0][1])
    whole = Spectrum.empty(width)
    for n, sums, values, basis in parts:
        whole.merge(Spectrum(int(n), [int(s) for s in sums], np.array(values), np.array(basis).reshape(width, width)))
    return _row(whole.n, whole.sums, whole.values, whole.basis)


def _merge_products(parts: list) -> tuple:
    total = sum(np.array(basis) for _, _, _, basis in parts)
    return int(sum(p[0] for p in parts)), [], [], total.tolist()


@dataclass
class Whitening:
    """Fitted components: columns of `basis` with falling variances, and what they were fitted on."""

    n: int
    sums: list[int]
    variances: np.ndarray
    basis: np.ndarray
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        total = self.variances.sum()
        return self.variances / total if total > 0 else np.zeros(len(self.variances))


def fit(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The components of all whole vectors of `table`; None where there is no vector with an entry."""
    spark = table.sparkSession
    own = spread(table.select(F.col(f"`{vector}`").alias("v"))).filter(is_whole(F.col("v")))
    width = own.agg(F.max(F.size("v")).alias("width")).first().width or 0
    if not width:
        return None

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Spectrum.empty(width)
        for batch in blocks(batches, width):
            part.add(scaled(matrix(batch.column(0), width), scale))
        if part.n:
            yield _emit(part.n, part.sums, part.values, part.basis)

    n, sums, values, flat = _combined(own.mapInArrow(spectra, _PART), _merge_spectra)
    sums = [int(s) for s in sums]
    mean = np.array([s / n for s in sums])
    basis = np.array(flat).reshape(width, width)[:, ::-1]
    variances, error = np.array(values)[::-1] / n, np.inf
    for round_ in range(PASSES + 1):
        sent = spark.sparkContext.broadcast((mean, basis))

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centre, directions = sent.value
            total, rows = np.zeros((width, width)), 0
            for batch in blocks(batches, width):
                projected = (scaled(matrix(batch.column(0), width), scale) - centre) @ directions
                total += projected.T @ projected
                rows += len(projected)
            if rows:
                yield _emit(rows, [], np.zeros(0), total)

        seen, _, _, flat = _combined(own.mapInArrow(products, _PART), _merge_products)
        product = np.array(flat).reshape(width, width) / n
        used = _used(variances)[:components]
        root = np.sqrt(variances[:components][used])
        inner = product[:components, :components][np.ix_(used, used)] / np.outer(root, root)
        error = float(np.abs(inner - np.eye(len(inner))).max(initial=0.0))
        if round_ and (error <= CLOSE or round_ == PASSES):
            break
        found, turn = np.linalg.eigh((product + product.T) / 2)
        order = np.argsort(-found, kind="stable")
        variances = np.maximum(found[order], 0.0)
        basis, _ = np.linalg.qr(basis @ turn[:, order])
    return Whitening(n, sums, variances, basis, error)


def _used(variances: np.ndarray) -> np.ndarray:
    return variances > FLAT * variances.max(initial=0.0)


def whiten(table: DataFrame, fitted: Whitening, vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> tuple[DataFrame, list[str]]:
    """The rows of `table` with whole vectors, with their whitened vector and exact deviation; and those names."""
    names = fresh(table.columns, "whitened", "deviation")
    width, n = len(fitted.sums), fitted.n
    count = min(components, width)
    at = table.columns.index(vector)
    sent = table.sparkSession.sparkContext.broadcast((fitted.basis[:, :count], fitted.variances[:count], _used(fitted.variances)[:count], fitted.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, variances, used, sums = sent.value
        mean = np.array([s / n for s in sums])
        root = np.sqrt(np.where(used, variances, 1.0))
        for batch in blocks(batches, width):
            values = scaled(matrix(batch.column(at), width), scale)
            whitened = ((values - mean) @ directions) / root
            flat = pa.array(whitened.ravel(), mask=np.tile(~used, len(values)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * count), flat)
            top = max(int(np.abs(values).max(initial=0)) * n, *(abs(s) for s in sums)) * 2
            if top * top * width < _LONG:
                apart = values * n - np.array(sums, np.int64)
                deviation = pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:  # whole numbers beyond a long
                apart = values.astype(object) * n - np.array(sums, dtype=object)
                deviation = pa.array([Decimal(int(d)) for d in (apart * apart).sum(axis=1)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, deviation], names=[*batch.schema.names, *names])

    fields = [T.StructField(names[0], T.ArrayType(T.DoubleType())), T.StructField(names[1], T.DecimalType(38, 0))]
    rows = spread(table).filter(is_whole(F.col(f"`{vector}`")))
    return rows.mapInArrow(run, T.StructType([*table.schema.fields, *fields])), names


def report(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component; a deviation that does not fit a long is null there (`whiten` has it whole)."""
    own = table.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    fitted = fit(own, "v")
    if fitted is None:
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], schema)
    rows, (white, apart) = whiten(own, fitted, "v")
    explained = F.array(*[F.lit(float(x)) for x in fitted.explained[:COMPONENTS]])
    return rows.select("vec_id", F.expr(f"try_cast({apart} AS bigint)").alias("deviation"), F.posexplode(white).alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(fitted.identity_error).alias("identity_error"))

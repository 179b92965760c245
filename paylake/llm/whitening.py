"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance is never formed. A block of vectors Q is multiplied by it in passes over the rows: every task centres its
rows and returns X'(XQ), the sums come back as one small matrix. A round applies a Chebyshev polynomial, by its three-term
recurrence, that is small on the unwanted part of the spectrum and large above it, then makes the block orthonormal (QR) and
solves the projected problem (Rayleigh-Ritz). Rounds end when the wanted pairs are certified: their residuals are at the
level of rounding, and a bound on everything outside them shows that no larger eigenvalue is missing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import staged

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Entries, as floor(64 * c), are held within this.
LARGEST = 2.0 ** 62
#: Vectors of the block beyond the wanted ones: the filter separates the wanted from what is beyond these.
GUARD = 24
#: Degree of the filter, steps of the Lanczos runs that bound the spectrum.
DEGREE, LANCZOS = 10, 10
#: Residuals, as a share of the largest eigenvalue: the aim, and what is accepted once they no longer fall.
AIM, ACCEPTED = 1e-13, 1e-10
ROUNDS = 200
#: Variance, as a share of the total, below which a direction counts as none.
NO_VARIANCE = 1e-12
#: Sums of products below this fit 64-bit integers.
_FITS = 2 ** 62


@dataclass
class Model:
    n: int                        # distinct vectors
    sums: list[int]               # of each dimension over them
    vectors: np.ndarray           # a column per component
    values: np.ndarray            # its eigenvalue
    trace: float
    largest: int                  # of the absolute entries
    identity_error: float = 0.0
    rounds: int = 0
    residual: float = 0.0         # the largest of the components, as a share of the first eigenvalue


def _entries(embedding: Column) -> Column:
    scaled = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    return F.transform(embedding, lambda c: F.floor(scaled(c)) + F.lit(SHIFT).cast("long"))


def integer_rows(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x, the entries as floor(64 * c) + 1,000,000. Rows whose vector is null or holds a null or non-finite entry
    are left out; shorter vectors are padded with entries of c = 0."""
    finite = F.forall(F.col(embedding), lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False))) \
        .select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"))
    sizes = rows.agg(F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    x = _entries(F.col("v"))
    if sizes.low != sizes.high:
        x = F.concat(x, F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(sizes.high) - F.size("v")))
    return rows.select("vec_id", x.alias("x"))


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0), np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """n * x - S, exactly."""
    if n * largest < _FITS:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


class _Passes:
    """Products of the covariance of the rows of x (column x) with a block of vectors."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int], largest: int):
        self.rows, self.n, self.sums, self.largest = rows, n, sums, largest
        self.width, self.count = len(sums), 0

    def _summed(self, partial, columns: int) -> np.ndarray:
        """The sum over all tasks of partial(centred rows), a matrix with a row per dimension."""
        n, sums, largest = self.n, self.sums, self.largest

        def batches(source):
            total = None
            for batch in source:
                if batch.num_rows:
                    part = partial(_centred(_matrix(batch.column(0)), n, sums, largest).astype(float) / n)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "y"])

        parts = self.rows.select("x").mapInArrow(batches, "at long, y double")
        found = parts.groupBy("at").agg(F.sum("y").alias("y")).toArrow()
        out = np.zeros(found.num_rows)
        out[found["at"].to_numpy()] = found["y"].to_numpy()
        return out.reshape(-1, columns)

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times q."""
        self.count += 1
        return self._summed(lambda c: c.T @ (c @ q), q.shape[1]) / self.n

    def trace(self) -> float:
        return float(self._summed(lambda c: (c * c).sum(axis=0)[:, None], 1).sum() / self.n)

    def identity_error(self, vectors: np.ndarray, values: np.ndarray) -> float:
        """How far the covariance of the whitened rows is from the identity, in its worst entry."""
        scaled = vectors / np.sqrt(values)

        def moments(c: np.ndarray) -> np.ndarray:
            w = c @ scaled
            return np.column_stack([w.T @ w, w.sum(axis=0)])
        total = self._summed(moments, len(values) + 1) / self.n
        mean = total[:, -1]
        return float(np.abs(total[:, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())


def _ends(times, width: int, random: np.random.Generator, without: np.ndarray | None = None) -> tuple[float, float]:
    """Safe bounds below and above the spectrum of an operator, off the columns of `without`, by a Lanczos run."""
    def off(v):
        return v if without is None else v - without @ (without.T @ v)

    q = off(random.standard_normal(width))
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    steps = min(LANCZOS, width - (0 if without is None else without.shape[1]))
    rest = 0.0
    for k in range(steps):
        f = off(times(basis[-1][:, None])[:, 0])
        alpha.append(float(basis[-1] @ f))
        for _ in range(2):  # full orthogonalization
            for b in basis:
                f = f - b * (b @ f)
        rest = float(np.linalg.norm(off(f)))
        if rest <= 1e-13 * max(map(abs, alpha)):
            break
        if k + 1 < steps:
            beta.append(rest)
            basis.append(off(f) / rest)
    found = np.linalg.eigvalsh(np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1))
    return max(0.0, float(found[0]) - rest), float(found[-1]) + rest


def _filtered(times, q: np.ndarray, vq: np.ndarray, low: float, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of the covariance, damped on [low, cut] and scaled by its value at top, times q. vq is the
    covariance times q, known from the round before."""
    centre, half = (low + cut) / 2, max((cut - low) / 2, 1e-12 * top)
    sigma = first = half / (top - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def _top(passes: _Passes, wanted: int, trace: float) -> tuple[np.ndarray, np.ndarray, int, float]:
    """The wanted largest eigenvalues and their vectors, the rounds taken and the largest residual."""
    width, random = passes.width, np.random.default_rng(11)
    block = min(width, wanted + GUARD)
    q, _ = np.linalg.qr(random.standard_normal((width, block)))
    low, _ = _ends(passes.times, width, random)
    vq, last = passes.times(q), np.inf
    for turn in range(1, ROUNDS + 1):
        small = q.T @ vq
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        q, vq = q @ turned, vq @ turned
        low = min(low, float(max(values[-1], 0.0)))
        real = int((values > NO_VARIANCE * trace).sum())
        need = min(wanted, real)
        apart = np.linalg.norm(vq - q * values, axis=0)
        worst = float(apart[:need].max(initial=0.0)) / values[0]
        settled = worst <= AIM or (worst <= ACCEPTED and worst > last / 2)
        if settled and _none_missing(passes, q, values, apart, need, block, random):
            return values[:need], q[:, :need], turn, worst
        last = worst
        if block == width or values[-1] <= NO_VARIANCE * trace:   # the block spans all there is
            q, _ = np.linalg.qr(vq)
        else:
            q, _ = np.linalg.qr(_filtered(passes.times, q, vq, low, float(values[-1]), float(values[0])))
        vq = passes.times(q)
    raise RuntimeError(f"not certified in {ROUNDS} rounds: residual {worst:.1e}, {passes.count} passes")


def _none_missing(passes: _Passes, q: np.ndarray, values: np.ndarray, apart: np.ndarray, need: int, block: int,
                  random: np.random.Generator) -> bool:
    """Whether no eigenvalue outside the first `need` pairs exceeds the last of them.

    Off those pairs the covariance consists of the guard's values, what couples the guard to the rest, and the rest; the
    largest eigenvalue of such a matrix is bounded by these three.
    """
    if need == 0 or block == passes.width:
        return True
    guard = float(values[need]) if need < block else 0.0
    coupling = float(np.linalg.norm(apart[need:]))
    _, rest = _ends(passes.times, passes.width, random, without=q)
    bound = (guard + rest) / 2 + np.hypot((guard - rest) / 2, coupling)
    return bool(bound <= values[need - 1] * (1 + 1e-9) + NO_VARIANCE * values[0])


def fit(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> Model | None:
    """The leading directions of the distinct vectors. None if there is no usable vector or all are equal."""
    distinct = staged(integer_rows(vectors, vec_id, embedding).select("x").distinct(), "whitening-vectors")
    numbered = distinct.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.max(F.abs("c")).alias("m")).orderBy("i").collect()
    if not numbered:
        return None
    n, sums, largest = distinct.count(), [int(r.s) for r in numbered], max(int(r.m) for r in numbered)
    passes = _Passes(distinct, n, sums, largest)
    trace = passes.trace()
    if trace <= 0:
        return None
    values, found, rounds, residual = _top(passes, min(components, len(sums)), trace)
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    return Model(n, sums, found, values, trace, largest, passes.identity_error(found, values), rounds, residual)


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, model: Model | None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per usable vector and component.

    Vectors that are null or hold a null or non-finite entry are left out; a shorter one counts as padded by zeros. Repeated
    vectors count once in the model, and each row is whitened; null and repeated ids stay as they are. Other columns are
    not read. An empty table, or one whose vectors are all equal, gives no rows: there is no direction with
    variance. With fewer directions than components, there are as many components as directions. deviation is null
    where it does not fit a long.
    """
    rows = integer_rows(vectors, vec_id, embedding)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {SCHEMA}"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    scaled = model.vectors / np.sqrt(model.values)
    many, explained = len(model.values), model.values / model.trace

    def batches(source):
        for batch in source:
            size = batch.num_rows
            if not size:
                continue
            exact = _centred(_matrix(batch.column(1)), model.n, model.sums, model.largest)
            farthest = int(abs(exact).max(initial=0))
            if farthest * farthest * exact.shape[1] >= _FITS:
                exact = exact.astype(object)
            deviation = (exact * exact).sum(axis=1)
            if deviation.dtype == object:
                deviation = [d if d < 2 ** 63 else None for d in deviation]
            whitened = (exact.astype(float) / model.n) @ scaled
            row = pa.array(np.repeat(np.arange(size), many))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(row), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), size)),
                pa.array(np.full(size * many, model.n)), pa.array(deviation, pa.int64()).take(row),
                pa.array(whitened.ravel()), pa.array(np.tile(explained, size)),
                pa.array(np.full(size * many, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(batches, schema)

"""Whitening of embeddings: the leading eigenvectors of their covariance by Jacobi-Davidson.

The covariance is never formed. What is asked of it are products with a few vectors at
once: each task centres its rows, multiplies twice, and hands on a small matrix; partial
matrices are added up by entry. All unfinished eigenpairs go on together, so a step costs
one pass whatever their number:

* Rayleigh-Ritz in a subspace whose products are known gives approximate pairs and residuals;
* per pair, a few MINRES steps solve the correction equation, projected off the pair and
  everything locked; the steps of all pairs share passes;
* pairs whose residuals are down to double precision are locked; the corrections of the
  others widen the subspace, which is thinned out to its best part when it is full.

When all are locked, the rest of the subspace is searched for a larger eigenvalue that
was missed, and the products of the locked vectors are taken afresh.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import stored

COMPONENTS = 8

#: Entries become floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000

#: Vectors of the subspace at most; MINRES steps of a correction; rounds; random vectors at the start.
SUBSPACE, INNER, ROUNDS, START = 64, 3, 60, 32

#: A residual is down to double precision at TIGHT x the largest eigenvalue; at LOOSE if it falls no more.
TIGHT, LOOSE = 50 * np.finfo(float).eps, 1e-12

#: Part of the largest eigenvalue below which an eigenvalue counts as zero.
FLAT = 1e-13

SEED = 20240611

#: Entries that become numbers of more bits than doubles hold exactly are refused.
LARGEST = 2.0**52


@dataclass
class Whitening:
    """`components` (dimensions x k, unit columns), `eigenvalues` (falling), `trace`, `n`, and `sums` by dimension."""

    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    n: int
    sums: list[int]


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """`vec_id`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error` per vector and component.

    Entries become x = floor(1024 * entry) + 100000. n is the number of vectors,
    S their sum; deviation (decimal, exact) is the sum over dimensions of (n * x - S)^2,
    whitened the projection of x - S / n on the component over the root of its
    eigenvalue, explained the eigenvalue's part of the trace, identity_error the largest
    absolute entry of the covariance of what is returned as whitened, less the identity.

    Vectors that are null, empty, or hold null or non-finite entries take no part, nor
    do those whose length is not the commonest (the longer one on a tie). Components
    with eigenvalue zero have no rows, so equal vectors give none, nor does an empty
    table. Null ids are kept; repeated rows count each. Other columns are ignored.
    Entries from 2**42 on raise an error.
    """
    spark = vectors.sparkSession
    rows = _integers(vectors, id_col, vector_col)
    fit = fit_whitening(rows, components)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"
    if fit is None or not len(fit.eigenvalues):
        return spark.createDataFrame([], schema + ", identity_error double")
    known = spark.sparkContext.broadcast(fit)
    error = _identity_error(rows, fit)
    return rows.mapInArrow(_whitened(known), schema).withColumn("identity_error", F.lit(error))


def _integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Stored `vec_id`, `x` (packed longs) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = "size(v) > 0 and forall(v, e -> e is not null and not isnan(e) and abs(e) < double('Infinity'))"
    rows = rows.where(f"v is not null and {usable}")
    packed = stored(rows.mapInArrow(_pack, "vec_id long, dim int, x binary"), "vectors")
    common = packed.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "dim"))).first()[0]
    return packed.where(F.col("dim") == (common["dim"] if common else 0)).select("vec_id", "x")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("v")
        ends = lists.offsets.to_numpy()
        scaled = np.floor(SCALE * lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]])
        if len(scaled) and np.abs(scaled).max() >= LARGEST:
            raise ValueError("an entry is too large to be scaled exactly")
        raw, at = (scaled.astype(np.int64) + SHIFT).tobytes(), 8 * (ends - ends[0])
        parts = [raw[a:b] for a, b in zip(at, at[1:])]
        dims = pa.array(np.diff(ends).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), dims, pa.array(parts, pa.binary())], ["vec_id", "dim", "x"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, a row each."""
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), np.int64).reshape(len(batch), -1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, from whole numbers: the shift that all entries share cancels exactly."""
    return _deviations(x, n, sums).astype(np.float64) / n


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S; in Python's whole numbers where longs might not hold it."""
    bound = n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
    if bound >= 2**63:
        return np.array(n * x.astype(object) - np.array(sums, object))
    return n * x - np.array(sums, np.int64)


def _add_up(rows: DataFrame, part: Callable[[Iterator[np.ndarray]], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over tasks of the small matrices that `part` makes of their rows."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(_matrix(batch) for batch in batches if len(batch)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "value"])

    added = rows.select("x").mapInArrow(entries, "i long, value double").groupBy("i").agg(F.sum("value").alias("value"))
    found = added.toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[found["i"].to_numpy()] = found["value"].to_numpy()
    return out.reshape(shape)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for x in (_matrix(batch) for batch in batches if len(batch)):
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        if n:
            values = [n, *(int(h) * 2**32 + int(v) for h, v in zip(high, low))]
            whole = pa.array([str(v) for v in values])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), whole], ["i", "value"])

    parts = rows.select("x").mapInArrow(entries, "i long, value string")
    total = F.sum(F.col("value").cast("decimal(28,0)"))
    found = dict(parts.groupBy("i").agg(total.alias("value")).collect())  # dimensions + 1 rows
    return int(found.pop(0, 0)), [int(found[i]) for i in sorted(found)]


def fit_whitening(rows: DataFrame, components: int) -> Whitening | None:
    """The leading eigenpairs of the covariance of stored `x`; None without rows."""
    n, sums = _sums(rows)
    if not n:
        return None
    dim = len(sums)

    def squares(matrices: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros((dim, 1))
        for x in matrices:
            total[:, 0] += (_centred(x, n, sums) ** 2).sum(0)
        return total

    trace = float(_add_up(rows, squares, (dim, 1)).sum()) / n
    if trace == 0:
        return Whitening(np.zeros((dim, 0)), np.zeros(0), 0.0, n, sums)

    def product(u: np.ndarray) -> np.ndarray:
        def part(matrices: Iterator[np.ndarray]) -> np.ndarray:
            total = np.zeros(u.shape)
            for x in matrices:
                y = _centred(x, n, sums)
                total += y.T @ (y @ u)
            return total

        return _add_up(rows, part, u.shape) / n

    values, found = eigenpairs(product, dim, min(components, dim))
    inner = values > FLAT * values[0]
    return Whitening(found[:, inner], values[inner], trace, n, sums)


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what `new` adds to the orthonormal columns of `against`."""
    out: list[np.ndarray] = []
    for column in new.T:
        norm = np.linalg.norm(column)
        if not norm:
            continue
        column = column / norm
        for _ in range(3):
            for known in (*against, *([np.stack(out, 1)] if out else [])):
                column = column - known @ (known.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-8:
                break
            column = column / left
        else:
            out.append(column)
    return np.stack(out, 1) if out else np.zeros((len(new), 0))


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], dim: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors of the symmetric operator `product`."""
    random = np.random.default_rng(SEED)
    limit = min(dim, max(SUBSPACE, 3 * (k + START)))
    locked, locked_values = np.zeros((dim, 0)), np.zeros(0)
    basis = _orthonormal(random.standard_normal((dim, min(dim, max(START, k)))))
    image = product(basis)
    before = np.full(k, np.inf)
    for _ in range(ROUNDS):
        # Rayleigh-Ritz in what the locked vectors leave.
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        scale = max([*locked_values, theta[0]]) if len(theta) else max(locked_values)
        missing = min(k - locked.shape[1], basis.shape[1])
        residual = image[:, :missing] - basis[:, :missing] * theta[:missing]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        stalled = (norms <= LOOSE * scale) & (norms >= before[:missing] / 2)
        whole = basis.shape[1] + locked.shape[1] >= dim
        done = (norms <= TIGHT * scale) | stalled | whole
        before = np.full(k, np.inf)
        before[: int((~done).sum())] = norms[~done]
        if done.any():
            locked = np.concatenate([locked, basis[:, :missing][:, done]], 1)
            locked_values = np.concatenate([locked_values, theta[:missing][done]])
            keep = np.ones(basis.shape[1], bool)
            keep[:missing] = ~done
            basis, image, theta = basis[:, keep], image[:, keep], theta[keep]
            residual = residual[:, ~done]
        if locked.shape[1] == k or whole:
            # Whether something larger than the smallest locked value was missed.
            larger = _missed(product, locked, locked_values, basis, random) if not whole else np.zeros((dim, 0))
            if not larger.shape[1]:
                return _settled(product, locked, k)
            drop = np.argsort(locked_values)[: larger.shape[1]]
            basis = _orthonormal(np.concatenate([larger, locked[:, drop], basis[:, :START]], 1), np.delete(locked, drop, 1))
            locked, locked_values = np.delete(locked, drop, 1), np.delete(locked_values, drop)
            image, before = product(basis), np.full(k, np.inf)
            continue
        missing = residual.shape[1]
        steps = _corrections(product, np.concatenate([locked, basis[:, :missing]], 1), theta[:missing], residual)
        if basis.shape[1] + steps.shape[1] > limit - locked.shape[1]:
            # Full: keep the best part, its products taken afresh.
            basis = _orthonormal(basis[:, : max(missing + START, 1)], locked)
            image = product(basis)
        new = _orthonormal(steps, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(random.standard_normal((dim, 1)), locked, basis)
        basis, image = np.concatenate([basis, new], 1), np.concatenate([image, product(new)], 1)
    raise RuntimeError(f"residuals did not come down to double precision in {ROUNDS} rounds")


def _corrections(
    product: Callable[[np.ndarray], np.ndarray], known: np.ndarray, theta: np.ndarray, residual: np.ndarray
) -> np.ndarray:
    """Columns t of (I - QQ')(V - theta)(I - QQ') t = -r after INNER steps of MINRES, Q being `known`.

    The recurrences of all columns run side by side; a column that is solved stands still.
    """

    def off(t: np.ndarray) -> np.ndarray:
        t = t - known @ (known.T @ t)
        return t - known @ (known.T @ t)

    right = off(-residual)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    safe = np.where(live, beta, 1.0)
    now, last = right / safe, np.zeros_like(right)
    solution, one, two = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta, beta = np.where(live, beta, 0.0), np.zeros_like(beta)
    cos, cos_before = np.ones_like(beta), np.ones_like(beta)
    sin, sin_before = np.zeros_like(beta), np.zeros_like(beta)
    floor = 1e-14 * np.abs(eta)
    for _ in range(min(INNER, len(known) - known.shape[1])):
        if not live.any():
            break
        image = np.zeros_like(now)
        image[:, live] = product(now[:, live])
        step = off(image - now * theta)
        alpha = (now * step).sum(0)
        step = off(step - now * alpha - last * beta)
        ahead = np.linalg.norm(step, axis=0)
        # Two old rotations on the new column of the tridiagonal matrix, then one that clears what is below it.
        third = sin_before * beta
        second = sin * alpha + cos * cos_before * beta
        first = cos * alpha - sin * cos_before * beta
        length = np.hypot(first, ahead)
        live = live & (length > 0)
        length = np.where(length > 0, length, 1.0)
        cos_before, sin_before = cos, sin
        cos, sin = first / length, ahead / length
        direction = (now - third * two - second * one) / length
        solution = np.where(live, solution + direction * (cos * eta), solution)
        two, one = one, direction
        eta = -sin * eta
        last, now = now, step / np.where(ahead > 0, ahead, 1.0)
        beta = ahead
        live = live & (ahead > 0) & (np.abs(eta) > floor)
    return solution


def _missed(product, locked: np.ndarray, values: np.ndarray, basis: np.ndarray, random) -> np.ndarray:
    """Ritz vectors off the locked ones whose values are larger than the smallest of theirs."""
    dim = len(locked)
    probe = _orthonormal(np.concatenate([basis[:, :4], random.standard_normal((dim, 4))], 1), locked)
    if not probe.shape[1]:
        return probe
    spanned, images = probe, product(probe)
    newest = images
    for _ in range(4):
        new = _orthonormal(newest, locked, spanned)
        if not new.shape[1]:
            break
        newest = product(new)
        spanned, images = np.concatenate([spanned, new], 1), np.concatenate([images, newest], 1)
    small = spanned.T @ images
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    return spanned @ turn[:, theta > values.min() + 1e-10 * values.max()]


def _settled(product, locked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A last Rayleigh-Ritz step on fresh products, largest first."""
    basis = _orthonormal(locked)
    small = basis.T @ product(basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = basis @ turn[:, ::-1]
    return np.maximum(values[::-1][:k], 0.0), vectors[:, :k] / np.linalg.norm(vectors[:, :k], axis=0)


def _identity_error(rows: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors, less the identity."""
    k, weights = len(fit.eigenvalues), fit.components / np.sqrt(fit.eigenvalues)
    n, sums = fit.n, fit.sums

    def totals(matrices: Iterator[np.ndarray]) -> np.ndarray:
        return sum(((_centred(x, n, sums) @ weights).sum(0) for x in matrices), np.zeros(k))[None, :]

    mean = _add_up(rows, totals, (1, k)) / n

    def part(matrices: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros((k, k))
        for x in matrices:
            z = _centred(x, n, sums) @ weights - mean
            total += z.T @ z
        return total

    return float(np.abs(_add_up(rows, part, (k, k)) / n - np.eye(k)).max())


def _whitened(known):
    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit: Whitening = known.value
        k, weights = len(fit.eigenvalues), fit.components / np.sqrt(fit.eigenvalues)
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch)
            away = _deviations(x, fit.n, fit.sums)
            if away.dtype == object or float(np.abs(away).max()) ** 2 * away.shape[1] >= 2.0**62:
                away = away.astype(object)
            squares = (away * away).sum(1).tolist()
            each = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column("vec_id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), fit.n)),
                pa.array([Decimal(d) for d in squares], pa.decimal128(38, 0)).take(each),
                pa.array(((away.astype(np.float64) / fit.n) @ weights).ravel()),
                pa.array(np.tile(fit.eigenvalues / fit.trace, len(x))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return whitened


"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become integers, so that counts, sums and deviations are exact. The leading
eigenvectors of their covariance V come from a block of a few more vectors than are asked for:
a Chebyshev polynomial of V, applied by its three-term recurrence, damps the unwanted part of
the spectrum and grows the wanted part; QR and Rayleigh-Ritz turn the block into eigenvector
estimates. Rounds go on until the residuals ``|V u - e u|`` certify the pairs asked for.

V itself is never formed. Every step of the recurrence is one pass over the table: each task
centres its rows, multiplies them with the block and back, and hands on one matrix of
``dimensions x block`` sums, which Spark adds up. What the driver sees is that one matrix,
whatever the number of rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_engine.scratch import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Vectors in the block beyond the components asked for; the filter damps all that lies below them.
GUARD = 24
# Steps of the recurrence, that is passes over the table, in a round.
DEGREE = 8
# Residuals, as a share of the largest eigenvalue: aimed at, and enough when no round lowers them.
AIM, ENOUGH = 2e-14, 1e-10
ROUNDS = 200
# An entry of this size or more has no exact integer and counts as not finite.
LARGEST = 2.0**43
# Components whose eigenvalue is a smaller share of the trace are rounding, not variance.
LEAST_SHARE = 1e-13


@dataclass
class Fit:
    """What whitening needs: rows, sums, eigenvalues (falling), eigenvectors as columns, trace, and
    the certificate: the largest residual as a share of the largest eigenvalue, and passes taken."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int


def usable(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, x): the rows whose vector is whole, as integers ``floor(1024 * c) + 100000``.

    Null vectors, empty ones, and those with a null, infinite or too large entry are dropped. All
    vectors should be of one length; if not, the most frequent length counts (the longer of
    two), and the others are dropped.
    """
    entry_ok = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST)
    doubles = F.col(f"`{column}`").cast("array<double>")
    whole = vectors.select(F.col(f"`{id_col}`").alias(id_col), doubles.alias("c")).where(
        F.forall("c", entry_ok) & (F.size("c") > 0)
    )
    lengths = whole.groupBy(F.size("c").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return whole.where(F.size("c") == (common["d"] if common else 0)).select(
        id_col, F.transform("c", lambda e: F.floor(e * SCALE) + SHIFT).alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, column: str, part, kind: str) -> np.ndarray:
    """Sum over all rows of ``part(matrix of a batch)``, an array of a fixed size.

    A task sends one array. They are added by position, so the sum is made where the data is and
    the driver reads one number per position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                now = part(_matrix(batch.column(0)))
                total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["v"])

    found = (
        rows.select(column)
        .mapInArrow(run, f"v array<{kind}>")
        .select(F.posexplode("v").alias("at", "v"))
        .groupBy("at")
        .agg(F.sum("v").alias("v"))
        .orderBy("at")
        .collect()
    )
    return np.array([r["v"] for r in found])


def _product(rows: DataFrame, n: int, sums: np.ndarray, block: np.ndarray) -> np.ndarray:
    """V times the block: one pass."""

    def part(x: np.ndarray) -> np.ndarray:
        centred = (n * x - sums) / n
        return centred.T @ (centred @ block)

    return _summed(rows, "x", part, "double").reshape(block.shape) / n


def _lowest(alphas: list[float], betas: list[float]) -> float:
    """A point below the spectrum as far as Lanczos has seen it."""
    if not alphas:
        return 0.0
    t = np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - betas[-1])


def fit(
    rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE
) -> Fit | None:
    """Eigenpairs of the covariance of all ``rows`` (id, x); None without rows.

    In the first round one more column goes with the block and runs Lanczos steps, which tell
    where the spectrum ends below; the filter interval is then as narrow as it may be. A wrong end
    costs rounds, not correctness, which rests on the residuals. Equal eigenvalues do no harm:
    any basis of theirs has residual 0.
    """
    n = rows.count()
    if not n:
        return None
    sums = _summed(rows, "x", lambda x: x.sum(0), "bigint")
    d = len(sums)

    def squares(x: np.ndarray) -> np.ndarray:
        return (((n * x - sums) / n) ** 2).sum(0)

    trace = float(_summed(rows, "x", squares, "double").sum() / n)
    if trace == 0.0:
        return Fit(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, 0)

    size = min(d, components + guard)
    wanted = min(d, components)
    random = np.random.Generator(np.random.PCG64(5))
    q = np.linalg.qr(random.standard_normal((d, size)))[0]
    lanczos = random.standard_normal(d)
    lanczos /= np.linalg.norm(lanczos)
    before, alphas, betas = np.zeros(d), [], []
    passes, best = 0, np.inf
    for _ in range(ROUNDS):
        # Rayleigh-Ritz: rotate the block to the eigenvectors of its projection of V
        image = _product(rows, n, sums, q)
        passes += 1
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residual = np.linalg.norm(image - q * values, axis=0)[:wanted].max() / values[0]
        if residual <= AIM or size == d or (residual <= ENOUGH and residual > best / 2):
            break
        best = min(best, residual)
        # Chebyshev recurrence on [low, high], scaled so that the wanted part stays near 1
        low, high = _lowest(alphas, betas), float(values[-1])
        low = min(low, high * 0.999)
        centre, half = (high + low) / 2, (high - low) / 2
        sigma = first = half / (values[0] - centre)
        older, newer = q, (image - centre * q) * (sigma / half)
        for _ in range(degree - 1):
            watched = len(alphas) < degree
            block = np.column_stack([newer, lanczos]) if watched else newer
            image = _product(rows, n, sums, block)
            passes += 1
            if watched:
                follow = image[:, -1] - (betas[-1] * before if betas else 0.0)
                alphas.append(float(follow @ lanczos))
                follow -= alphas[-1] * lanczos
                betas.append(float(np.linalg.norm(follow)))
                before, lanczos = lanczos, follow / (betas[-1] or 1.0)
                image = image[:, :-1]
            after = 1 / (2 / first - sigma)
            older, newer = newer, (image - centre * newer) * (2 * after / half) - older * (
                sigma * after
            )
            sigma = after
        q = np.linalg.qr(newer)[0]
    else:
        raise ArithmeticError(f"residual {best:.1e} after {passes} passes")
    kept = int((values[:wanted] > LEAST_SHARE * trace).sum())
    return Fit(n, sums, values[:kept], q[:, :kept], trace, float(residual), passes)


def whiten(rows: DataFrame, found: Fit, id_col: str = "vec_id") -> DataFrame:
    """(id, deviation, whitened) of ``rows`` (id, x). ``deviation`` is the exact sum of
    ``(n * x - sum)^2`` as decimal(38, 0), ``whitened`` an array with one entry per component."""
    n, sums = found.n, found.sums
    axes = found.vectors / np.sqrt(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off = n * _matrix(batch.column("x")) - sums
            # int64 where no sum can leave it, else Python's integers
            fits = float(np.abs(off).max()) ** 2 * off.shape[1] < 2**62
            squares = (off if fits else off.astype(object)) ** 2
            deviation = pa.array(squares.sum(1).tolist(), pa.int64() if fits else pa.decimal128(38))
            points = (off / n) @ axes
            bounds = np.arange(len(points) + 1, dtype=np.int32) * axes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    deviation.cast(pa.decimal128(38)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(points.ravel())),
                ],
                names=[id_col, "deviation", "whitened"],
            )

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        run, f"`{id_col}` {kind}, deviation decimal(38,0), whitened array<double>"
    )


def identity_error(points: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    count = len(found.values)
    if not count:
        return 0.0
    mean = _summed(points, "whitened", lambda w: w.sum(0), "double") / found.n

    def part(w: np.ndarray) -> np.ndarray:
        return (w - mean).T @ (w - mean)

    covariance = _summed(points, "whitened", part, "double").reshape(count, count) / found.n
    return float(np.abs(covariance - np.eye(count)).max())


def whitened_embeddings(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and
    component, components numbered from 1 by falling eigenvalue.

    All rows are fitted and all are whitened; a repeated row counts as often as it is there, and a
    null id is an id. Components without variance (fewer distinct vectors or dimensions than
    components) do not appear, so one vector alone, or none, gives no rows.
    """
    rows = written(usable(vectors, id_col, column))
    found = fit(rows, components)
    if found is None or not len(found.values):
        found = Fit(0, np.zeros(0), np.ones(1), np.zeros((0, 1)), 1.0, 0.0, 0)
        rows = rows.limit(0)
    points = written(whiten(rows, found, id_col))
    error = identity_error(points, found) if found.n else 0.0
    explained = F.array(*(F.lit(float(v / found.trace)) for v in found.values))
    each = points.select("*", F.posexplode("whitened").alias("__at", "__value"))
    return each.select(
        id_col,
        (F.col("__at") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        F.col("__value").alias("whitened"),
        F.get(explained, F.col("__at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

"""Whitening of vectors by principal components from spectral divide and conquer.

Sums and the centred covariance are added up over all vectors in Spark. The covariance, a matrix of the dimensions alone,
is split by polar decompositions: the orthogonal factor of the matrix less a shift has the eigenvalues 1 and -1, half of it
plus one is the projector on the components above the shift, and a basis of its range and of the rest
splits the matrix in two smaller ones, until they have one row. The polar factor is found by the dynamically weighted
Halley iteration in its QR form. The projection on the first components is sent to all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: From here on an entry's whole number needs more than 64 bits; such rows take no part.
LARGEST = 2.0**52
#: Whole numbers are added up in two parts, the lower one of this many bits.
_LOWER = 24
_EPS = float(np.finfo(np.float64).eps)


# -- spectral divide and conquer ------------------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by the QR form of the dynamically weighted Halley iteration."""
    n = len(a)
    x, low = a / np.linalg.norm(a), _EPS / 2
    for _ in range(40):
        square = low * low
        d = (4 * (1 - square) / square**2) ** (1 / 3)
        root = math.sqrt(1 + d)
        wa = root + 0.5 * math.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, np.eye(n)]))
        after = (wb / wc) * x + (wa - wb / wc) / math.sqrt(wc) * (q[:n] @ q[n:].T)
        moved, x = np.linalg.norm(after - x), after
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved < (4 * _EPS) ** (1 / 3) and 1 - low < 10 * _EPS:
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """An orthonormal basis of the range of a projector, by two rounds of subspace iteration."""
    q = np.random.default_rng(rank).standard_normal((len(projector), rank))
    for _ in range(2):
        q, _ = np.linalg.qr(projector @ q)
    return q


def _divided(a: np.ndarray, whole: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces of a symmetric matrix; None where all its eigenvalues are one, to rounding."""
    n = len(a)
    center = float(np.trace(a)) / n
    spread = float(np.linalg.norm(a - center * np.eye(n)))
    if spread <= 4 * _EPS * whole:
        return None
    # A shift that is an eigenvalue has no polar factor; the mean lies between the eigenvalues, and some shifts around it do.
    for step in (0.0, *np.random.default_rng(n).uniform(-0.9, 0.9, 40)):
        u = polar_factor(a - (center + step * spread / n) * np.eye(n))
        u = (u + u.T) / 2
        rank = round((float(np.trace(u)) + n) / 2)
        if 0 < rank < n and np.linalg.norm(u @ u - np.eye(n)) < 1e-8:
            above = _basis((np.eye(n) + u) / 2, rank)
            below = _basis((np.eye(n) - u) / 2, n - rank)
            basis, _ = np.linalg.qr(np.hstack([above, below]))
            return basis[:, :rank], basis[:, rank:]
    raise ArithmeticError("no shift divides the spectrum")


def eigenpairs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    whole = float(np.linalg.norm(matrix))
    done, left = [], [(np.asarray(matrix, np.float64), np.eye(len(matrix)))]
    while left:
        a, basis = left.pop()
        a = (a + a.T) / 2
        halves = _divided(a, whole) if len(a) > 1 else None
        if halves is None:
            done += list(zip(np.diag(a).tolist(), basis.T))
        else:
            left += [(half.T @ a @ half, basis @ half) for half in halves]
    done.sort(key=lambda pair: -pair[0])
    vectors = np.array([v for _, v in done]).T
    values = np.array([float(v @ matrix @ v) for v in vectors.T])
    return values, vectors


# -- sums over all vectors ------------------------------------------------------------------------

def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, known, vector of the rows that take part."""
    rows = vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(0)).alias("vec_id"),
        F.col("vec_id").isNotNull().alias("known"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    return rows.where(f"size(vector) > 0 and forall(vector, x -> x is not null and abs(x) < {LARGEST})")


def _integers(vectors: pd.Series) -> np.ndarray:
    return np.floor(SCALE * np.stack(vectors.to_numpy())).astype(np.int64) + SHIFT


def _deviations(x: np.ndarray, n: int, sums: np.ndarray, exact: bool) -> np.ndarray:
    """n * x - S, in 64 bits where they suffice, else in whole numbers of any size."""
    return n * x - sums if exact else n * x.astype(object) - np.array([int(s) for s in sums], object)


def _added(frame: DataFrame, make: Callable[[np.ndarray], list[np.ndarray]], size: int) -> np.ndarray:
    """The sum over all rows of a matrix that `make` gives for a batch; each task sends one, which are added in Spark."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                part = make(_integers(batch["vector"]))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"place": np.arange(len(total)), "row": list(total)})

    rows = frame.select("vector").mapInPandas(run, "place int, row array<double>")
    added = rows.groupBy("place").agg(*[F.sum(F.col("row")[j]).alias(f"s{j}") for j in range(size)])
    return np.array([list(r)[1:] for r in sorted(added.collect())], np.float64)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component (from 1).

    Rows of vectors (vec_id, embedding) whose vector is null, empty, of another length than most (ties: the shorter), or holds
    a null, a non-finite entry or one of 2^52 or more take no part, neither in the fit nor in the result. Zero vectors do.
    Components whose variance is rounding error, at most that of the entries' trace, do not exist, so equal vectors (or one
    alone) give no rows. Repeated rows count and come out as often as they stand; null ids stay null. A deviation that
    needs more than 64 bits is null. An empty table gives no rows; further columns are left out, whatever their names.
    The covariance is a matrix of the dimensions, the only thing that passes through the driver.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors)
    found = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "vec_id long, known boolean, component int, n long, deviation long, whitened double, explained double, identity_error double"
    order = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if found is None:
        return spark.createDataFrame([], schema).select(*order)
    dim = found["dim"]
    rows = rows.where(F.size("vector") == dim)

    def batch_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _integers(batch["vector"])
                both = np.concatenate([(x >> _LOWER).sum(axis=0), (x & ((1 << _LOWER) - 1)).sum(axis=0)])
                yield pd.DataFrame({"rows": [len(x)], "sums": [both], "least": [x.min()], "most": [x.max()]})

    # An Arrow batch is at most some ten thousand rows, so its sums stay within 64 bits.
    parts = rows.select("vector").mapInPandas(batch_sums, "rows long, sums array<long>, least long, most long")
    whole = [F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(2 * dim)]
    total = parts.agg(F.sum("rows").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), *whole).first()
    n, sums = int(total["n"]), [(int(total[f"s{j}"]) << _LOWER) + int(total[f"s{dim + j}"]) for j in range(dim)]
    # All |n * x - S| are at most n times the widest gap, their squares' sum dim times its square.
    widest = n * (int(total["most"]) - int(total["least"]))
    exact = dim * widest**2 < 2**63 and n * max(abs(int(total["most"])), abs(int(total["least"]))) < 2**62
    sums_array = np.array(sums, np.int64) if exact else np.array(sums, object)

    def centred(x: np.ndarray) -> np.ndarray:
        return _deviations(x, n, sums_array, exact).astype(np.float64) / n

    def covariance(x: np.ndarray) -> np.ndarray:
        c = centred(x)
        return c.T @ c

    v = _added(rows, covariance, dim) / n
    values, basis = eigenpairs(v)
    trace = float(np.trace(v))
    k = int(min(components, (values > 64 * dim * _EPS * trace).sum())) if trace > 0 else 0
    if k == 0:
        return spark.createDataFrame([], schema).select(*order)
    turn = basis[:, :k] / np.sqrt(values[:k])

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ turn
        return np.vstack([w.T @ w, w.sum(axis=0)])

    measured = _added(rows, moments, k) / n
    identity_error = float(np.abs(measured[:k] - np.outer(measured[k], measured[k]) - np.eye(k)).max())
    explained = values[:k] / trace

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = _deviations(_integers(batch["vector"]), n, sums_array, exact)
                squares = (away * away).sum(axis=1)
                deviation = pd.array([int(s) if int(s) < 2**63 else None for s in squares], "Int64")
                white = (away.astype(np.float64) / n) @ turn
                yield pd.DataFrame(
                    {
                        "vec_id": np.repeat(batch["vec_id"].to_numpy(), k),
                        "known": np.repeat(batch["known"].to_numpy(), k),
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch)),
                        "n": n,
                        "deviation": deviation.repeat(k),
                        "whitened": white.ravel(),
                        "explained": np.tile(explained, len(batch)),
                        "identity_error": identity_error,
                    }
                )

    out = rows.mapInPandas(apply, schema)
    return out.withColumn("vec_id", F.when(F.col("known"), F.col("vec_id"))).select(*order)

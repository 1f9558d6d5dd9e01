"""Embedding whitening (operator 12): Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Vectors become whole numbers x (``SCALE`` times the entry, floored, plus ``SHIFT``),
kept in a written table of row blocks.  Their sums are exact.  Each step of the
bidiagonalisation is one pass over the blocks that does both products: X h on the
centred rows, then X' of the result, summed by Spark over partitions.

    alpha_j u_j = X v_j - beta_(j-1) u_(j-1)       beta_j v_(j+1) = X' u_j - alpha_j v_j

A left vector is as long as the table.  It is never kept: every u_j is X g_j for
a vector g_j of one row's length, since u_j = X (v_j - beta g_(j-1)) / alpha, so
a pass needs g_j alone and a lost executor costs its running tasks.  Both sides are
fully reorthogonalised, twice: v against all v, u against all u (u_i'u_j = g_i' X'u_j).
The small bidiagonal matrix gives singular values and right vectors; they are the
deviations and components.  Steps end when the residuals of all wanted components
are at rounding level, at the latest after as many steps as dimensions.

A last pass measures the covariance of the whitened rows; where rounding left it
more than ``REFINE`` from the identity, the components are turned by its
eigenvectors (Rayleigh-Ritz) and measured again.

Defined results: rows whose vector is null or holds a null or non-finite entry are
dropped, also those of another length than the commonest (ties: the longest), and
empty vectors; entries beyond 2^55 count as 2^55; equal vectors and repeated rows
count each; a null id is kept; components without deviation (constant or dependent
dimensions, a single row) are not returned, so a table of equal vectors gives no rows;
a deviation that doesn't fit a long is null; extra columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.llm.common import cut, ship

ship(__name__)

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Largest whole number before the shift.
LARGEST = float(1 << 55)
#: Entries of a block of rows.
ENTRIES = 1 << 18
#: Residual at which a component is done, and least deviation, both as a share of the largest one.
DONE, LEAST = 1e-15, 1e-7
#: Distance from the identity above which components are turned once more.
REFINE = 1e-9

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def row_blocks(vectors: DataFrame, size: int) -> DataFrame:
    """ids, x: blocks of rows as little-endian longs, without the shift."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, ENTRIES // size)
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                some = batch.slice(a, step)
                entries = some.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.clip(np.floor(SCALE * np.clip(entries, -LARGEST, LARGEST)), -LARGEST, LARGEST).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    return vectors.mapInArrow(run, "ids array<long>, x binary")


def rows_of(x: bytes, size: int) -> np.ndarray:
    return np.frombuffer(x, np.int64).reshape(-1, size)


def exact_sums(blocks: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows and, for each dimension, the exact sum (without the shift)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            for x in batch.column(1):
                rows = rows_of(x.as_py(), size)
                n += len(rows)
                # halves, so that no sum of a block leaves 64 bits
                high, low = rows >> 32, rows & 0xFFFFFFFF
                total = total + high.sum(axis=0).astype(object) * (1 << 32) + low.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()),
                                          pa.array([Decimal(n), *map(Decimal, total)], pa.decimal128(38, 0))], ["k", "s"])

    found = dict(tuple(r) for r in blocks.mapInArrow(run, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s")).collect())
    return int(found.get(-1, 0)), [int(found.get(k, 0)) for k in range(size)]


class Centre:
    """The exact mean as a whole part and a rest, so that centring loses nothing."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = [round(s / n) if abs(s) < 1 << 52 else s // n for s in sums]
        self.left = [s - n * w for s, w in zip(sums, self.whole, strict=True)]      # S - n * whole
        self.rest = np.array([r / n for r in self.left])

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return (rows - np.array(self.whole, np.int64)).astype(np.float64) - self.rest

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; null where it doesn't fit a long."""
        y = rows - np.array(self.whole, np.int64)
        most = max((abs(int(y.min())), abs(int(y.max())))) * self.n + max(map(abs, self.left))
        if most * most * rows.shape[1] < 1 << 63:
            d = self.n * y - np.array(self.left, np.int64)
            return (d * d).sum(axis=1).tolist()
        found = [sum((self.n * int(a) - r) ** 2 for a, r in zip(row, self.left, strict=True)) for row in y.tolist()]
        return [f if f < 1 << 63 else None for f in found]


def partial_sums(blocks: DataFrame, size: int, centre: Centre, work, length: int) -> np.ndarray:
    """The sum over all blocks of ``work(centred rows)``, a vector of ``length`` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for x in batch.column(0):
                total += work(centre.centred(rows_of(x.as_py(), size)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length, dtype=np.int32)), pa.array(total)], ["k", "v"])

    # one row a partition and entry, added up by Spark; the driver gets one vector
    found = blocks.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v")).toArrow()
    out = np.zeros(length)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


def products(blocks: DataFrame, size: int, centre: Centre, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Square of the length of u = X h, and X' u."""
    def work(rows: np.ndarray) -> np.ndarray:
        u = rows @ h
        return np.append(u @ u, u @ rows)

    out = partial_sums(blocks, size, centre, work, size + 1)
    return float(out[0]), out[1:]


def bidiagonalise(multiply, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right vectors (rows) of the matrix behind ``multiply(h) -> (|X h|^2, X' X h)``."""
    random = np.random.default_rng(12)
    right: list[np.ndarray] = []       # v
    left: list[np.ndarray] = []        # g, where u = X g
    back: list[np.ndarray] = []        # X' u
    alphas, betas, scale = [], [], 0.0

    def apart(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in right:
                v = v - (other @ v) * other
        return v

    v = random.standard_normal(size)
    v /= np.linalg.norm(v)
    while True:
        h = v - betas[-1] * left[-1] if betas else v
        right.append(v)
        square, z = multiply(h)
        for _ in range(2):                                  # u against all earlier u
            for g, w in zip(left, back, strict=True):
                c = float(g @ z)
                h, z = h - c * g, z - c * w
        square = float(h @ z)                               # |X h|^2 of what is left
        alpha = np.sqrt(max(square, 0.0))
        scale = max(scale, alpha)
        if alpha > LEAST * scale:
            left.append(h / alpha)
            back.append(z / alpha)
        else:                                               # X v lies in the earlier u
            alpha = 0.0
            left.append(np.zeros(size))
            back.append(np.zeros(size))
        alphas.append(alpha)
        b = np.diag(alphas) + np.diag(betas, 1)
        p, sigma, q = np.linalg.svd(b)
        scale = max(scale, float(sigma[0]))
        v = apart(back[-1] - alpha * right[-1])
        beta = float(np.linalg.norm(v))
        k = len(alphas)
        if k == size or k >= wanted and (beta * np.abs(p[-1, :wanted]) <= DONE * sigma[0]).all():
            return sigma, q @ np.array(right)
        if beta > 1e-13 * scale:
            v = v / beta
        else:                                               # an invariant subspace: go on with a new direction
            beta, v = 0.0, apart(random.standard_normal(size))
            v /= np.linalg.norm(v)
        betas.append(beta)


def covariance(blocks: DataFrame, size: int, centre: Centre, weights: np.ndarray) -> np.ndarray:
    """Covariance (centred, divisor n) of the rows times ``weights`` (dimensions x columns)."""
    k = weights.shape[1]

    def work(rows: np.ndarray) -> np.ndarray:
        w = rows @ weights
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    out = partial_sums(blocks, size, centre, work, k + k * k) / centre.n
    return out[k:].reshape(k, k) - np.outer(out[:k], out[:k])


def fit(blocks: DataFrame, size: int, wanted: int = COMPONENTS) -> dict | None:
    """Mean, components (rows, numbered by falling eigenvalue), eigenvalues, explained shares and the identity error."""
    n, sums = exact_sums(blocks, size)
    if not n:
        return None
    centre = Centre(n, sums)
    trace = float(partial_sums(blocks, size, centre, lambda rows: np.array([np.square(rows).sum()]), 1)[0]) / n
    if not trace:
        return None
    wanted = min(wanted, size)
    sigma, vectors = bidiagonalise(lambda h: products(blocks, size, centre, h), size, wanted)
    sigma, vectors = sigma[:wanted], vectors[:wanted]
    kept = sigma > LEAST * sigma[0]
    e, vectors = np.square(sigma[kept]) / n, vectors[kept]
    for turn in range(4):
        got = covariance(blocks, size, centre, vectors.T / np.sqrt(e))
        error = float(np.abs(got - np.eye(len(e))).max())
        if error <= REFINE or turn == 3:
            break
        inside = got * np.sqrt(np.outer(e, e))              # covariance of the rows in the components' basis
        e, turned = np.linalg.eigh((inside + inside.T) / 2)
        e, vectors = e[::-1], turned[:, ::-1].T @ vectors
        vectors = np.linalg.qr(vectors.T)[0].T
    signs = np.sign(vectors[np.arange(len(e)), np.abs(vectors).argmax(axis=1)])
    return {"centre": centre, "components": vectors * signs[:, None], "e": e, "explained": e / trace, "identity_error": error}


def whiten(vectors: DataFrame, wanted: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """A row for each remaining row of ``vectors`` (vec_id, embedding) and component."""
    spark = vectors.sparkSession
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    entries = F.col(vector).cast("array<double>")
    clean = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("v"))
             .where(F.col("v").isNotNull() & F.coalesce(F.forall("v", good), F.lit(False))))
    common = (clean.where("size(v) > 0").groupBy(F.size("v").alias("size")).count()
              .orderBy(F.desc("count"), F.desc("size")).first())
    if common is None:
        return spark.createDataFrame([], RESULT)
    size = int(common["size"])
    blocks = cut(row_blocks(clean.where(F.size("v") == size), size), "whitening-rows")
    model = fit(blocks, size, wanted)
    if model is None:
        return spark.createDataFrame([], RESULT)
    sent = spark.sparkContext.broadcast(model)              # a mean and at most ``wanted`` vectors of one row's length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        weights = m["components"].T / np.sqrt(m["e"])
        k, n = len(m["e"]), m["centre"].n
        for batch in batches:
            for ids, x in zip(batch.column(0), batch.column(1), strict=True):
                rows = rows_of(x.as_py(), size)
                white, r = m["centre"].centred(rows) @ weights, len(rows)
                deviations = pa.array(m["centre"].deviations(rows), pa.int64())
                who = pa.array(np.repeat(np.arange(r), k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.as_py(), pa.int64()).take(who), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                     pa.array(np.full(r * k, n)), deviations.take(who), pa.array(white.ravel()),
                     pa.array(np.tile(m["explained"], r)), pa.array(np.full(r * k, m["identity_error"]))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(run, RESULT)


__all__ = ["whiten", "fit", "bidiagonalise", "row_blocks", "Centre"]

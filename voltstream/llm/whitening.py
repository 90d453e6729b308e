"""Embedding whitening by polarisation: covariances from the variances of single dimensions and of sums of two.

1. Vectors become integers x = floor(``SCALE`` * c). The fit list is every distinct x vector once: n vectors with sums S.
2. One scan adds up, exactly, (n x_i - S_i)**2 for every dimension and (n x_i + n x_j - S_i - S_j)**2 for every pair of
   dimensions. With Q for these sums, cov(i, j) = (Q_ij - Q_ii - Q_jj) / (2 n**3), var(i) = Q_ii / n**3: integers
   until that last division.
3. ``numpy.linalg.eigh`` of that matrix gives the components; another scan measures the covariance of the whitened
   fit list. Each vector is projected in its scan partition.

Bounds: only sums reach the driver, one for each dimension and pair. Tasks hold ``BLOCK`` vectors and one integer per
pair. Sums are Python integers in tasks and two decimals (units of 2**60 and the rest) between them.

Cases: vectors that are NULL, empty, hold NULL or non-finite entries, or whose length isn't the commonest one (of
equally common ones the longest) give no rows; so do entries of 2**40 / SCALE or more. Repeated vectors count once in
the fit and get rows each; NULL ids are kept. Components with no variance beyond rounding are left out, so one vector,
or none, gives no rows. ``deviation`` is NULL if it doesn't fit a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm.common import stage

SCALE, COMPONENTS = 256, 4
#: Vectors handled at once.
BLOCK = 1024
_LIMB = 60


def quantised(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and x (array of long) of the usable vectors."""
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda c: c * scale)
    usable = F.forall("c", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float(1 << 40)), F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("c")).where(F.col("c").isNotNull() & (F.size("c") > 0) & usable)
    rows = stage(spark, rows.select("vec_id", F.transform("c", lambda c: F.floor(c).cast("long")).alias("x")), "quantised")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (common.d if common else 0))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, as 64-bit integers if sums of two of them fit 50 bits, else as Python integers."""
    most = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums))
    kind = np.int64 if most < 1 << 49 else object
    return n * x.astype(kind) - np.array(sums, kind)


def _square_sums(t: np.ndarray) -> list[int]:
    """The exact sum of squares of each column."""
    if t.dtype == object:
        return (t * t).sum(axis=0).tolist()
    half = (max(int(t.max()), -int(t.min())).bit_length() + 2) // 2  # t = high * 2**half + low; 1024 products fit
    high, low = t >> half, t & ((1 << half) - 1)
    parts = (np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low)))
    return [(hh << (2 * half)) + (hl << (half + 1)) + ll for hh, hl, ll in zip(*parts)]


def square_sums(fit: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Exact Q by (i, j): i = j for a dimension, i < j for the sum of two; as high * 2**60 + low."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * (d - i) for i in range(d)]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                v = _centred(_matrix(batch.slice(at, BLOCK), d), n, sums)
                for i in range(d):
                    t = v[:, i:] + v[:, i:i + 1]
                    t[:, 0] = v[:, i]
                    total[i] = [a + b for a, b in zip(total[i], _square_sums(t))]
        from decimal import Decimal

        cells = [(i, i + k, q) for i, row in enumerate(total) for k, q in enumerate(row)]
        number = lambda values: pa.array(list(map(Decimal, values)), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), number(c[2] >> _LIMB for c in cells), number(c[2] & ((1 << _LIMB) - 1) for c in cells)],
            ["i", "j", "high", "low"])

    found = fit.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    return found.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance matrix (divisor n), each entry the nearest double."""
    q = {(r.i, r.j): (int(r.high) << _LIMB) + int(r.low) for r in square_sums(fit, n, sums).collect()}
    v = np.empty((len(sums), len(sums)))
    for (i, j), total in q.items():
        v[i, j] = v[j, i] = total / n ** 3 if i == j else (total - q[i, i] - q[j, j]) / (2 * n ** 3)
    return v


class Whitening:
    """n, S, falling eigenvalues, and their unit eigenvectors by column (largest entry positive)."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, components: int = COMPONENTS):
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        full = values > np.trace(v) * len(v) * np.finfo(float).eps
        self.n, self.sums, self.values, self.vectors = n, sums, values[full], vectors[:, full]
        largest = np.take_along_axis(self.vectors, np.abs(self.vectors).argmax(axis=0)[None], axis=0)
        self.vectors = self.vectors * np.sign(largest)
        self.explained = self.values / max(np.trace(v), np.finfo(float).tiny)

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whitened, n x - S) of some x vectors."""
        centred = _centred(x, self.n, self.sums)
        return (centred / self.n).astype(float) @ self.vectors / np.sqrt(self.values), centred


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    d, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, cross = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.apply(_matrix(batch, d))[0]
            if len(w):
                own, m = w.mean(axis=0), len(w)
                cross += (w - own).T @ (w - own) + np.outer(own - mean, own - mean) * (count * m / (count + m))
                mean, count = mean + (own - mean) * (m / (count + m)), count + m
        if count:
            i, j = (a.ravel() for a in np.indices((k, k)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(count * mean[i]), pa.array(count * mean[j]), pa.array((cross + count * np.outer(mean, mean)).ravel())],
                ["i", "j", "si", "sj", "sij"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, si double, sj double, sij double").groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in ("si", "sj", "sij")))
    return max((abs(r.sij / model.n - r.si * r.sj / model.n ** 2 - (r.i == r.j)) for r in parts.collect()), default=0.0)


def fit_whitening(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, float]:
    """The model of ``rows(x)`` and its identity error; None without rows."""
    fit = stage(spark, rows.select("x").distinct(), "fit")
    totals = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("i").collect()
    if not totals:
        return None, 0.0
    n, sums = totals[0].n, [int(r.s) for r in totals]
    model = Whitening(n, sums, covariance(fit, n, sums), components)
    return model, identity_error(fit, model)


def whiten(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every usable vector."""
    rows = quantised(spark, vectors, id_col, vector_col)
    model, error = fit_whitening(spark, rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = len(model.values) if model else 0
            if not k or not batch.num_rows:
                continue
            w, centred = model.apply(_matrix(batch, len(model.sums)))
            most = max(int(centred.max()), -int(centred.min()))
            if centred.dtype != object and most * most * centred.shape[1] < 1 << 63:
                deviation = np.einsum("ij,ij->i", centred, centred).tolist()
            else:
                deviation = [s if s < 1 << 63 else None for s in (centred.astype(object) ** 2).sum(axis=1)]
            m = len(w) * k
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(w)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))), pa.array(np.full(m, model.n)),
                 pa.array([s for s in deviation for _ in range(k)], pa.int64()), pa.array(w.ravel()), pa.array(np.tile(model.explained, len(w))), pa.array(np.full(m, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers x = floor(scale * c) + offset. Per dimension they are shifted
by the smallest one and cut into bit planes; a plane holds one bit a row, 64 rows a
word. For dimensions i and j,

    sum over rows of x_i x_j = sum over planes b, p of 2**(b+p) * popcount(plane_ib AND plane_jp),

so every cross-product is counted exactly, in any order of rows. Sums are centred as
integers, n * Sum(x_i x_j) - S_i * S_j, and only then become doubles for eigh: no
digits cancel, whatever the offset. Rows never leave their partition; only d (d + 1) / 2
integers a partition are shuffled, and a d x d matrix reaches the driver.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, staged

_U = np.uint64
#: floor(scale * c) stops at this size, so that products of sums stay within 38 digits
LIMIT = 1 << 46


def clean_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows whose vector is neither NULL nor holds NULL
    or non-finite entries; of several lengths the commonest stays (ties: the longer)."""
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    ok = (df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
          .where(v.isNotNull()).where(~bad))
    sizes = ok.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.agg(F.max(F.struct("n", "d")).alias("m")).select(F.col("m.d").alias("_d"))
    return ok.join(F.broadcast(most), F.size("v") == F.col("_d")).select("vec_id", "v")


def _matrix(column, scale: float, offset: int) -> np.ndarray:
    """The x-vectors of an Arrow list column, rows x dimensions."""
    if not len(column):
        return np.zeros((0, 0), dtype=np.int64)
    flat = column.flatten().to_numpy().reshape(len(column), -1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * flat), -LIMIT, LIMIT).astype(np.int64) + offset


def _ranges(vectors: DataFrame, scale: float, offset: int):
    """(rows, smallest, largest) per dimension, as integers on the driver."""
    def run(batches):
        n, lo, hi = 0, None, None
        for batch in batches:
            x = _matrix(batch.column(0), scale, offset)
            if x.size:
                n += len(x)
                lo = x.min(0) if lo is None else np.minimum(lo, x.min(0))
                hi = x.max(0) if hi is None else np.maximum(hi, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(lo), dtype=np.int32)), pa.array(np.full(len(lo), n)), pa.array(lo), pa.array(hi)],
                names=["dim", "n", "lo", "hi"])
    rows = (vectors.select("v").mapInArrow(run, "dim int, n long, lo long, hi long").groupBy("dim")
            .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("dim").collect())
    return (rows[0].n if rows else 0), [r.lo for r in rows], [r.hi for r in rows]


def bit_planes(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Planes of non-negative integers, dimension by dimension from the lowest bit:
    (sum of bits, words); row r is bit r % 64 of word r // 64, missing rows are 0."""
    n, d = x.shape
    words = -(-n // 64)
    out = np.zeros((int(bits.sum()), words * 64), dtype=np.uint8)
    at = 0
    for i in range(d):
        b = int(bits[i])
        out[at:at + b, :n] = (x[:, i] >> np.arange(b)[:, None]) & 1
        at += b
    return np.packbits(out, axis=1, bitorder="little").view("<u8").astype(np.uint64)


def _scatter(vectors: DataFrame, scale: float, offset: int, lo, hi, block: int = 4096) -> dict:
    """Exact sums of products of the shifted entries: {(i, j): sum} for i <= j, and
    {(i, -1): sum of entries}."""
    low = np.array(lo, dtype=np.int64)
    bits = np.array([int(b - a).bit_length() for a, b in zip(lo, hi)], dtype=np.int64)
    d, top = len(lo), int(bits.max()) if len(lo) else 0
    dim = np.repeat(np.arange(d), bits)
    place = np.concatenate([np.arange(b) for b in bits]) if d else np.zeros(0, dtype=np.int64)

    def run(batches):
        counts = np.zeros((len(dim), len(dim)), dtype=np.int64)     # popcounts of plane pairs
        ones = np.zeros(len(dim), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                x = _matrix(batch.column(0).slice(at, block), scale, offset) - low
                planes = bit_planes(x, bits)
                ones += np.bitwise_count(planes).sum(1, dtype=np.int64)
                for p in range(len(planes)):
                    counts[p, p:] += np.bitwise_count(planes[p:] & planes[p]).sum(1, dtype=np.int64)
        if not len(dim) or not ones.any():
            return
        full = counts + np.triu(counts, 1).T
        # weights: pairs of planes with the same place value are added first, as counts
        sums = np.zeros((d, d), dtype=object)
        for s in range(2 * top - 1):
            layer = np.zeros((d, d), dtype=np.int64)
            for b in range(max(0, s - top + 1), min(s, top - 1) + 1):
                left, right = np.flatnonzero(place == b), np.flatnonzero(place == s - b)
                layer[np.ix_(dim[left], dim[right])] += full[np.ix_(left, right)]
            sums += layer.astype(object) * (1 << s)
        linear = np.zeros(d, dtype=object)
        for q in range(len(dim)):
            linear[dim[q]] += int(ones[q]) << int(place[q])
        i, j = np.triu_indices(d)
        value = [Decimal(int(sums[a, b])) for a, b in zip(i, j)] + [Decimal(int(v)) for v in linear]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[i, np.arange(d)].astype(np.int32)), pa.array(np.r_[j, np.full(d, -1)].astype(np.int32)),
             pa.array(value, pa.decimal128(38, 0))], names=["i", "j", "s"])
    total = (vectors.select("v").mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j")
             .agg(F.sum("s").alias("s")).collect())
    return {(r.i, r.j): int(r.s) for r in total}


class Whitener:
    """A fitted whitening: row count, exact sums, covariance, components."""

    def __init__(self, n, low, sums, products, components, scale, offset):
        d = len(low)
        self.n, self.scale, self.offset = n, scale, offset
        self.sums = [s + n * a for s, a in zip(sums, low)]                  # of the unshifted integers
        cov = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                # int / int is rounded once; a shift does not change a centred product
                cov[i, j] = cov[j, i] = (n * products.get((i, j), 0) - sums[i] * sums[j]) / (n * n)
        self.covariance, self.trace = cov, float(np.trace(cov))
        e, u = np.linalg.eigh(cov)
        order = np.argsort(-e, kind="stable")
        e, u = e[order], u[:, order]
        keep = [c for c in range(min(components, d)) if e[c] > 1e-12 * max(e[0], 0.0) and e[c] > 0]
        self.values, self.vectors = e[keep], np.ascontiguousarray(u[:, keep])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as exact integers: long where they fit, Python integers else."""
        peak = self.n * (LIMIT + abs(self.offset)) if not x.size else max(
            abs(self.n * int(t) - s) for t, s in [*zip(x.max(0), self.sums), *zip(x.min(0), self.sums)])
        if self.n * int(max(np.abs(x).max(initial=0), 1)) < 1 << 62 and peak < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def deviations(self, y: np.ndarray) -> list:
        """Sum of squares per row, None where it is no long."""
        big = int(np.abs(y).max(initial=0)) if y.size else 0
        if y.dtype != object and big * big * max(y.shape[1], 1) < 1 << 63:
            return (y * y).sum(1).tolist()
        return [t if t < 1 << 63 else None for t in (y.astype(object) ** 2).sum(1).tolist()]

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y.astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000) -> Whitener | None:
    """The whitening of ``vectors`` (vec_id, v), from ``clean_vectors``; None without rows
    or dimensions. Two passes; d numbers, then d (d + 3) / 2 reach the driver."""
    n, lo, hi = _ranges(vectors, scale, offset)
    if not n or not lo:
        return None
    found = _scatter(vectors, scale, offset, lo, hi)
    sums = [found.get((i, -1), 0) for i in range(len(lo))]
    return Whitener(n, lo, sums, found, components, scale, offset)


def identity_error(vectors: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, from
    the rows themselves. They are centred before they are multiplied, as x - S / n is."""
    k = len(model.values)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, one, two = shared.value, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = m.whitened(m.centred(_matrix(batch.column(0), m.scale, m.offset))) if batch.num_rows else np.zeros((0, k))
            one += w.sum(0)
            two += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[i, np.arange(k)].astype(np.int32)), pa.array(np.r_[j, np.full(k, -1)].astype(np.int32)),
             pa.array(np.r_[two[i, j], one])], names=["i", "j", "s"])
    rows = (vectors.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j")
            .agg(F.sum("s").alias("s")).collect())
    got = {(r.i, r.j): r.s / model.n for r in rows}
    return max((abs(got[i, j] - got[i, -1] * got[j, -1] - (i == j)) for i in range(k) for j in range(i, k)), default=0.0)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
           scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """Principal-component whitening of a vector column.

    Returns, per remaining row and component: (``vec_id``, ``component`` from 1 by
    falling eigenvalue, ``n``: rows of the fit, ``deviation``: exact sum over dimensions
    of (n x - S)**2, ``whitened``, ``explained``: the eigenvalue's share of the trace,
    ``identity_error``: one value).

    Rows leave whose vector is NULL or holds NULL or non-finite entries, or is of another
    length than most. floor(scale * c) is limited to 2**46 in size. A ``deviation`` beyond
    a long is NULL. Components without variance (eigenvalue at most 1e-12 of the largest:
    constant dimensions, fewer rows than dimensions) cannot be whitened and are not
    returned; if no row differs there are none and the result is empty, as for an empty
    table. Repeated rows and NULL ids are rows like any other. Eigenvectors of equal
    eigenvalues may be any basis, the same for all rows. Other columns are ignored,
    whatever their names."""
    ship(df.sparkSession)
    spark = df.sparkSession
    vectors = staged(clean_vectors(df, id_col, vector_col))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    model = fit(vectors, components, scale, offset)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, model)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        k = len(m.values)
        share = m.values / m.trace
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                y = m.centred(_matrix(part.column(1), m.scale, m.offset))
                r = len(part)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(r), k)))
                dev = pa.array(m.deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(r), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)), pa.array(np.full(r * k, m.n)), dev,
                     pa.array(m.whitened(y).reshape(-1)), pa.array(np.tile(share, r)), pa.array(np.full(r * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return vectors.mapInArrow(run, schema)

"""Approximate nearest neighbours by vantage-point trees, one per shard.

Nearness is the largest inner product. With one more coordinate,
sqrt(M^2 - |x|^2) for the rows (M the largest norm) and 0 for the queries, the
order of inner products is the order of Euclidean distances, so the triangle
inequality holds and a tree can prune: a node is skipped when its lower bound
times ``factor`` exceeds the distance of the query's k-th best so far. Factor
one is exact; a larger factor skips more.

Rows are dealt to shards of a bounded expected size by a hash of their id, and
queries to blocks. A task gets one shard and one block, builds the tree and
answers the whole block at once: distances to all vantage points are a matrix,
each leaf is scored for the queries that still need it. The k best per query
and shard meet in the final ranking."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship
from .textkernel import mix64

#: relative error of an inner product per component, with room to spare
_EPS = 1e-15


class VantageTree:
    """Tree over the rows of ``x`` (n, d), Euclidean. ``leaves`` are index
    arrays; a leaf's ``paths`` entry lists (vantage point, low, high): the range
    of distances from that point to anything below."""

    def __init__(self, x: np.ndarray, order_key: np.ndarray, leaf: int = 256):
        self.vantage: list[int] = []
        self.leaves: list[np.ndarray] = []
        self.paths: list[list[tuple[int, float, float]]] = []
        todo = [(np.arange(len(x)), [])]
        while todo:
            rows, path = todo.pop()
            if len(rows) <= leaf:
                self.leaves.append(rows)
                self.paths.append(path)
                continue
            v = rows[np.argmin(order_key[rows])]
            at = len(self.vantage)
            self.vantage.append(int(v))
            dist = np.sqrt(np.maximum(((x[rows] - x[v]) ** 2).sum(axis=1), 0))
            near = np.argsort(dist, kind="stable")   # split by rank: equal points spread evenly
            half = len(rows) // 2
            for part in (near[:half], near[half:]):
                todo.append((rows[part], [*path, (at, float(dist[part].min()), float(dist[part].max()))]))

    def bounds(self, dist: np.ndarray) -> np.ndarray:
        """Lower bounds (queries, leaves) from distances (queries, vantage points)."""
        out = np.zeros((len(dist), len(self.leaves)))
        for j, path in enumerate(self.paths):
            for at, low, high in path:
                d = dist[:, at]
                np.maximum(out[:, j], np.maximum(low - d, d - high), out=out[:, j])
        return out


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in order of the components: equal
    vectors get equal scores wherever they stand."""
    return np.cumsum(q * x, axis=1)[:, -1] if len(q) else np.zeros(0)


def search(q_ids, q, ids, x, k: int, factor: float, max_norm: float, leaf: int = 256):
    """(query index, row index, score) of the k best rows per query; ties to the
    smaller id; a row never answers the query with its id."""
    if not len(q) or not len(ids):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(0)
    lift = np.sqrt(np.maximum(max_norm ** 2 - (x * x).sum(axis=1), 0))
    tree = VantageTree(np.c_[x, lift], mix64(ids.view(np.uint64)), leaf)
    base = (q * q).sum(axis=1) + max_norm ** 2       # distance^2 = base - 2 * inner product
    # rounding of a score grows with both norms; of a distance with its root, where it is near 0
    error = _EPS * (x.shape[1] + 4)
    slack, room = error * np.sqrt((q * q).sum(axis=1)) * max_norm, 4 * np.sqrt(error * base)
    if tree.vantage:
        dist = np.sqrt(np.maximum(base[:, None] - 2 * (q @ x[tree.vantage].T), 0))
    else:
        dist = np.zeros((len(q), 0))
    low = tree.bounds(dist)
    score = np.full((len(q), k), -np.inf)
    row = np.full((len(q), k), -1, dtype=np.int64)
    id_of = np.r_[ids, np.iinfo(np.int64).max]       # index -1: no row yet
    seen = np.argmin(low, axis=1)
    for first in (True, False):
        for j, members in enumerate(tree.leaves):
            if first:
                act = np.flatnonzero(seen == j)
            else:
                reach = np.sqrt(np.maximum(base - 2 * np.where(np.isfinite(score[:, -1]), score[:, -1], -np.inf), 0))
                act = np.flatnonzero((seen != j) & (low[:, j] * factor <= reach + room))
            for a in range(0, len(act), 1024):
                some = act[a:a + 1024]
                s = q[some] @ x[members].T
                s[q_ids[some][:, None] == ids[members][None, :]] = -np.inf
                cut = score[some, -1]
                if len(members) > k:
                    cut = np.maximum(cut, np.partition(s, len(members) - k, axis=1)[:, len(members) - k])
                r, c = np.nonzero((s >= (cut - slack[some])[:, None]) & np.isfinite(s))
                if not len(r):
                    continue
                real = _exact(q[some[r]], x[members[c]])
                # merge: old best and new candidates of each query, best first, then smaller id
                keep = np.flatnonzero(row[some].ravel() >= 0)
                rr = np.r_[keep // k, r]
                ss = np.r_[score[some].ravel()[keep], real]
                ii = np.r_[row[some].ravel()[keep], members[c]]
                order = np.lexsort((id_of[ii], -ss, rr))
                rr, ss, ii = rr[order], ss[order], ii[order]
                start = np.searchsorted(rr, np.arange(len(some)))
                place = np.arange(len(rr)) - start[rr]
                ok = place < k
                score[some[rr[ok]], place[ok]] = ss[ok]
                row[some[rr[ok]], place[ok]] = ii[ok]
    qi, pl = np.nonzero(row >= 0)
    return qi, row[qi, pl], score[qi, pl]


def _matrix(column, dim: int) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    return np.asarray(col.flatten(), dtype=np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = 20, factor: float = 1.0, shard_rows: int = 16_384, block_rows: int = 4_096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the
    largest inner product for each row of ``queries``, in double precision on the
    vectors as given.

    A vector that is NULL, empty, zero, or holds a NULL or non-finite component
    takes no part, nor does a row without an id; vectors are compared with those of
    their own length. Ties go to the smaller id. A row never answers a query with
    its own id; rows that repeat id and vector count once. Fewer than ``k``
    candidates are all returned. Empty inputs give an empty result; other columns
    are ignored."""
    ship(vectors.sparkSession)

    def clean(df):
        v = F.transform(F.col(vec_col), lambda e: e.cast("double"))
        d = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and size(v) > 0")
        bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
        return d.where(~bad & F.exists("v", lambda e: e != 0)).withColumn("dim", F.size("v"))

    rows, asked = clean(vectors), clean(queries)
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)
    n, top = rows.agg(F.count("*"), F.max(F.sqrt(norm2))).first()
    m = asked.count()
    shards, blocks = max(1, math.ceil((n or 0) / shard_rows)), max(1, math.ceil(m / block_rows))
    top = float(top or 0.0) * (1 + 1e-12)
    share = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int")
    left = rows.select("id", "v", "dim", share.alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.select("id", "v", "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                         block.alias("block"))

    def unpack(key, table):
        dim = key[0].as_py()
        ids, x = np.asarray(table["id"], dtype=np.int64), _matrix(table["v"], dim)
        order = np.lexsort((*x.T[::-1], ids))
        ids, x = ids[order], x[order]
        new = np.r_[True, (ids[1:] != ids[:-1]) | (x[1:] != x[:-1]).any(axis=1)]
        return ids[new], x[new]

    def run(key, a, b):
        none = np.zeros(0, dtype=np.int64)
        if not a.num_rows or not b.num_rows:
            q, v, s = none, none, np.zeros(0)
        else:
            (ids, x), (q_ids, qv) = unpack(key, a), unpack(key, b)
            qi, ri, s = search(q_ids, qv, ids, x, k, factor, top)
            q, v = q_ids[qi], ids[ri]
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()),
                         "score": pa.array(s, pa.float64())})

    found = (left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim", "shard", "block"))
             .applyInArrow(run, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

"""Truncated SVD of a sparse matrix held as a long table (row, column, value).

A randomised range finder: a hash-normal test matrix with k + oversample columns,
power iterations, orthonormal bases by a blockwise QR. The entries are packed once into
blocks of whole matrix rows, with columns numbered inside a block, and written. A product
reads a block's file a chunk at a time, so that a task never holds its entries; it is
sent one short array for each column of the block, or sends one back, never one for each
entry; a column that only one block holds does not leave it. Only triangular blocks of
(k + oversample)^2 numbers reach the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import normals
from ..session import cut_lineage, ship

BLOCK_ENTRIES = 48_000_000     # entries of a block
CHUNK_ENTRIES = 262_144        # entries read and multiplied at once


def _triangle(rows: np.ndarray, above: np.ndarray | None) -> np.ndarray:
    return np.linalg.qr(rows if above is None else np.vstack([above, rows]), mode="r")


def _block(frames: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    r = None
    for frame in frames:
        if len(frame):
            r = _triangle(np.stack(frame["v"].to_numpy()).reshape(-1, width), r)
    if r is not None:
        yield pd.DataFrame({"r": [r.ravel().tolist()]})


def triangle(table: DataFrame, width: int, fan: int = 64) -> np.ndarray:
    """The triangular factor of the array column ``v`` (one matrix row a table row):
    a QR per partition, one per group of partitions, one of ``fan`` blocks at most on
    the driver. An empty table gives no rows."""
    ship(table.sparkSession)

    def first(frames):
        yield from _block(frames, width)

    def second(group: pd.DataFrame) -> pd.DataFrame:
        whole = np.concatenate([np.reshape(x, (-1, width)) for x in group["r"]])
        return pd.DataFrame({"r": [_triangle(whole, None).ravel().tolist()]})
    blocks = (table.select("v").mapInPandas(first, "r array<double>")
                   .withColumn("g", F.spark_partition_id() % fan).groupBy("g").applyInPandas(second, "r array<double>"))
    parts = [np.reshape(x["r"], (-1, width)) for x in blocks.collect()]
    return _triangle(np.concatenate(parts), None) if parts else np.zeros((0, width))


def _times(table: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """Rows of ``v`` times a small constant matrix."""
    cols = [sum((F.get("v", F.lit(i)) * F.lit(float(matrix[i, j])) for i in range(matrix.shape[0])), F.lit(0.0))
            for j in range(matrix.shape[1])]
    return table.select(key, F.array(*cols).alias("v"))


def _basis(table: DataFrame, width: int, tolerance: float) -> np.ndarray:
    """The matrix that turns the table's columns into an orthonormal basis (a column per rank)."""
    r = triangle(table, width)
    if not r.size:
        return np.zeros((width, 0))
    _, s, vt = np.linalg.svd(r)
    rank = int((s > tolerance * s[0]).sum()) if s[0] > 0 else 0
    return vt[:rank].T / s[:rank]


class _Codes:
    """Values numbered 0, 1, 2, ... as they come."""

    def __init__(self):
        self.at = {}

    def take(self, values: pa.Array) -> np.ndarray:
        coded, at = values.dictionary_encode(), self.at
        new = np.fromiter((at.setdefault(x, len(at)) for x in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        return new[coded.indices.to_numpy(zero_copy_only=False)]


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)


def _smallest(values: np.ndarray) -> np.ndarray:
    """The values as the smallest unsigned integers that hold them all, or as they are."""
    top = values.max()
    return values.astype(np.min_scalar_type(int(top))) if values.min() >= 0 and top < 2 ** 32 and (values == np.floor(values)).all() else values


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


_PACKED = ("block long, at int, rows binary, lens binary, names binary, cols binary, vals binary, form string, `row` {row}, `column` {column}, "
           "cf double, df long")


def _pack(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Blocks of coded entries in chunks, and the rows and columns that the codes stand for.

    A batch holds either entries (row, column, value), or rows (row, columns) whose
    columns count once for each time they occur."""
    types = {}

    def out(n: int, **given) -> pa.RecordBatch:
        kinds = {"block": pa.int64(), "at": pa.int32(), "rows": pa.binary(), "lens": pa.binary(), "names": pa.binary(), "cols": pa.binary(), "vals": pa.binary(),
                 "form": pa.string(), "row": types["row"], "column": types["column"], "cf": pa.float64(), "df": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(given[k], t) if k in given else pa.nulls(n, t) for k, t in kinds.items()], list(kinds))

    def names(block, rows, columns, cf, df):
        for name, codes in (("row", rows), ("column", columns)):
            keys = list(codes.at)
            for i in range(0, len(keys), 100_000):
                part = keys[i:i + 100_000]
                more = {} if name == "row" else {"cf": cf[i:i + len(part)], "df": df[i:i + len(part)]}
                yield out(len(part), block=np.full(len(part), block), at=np.arange(i, i + len(part)), **{name: part}, **more)

    number, held = 0, 0
    for batch in batches:
        if "value" in batch.schema.names:
            row, column = batch.column("row"), batch.column("column")
            value, of = batch.column("value").to_numpy(zero_copy_only=False), None
        else:
            lists = batch.column("columns")
            of = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            row, column = batch.column("row"), lists.flatten()
            value = np.ones(len(column))
        if not types:
            types = {"row": row.type, "column": column.type}
        if not len(column):
            continue
        if not held:
            block, rows, columns, cf, df = (TaskContext.get().partitionId() << 32) + number, _Codes(), _Codes(), np.zeros(1024), np.zeros(1024, np.int64)
        r = rows.take(row) if of is None else np.repeat(rows.take(row), of)
        c = columns.take(column)
        width = len(columns.at)
        order = np.argsort(r * width + c, kind="stable")
        r, c = r[order], c[order]
        at = _runs(r * width + c)
        r, c, value = r[at], c[at], np.add.reduceat(value[order], at)
        cf, df = _grown(cf, width), _grown(df, width)
        np.add.at(cf, c, value)
        np.add.at(df, c, 1)
        for i in range(0, len(r), CHUNK_ENTRIES):
            x, z = r[i:i + CHUNK_ENTRIES].astype(np.int32), _smallest(value[i:i + CHUNK_ENTRIES])
            own, y = np.unique(c[i:i + CHUNK_ENTRIES].astype(np.int32), return_inverse=True)     # a chunk numbers its columns again
            y, at = _smallest(y), _runs(x)
            lens = np.diff(np.r_[at, len(x)]).astype(np.int32)
            yield out(1, block=[block], form=[f"{y.dtype.str} {z.dtype.str}"],
                      **{k: [a.tobytes()] for k, a in (("rows", x[at]), ("lens", lens), ("names", own), ("cols", y), ("vals", z))})
        held += len(r)
        if held >= limit:
            yield from names(block, rows, columns, cf, df)
            number, held = number + 1, 0
    if held:
        yield from names(block, rows, columns, cf, df)


class Blocks(NamedTuple):
    """A sparse matrix in blocks of rows: ``chunks`` (block, rows, lens, names, cols, vals, form), ``rows`` (block, at, row),
    ``places`` (block, at, column) and ``columns`` (column, cf, df, places): the sum of a column, the number of its
    entries and its numbers in the blocks that hold it."""
    chunks: DataFrame
    rows: DataFrame
    columns: DataFrame
    places: DataFrame


def pack(table: DataFrame, block_entries: int = BLOCK_ENTRIES) -> Blocks:
    """Blocks of a table (row, column, value), whose entries of one cell add up, or of a
    table (row, columns) with one line a row, whose columns are counted. The table is dealt
    out by ``row``; its tasks make a block each, more above ``block_entries``."""
    spark = ship(table.sparkSession)
    kinds = dict(table.dtypes)
    schema = _PACKED.format(row=kinds["row"], column=kinds["column"] if "column" in kinds else kinds["columns"][6:-1])

    def packed(batches):
        yield from _pack(batches, block_entries)
    raw = cut_lineage(table.mapInArrow(packed, schema))
    places = raw.where("column IS NOT NULL").select("block", "at", "column", "cf", "df")
    # dealt first: a partial aggregate would only hold what is already one line a block
    columns = places.repartition("column").groupBy("column").agg(
        F.sum("cf").alias("cf"), F.sum("df").alias("df"), F.collect_list(F.struct("block", "at")).alias("places"))
    return Blocks(raw.where("cols IS NOT NULL").select("block", "rows", "lens", "names", "cols", "vals", "form"),
                  raw.where("row IS NOT NULL").select("block", "at", "row"), cut_lineage(columns), places.select("block", "at", "column"))


class _Chunks:
    """The chunks of a block, from the file of the task that packed it."""

    def __init__(self, files: dict[int, list[str]], key: int):
        self.files, self.key = files.get(key >> 32, []), key

    def read(self, names: list[str]) -> Iterator[tuple]:
        for uri in self.files:
            where, path = fs.FileSystem.from_uri(uri)
            # buffered: a row group of the file is not held at once
            with where.open_input_file(path) as stream, pq.ParquetFile(stream, buffer_size=1 << 20, pre_buffer=False) as file:
                at = file.schema_arrow.names.index("form")        # short in every chunk: it always has statistics
                for group in range(file.num_row_groups):
                    known = file.metadata.row_group(group).column(at).statistics
                    left = known.num_values if known is not None else file.metadata.row_group(group).num_rows
                    if not left:
                        continue                       # names of rows and columns only
                    for batch in file.iter_batches(4, row_groups=[group], columns=["block", "lens", *names]):
                        mine = pc.is_valid(batch.column("lens"))
                        left -= mine.true_count
                        batch = batch.filter(pc.and_(mine, pc.equal(batch.column("block"), self.key)))
                        yield from zip(*(batch.column(c) for c in names))
                        if left <= 0:
                            break                      # the rest of the group are names

    def entries(self) -> Iterator[tuple]:
        """Rows, entries of each, columns, entries as numbers of those columns, values."""
        for *whole, cols, vals, form in self.read(["rows", "lens", "names", "cols", "vals", "form"]):
            forms = form.as_py().split()
            yield tuple(np.frombuffer(x.as_buffer(), t) for x, t in zip([*whole, cols, vals], [np.int32, np.int32, np.int32, *forms]))


class _Matrix:
    """One block in a task; its entries stay in the file."""

    def __init__(self, files: dict[int, list[str]], marks: pa.Table, key: int, unit: bool):
        self.chunks = _Chunks(files, key).entries
        n = self.height = 0
        for rows, names in _Chunks(files, key).read(["rows", "names"]):
            self.height = max(self.height, 1 + int(np.frombuffer(rows.as_buffer(), np.int32).max()))
            n = max(n, 1 + int(np.frombuffer(names.as_buffer(), np.int32).max()))
        at = marks.column("at").to_numpy()
        self.known, self.c, self.scale, self.shared = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
        self.known[at], self.c[at], self.scale[at] = True, marks.column("c").to_numpy(), marks.column("scale").to_numpy()
        self.shared[at] = marks.column("shared").to_numpy()
        self.turn = np.ones(self.height)
        if unit:
            square = np.zeros(self.height)
            for rows, lens, names, cols, vals in self.chunks():
                square[rows] += np.add.reduceat((vals * self.scale[names][cols]) ** 2, np.cumsum(lens) - lens)
            self.turn = np.divide(1.0, np.sqrt(square), out=np.zeros(self.height), where=square > 0)

    def times(self, x: np.ndarray) -> np.ndarray:
        """The block times a row of ``x`` for each of its columns."""
        out = np.zeros((self.height, x.shape[1]))
        for rows, lens, names, cols, vals in self.chunks():
            start, mine = np.cumsum(lens) - lens, (x[names] * self.scale[names][:, None]).T.copy()
            cols, vals = cols.astype(np.intp), vals.astype(float)       # once, not for each column of x
            out[rows] += np.stack([np.add.reduceat(v[cols] * vals, start) for v in mine], axis=1)
        return out * self.turn[:, None]

    def back(self, y: np.ndarray, only: np.ndarray | None = None) -> np.ndarray:
        """The transposed block times a row of ``y`` for each of its rows; for the columns ``only``."""
        out, y = np.zeros((len(self.c), y.shape[1])), y * self.turn[:, None]
        for rows, lens, names, cols, vals in self.chunks():
            of = np.repeat(np.arange(len(rows)), lens)
            if only is not None:
                some = only[names][cols]
                of, cols, vals = of[some], cols[some], vals[some]
            if len(cols):
                mine, cols, vals = y[rows].T.copy(), cols.astype(np.intp), vals.astype(float)
                out[names] += np.stack([np.bincount(cols, v[of] * vals, len(names)) for v in mine], axis=1)
        return out * self.scale[:, None]


def _arrays(table: pa.Table, negative: bool, n: int, width: int) -> np.ndarray:
    """The arrays ``v`` at 0, 1, ... or at -1, -2, ..., as ``n`` rows; zeros where there is none."""
    out = np.zeros((n, width))
    for x in table.select(["at", "v"]).to_batches():
        at = x.column("at").to_numpy()
        mine = at < 0 if negative else at >= 0
        if mine.any():
            v = x.column("v").filter(pa.array(mine)).flatten().to_numpy()
            out[-1 - at[mine] if negative else at[mine]] = v.reshape(-1, width)
    return out


def _state(**columns) -> pa.Table:
    v = columns.pop("v")
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, max(v.shape[1], 1), dtype=np.int32)), pa.array(v.ravel()))
    return pa.table({**columns, "v": lists})


_LINES = "block long, at int, v array<double>"


class _Dealt(NamedTuple):
    """The weights of the columns, cached by block in ``parts`` partitions, and the files of the chunks by their task."""
    table: DataFrame
    parts: int
    unit: bool
    files: dict[int, list[str]]

    def apply(self, state: DataFrame, work: Callable, schema: str) -> DataFrame:
        """``work`` on each block, its number and its lines of ``state``; only ``state`` moves."""
        files, unit = self.files, self.unit

        def run(marks: pa.Table, lines: pa.Table) -> pa.Table:
            key = (lines if lines.num_rows else marks).column("block")[0].as_py()
            return work(_Matrix(files, marks, key, unit), key, lines)
        return self.table.groupBy("block").cogroup(
            state.repartition(self.parts, "block").groupBy("block")).applyInArrow(run, schema)


def _files(table: DataFrame) -> dict[int, list[str]]:
    """The files of a written table by the task that wrote them."""
    out: dict[int, list[str]] = {}
    for uri in sorted(table.inputFiles()):
        out.setdefault(int(uri.rsplit("/", 1)[1].split("-")[1]), []).append(uri)
    return out


def _rows(key: int, v: np.ndarray) -> pa.Table:
    """The left side of a block: row i is at -1 - i."""
    return _state(block=np.full(len(v), key), at=(-1 - np.arange(len(v))).astype(np.int32), v=v)


def _first(dealt: _Dealt, places: DataFrame, seeds: list[str]) -> DataFrame:
    """(block, at, v): the matrix times the normals of the names of its columns."""
    def work(m: _Matrix, key: int, state: pa.Table) -> pa.Table:
        x = np.zeros((len(m.c), len(seeds)))
        for part in state.select(["at", "name"]).to_batches():
            x[part.column("at").to_numpy()] = normals(part.column("name").to_pylist(), seeds)
        return _rows(key, m.times(x))
    names = places.select("block", "at", F.col("column").cast("string").alias("name"))
    return cut_lineage(dealt.apply(names, work, _LINES))


def _left(dealt: _Dealt, words: DataFrame, width: int, turn: np.ndarray, before: DataFrame, last: np.ndarray) -> DataFrame:
    """(block, at, v): the matrix times ``turn`` times the columns' arrays of ``words``; those of columns in one block
    come from the left side ``before`` times ``last``."""
    def work(m: _Matrix, key: int, state: pa.Table) -> pa.Table:
        x = _arrays(state, False, len(m.c), width)
        own = m.known & ~m.shared
        x[own] = m.back(_arrays(state, True, m.height, len(last)) @ last, own)[own]
        return _rows(key, m.times(x @ turn))
    return cut_lineage(dealt.apply(words.unionByName(before), work, _LINES))


def _right(dealt: _Dealt, left: DataFrame, last: np.ndarray, places: DataFrame | None) -> DataFrame:
    """(c, v, places): the transposed matrix times the left side times ``last``. Columns of one block are there as the
    triangular factor of their arrays, below 0; without ``places``, each as it is."""
    whole = places is None

    def work(m: _Matrix, key: int, state: pa.Table) -> pa.Table:
        out = m.back(_arrays(state, True, m.height, len(last)) @ last)
        if whole:
            return _state(c=m.c[m.known], v=out[m.known])
        some, own = m.known & m.shared, out[m.known & ~m.shared]
        own = _triangle(own, None) if len(own) else own
        code = -1 - (((key >> 32) * 65536 + (key & 0xFFFFFFFF)) * 1024 + np.arange(len(own)))    # one a block and row
        return _state(c=np.concatenate([m.c[some], code]), v=np.vstack([out[some], own]))
    parts = dealt.apply(left, work, "c long, v array<double>").repartition("c")     # a block has a column once: nothing to add up before
    width = last.shape[1]
    sums = parts.groupBy("c").agg(*[F.sum(F.get("v", F.lit(j))).alias(f"_{j}") for j in range(width)])
    out = sums.select("c", F.array(*[f"_{j}" for j in range(width)]).alias("v"))
    return cut_lineage(out if whole else out.join(places, "c", "left"))


def _lines(right: DataFrame) -> DataFrame:
    """The arrays of shared columns for each block that holds them."""
    return right.where("places IS NOT NULL").select(F.explode("places").alias("_p"), "v").select("_p.block", "_p.at", "v")


def block_svd(blocks: Blocks, k: int, weights: DataFrame | None = None, unit_rows: bool = False, oversample: int = 10,
              iterations: int = 4, seed: int = 42, tolerance: float = 1e-12) -> tuple[DataFrame, DataFrame, list[float]]:
    """``truncated_svd`` of a matrix in blocks: (row, v), (column, v), singular values.

    ``weights`` (column, weight) multiply the columns; columns without one take no
    part. ``unit_rows`` divides each row by its length after that."""
    width = k + oversample
    known = (blocks.columns.withColumn("weight", F.lit(1.0)) if weights is None else blocks.columns.join(weights, "column"))
    columns = cut_lineage(known.select(F.monotonically_increasing_id().alias("c"), "column", F.col("weight").alias("scale"),
                                       (F.size("places") > 1).alias("shared"), "places"))
    marks = columns.select("c", "scale", "shared", F.explode("places").alias("_p")).select(
        "_p.block", "_p.at", "c", "scale", "shared")
    parts = 4 * blocks.chunks.select("block").distinct().count()      # few blocks meet in one
    rank = 0
    if parts:
        table = marks.repartition(parts, "block").sortWithinPartitions("block").persist()
        dealt = _Dealt(table, parts, unit_rows, _files(blocks.chunks))
        left = _first(dealt, blocks.places, [f"{seed}:{j}" for j in range(width)])
        turn = _basis(left, width, tolerance)
        rank = turn.shape[1]
        places = columns.where("shared").select("c", "places")
        for _ in range(iterations):
            if not rank:
                break
            right = _right(dealt, left, turn, places)
            to = _basis(right, rank, tolerance)
            if not to.shape[1]:
                rank = 0
                break
            left = _left(dealt, _lines(right), rank, to, left, turn)
            turn = _basis(left, to.shape[1], tolerance)
            rank = turn.shape[1]
    if not rank:
        nothing = F.array().cast("array<double>").alias("v")
        return blocks.rows.select("row", nothing), blocks.columns.select("column", nothing), []
    right = _right(dealt, left, turn, None)
    table.unpersist()
    _, s, vt = np.linalg.svd(triangle(right, rank))
    s, v = s[:k], vt[:k].T
    s, v = s[s > tolerance * s[0]], v[:, s > tolerance * s[0]]
    loadings = cut_lineage(_times(right.join(columns.select("c", "column"), "c"), "column", v / s))
    signs = loadings.agg(*[F.max_by(F.signum(F.get("v", F.lit(j))),
                                    F.struct(F.round(F.abs(F.get("v", F.lit(j))), 9), F.col("column").cast("string")))
                           .alias(f"_{j}") for j in range(len(s))]).first()
    sign = np.array([1.0 if x >= 0 else -1.0 for x in signs])
    rows = left.select("block", (-1 - F.col("at")).alias("at"), "v").join(blocks.rows, ["block", "at"])
    return (_times(rows, "row", turn @ (v * s * sign)), _times(loadings, "column", np.diag(sign)), [float(x) for x in s])


def truncated_svd(entries: DataFrame, k: int, row: str = "row", column: str = "column", value: str = "value",
                  oversample: int = 10, iterations: int = 4, seed: int = 42, salt: int | None = None,
                  tolerance: float = 1e-12) -> tuple[DataFrame, DataFrame, list[float]]:
    """(scores, loadings, singular values) of the matrix of ``entries``, uncentred.

    ``scores``: (row, v) with v the row of U * Sigma; ``loadings``: (column, v) with v
    the row of V; at most ``k`` components, fewer when the rank is lower. Each
    component's largest loading (ties: the last column by name) is positive. NULL
    keys or values take no part; several entries of one cell add up.

    The error of a component falls with (s_out / s_i)^(2 * iterations + 1), where
    s_out is the first singular value outside the k + oversample kept. A column that is
    in most rows is one line a block, so ``salt`` has nothing left to spread."""
    table = entries.select(F.col(row).alias("row"), F.col(column).alias("column"), F.col(value).cast("double").alias("value")).dropna()
    blocks = pack(table.repartition(max(1, -(-table.count() // BLOCK_ENTRIES)), "row"))
    scores, loadings, values = block_svd(blocks, k, oversample=oversample, iterations=iterations, seed=seed, tolerance=tolerance)
    return scores.withColumnRenamed("row", row), loadings.withColumnRenamed("column", column), values

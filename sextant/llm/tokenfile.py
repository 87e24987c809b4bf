"""Token ids as Arrow files of fixed-size lists.

Documents are range-partitioned by id, sorted, and encoded in that order; every
partition is one stream of ids (each document followed by the end id), cut into
sequences of one length. A partition writes two files in Arrow's IPC file format:

``part-00000.arrow``       ids: fixed_size_list<uint16|uint32>[length], mask:
                           fixed_size_list<bool>[length] (false: padding, only at the end)
``part-00000.docs.arrow``  doc_id, start (within the partition's stream), n_tokens

All sequences have one size, so sequence i is at a known place: a reader maps the
file and takes any of them without copying. Names follow the partition, and a file
gets its name when it is complete, so a task that runs again replaces its own files.

Encoding is that of the ``tokenizers`` library, word by word: the tokenizer drops
white space and never joins text across it, so a text's ids are those of its words in
turn. A task encodes every distinct word once."""

from __future__ import annotations

import math
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import textkernel as K
from .common import ship, staged

# letters whose normal form and lower case are single letters of the same kind,
# then marks that are never part of a contraction or a special token
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!#-&(-/:;=?@\[-`{}~]*)")


class WordEncoder:
    """Ids of the words of documents, with a memory of the words seen."""

    def __init__(self, path: str, remember: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tok, self.remember = Tokenizer.from_file(path), remember
        self.model = self.tok.model
        self.pieces: dict[str, list[int]] = {}
        letters = [chr(c) for c in range(0x100)]
        # lower case and byte alphabet of single characters, as the library maps them
        self.table = {}
        for c in letters:
            if _PLAIN.fullmatch(c):
                got = self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(c)) if c.strip() else []
                if len(got) == 1:
                    self.table[ord(c)] = got[0][0]
        self._reset()

    def _reset(self):
        self.at: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.size = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _piece(self, text: str) -> list[int]:
        return [t.id for t in self.model.tokenize(text.translate(self.table))]

    def _ids(self, raw: list[str]) -> list[list[int]]:
        out: list = [None] * len(raw)
        rest = []
        for i, w in enumerate(raw):
            m = _PLAIN.fullmatch(w)
            if m is None:
                rest.append(i)
                continue
            head, tail = m.groups()
            ids = self._piece(head) if head else []
            if tail:
                end = self.pieces.get(tail)
                if end is None:
                    end = self.pieces[tail] = self._piece(tail)
                ids = ids + end
            out[i] = ids
        if rest:
            for i, e in zip(rest, self.tok.encode_batch_fast([raw[i] for i in rest], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def _learn(self, hashes: list[int], words: list[str]):
        ids = self._ids(words)
        n = len(self.at)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        while n + len(ids) > len(self.start):
            self.start = np.r_[self.start, np.zeros_like(self.start)]
            self.size = np.r_[self.size, np.zeros_like(self.size)]
        self.flat[self.used:self.used + total] = [x for one in ids for x in one]
        self.size[n:n + len(ids)] = sizes
        self.start[n:n + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.used += total
        for k, h in enumerate(hashes):
            self.at[h] = n + k

    def encode(self, w: K.Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, ids per document), the end id after each."""
        if len(self.at) > self.remember:
            self._reset()
        uniq, first, inv = np.unique(w.hash, return_index=True, return_inverse=True)
        at = self.at
        new = [k for k, h in enumerate(uniq.tolist()) if h not in at]
        if new:
            body = w.bytes.tobytes()
            b, e = w.begin[first], w.stop[first]
            self._learn([int(uniq[k]) for k in new], [body[b[k]:e[k]].decode("utf-8", "replace") for k in new])
        idx = np.fromiter((at[h] for h in uniq.tolist()), dtype=np.int64, count=len(uniq))[inv]
        size = self.size[idx]
        total = int(size.sum())
        before = np.cumsum(size) - size
        ids = self.flat[np.repeat(self.start[idx] - before, size) + np.arange(total)]
        doc = np.repeat(w.doc, size)
        per_doc = np.bincount(doc, minlength=w.n_docs).astype(np.int64) + 1
        out = np.full(total + w.n_docs, end_id, dtype=np.uint32)
        out[np.arange(total) + doc] = ids
        return out, per_doc


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class _Writer:
    """One Arrow IPC file under a temporary name until it is complete."""

    def __init__(self, folder: str, name: str, schema: pa.Schema):
        self.fs, base = _open(folder)
        self.fs.create_dir(base, recursive=True)
        self.final, self.temp = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.temp)
        self.file = pa.ipc.new_file(self.stream, schema)

    def close(self):
        self.file.close()
        self.stream.close()
        self.fs.move(self.temp, self.final)


def _list_schema(length: int, dtype: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", dtype, nullable=False), length)),
                      ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length))])


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 length: int = 2048, end_id: int = 2, part_bytes: int = 16 << 20, vocab: int = 1 << 16) -> DataFrame:
    """Write the files under ``folder`` (a shared folder, as a path or URI) and
    return (part, n_docs, n_tokens, n_sequences), one row per file pair.

    A NULL text is an empty one (its only id is the end id). Rows are in ascending
    id order, rows without an id first, rows that repeat an id by text. Other columns
    are ignored. An empty table writes no file. ``vocab`` bounds the ids: up to 65,536
    they take two bytes."""
    ship(docs.sparkSession)
    dtype, np_type = (pa.uint16(), np.uint16) if vocab <= 1 << 16 else (pa.uint32(), np.uint32)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))

    def run(batches):
        part = TaskContext.get().partitionId()
        name, seqs, rows = f"part-{part:05d}", None, None
        enc, rest = None, np.zeros(0, dtype=np_type)
        n_docs = n_tokens = n_seq = 0

        def put(ids: np.ndarray, live: int):
            flat = pa.array(ids.astype(np_type), dtype)
            mask = pa.array(np.arange(len(ids)) < live)
            schema = _list_schema(length, dtype)
            seqs.file.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(flat, type=schema.field("ids").type),
                 pa.FixedSizeListArray.from_arrays(mask, type=schema.field("mask").type)], schema=schema))

        for batch in batches:
            if enc is None:
                enc = WordEncoder(tokenizer_path)
                seqs = _Writer(folder, f"{name}.arrow", _list_schema(length, dtype))
                rows = _Writer(folder, f"{name}.docs.arrow", _DOCS)
            for a, b, w in K.word_blocks(batch.column(1), 1 << 20):
                ids, per_doc = enc.encode(w, end_id)
                start = n_tokens + np.cumsum(per_doc) - per_doc
                rows.file.write_batch(pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(start), pa.array(per_doc)], schema=_DOCS))
                n_docs, n_tokens = n_docs + b - a, n_tokens + len(ids)
                rest = np.r_[rest, ids.astype(np_type)]
                full = len(rest) // length
                if full:
                    put(rest[:full * length], full * length)
                    rest, n_seq = rest[full * length:].copy(), n_seq + full
        if enc is not None:
            if len(rest):
                put(np.r_[rest, np.zeros(length - len(rest), dtype=np_type)], len(rest))
                n_seq += 1
            seqs.close()
            rows.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([n_docs], pa.int64()), pa.array([n_tokens], pa.int64()),
                 pa.array([n_seq], pa.int64())], names=["part", "n_docs", "n_tokens", "n_sequences"])
    ordered = src.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")
    # written once, as a table: the files are a product of this job
    return staged(ordered.mapInArrow(run, "part int, n_docs long, n_tokens long, n_sequences long"))


def read_sequence(folder: str, part: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of sequence ``i`` of a partition, from its place in the file."""
    fs, base = _open(folder)
    local = isinstance(fs, pafs.LocalFileSystem)
    path = f"{base}/part-{part:05d}.arrow"
    with (pa.memory_map(path) if local else fs.open_input_file(path)) as f:
        reader = pa.ipc.open_file(f)
        for b in range(reader.num_record_batches):
            batch = reader.get_batch(b)
            if i < batch.num_rows:
                n = batch.schema.field("ids").type.list_size
                ids = batch.column(0).flatten().slice(i * n, n).to_numpy(zero_copy_only=True)
                return ids, batch.column(1).flatten().slice(i * n, n).to_numpy(zero_copy_only=False)
            i -= batch.num_rows
    raise IndexError("no such sequence")


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files: ``start``
    counts the ids of all documents before it, over all parts."""
    ship(spark)
    upto = Window.orderBy("part")      # one row per file
    base = manifest.select("part", (F.sum("n_tokens").over(upto) - F.col("n_tokens")).alias("base"))
    n = manifest.count()

    def run(batches):
        fs, root = _open(folder)
        local = isinstance(fs, pafs.LocalFileSystem)

        def opened(name):
            path = f"{root}/{name}"
            return pa.memory_map(path) if local else fs.open_input_file(path)
        for batch in batches:
            for part, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(f"part-{part:05d}.arrow") as f, opened(f"part-{part:05d}.docs.arrow") as g:
                    seqs, docs = pa.ipc.open_file(f), pa.ipc.open_file(g)
                    nth, have, off = 0, np.zeros(0, dtype=np.uint32), 0   # ids from stream place ``off`` on
                    for b in range(docs.num_record_batches):
                        d = docs.get_batch(b)
                        first, size = d.column(1).to_numpy(), d.column(2).to_numpy()
                        need = int(first[-1] + size[-1]) if len(size) else off
                        have, off = have[int(first[0]) - off:] if len(size) else have, int(first[0]) if len(size) else off
                        more = [have]
                        end = off + len(have)
                        while end < need:
                            x = seqs.get_batch(nth)
                            nth += 1
                            flat = x.column(0).flatten().to_numpy(zero_copy_only=True)
                            more.append(flat.astype("<u4"))
                            end += len(flat)
                        have = np.concatenate(more)
                        crc = [zlib.crc32(have[s - off:s - off + m].astype("<u4").tobytes())
                               for s, m in zip(first.tolist(), size.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [d.column(0), pa.array(first + start), d.column(2), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return (base.repartition(max(1, n), "part")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files below the shared checkpoint folder."""
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/tokens-{uuid.uuid4().hex}"

"""Vectorised word and shingle hashing over Arrow string columns.

Inside a task the text of a batch is one byte buffer. Word boundaries, word
hashes and shingle hashes are computed for all its documents by numpy array
operations: no per-word Python. Words are maximal runs of bytes other than
space and 0x09-0x0D; A-Z hash like a-z. Hashes are 64-bit and depend only on
the bytes, so every task and every run agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64


def _splitmix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser: a bijection of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


mix64 = _splitmix

# one random 64-bit value per byte; upper case shares its lower-case value
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE = _splitmix(_FOLD.astype(np.uint64) * _U(0x5851F42D4C957F2D))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_BASE = 0x2545F4914F6CDD1D | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    have = 1
    with np.errstate(over="ignore"):
        while have < n:
            take = min(have, n - have)
            out[have:have + take] = out[:take] * _U(pow(base, have, 1 << 64))
            have += take
    return out


_POW = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _pow_tables(n: int):
    if len(_POW[0]) < n:
        _POW[0], _POW[1] = _powers(_BASE, n), _powers(_BASE_INV, n)
    return _POW


class Words:
    """Words of a run of documents: hash, document index, byte span."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """``data`` holds the UTF-8 bytes; document i is data[starts[i]:ends[i]]
        and documents follow one another without overlap."""
        self.n_docs = len(starts)
        lo = int(starts[0]) if len(starts) else 0
        hi = int(ends[-1]) if len(ends) else 0
        body = data[lo:hi]
        self.bytes, self.doc_start, self.doc_end = body, starts - lo, ends - lo
        m = len(body)
        inside = np.zeros(m + 2, dtype=np.int8)
        inside[1:-1] = ~_SPACE[body]
        edge = np.diff(inside)
        begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # a word never crosses a document border: cut at every border inside a run
        cuts = self.doc_start[1:]
        cuts = cuts[(cuts > 0) & (cuts < m)]
        if len(cuts):
            cuts = np.unique(cuts)
            cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
            if len(cuts):
                begin = np.sort(np.concatenate([begin, cuts]))
                stop = np.sort(np.concatenate([stop, cuts]))
        self.begin, self.stop = begin, stop
        self.doc = np.searchsorted(self.doc_end, begin, side="right").astype(np.int64)
        pw, inv = _pow_tables(m + 1)
        with np.errstate(over="ignore"):
            acc = np.zeros(m + 1, dtype=np.uint64)
            np.cumsum(_BYTE[body] * pw[:m], out=acc[1:])
            raw = (acc[stop] - acc[begin]) * inv[begin]
            self.hash = _splitmix(raw ^ (stop - begin).astype(np.uint64))
        self.per_doc = np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)

    def has_digit(self) -> np.ndarray:
        """Per word: does it hold an ASCII digit."""
        acc = np.zeros(len(self.bytes) + 1, dtype=np.int64)
        np.cumsum(_DIGIT[self.bytes], out=acc[1:])
        return acc[self.stop] > acc[self.begin]

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(document index, hash) of every run of k words, in text order; a
        document with 1..k-1 words gives its whole sequence as one shingle."""
        h, doc, n = self.hash, self.doc, len(self.hash)
        with np.errstate(over="ignore"):
            out_doc, out_hash = [], []
            if n >= k:
                acc = np.zeros(n - k + 1, dtype=np.uint64)
                for j in range(k):
                    acc = acc * _U(0x9E3779B97F4A7C15) + _splitmix(h[j:n - k + 1 + j] + _U(j + 1))
                ok = doc[:n - k + 1] == doc[k - 1:]
                out_doc.append(doc[:n - k + 1][ok])
                out_hash.append(_splitmix(acc[ok]))
            short = np.flatnonzero((self.per_doc > 0) & (self.per_doc < k))
            if len(short):
                first = np.searchsorted(doc, short, side="left")
                acc = np.zeros(len(short), dtype=np.uint64)
                for j in range(k - 1):
                    has = self.per_doc[short] > j
                    w = h[np.minimum(first + j, n - 1)]
                    acc = np.where(has, acc * _U(0xD6E8FEB86659FD93) + _splitmix(w + _U(j + 101)), acc)
                out_doc.append(short)
                out_hash.append(_splitmix(acc ^ self.per_doc[short].astype(np.uint64)))
        if not out_doc:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        d, s = np.concatenate(out_doc), np.concatenate(out_hash)
        if len(out_doc) == 2:
            order = np.argsort(d, kind="stable")
            d, s = d[order], s[order]
        return d, s


def string_buffers(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of an Arrow string column without copying; NULL is
    an empty document."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, off_buf, data_buf = column.buffers()
    if n == 0 or off_buf is None:
        z = np.zeros(n, dtype=np.int64)
        return np.zeros(0, dtype=np.uint8), z, z
    off = np.frombuffer(off_buf, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, dtype=np.uint8)
    starts, ends = off[:-1].copy(), off[1:].copy()
    if column.null_count:
        null = np.asarray(column.is_null())
        starts[null] = ends[null]
    return data, starts, ends


def word_blocks(column, max_bytes: int = 1 << 21) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, Words) over consecutive rows of at most
    ``max_bytes`` together (one row at least), so that scratch arrays stay
    small whatever the batch holds."""
    data, starts, ends = string_buffers(column)
    n, at = len(starts), 0
    while at < n:
        stop = int(np.searchsorted(ends, starts[at] + max_bytes, side="right"))
        stop = min(max(stop, at + 1), n)
        yield at, stop, Words(data, starts[at:stop], ends[at:stop])
        at = stop


def distinct_pairs(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs sorted by document, then hash."""
    if not len(doc):
        return doc, h
    # one packed sort key: document index above, leading hash bits below
    bits = int(doc.max()).bit_length()
    with np.errstate(over="ignore"):
        key = (doc.astype(np.uint64) << _U(64 - bits) if bits else _U(0)) | (h >> _U(bits))
    order = np.argsort(key)
    doc, h = doc[order], h[order]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[keep], h[keep]


def segment_sums(values: np.ndarray, seg: np.ndarray, n: int) -> np.ndarray:
    """Sum (modulo 2**64) of ``values`` per segment id; ``seg`` is sorted."""
    out = np.zeros(n, dtype=np.uint64)
    if len(values):
        first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
        with np.errstate(over="ignore"):
            out[seg[first]] = np.add.reduceat(values, first)
    return out

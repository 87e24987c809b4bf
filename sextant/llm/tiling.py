"""Benchmark decontamination by greedy string tiling.

A seed is ``min_match`` consecutive words of a benchmark item. Documents are
scanned for seeds by rolling hashes; (document, item) pairs that share one are
tiled: the longest common run of words in which no word is taken yet is marked,
again and again, until no run of ``min_match`` words is left. Each word of
either side is in one tile at most, so coverage (marked share of the item) also
finds an item whose sentences were put in another order, and does not count a
repeated phrase twice. Common runs of any length come from running Karp-Rabin
hashes; a phrase that repeats in both sides costs its length, not the product.

The benchmark is the small side. Its words go to every task in blocks of at most
``block_words`` words, and each pass but the last is written: a larger benchmark
takes more passes over the documents, never a larger broadcast."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import ship, staged, trimmed, word_count

SCHEMA = ("doc_id long, item_id long, coverage double, item_words int, n_tiles int, longest int, "
          "spans array<struct<doc_word:int,item_word:int,words:int>>")
_BITS = 20


def _windows(w: K.Words, k: int):
    """(document, first word within it, hash) of every run of k words."""
    n = len(w.hash)
    if n < k:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(0, dtype=np.uint64)
    acc = np.zeros(n - k + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):   # the same window hash for documents and items
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + w.hash[j:n - k + 1 + j]
    at = np.flatnonzero(w.doc[:n - k + 1] == w.doc[k - 1:])
    first = np.cumsum(w.per_doc) - w.per_doc
    return w.doc[at], at - first[w.doc[at]], acc[at]


_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def _runs(places: np.ndarray, words: np.ndarray, size: int):
    """(first place, running hash) of every run of ``size`` neighbouring places."""
    n = len(places) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        up = np.full(len(places), _BASE, dtype=np.uint64)
        down = np.full(n, _UNBASE, dtype=np.uint64)
        up[0] = down[0] = 1
        total = np.r_[np.uint64(0), np.cumsum(words[places] * np.cumprod(up))]
        h = (total[size:] - total[:n]) * np.cumprod(down)
    at = np.flatnonzero(places[size - 1:] - places[:n] == size - 1)
    return places[at], h[at]


def tile(doc: np.ndarray, item: np.ndarray, k: int, free: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiles (document word, item word, length) of two arrays of word
    hashes, none shorter than ``k``. Longest first; ties to the earlier place in
    the document, then in the item. ``free``: the document's places to look at.

    The longest run that both sides still have free is found by halving over its
    length, each probe by running Karp-Rabin hashes; all tiles of that length are
    marked in one pass. Memory is the length of both sides, also where one phrase
    repeats in both."""
    left, right = np.arange(len(doc)) if free is None else free, np.arange(len(item))
    longest, out = min(len(left), len(right)), []
    while True:
        size, none = k - 1, longest + 1
        while none - size > 1:
            mid = (size + none) // 2
            if np.isin(_runs(left, doc, mid)[1], _runs(right, item, mid)[1]).any():
                size = mid
            else:
                none = mid
        if size < k:
            return out
        tiles = _tiles_of(doc, item, left, right, size)
        out += tiles
        taken = np.arange(size)
        left = np.setdiff1d(left, np.concatenate([a + taken for a, _, _ in tiles] or [taken[:0]]), True)
        right = np.setdiff1d(right, np.concatenate([b + taken for _, b, _ in tiles] or [taken[:0]]), True)
        longest = min(size - 1, len(left), len(right))


def _tiles_of(doc, item, left, right, size: int) -> list[tuple[int, int, int]]:
    """The tiles of ``size`` words, the greatest length there is."""
    at, h = _runs(left, doc, size)
    places, seeds = _runs(right, item, size)
    order = np.lexsort((places, seeds))
    places, seeds = places[order], seeds[order]
    first, last = np.searchsorted(seeds, h, "left"), np.searchsorted(seeds, h, "right")
    used = np.zeros(len(item), dtype=bool)
    after, out = {}, []
    end, waiting = -1, len(places)
    for i in np.flatnonzero(last > first):
        a, group, stop = int(at[i]), int(first[i]), int(last[i])
        if a < end:
            continue
        j = after.get(group, group)
        # tiles of one length overlap only if one holds an end of the other
        while j < stop and (used[places[j]] or used[places[j] + size - 1]):
            j, waiting = j + 1, waiting - 1
        after[group] = j
        if j < stop:
            b = int(places[j])
            if np.array_equal(doc[a:a + size], item[b:b + size]):
                used[b:b + size] = True
                end = a + size
                out.append((a, b, size))
        elif not waiting:
            break
    return out


class SeedIndex:
    """Seeds of a block of items: sorted window hashes with item and place."""

    def __init__(self, items: list[tuple[int, str]], k: int):
        self.k, self.ids = k, np.array([i for i, _ in items], dtype=np.int64)
        h, item, at, self.words, text = [], [], [], np.zeros(len(items), dtype=np.int64), []
        for a, _, w in K.word_blocks(pa.array([t for _, t in items], pa.string())):
            d, p, x = _windows(w, k)
            h.append(x)
            item.append(d + a)
            at.append(p)
            self.words[a:a + w.n_docs] = w.per_doc
            text.append(w.hash)
        self.text = np.concatenate(text) if text else np.zeros(0, dtype=np.uint64)
        self.first = np.cumsum(self.words) - self.words
        h = np.concatenate(h) if h else np.zeros(0, dtype=np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.item = (np.concatenate(item) if item else np.zeros(0, dtype=np.int64))[order]
        self.at = (np.concatenate(at) if at else np.zeros(0, dtype=np.int64))[order]
        self.mask = np.zeros(1 << _BITS, dtype=bool)
        self.mask[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def seeds(self, w: K.Words):
        """(document, first word, seed, places of the seed) of the windows that some item holds; documents ascend."""
        d, p, x = _windows(w, self.k)
        maybe = np.flatnonzero(self.mask[(x >> np.uint64(64 - _BITS)).astype(np.int64)])
        lo = np.searchsorted(self.hash, x[maybe], side="left")
        n = np.searchsorted(self.hash, x[maybe], side="right") - lo
        hit = n > 0
        return d[maybe][hit], p[maybe][hit], lo[hit], n[hit]

    def tilings(self, w: K.Words, threshold: float):
        """(document, item, coverage, tiles) of the pairs that reach the threshold.
        One document at a time: a seed counts once however often the document
        repeats it, so a document's work list is never longer than the index."""
        d, p, seed, n = self.seeds(w)
        if not len(d):
            return
        begin = np.cumsum(w.per_doc) - w.per_doc
        edge = np.flatnonzero(np.r_[True, np.diff(d) != 0, True])
        for a, b in zip(edge[:-1], edge[1:]):
            doc = w.hash[begin[d[a]]:begin[d[a]] + w.per_doc[d[a]]]
            own, one = np.unique(seed[a:b], return_index=True)
            many = n[a:b][one]
            ref = np.repeat(own, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            item, at, of = self.item[ref], self.at[ref], np.repeat(own, many)
            order = np.lexsort((at, item))
            item, at, of = item[order], at[order], of[order]
            cut = np.flatnonzero(np.r_[True, np.diff(item) != 0, True])
            for u, v in zip(cut[:-1], cut[1:]):
                it = int(item[u])
                size = int(self.words[it])
                # every word of the item under some seed bounds the coverage
                reach = np.minimum(np.diff(at[u:v]), self.k).sum() + self.k
                if reach < threshold * size:
                    continue
                under = np.zeros(len(doc) + 1, dtype=np.int64)
                mine = p[a:b][np.isin(seed[a:b], of[u:v])]
                under[mine] += 1
                under[mine + self.k] -= 1
                text = self.text[self.first[it]:self.first[it] + size]
                tiles = tile(doc, text, self.k, np.flatnonzero(np.cumsum(under[:-1])))
                cover = sum(t[2] for t in tiles) / size
                if cover >= threshold:
                    yield int(d[a]), it, cover, tiles


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", min_match: int = 5,
                 threshold: float = 0.5, block_words: int = 500_000) -> DataFrame:
    """One row per (document, benchmark item) whose tiles cover at least
    ``threshold`` of the item: (doc_id, item_id, coverage, item_words, n_tiles,
    longest, spans). Documents without such an item give no row.

    NULL, empty and short texts (under ``min_match`` words, on either side) match
    nothing. Repeated documents give a row each; repeated item ids are items of
    their own. Rows without an id stay (the id is NULL). Whole texts are used
    whatever their length; other columns are ignored."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(index):
        def run(batches):
            for batch in batches:
                ids = batch.column(0).to_pylist()
                out = []
                for a, _, w in K.word_blocks(batch.column(1), 1 << 18):
                    for d, it, cover, tiles in index.tilings(w, threshold):
                        out.append({"doc_id": ids[a + d], "item_id": int(index.ids[it]), "coverage": cover,
                                    "item_words": int(index.words[it]), "n_tiles": len(tiles),
                                    "longest": max(t[2] for t in tiles),
                                    "spans": [{"doc_word": t[0], "item_word": t[1], "words": t[2]}
                                              for t in sorted(tiles)]})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
        return run
    parts = [src.mapInArrow(trimmed(scan(index)), SCHEMA) if last else staged(src.mapInArrow(trimmed(scan(index)), SCHEMA))
             for index, last in _indexes(benchmark, item_col, item_text_col, min_match, block_words)]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("item_id", F.when(F.col("item_id") != _NO_ID, F.col("item_id")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", min_match: int = 5, threshold: float = 0.5,
                      block_words: int = 500_000) -> DataFrame:
    """The rows of ``docs`` (all columns) without a benchmark item in the sense of
    ``contaminated``, found within the scan: no row is shuffled."""
    at = docs.columns.index(text_col)

    def scan(index):
        def run(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for a, _, w in K.word_blocks(batch.column(at), 1 << 18):
                    for d, *_ in index.tilings(w, threshold):
                        keep[a + d] = False
                yield batch.filter(pa.array(keep))
        return run
    for index, last in _indexes(benchmark, item_col, item_text_col, min_match, block_words):
        docs = docs.mapInArrow(trimmed(scan(index)), docs.schema)
        if not last:
            docs = staged(docs)
    return docs


_NO_ID = -(1 << 63)


def _indexes(benchmark: DataFrame, item_col: str, item_text_col: str, min_match: int,
             block_words: int) -> Iterator[tuple["SeedIndex", bool]]:
    """(seed index of a block of the benchmark, is it the last), one at least. The
    next block is read when the pass over this one is written, so neither the driver
    nor a task ever holds two."""
    ship(benchmark.sparkSession)
    items = staged(benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                                    F.col(item_text_col).cast("string").alias("text"))
                   .withColumn("words", word_count("text")).where(F.col("words") >= min_match))
    total = items.agg(F.sum("words")).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_words))
    for b in range(n_blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b)
        rows = block.orderBy("item_id", "text").select("item_id", "text").collect()
        yield (SeedIndex([(_NO_ID if r.item_id is None else r.item_id, r.text) for r in rows], min_match),
               b == n_blocks - 1)


_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()),
                    ("item_words", pa.int32()), ("n_tiles", pa.int32()), ("longest", pa.int32()),
                    ("spans", pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()),
                                                  ("words", pa.int32())])))])

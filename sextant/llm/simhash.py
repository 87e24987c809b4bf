"""SimHash near-duplicates by anchor-point covering.

*Fingerprint.* A text's words (runs of bytes other than space and 0x09-0x0D, A-Z
lower-cased) give its runs of ``k`` words, repeats included. Bit b of the 64-bit
fingerprint is 1 if it is set in more than half of their XXH64 values (seed 42).

*Anchors.* Two fingerprints that differ in at most t bits differ in at most t // 2
bits in one of their two halves. The anchors of a half are the words of the perfect
Hamming code over its first 31 bits: every point has exactly one anchor within
distance 1 (covering radius 1), its home. A fingerprint is sent to its home and to
every other anchor within covering radius + t // 2. If x and y are that close in a
half, y lies within 1 + t // 2 of x's home, so the pair meets there and is compared on
all 64 bits. For t = 3 that makes at most 32 rows a distinct fingerprint, and an
anchor's ball holds 497 of 2**31 points. (A covering code of the whole 64 bits
needs thousands of rows: nine Hamming blocks of seven bits give about 2,500.)

*Cells.* Equal fingerprints are one class before anything is replicated. A task reads
its anchors as sorted runs, compares homes with the run, and passes on a spanning
forest of what it found: at most one link a row, however large a group of near
copies is. An anchor with more than ``cell_rows`` rows is dealt again by the t + 1
blocks of the other half, of which a linked pair has one in common.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, ship, small, staged
from .textkernel import string_buffers

_U = np.uint64
SEED = 42
_BLOCK = 1 << 15


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 of every run of ``k`` words of a text, repeats included; the whole
    sequence if it is shorter, nothing without words."""
    ws = text.lower().split()
    if len(ws) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(ws), SEED)] if ws else [], dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(ws[i:i + k]), SEED) for i in range(len(ws) - k + 1)),
                       dtype=np.uint64, count=len(ws) - k + 1)


def _votes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per segment of ``h`` and bit, how many values have the bit set."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, first, axis=0, dtype=np.int64)


def _majority(votes: np.ndarray, n: np.ndarray) -> np.ndarray:
    ones = (2 * votes > n[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprint_column(column, k: int) -> np.ndarray:
    """Fingerprints of an Arrow string column; scratch memory stays within a block of
    hashes, a longer text is counted block by block."""
    data, starts, ends = string_buffers(column)
    out = np.zeros(len(starts), dtype=np.uint64)
    rows, parts, have = [], [], 0

    def flush():
        size = np.array([len(p) for p in parts], dtype=np.int64)
        out[rows] = _majority(_votes(np.concatenate(parts), np.r_[0, np.cumsum(size)[:-1]]), size)

    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        h = shingle_hashes(data[a:b].tobytes(), k)
        if len(h) > _BLOCK:
            total = sum(_votes(h[at:at + _BLOCK], np.array([0])) for at in range(0, len(h), _BLOCK))
            out[i] = _majority(total, np.array([len(h)]))[0]
        elif len(h):
            rows.append(i)
            parts.append(h)
            have += len(h)
            if have >= _BLOCK:
                flush()
                rows, parts, have = [], [], 0
    if have:
        flush()
    return out


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, fp) per row of ``docs`` (doc_id, text)."""
    def run(batches):
        for batch in batches:
            fp = fingerprint_column(batch.column(1), k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    return docs.mapInArrow(run, "doc_id long, fp long")


BITS = 31                      # a half's bits that take part in the code
_CHECKS = [sum(1 << j for j in range(BITS) if (j + 1) >> b & 1) for b in range(5)]


def anchor_moves(reach: int) -> list[list[int]]:
    """Per syndrome (0..31) the bit flips that lead from a point to the anchors within
    ``reach`` of it, the home anchor first."""
    moves: list[list[int]] = [[] for _ in range(BITS + 1)]
    for weight in range(reach + 1):
        for places in combinations(range(BITS), weight):
            s = 0
            for j in places:
                s ^= j + 1
            moves[s].append(sum(1 << j for j in places))
    return moves


def _cells(classes: DataFrame, max_bits: int) -> DataFrame:
    """(fp, key, away): every class at its anchors; ``away`` is 0 at the home."""
    table = ", ".join(f"array({', '.join(f'{m}L' for m in row)})" for row in anchor_moves(1 + max_bits // 2))
    halves = []
    for part in (0, 1):
        point = F.shiftrightunsigned("fp", 32 * part).bitwiseAND(F.lit((1 << BITS) - 1))
        syndrome = sum((F.bit_count(point.bitwiseAND(F.lit(m))).bitwiseAND(F.lit(1)) * (1 << b)
                        for b, m in enumerate(_CHECKS)), F.lit(0))
        halves.append(classes.select("fp", point.alias("point"), syndrome.alias("s"))
                      .select("fp", "point", F.posexplode(F.element_at(F.expr(f"array({table})"), F.col("s") + 1)))
                      .select("fp", F.col("point").bitwiseXOR(F.col("col")).bitwiseOR(F.lit(part << BITS)).alias("key"),
                              (F.col("pos") > 0).cast("int").alias("away")))
    return halves[0].unionByName(halves[1])


def _dealt(cells: DataFrame, max_bits: int, cell_rows: int) -> DataFrame:
    """(fp, key, sub, away): hot anchors dealt again by blocks of the other half."""
    hot = staged(cells.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > cell_rows)
                 .select("key", F.lit(True).alias("hot")))
    blocks = max_bits + 1
    width = 32 // blocks
    low = F.shiftrightunsigned("fp", 32)             # keys of the first half: the other one is the upper
    other = F.when(F.shiftrightunsigned("key", BITS) == 0, low).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    subs = []
    for j in range(blocks):
        size = width if j < blocks - 1 else 32 - width * (blocks - 1)
        block = F.shiftright(F.col("other"), width * j).bitwiseAND(F.lit((1 << size) - 1))
        subs.append(F.lit((j + 1) << 32).cast("long").bitwiseOR(block))
    return (cells.join(small(hot), "key", "left").withColumn("other", other)
            .select("fp", "key", "away", F.explode(F.when(F.col("hot"), F.array(*subs))
                                                   .otherwise(F.array(F.lit(0).cast("long")))).alias("sub")))


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of a[i] and b[i]; every label is its class's smallest index."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _forest(fp: np.ndarray, first: np.ndarray, homes: np.ndarray, max_bits: int, pairs: int = 1 << 21):
    """Links of the runs that start at ``first`` (the first ``homes`` rows of a run
    are at home there), as a spanning forest: (fp, fp of the smallest partner)."""
    end = np.r_[first[1:], len(fp)]
    n_home = homes
    row = np.repeat(first, n_home) + (np.arange(n_home.sum()) - np.repeat(np.cumsum(n_home) - n_home, n_home))
    todo = np.repeat(end, n_home) - 1 - row                    # rows after it in its run
    label = np.arange(len(fp))
    upto = np.cumsum(todo)
    at = 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + pairs, side="right")))
        r, c = row[at:stop], todo[at:stop]
        i = np.repeat(r, c)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        label = _union(label, i[near], j[near])
        at = stop
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _links(dealt: DataFrame, max_bits: int) -> DataFrame:
    """(src, dst): a spanning forest of the links of every cell."""
    def run(batches):
        def found(cols):
            key, sub, away, fp = cols
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
            homes = np.add.reduceat((away == 0).astype(np.int64), first)
            a, b = _forest(fp.view(np.uint64), first, homes, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["src", "dst"])

        parts: list = []                  # column arrays of the runs not yet finished
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(4)]
            key, sub = cols[0], cols[1]
            last = np.flatnonzero((key[1:] != key[:-1]) | (sub[1:] != sub[:-1]))
            if len(last) or (parts and (parts[-1][0][-1], parts[-1][1][-1]) != (key[0], sub[0])):
                cut = int(last[-1]) + 1 if len(last) else 0
                yield found([np.concatenate(x) for x in zip(*parts, [c[:cut] for c in cols])])
                parts, cols = [], [c[cut:] for c in cols]
            parts.append(cols)
        if parts:
            yield found([np.concatenate(x) for x in zip(*parts)])
    order = ["key", "sub", "away", "fp"]
    return (dealt.select(*order).repartition("key", "sub").sortWithinPartitions(*order)
            .mapInArrow(run, "src long, dst long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                       max_bits: int = 3, cell_rows: int = 20_000) -> DataFrame:
    """Groups of documents whose SimHash fingerprints are connected by steps of at
    most ``max_bits`` (0 to 5) differing bits.

    Returns one row per input row: (``doc_id``, ``fingerprint``: 16 lower-case hex
    digits, ``component_id``: smallest id reachable, itself included, ``class_size``:
    rows with this fingerprint). NULL, empty and blank texts have fingerprint zero and
    link like any other. Rows that repeat an id or a text are rows of their own. A row
    with a NULL id takes its component's smallest id (NULL if it has none) and links
    others. Ties cannot arise. Other columns of ``docs`` are ignored, whatever their
    names. An empty table gives an empty result. ``cell_rows`` only deals the work
    out; it drops nothing."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fps = staged(fingerprints(src, k))
    classes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("class_size")))
    links = _links(_dealt(_cells(classes.select("fp"), max_bits), max_bits, cell_rows), max_bits)
    roots = components(links)
    linked = staged(classes.join(small(staged(roots)), classes.fp == F.col("node"), "left")
                    .select("fp", "low", "class_size", F.coalesce("root", "fp").alias("root")))
    best = linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("parts"))
    label = staged(linked.join(best, "root").where("class_size > 1 or parts > 1")
                   .select("fp", "class_size", F.col("component_id").alias("found")))
    return (fps.join(small(label), "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.coalesce("found", "doc_id").alias("component_id"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size")))

"""N-gram Jaccard join with vertical partitioning.

The n-grams (64-bit hashes of ``k`` consecutive words) have one global order:
by hash. The order is cut into contiguous fragments; each fragment is worked on
by itself and the partial results are summed per set or per pair:

1. *Classes.* Documents with the same n-gram set (128-bit fingerprint) are one
   class; only classes take part from here on.
2. *Shared counts.* Per fragment, count how many of a class's n-grams another
   class holds too; summed over fragments this bounds every overlap of the
   class from above. A class below the threshold's share of its own size cannot
   have a partner and leaves. N-grams travel as packed blobs, one row per task
   flush and fragment; an n-gram that several classes of a flush hold travels
   once, so a phrase of a third of the corpus is pre-aggregated.
3. *First links.* Each class is compared with the most typical class that shares
   a min-hash value with it. Large groups of near copies fall into one
   component here with a handful of candidates per class.
4. *Remaining links, exactly.* Only links between different components are
   still of interest. Classes whose n-grams held by other components reach the
   threshold's share are joined by prefix filter: rarest n-grams first, the
   prefix being just long enough that every linked pair meets in it.
5. *Verification* of all candidates: overlap per fragment, summed per pair.

Connectivity is exact: every pair of documents that link is in one component,
and no unverified pair joins two. Pairs inside a component found in step 3 are
not listed, so a group of copies costs links in proportion to its size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import components, release_memory, ship, small, staged, trimmed

_U = np.uint64
_MULTI = 0xFFFFFF
FP_SCHEMA = "doc_id long, n long, f1 long, f2 long, text_key long"


def _sets(column, k):
    """(first row, rows, document index, hash, per-document count, f1, f2) per
    block of a text column; distinct n-grams sorted by document, then hash."""
    for a, b, w in K.word_blocks(column, 1 << 18):
        doc, h = K.distinct_pairs(*w.shingles(k))
        n = np.bincount(doc, minlength=b - a).astype(np.int64)
        f1 = K.segment_sums(K.mix64(h), doc, b - a)
        f2 = K.segment_sums(K.mix64(h ^ _U(0xA5A5A5A5DEADBEEF)), doc, b - a)
        yield a, b - a, doc, h, n, f1, f2


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, f1, f2, text_key) per row of ``docs`` (doc_id, text, text_key)."""
    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(2)
            for a, m, _, _, n, f1, f2 in _sets(batch.column(1), k):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, m), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                     keys.slice(a, m)], names=["doc_id", "n", "f1", "f2", "text_key"])
    return docs.mapInArrow(trimmed(run), FP_SCHEMA)


def _planes(x: np.ndarray, width: int) -> bytes:
    """Byte planes of little-endian integers: rare high bytes form runs of
    zeros that the shuffle's compression removes."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(b: bytes, width: int) -> np.ndarray:
    n = len(b) // width
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(b, dtype=np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _flush(gram, owner, member, n_frag):
    """Pack the postings of a flush: 40-bit n-gram, class or component (owner) and
    class (member) that holds it. Rows (fragment, grams, members, table) for the
    fragments, and members with the number of their n-grams that were already seen
    with two owners here; of such an n-gram one posting travels."""
    table, at = np.unique(member, return_index=True)
    owner_of = owner[at]
    m = np.searchsorted(table, member)
    key = np.unique((gram << _U(24)) | m.astype(np.uint64))
    g, m = key >> _U(24), (key & _U(_MULTI)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    size = np.diff(np.r_[first, len(g)])
    own = owner_of[m]
    several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
    shared = np.repeat(several, size)
    local = np.bincount(m[shared], minlength=len(table))
    hit = np.flatnonzero(local)
    head = np.zeros(len(g), dtype=bool)
    head[first] = True
    send = ~shared | head
    g1, m1 = g[send], np.where(shared, _MULTI, m)[send]
    frag = ((g1 * _U(n_frag)) >> _U(40)).astype(np.int64)
    cuts = np.searchsorted(frag, np.arange(n_frag + 1))
    rows = {"frag": [], "grams": [], "members": [], "table": [], "owners": []}
    same = bool((owner_of == table).all())
    for f in range(n_frag):
        a, b = cuts[f], cuts[f + 1]
        if a == b:
            continue
        part = m1[a:b]
        used = np.unique(part[part != _MULTI])
        idx = np.where(part == _MULTI, len(used), np.searchsorted(used, part))
        rows["frag"].append(f)
        rows["grams"].append(_planes(np.diff(g1[a:b], prepend=_U(0)), 5))
        rows["members"].append(_planes(idx, 3))
        rows["table"].append(table[used].tobytes())
        rows["owners"].append(b"" if same else owner_of[used].tobytes())
    return rows, table[hit], local[hit]


def _pack(source, n_frag: int, flush: int):
    """Record batches of packed postings from (gram, owner, member) arrays."""
    def emit(parts):
        gram, owner, member = (np.concatenate(x) for x in zip(*parts))
        rows, who, cnt = _flush(gram, owner, member, n_frag)
        # the flush's own counts travel under a negative fragment, any will do
        mine = -1 - int(who[0] % _U(1 << 16)) if len(who) else -1
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["frag"] + [mine], pa.int32()), pa.array(rows["grams"] + [b""], pa.binary()),
             pa.array(rows["members"] + [cnt.astype("<u4").tobytes()], pa.binary()),
             pa.array(rows["table"] + [who.tobytes()], pa.binary()), pa.array(rows["owners"] + [b""], pa.binary())],
            names=["frag", "grams", "members", "tab", "owners"])

    parts, have = [], 0
    for part in source:
        parts.append(part)
        have += len(part[0])
        if have >= flush:
            yield emit(parts)
            parts, have = [], 0
    if have:
        yield emit(parts)


PACKED = "frag int, grams binary, members binary, tab binary, owners binary"


def _tally(packed: DataFrame, n_frag: int) -> DataFrame:
    """(member, credit): per member the number of its n-grams that another owner
    holds too. Leading 40 bits are compared, and a member met in several flushes may
    be credited twice: the count is an upper bound."""
    def bucketed(who, cnt):
        bucket = (who >> _U(40)) % _U(n_frag)
        order = np.argsort(bucket, kind="stable")
        who, cnt, bucket = who[order], cnt[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(who) else [0]
        return pa.table({"bucket": pa.array(bucket[cuts[:-1]].astype(np.int32) if len(who) else [], pa.int32()),
                         "who": pa.array([who[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary()),
                         "cnt": pa.array([_planes(cnt[x:y], 4) for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())})

    def count(key, table):
        cols = [table[c].to_pylist() for c in ("grams", "members", "tab", "owners")]
        if key[0].as_py() < 0:
            return bucketed(np.concatenate([np.frombuffer(t, dtype=np.uint64) for t in cols[2]]),
                            np.concatenate([np.frombuffer(c, dtype="<u4").astype(np.uint64) for c in cols[1]]))
        grams, members, owners, flags, mixed = [], [], [], [], any(cols[3])
        for gb, mb, tb, ob in zip(*cols):
            tab, at = np.frombuffer(tb, dtype=np.uint64), _unplanes(mb, 3).astype(np.int64)
            grams.append(np.cumsum(_unplanes(gb, 5), dtype=np.uint64))
            members.append(np.r_[tab, _U(0)][at])
            if ob:
                owners.append(np.r_[np.frombuffer(ob, dtype=np.uint64), _U(0)][at])
            elif mixed:
                owners.append(members[-1])
            flags.append(at == len(tab))          # the last entry stands for "several owners"
        del cols
        g, multi = np.concatenate(grams), np.concatenate(flags)
        m = np.concatenate(members)
        o = np.concatenate(owners) if owners else m
        del grams, members, owners, flags
        order = np.argsort(g)
        same = o is m
        g, multi, m = g[order], multi[order], m[order]
        o = m if same else o[order]
        del order
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        size = np.diff(np.r_[first, len(g)])
        lo = np.minimum.reduceat(np.where(multi, _U(0xFFFFFFFFFFFFFFFF), o), first)
        hi = np.maximum.reduceat(np.where(multi, _U(0), o), first)
        some = (lo < hi) | (np.add.reduceat(multi.astype(np.int64), first) > 0)
        pick = np.repeat(some, size) & ~multi
        g, m = g[pick], m[pick]
        order = np.lexsort((m, g))                # copies of a member count once
        g, m = g[order], m[order]
        new = np.r_[True, (g[1:] != g[:-1]) | (m[1:] != m[:-1])] if len(g) else np.zeros(0, dtype=bool)
        who, cnt = np.unique(m[new], return_counts=True)
        del g, m, o, order, new, multi
        release_memory()
        return bucketed(who, cnt.astype(np.uint64))

    def total(key, table):
        who = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table["who"].to_pylist()])
        cnt = np.concatenate([_unplanes(x, 4) for x in table["cnt"].to_pylist()])
        one, at = np.unique(who, return_inverse=True)
        return pa.table({"member": pa.array(one.view(np.int64)),
                         "credit": pa.array(np.bincount(at, weights=cnt.astype(np.float64)).astype(np.int64))})
    return (packed.groupBy("frag").applyInArrow(count, "bucket int, who binary, cnt binary")
            .groupBy("bucket").applyInArrow(total, "member long, credit long"))


def shared_counts(docs: DataFrame, k: int, n_frag: int, flush: int = 750_000) -> DataFrame:
    """(f1, credit): how many n-grams of a class some other class holds, at most."""
    def run(batches):
        def source():
            for batch in batches:
                for _, _, doc, h, _, f1, _ in _sets(batch.column(0), k):
                    yield h >> _U(24), f1[doc], f1[doc]
        yield from _pack(source(), n_frag, flush)
    return _tally(docs.select("text").mapInArrow(trimmed(run), PACKED), n_frag).withColumnRenamed("member", "f1")


def _cross_counts(own: DataFrame, n_frag: int, flush: int = 750_000) -> DataFrame:
    """(node, credit) from (node, comp, grams): n-grams another component holds."""
    def run(batches):
        def source():
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    size = np.asarray(part.column(2).value_lengths())
                    gram = part.column(2).flatten().to_numpy().view(np.uint64) >> _U(24)
                    node, comp = (part.column(i).to_numpy().view(np.uint64) for i in (0, 1))
                    yield gram, np.repeat(comp, size), np.repeat(node, size)
        yield from _pack(source(), n_frag, flush)
    return _tally(own.select("node", "comp", "grams").mapInArrow(trimmed(run), PACKED), n_frag).withColumnRenamed("member", "node")


def _class_sets(docs: DataFrame, keep: DataFrame, k: int) -> DataFrame:
    """(node, n, gap, grams array<long>) of the classes in ``keep`` (doc_id, text_key, f1, f2, gap)."""
    def run(batches):
        for batch in batches:
            f1w, f2w, gap = (batch.column(i).to_numpy() for i in (1, 2, 3))
            for a, m, doc, h, n, f1, f2 in _sets(batch.column(0), k):
                ok = (f1.view(np.int64) == f1w[a:a + m]) & (f2.view(np.int64) == f2w[a:a + m])
                rows = np.flatnonzero(ok)
                keep_g = ok[doc]
                off = np.r_[0, np.cumsum(n[rows])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f1.view(np.int64)[rows]), pa.array(n[rows]), pa.array(gap[a:a + m][rows]),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(h.view(np.int64)[keep_g]))],
                    names=["node", "n", "gap", "grams"])
    pick = small(keep.select(F.col("doc_id").alias("_kid"), F.col("text_key").alias("_key"), "f1", "f2", "gap"))
    # one row of each class; of a class without an id, the rows of one of its texts
    one = docs.withColumn("text_key", F.xxhash64("text"))
    joined = (one.join(pick, one.doc_id.eqNullSafe(F.col("_kid")) & (one.text_key == F.col("_key")))
              .select("text", "f1", "f2", "gap"))
    return joined.mapInArrow(trimmed(run), "node long, n long, gap long, grams array<long>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: per fragment the overlap of the two segments,
    summed per pair, against the threshold."""
    sa = segments.select(F.col("node").alias("a"), F.col("n").alias("na"), "frag", F.col("seg").alias("sa"))
    sb = segments.select(F.col("node").alias("b"), F.col("n").alias("nb"), "frag", F.col("seg").alias("sb"))
    part = (small(pairs).join(sa, "a").join(sb, ["b", "frag"])
            .select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("c")))
    total = part.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"))
    return (total.where((F.lit(100) * F.col("c")) >= (F.lit(percent) * (F.col("na") + F.col("nb") - F.col("c"))))
            .select(F.col("a").alias("src"), F.col("b").alias("dst")))


def _first_candidates(sets: DataFrame, n_keys: int) -> DataFrame:
    """(a, b): each class with the most typical class sharing a min-hash value: the
    one with the fewest n-grams of its own. In a group of near copies that is the
    text they all stem from, or close to it."""
    seeds = K.mix64(np.arange(1, n_keys + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            grams = batch.column(1)
            vals = grams.flatten().to_numpy().view(np.uint64)
            off = np.r_[0, np.cumsum(np.asarray(grams.value_lengths()))][:-1].astype(np.int64)
            node, gap = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            if not len(node):
                continue
            key = np.concatenate([np.minimum.reduceat(K.mix64(vals ^ s), off) for s in seeds])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(node, n_keys)), pa.array(np.repeat(np.arange(n_keys, dtype=np.int32), len(node))),
                 pa.array(key.view(np.int64)), pa.array(np.tile(gap, n_keys))], names=["node", "slot", "val", "gap"])
    keys = sets.select("node", "grams", "gap").mapInArrow(trimmed(run), "node long, slot int, val long, gap long")
    low = (keys.groupBy("slot", "val").agg(F.min(F.struct("gap", "node")).alias("best"), F.count("*").alias("m"))
           .where("m > 1").select("slot", "val", F.col("best.node").alias("lead")))
    return (keys.join(low, ["slot", "val"]).where("node <> lead")
            .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct())


SKETCH = 16


def _sketches(sets: DataFrame) -> DataFrame:
    """(node, k0..k15): 1024 parity bits per set, each the number (odd or even) of
    n-grams with that hash residue. Two sets differ in at least as many n-grams
    as their sketches differ in bits."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                grams = part.column(1)
                vals = grams.flatten().to_numpy().view(np.uint64)
                row = np.repeat(np.arange(len(part)), np.asarray(grams.value_lengths()))
                width = 64 * SKETCH
                odd = np.bincount(row * width + (vals % _U(width)).astype(np.int64), minlength=len(part) * width) & 1
                words = np.packbits(odd.astype(np.uint8).reshape(len(part), width), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(np.ascontiguousarray(words[:, i])) for i in range(SKETCH)],
                    names=["node"] + [f"k{i}" for i in range(SKETCH)])
    return sets.select("node", "grams").mapInArrow(
        trimmed(run), "node long, " + ", ".join(f"k{i} long" for i in range(SKETCH)))


def _rest_candidates(sets: DataFrame, comp: DataFrame, percent: int, fragment_grams: int) -> DataFrame:
    """(a, b): pairs of classes in different components that may still link."""
    own = sets.join(comp.withColumnRenamed("root", "comp"), "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    total = sets.agg(F.sum("n")).first()[0] or 0
    credit = _cross_counts(own, max(8, math.ceil(total / fragment_grams)))
    near = staged(credit.join(sets.select("node", "n"), "node")
                  .where(F.lit(100) * F.col("credit") >= F.lit(percent) * F.col("n")).select("node"))
    own = own.join(small(near), "node")
    post = own.select("node", "n", "comp", F.explode("grams").alias("gram"))
    cross = staged(post.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                            F.count("*").alias("df")).where("lo < hi").select("gram", "df"))
    met = post.join(small(cross), "gram")
    enough = (met.groupBy("node").agg(F.count("*").alias("m"), F.max("n").alias("nn"))
              .where(F.lit(100) * F.col("m") >= F.lit(percent) * F.col("nn")).select("node", "m"))
    live = staged(met.join(small(staged(enough)), "node").select("node", "n", "m", "comp", "gram", "df"))
    # n-grams outside ``cross`` come first in the order (they match nothing):
    # n - m prefix places are spent on them
    w = live.groupBy("node", "n", "m", "comp").agg(
        F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("g"))
    places = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / F.lit(100)) + 1 - (F.col("n") - F.col("m"))
    prefix = staged(w.where(places > 0).select(
        "node", "n", "m", "comp", F.explode(F.slice("g", F.lit(1), places.cast("int"))).alias("s"))
        .select("node", "n", "m", "comp", F.col("s.gram").alias("gram")))
    ks = [f"k{i}" for i in range(SKETCH)]
    prefix = prefix.join(_sketches(sets), "node")
    x = prefix.select("gram", F.col("node").alias("a"), F.col("n").alias("na"), F.col("m").alias("ma"),
                      F.col("comp").alias("ca"), *[F.col(k).alias(f"a{k}") for k in ks])
    y = prefix.select("gram", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("m").alias("mb"),
                      F.col("comp").alias("cb"), *[F.col(k).alias(f"b{k}") for k in ks])
    differ = sum((F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in ks), F.lit(0))
    both = F.col("na") + F.col("nb")
    return (x.join(y, "gram")
            .where("a < b and ca <> cb")
            .where((F.lit(100) * F.least("na", "nb")) >= (F.lit(percent) * F.greatest("na", "nb")))
            # the overlap is at most the smaller m; a link needs percent / (100 + percent) of both sizes
            .where((F.lit(100 + percent) * F.least("ma", "mb")) >= (F.lit(percent) * both))
            # and the sets may not differ in more n-grams than a link leaves room for
            .where((F.lit(100 + percent) * (both - differ)) >= (F.lit(2 * percent) * both))
            .select("a", "b").distinct())


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 80, n_keys: int = 6, n_segments: int = 4,
                       fragment_grams: int = 1_000_000) -> DataFrame:
    """Groups of documents connected by n-gram Jaccard links.

    Returns one row per input row: (``doc_id``, ``n_shingles``, ``component_id``,
    ``class_size``, ``text_key``: a hash of the text, ``group_key``: one value for all
    rows of a group, with or without ids; NULL for an empty set). Two documents link when 100 * intersection >= percent * union of
    their sets of distinct ``k``-word n-grams; ``component_id`` is the smallest id
    reachable. A text of 1..k-1 words has its whole sequence as its only n-gram.

    NULL, empty and blank texts have an empty set and link with nothing. Rows
    that repeat an id are documents of their own; a row with a NULL id links like any
    other and takes the component's smallest id (NULL if that has none). Ties cannot arise. Other
    columns of ``docs`` are ignored, whatever their names. An empty table gives
    an empty result.

    ``fragment_grams`` bounds the n-grams of one fragment; the number of
    fragments follows the corpus."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fp = staged(fingerprints(src.withColumn("text_key", F.xxhash64("text")), k))
    total = fp.agg(F.sum("n")).first()[0] or 0
    n_frag = max(8, math.ceil(total / fragment_grams))
    classes = (fp.where("n > 0").groupBy("f1", "f2", "n")
               .agg(F.min("doc_id").alias("low"), F.count("*").alias("class_size"),
                    F.coalesce(F.min_by("text_key", "doc_id"), F.min("text_key")).alias("text_key")))
    credit = shared_counts(src, k, n_frag)
    # a class is named by f1; id and text hash are only needed to find one of its texts again
    keep = staged(classes.join(credit, "f1")
                  .where(F.lit(100) * F.col("credit") >= F.lit(percent) * F.col("n"))
                  .select(F.col("low").alias("doc_id"), "text_key", "f1", "f2",
                          F.greatest(F.lit(0), F.col("n") - F.col("credit")).alias("gap")))
    sets = staged(_class_sets(src, keep, k))
    segments = staged(_segments(sets, n_segments))
    links = _verified(staged(_first_candidates(sets, n_keys)), segments, percent)
    links = staged(links)
    comp = components(links)
    more = _verified(staged(_rest_candidates(sets, staged(comp), percent, fragment_grams)), segments, percent)
    both = components(links.unionByName(more))
    named = classes.join(both.withColumnRenamed("node", "f1"), "f1", "left").withColumn(
        "root", F.coalesce("root", "f1"))
    named = staged(named.select("f1", "f2", "n", "low", "class_size", "root"))
    best = named.groupBy("root").agg(F.min("low").alias("component_id"))
    label = named.join(best, "root").select("f1", "f2", "class_size", "root", F.col("component_id").alias("_c"))
    out = fp.join(label, ["f1", "f2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("_c", "doc_id").alias("component_id"),
                      F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), "text_key",
                      F.col("root").alias("group_key"))


def _segments(sets: DataFrame, n_segments: int) -> DataFrame:
    """(node, n, frag, seg): each set cut at the fragment borders of the order."""
    def run(batches):
        for batch in batches:
            grams = batch.column(2)
            vals = grams.flatten().to_numpy()
            node, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            size = np.asarray(grams.value_lengths()).astype(np.int64)
            row = np.repeat(np.arange(len(node)), size)
            frag = ((vals.view(np.uint64) >> _U(32)) * _U(n_segments)) >> _U(32)
            key = row * n_segments + frag.astype(np.int64)
            # sets are sorted by hash, so a segment is a contiguous run
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
            off = np.r_[first, len(key)].astype(np.int32)
            r = row[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[r]), pa.array(n[r]), pa.array(frag[first].astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(vals))], names=["node", "n", "frag", "seg"])
    return sets.select("node", "n", "grams").mapInArrow(trimmed(run), "node long, n long, frag int, seg array<long>")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` (all columns) with one document of each group of linked ones: the
    one with the smallest id. Only ids and text hashes of leaving documents travel,
    not texts. Rows that repeat id and text stay once; rows that repeat an id with
    another text are documents of their own; a row without an id leaves if it links
    with one that has an id; of a group without any id the text of the smallest hash
    stays, once."""
    found = staged(ngram_jaccard_join(docs, id_col, text_col, **options))
    nameless = (found.where("component_id is null and group_key is not null").groupBy("group_key")
                .agg(F.min("text_key").alias("_first")).select(F.col("group_key").alias("_group"), "_first"))
    found = found.join(small(staged(nameless)), F.col("group_key") == F.col("_group"), "left")
    gone = staged(found.where("doc_id <> component_id or (doc_id is null and component_id is not null) "
                              "or (component_id is null and text_key <> _first)")
                  .select(F.col("doc_id").alias("_gi"), F.col("text_key").alias("_gk")).distinct())
    again = staged(found.groupBy("doc_id", "text_key").count().where("count > 1")
                   .select(F.col("doc_id").alias("_ai"), F.col("text_key").alias("_ak")))
    this, key = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))
    kept = docs.join(small(gone), this.eqNullSafe(F.col("_gi")) & (key == F.col("_gk")), "left_anti")
    if again.isEmpty():
        return kept
    same = this.eqNullSafe(F.col("_ai")) & (key == F.col("_ak"))
    return (kept.join(small(again), same, "left_anti")
            .unionByName(kept.join(small(again), same, "left_semi").dropDuplicates([id_col, text_col])))

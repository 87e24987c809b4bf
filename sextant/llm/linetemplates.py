"""Line dedup by a log-template tree.

A line's path in the tree is fixed in depth: its token count, then its leading
tokens. Below that path stand the templates: tokens that hold a digit are
variable fields in every template (in a line with a fixed token for every two of
them; rows of numbers stand for themselves), and one further field may vary, a run of
neighbouring tokens (the rest of the line is cut into ``fields`` runs). A line so
belongs to its own template and to one with each run left open. A template
recurs if lines of enough different texts belong to it; lines of recurring
templates are dropped. ``min_docs`` texts are enough, one less for every
``WORDS_PER_DOC`` fixed tokens of the template, 2 at least: the longer a line, the
less it repeats by chance. Lines of under ``min_tokens`` words stand for themselves,
with no field, and need twice ``min_docs`` texts.

Templates are 64-bit hashes, sums over positions, computed for all lines of a
batch by array operations. A task sends each template once per flush with the
number of its texts, so the commonest line of the corpus costs one row per
flush. Recurring templates then go back to the documents: by broadcast if their
number is bounded, else by a join keyed by template."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import ship, staged

_U = np.uint64
_WILD = _U(0x7E57AB1E5EED0001)
#: Recurring templates that a task may hold (8 bytes each).
HELD_TEMPLATES = 1_000_000
#: So many fixed tokens of a template stand for one of its texts.
WORDS_PER_DOC = 8


class Lines:
    """Lines (split at newline) of a block of documents and their templates."""

    def __init__(self, w: K.Words, depth: int, fields: int, min_tokens: int, min_docs: int = 5):
        body = w.bytes
        nl = np.flatnonzero(body == 0x0A)
        # a line starts at a document's start and after each of its newlines
        full = w.doc_end > w.doc_start
        begin = np.concatenate([w.doc_start[full], nl + 1])
        doc = np.concatenate([np.flatnonzero(full), np.searchsorted(w.doc_end, nl, side="right")])
        order = np.argsort(begin, kind="stable")
        begin, doc = begin[order], doc[order]
        ok = begin < w.doc_end[doc]            # nothing after a final newline: not a line
        begin, doc = begin[ok], doc[ok]
        self.begin, self.doc = begin, doc
        stop = w.doc_end[doc]
        if len(begin):
            stop = stop - (body[stop - 1] == 0x0A)
            same = np.flatnonzero(doc[1:] == doc[:-1])
            stop[same] = begin[same + 1] - 1
        self.stop = stop
        line = np.searchsorted(begin, w.begin, side="right") - 1      # of each word
        n = len(begin)
        self.tokens = np.bincount(line, minlength=n).astype(np.int64)
        first = np.cumsum(self.tokens) - self.tokens
        pos = np.arange(len(line)) - first[line]
        m = self.tokens[line]
        digit = w.has_digit()
        fields_of = np.bincount(line[digit], minlength=n)
        # fields need fixed tokens around them: one for every two, else all tokens stand for themselves
        ok = (self.tokens >= min_tokens) & (2 * (self.tokens - fields_of) >= fields_of) & (fields_of < self.tokens)
        wild = digit & ok[line]
        tok = np.where(wild, _WILD, w.hash)
        fixed = np.bincount(line[~wild], minlength=n)
        with np.errstate(over="ignore"):
            part = K.mix64(tok ^ K.mix64(pos.astype(np.uint64)))
            total = K.segment_sums(part, line, n) + K.mix64(self.tokens.astype(np.uint64))
            own = K.mix64(total)
            # index of the run of each token behind the leading ones
            run = np.where(pos >= depth, ((pos - depth) * fields) // np.maximum(m - depth, 1), -1)
            open_ = np.flatnonzero(self.tokens >= max(min_tokens, depth + fields))
            sig, of, words = [own], [np.arange(n)], [fixed]
            for f in range(fields):
                cut = total.copy()
                pick = np.flatnonzero(run == f)
                cut -= K.segment_sums(part[pick], line[pick], n)
                sig.append(K.mix64(cut + K.mix64(np.full(1, 1000 + f, dtype=np.uint64))[0])[open_])
                of.append(open_)
                words.append((fixed - np.bincount(line[pick[~wild[pick]]], minlength=n))[open_])
        self.sig, self.line, words = np.concatenate(sig), np.concatenate(of), np.concatenate(words)
        # texts that a template needs
        self.need = np.where(self.tokens[self.line] < min_tokens, 2 * min_docs,
                             np.maximum(min_docs - words // WORDS_PER_DOC, min(2, min_docs)))
        keep = (self.tokens[self.line] > 0) & (words > 0)       # nothing but fields is no template
        self.sig, self.line, self.need = self.sig[keep], self.line[keep], self.need[keep]


def _text_key(w: K.Words) -> np.ndarray:
    """A hash of each document's words in order: copies share it."""
    first = np.cumsum(w.per_doc) - w.per_doc
    pos = np.arange(len(w.hash)) - first[w.doc]
    return K.segment_sums(K.mix64(w.hash ^ K.mix64(pos.astype(np.uint64))), w.doc, w.n_docs)


def recurring_templates(docs: DataFrame, depth: int, fields: int, min_tokens: int, min_docs: int,
                        flush: int = 1_000_000) -> DataFrame:
    """(sig) of the templates whose lines stand in as many different texts as they
    need. These are proof enough, so a task sends so many per template and flush at
    most; texts are then told apart and counted."""
    def run(batches):
        sig, key, need, have = [], [], [], 0

        def emit():
            s, k, m = np.concatenate(sig), np.concatenate(key), np.concatenate(need)
            order = np.lexsort((k, s))
            s, k, m = s[order], k[order], m[order]
            new = np.r_[True, (s[1:] != s[:-1]) | (k[1:] != k[:-1])]
            s, k, m = s[new], k[new], m[new]
            first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            rank = np.arange(len(s)) - np.repeat(first, np.diff(np.r_[first, len(s)]))
            few = rank < m
            return pa.RecordBatch.from_arrays(
                [pa.array(s[few].view(np.int64)), pa.array((k[few] >> _U(33)).astype(np.int32)),
                 pa.array(m[few].astype(np.int32))], names=["sig", "txt", "need"])

        for batch in batches:
            for _, _, w in K.word_blocks(batch.column(0), 1 << 18):
                x = Lines(w, depth, fields, min_tokens, min_docs)
                if not len(x.sig):
                    continue
                sig.append(x.sig)
                key.append(_text_key(w)[x.doc[x.line]])
                need.append(x.need)
                have += len(x.sig)
                if have >= flush:
                    yield emit()
                    sig, key, need, have = [], [], [], 0
        if have:
            yield emit()
    part = (docs.select("text").mapInArrow(run, "sig long, txt int, need int")
            .groupBy("sig", "txt").agg(F.max("need").alias("need")))
    return (part.groupBy("sig").agg(F.count("*").alias("m"), F.max("need").alias("need"))
            .where(F.col("m") >= F.col("need")).select("sig"))


def _drop_held(src: DataFrame, held: np.ndarray, depth: int, fields: int, min_tokens: int) -> DataFrame:
    """The lines of ``held`` templates (sorted) leave, within the scan."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            out, n_lines, n_drop = texts.to_pylist(), [], []
            for a, b, w in K.word_blocks(texts, 1 << 18):
                x = Lines(w, depth, fields, min_tokens)
                at = np.searchsorted(held, x.sig)
                hit = at < len(held)
                hit[hit] = held[at[hit]] == x.sig[hit]
                gone = np.zeros(len(x.begin), dtype=bool)
                gone[x.line[hit]] = True
                n_lines.append(np.bincount(x.doc, minlength=b - a))
                n_drop.append(np.bincount(x.doc[gone], minlength=b - a))
                body = w.bytes.tobytes()
                edge = np.searchsorted(x.doc, np.arange(b - a + 1))
                for d in np.flatnonzero(n_drop[-1]).tolist():
                    keep = [body[x.begin[i]:x.stop[i]] for i in range(edge[d], edge[d + 1]) if not gone[i]]
                    out[a + d] = b"\n".join(keep).decode("utf-8")
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(out, pa.string()), pa.array(np.concatenate(n_lines).astype(np.int32)),
                     pa.array(np.concatenate(n_drop).astype(np.int32))], names=["doc_id", "text", "n_lines", "n_dropped"])
    return src.mapInArrow(run, "doc_id long, text string, n_lines int, n_dropped int")


def _drop_joined(src: DataFrame, rec: DataFrame, depth: int, fields: int, min_tokens: int) -> DataFrame:
    """The same by joins, for any number of templates: the templates' lines are
    found by a join keyed by template and go back to their texts by a join keyed
    by a hash of id and text (equal rows lose equal lines)."""
    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for a, b, w in K.word_blocks(batch.column(1), 1 << 18):
                x = Lines(w, depth, fields, min_tokens)
                nth = np.arange(len(x.doc)) - np.searchsorted(x.doc, x.doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a + x.doc[x.line]]), pa.array(nth[x.line].astype(np.int32)),
                     pa.array(x.sig.view(np.int64))], names=["key", "line", "sig"])
    keyed = src.withColumn("key", F.xxhash64("doc_id", "text"))
    lines = keyed.select("key", "text").mapInArrow(run, "key long, line int, sig long")
    gone = lines.join(rec, "sig").groupBy("key").agg(F.collect_set("line").alias("gone"))
    body = F.split(F.regexp_replace("text", r"\n\z", ""), "\n", -1)
    none = F.col("text").isNull() | (F.col("text") == "")
    size = F.when(none, F.lit(0)).otherwise(F.size(body)).cast("int")
    kept = F.array_join(F.filter(body, lambda _, i: ~F.array_contains("gone", i)), "\n")
    return (keyed.join(gone, "key", "left")
            .select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
                    size.alias("n_lines"), F.coalesce(F.array_size("gone"), F.lit(0)).alias("n_dropped")))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 2,
                         fields: int = 4, min_tokens: int = 3, min_docs: int = 5,
                         held_templates: int = HELD_TEMPLATES) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) per input row: the text without the
    lines of recurring templates. Lines of under ``min_tokens`` words need twice
    ``min_docs`` texts; blank lines stay. Copies of one text count once, so a text is
    not emptied for being copied; near copies are different texts and all lose the long
    lines they share, so a near-copy join belongs before this step.

    A NULL text stays NULL with no lines; an empty text stays empty; a text that
    loses no line stays as it is, else its lines are joined anew. Repeated rows and
    rows without an id are rows like others; other columns are ignored. A template
    met in exactly as many texts as it needs recurs. An empty table gives an empty result.
    Up to ``held_templates`` recurring templates are held by each task; more are
    joined."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rec = staged(recurring_templates(src, depth, fields, min_tokens, min_docs))
    if rec.limit(held_templates + 1).count() > held_templates:
        return _drop_joined(src, rec, depth, fields, min_tokens)
    held = np.sort(rec.toPandas()["sig"].to_numpy(dtype=np.int64).view(np.uint64))
    return _drop_held(src, held, depth, fields, min_tokens)

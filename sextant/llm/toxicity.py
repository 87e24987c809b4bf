"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

*Lexicon.* From a bounded sample of labelled documents: words, and word stems
(leading letters), that are many times likelier in toxic documents than in
clean ones.

*Matching.* The lexicon is a trie. The Levenshtein automata of all its terms
are intersected with it: a state is a set of (trie node, edits so far), made
deterministic as words are read, so a word costs one table step per letter and
most words reach the empty state after a few. Long terms allow one edit
(insertion, deletion, substitution or neighbouring letters swapped).

*Context.* A hit is quoted if quotation marks enclose it within a window of
words or a cue of reported speech stands in it; the window scales what the hit
adds to the score.

*Score.* For each term the share of toxic documents among the sampled ones with an
exact hit, smoothed. A misspelling backs off in steps: the sampled documents with
this very form count first, then the term's share times its edit factor, which
backs off to the factor over all terms. The factor is learned from forms that
stand in one half of the sample only, as a form new to the sample does, so a term
amid clean look-alikes gets a low one. A document's score is the noisy-or of its
distinct terms that speak for toxicity. Without one it is the smoothed rate of
the sampled documents without one."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import crc_mod, ship, small, staged, trimmed

_LETTERS = re.compile(r"[^\W\d_]+")
_PIECES = re.compile(r"[^\W_]+")
# marks that open or close a quotation
_QUOTES = set("\"“”„«»‹›")
# words that report someone else's speech, in the corpus languages
CUES = frozenset("said says saying quote quoted wrote writes sagte schrieb zitat zitiert dit disait écrit cite "
                 "dijo dice escribió cita".split())


class LexiconAutomaton:
    """Deterministic union of the Levenshtein automata of the lexicon's terms,
    run over their trie. ``terms`` are (text, is_stem)."""

    def __init__(self, terms: list[tuple[str, bool]], fuzzy_length: int = 5, edits: int = 1):
        self.terms = terms
        self.kids: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.slack: list[int] = [0]     # edits that some term below allows
        for i, (text, is_stem) in enumerate(terms):
            allow = edits if len(text) >= fuzzy_length and not is_stem else 0
            node = 0
            self.slack[0] = max(self.slack[0], allow)
            for c in text:
                if c not in self.kids[node]:
                    self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.slack.append(0)
                node = self.kids[node][c]
                self.slack[node] = max(self.slack[node], allow)
            (self.stem if is_stem else self.word)[node] = i
        self.allow = [edits if len(t) >= fuzzy_length and not s else 0 for t, s in terms]
        self.sets: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.stems: list[tuple[int, int] | None] = []
        self.words: list[tuple[int, int] | None] = []
        self.start = self._add(self._closed({(0, 0, "")}))

    def _closed(self, states: set) -> frozenset:
        """With the states reached by skipping letters of terms, fewest edits each."""
        best: dict[tuple[int, str], int] = {}
        todo = list(states)
        while todo:
            node, e, want = todo.pop()
            if e > self.slack[node] or best.get((node, want), 9) <= e:
                continue
            best[(node, want)] = e
            if not want:
                todo.extend((kid, e + 1, "") for kid in self.kids[node].values())
        return frozenset((n, e, w) for (n, w), e in best.items())

    def _add(self, s: frozenset) -> int:
        if s in self.number:
            return self.number[s]
        self.number[s] = i = len(self.sets)
        self.sets.append(s)
        self.steps.append({})
        stem = sorted((e, self.stem[n]) for n, e, w in s if not w and e == 0 and self.stem[n] >= 0)
        word = sorted((e, self.word[n]) for n, e, w in s
                      if not w and self.word[n] >= 0 and e <= self.allow[self.word[n]])
        self.stems.append((stem[0][1], 0) if stem else None)
        self.words.append((word[0][1], word[0][0]) if word else None)
        return i

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, e, want in self.sets[state]:
            if want:                                   # second half of a swap
                if c == want:
                    out.add((node, e, ""))
                continue
            kids = self.kids[node]
            if c in kids:
                out.add((kids[c], e, ""))
            if e < self.slack[node]:
                out.add((node, e + 1, ""))             # a letter too many
                for a, kid in kids.items():
                    out.add((kid, e + 1, ""))          # another letter
                    if c in self.kids[kid] and a != c:
                        out.add((self.kids[kid][c], e + 1, a))
        s = self._closed(out)
        nxt = self._add(s) if s else -1
        self.steps[state][c] = nxt
        return nxt

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best term, or None: fewest edits, a whole word
        before a stem, then the earlier term."""
        at, stem = self.start, None
        for c in word:
            nxt = self.steps[at].get(c)
            if nxt is None:
                nxt = self._step(at, c)
            if nxt < 0:
                return stem
            at = nxt
            stem = stem or self.stems[at]
        whole = self.words[at]
        return whole if whole and (whole[1] == 0 or stem is None) else stem


class Scanner:
    """Finds (term, edits, form, quoted) in documents; ``form`` is the word of a hit
    with edits, else empty. A hit of a word under a stem of the lexicon counts for the
    stem. Words seen before are looked up by hash. The memory of seen words is emptied
    when it holds ``remember``."""

    def __init__(self, terms, window: int = 8, remember: int = 1_000_000, fuzzy_length: int = 4):
        self.auto, self.window, self.remember = LexiconAutomaton(terms, fuzzy_length), window, remember
        stems = {x: i for i, (x, stem) in enumerate(terms) if stem}
        self.of = [next((stems[x[:m]] for m in range(1, len(x)) if x[:m] in stems), i) if not stem else i
                   for i, (x, stem) in enumerate(terms)]
        self.seen: dict[int, int] = {}
        self.codes: list[tuple[int, int, str]] = []
        self.code_of: dict[tuple[int, int, str], int] = {}

    def _code(self, raw: bytes) -> int:
        best = None
        for piece in _PIECES.findall(raw.decode("utf-8", "replace").lower()):
            m = self.auto.match(piece)
            if m and (best is None or m[1] < best[1]):
                best = (self.of[m[0]], m[1], piece if m[1] else "")
        if best is None:
            return -1
        if best not in self.code_of:
            self.code_of[best] = len(self.codes)
            self.codes.append(best)
        return self.code_of[best]

    def _quoted(self, w: K.Words, body: bytes, i: int) -> bool:
        lo, hi = i, i
        while lo > 0 and i - lo < self.window and w.doc[lo - 1] == w.doc[i]:
            lo -= 1
        while hi + 1 < len(w.doc) and hi - i < self.window and w.doc[hi + 1] == w.doc[i]:
            hi += 1
        around = [body[w.begin[j]:w.stop[j]].decode("utf-8", "replace") for j in range(lo, hi + 1)]
        before, here, after = "".join(around[:i - lo]), around[i - lo], "".join(around[i - lo + 1:])
        lead = any(c in _QUOTES for c in here[:1]) or sum(c in _QUOTES for c in before) % 2 == 1
        tail = any(c in _QUOTES for c in here[1:]) or any(c in _QUOTES for c in after)
        return (lead and tail) or any(x.lower().strip(",.:;!?") in CUES for x in around)

    def block(self, w: K.Words):
        """(document index, term, edits, form, quoted) of the hits of a block."""
        if len(self.seen) > self.remember:
            self.seen, self.codes, self.code_of = {}, [], {}
        uniq, first, inv = np.unique(w.hash, return_index=True, return_inverse=True)
        body = w.bytes.tobytes()
        code = np.empty(len(uniq), dtype=np.int64)
        seen = self.seen
        for k, h in enumerate(uniq.tolist()):
            c = seen.get(h)
            if c is None:
                f = first[k]
                c = seen[h] = self._code(body[w.begin[f]:w.stop[f]])
            code[k] = c
        for i in np.flatnonzero(code[inv] >= 0).tolist():
            yield int(w.doc[i]), *self.codes[code[inv[i]]], self._quoted(w, body, i)


def _terms_of(text: str, stems: tuple[int, ...]) -> set[tuple[str, bool]]:
    words = set(_LETTERS.findall(text.lower()))
    return {(x, False) for x in words if len(x) >= 3} | {(x[:n], True) for x in words for n in stems if len(x) > n}


def fit(labelled: DataFrame, stems: tuple[int, ...] = (4, 5, 6, 7), min_docs: int = 5, min_share: float = 0.005,
        lift: float = 20.0, max_terms: int = 3000, prior: float = 2.0, edit_factor: float = 0.9) -> dict:
    """The model from ``labelled`` (text, toxic 0/1; a bounded sample): terms,
    precision per (term, edits) and per (term, misspelt form) of the sample, rate
    without a term, factor for quoted hits. ``edit_factor`` is the edit factor
    without any evidence. A
    term stands in at least ``min_docs`` and ``min_share`` of the toxic texts (a
    text that several documents share counts once) that no better term explains."""
    ship(labelled.sparkSession)
    labelled = staged(labelled.groupBy("text").agg(F.max("toxic").alias("toxic")))
    n1, n0 = (labelled.agg(F.sum(F.col("toxic")).alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first())
    n1, n0 = int(n1 or 0), int(n0 or 0)
    least = max(min_docs, min_share * n1)
    base = (n1 + 0.5) / (n1 + n0 + 1) if n1 + n0 else 0.0
    empty = {"terms": [], "precision": {}, "forms": {}, "rest": base, "quoted": 0.5}
    if not n1 or not n0:
        return empty

    def count(wanted):
        def run(batches):
            have: dict = {}
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    t = _terms_of(text, stems)
                    for x in (t if wanted is None else t & wanted):
                        have[x] = have.get(x, 0) + 1
                if len(have) > 500_000:
                    yield _term_batch(have)
                    have = {}
            yield _term_batch(have)
        return run

    schema = "term string, stem boolean, n long"

    def totals(label, wanted):
        return (labelled.where(F.col("toxic") == label).select("text").mapInArrow(trimmed(count(wanted)), schema)
                .groupBy("term", "stem").agg(F.sum("n").alias("n")))
    # at most (terms of the bounded sample) / min_docs rows
    hot = {(r.term, r.stem): r.n for r in totals(1, None).where(F.col("n") >= least).collect()}
    cold = {(r.term, r.stem): r.n for r in totals(0, set(hot)).collect()}
    score = {t: (n / n1) / ((cold.get(t, 0) + 0.5) / (n0 + 1)) for t, n in hot.items()}
    good = sorted((t for t in hot if score[t] >= lift), key=lambda t: (-hot[t], t))
    # a stem is of use if it gathers more than its most frequent word; it grows
    # while it keeps nearly all its documents; words under a stem are not needed
    # but for their misspellings
    top: dict[str, int] = {}
    for (x, stem), n in hot.items():
        if not stem:
            for m in stems:
                top[x[:m]] = max(top.get(x[:m], 0), n)
    found = sorted((x for x, stem in good if stem and hot[(x, True)] >= 1.5 * top.get(x, 0)), key=lambda x: (len(x), x))
    kept_stems: set[str] = set()
    for x in found:
        if not any(x[:m] in kept_stems for m in stems if m < len(x)) and not any(
                y != x and y.startswith(x) and hot[(y, True)] >= 0.9 * hot[(x, True)] for y in found):
            kept_stems.add(x)
    options = [(x, stem) for x, stem in good
               if (x in kept_stems if stem else not any(x[:m] in kept_stems for m in stems if m <= len(x)))]
    common = [t for t in options if hot[t] >= 0.05 * n1]
    rest = [t for t in options if t not in set(common)]
    terms = common + _cover(labelled.where("toxic = 1").select("text"), common, rest, stems)
    if not terms:
        return empty
    used = {x for x, stem in terms if stem}
    terms = terms + [(x, False) for x, stem in good if not stem and any(x[:m] in used for m in stems if m <= len(x))]

    def hits(batches):
        scan = Scanner(terms)
        for batch in batches:
            label, half = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out = []
            for a, b, w in K.word_blocks(batch.column(0), 1 << 18):
                found = {}
                for d, term, edits, form, quoted in scan.block(w):
                    key = (a + d, term, edits, form)
                    found[key] = found.get(key, True) and quoted
                out += [(d, t, e, f, q, label[d], half[d]) for (d, t, e, f), q in found.items()]
                hit = {d for d, *_ in found}
                out += [(d, -1, 0, "", False, label[d], half[d]) for d in range(a, b) if d not in hit]
            if out:
                _, t, e, f, q, y, h = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t, pa.int32()), pa.array(e, pa.int32()), pa.array(f, pa.string()),
                     pa.array(q, pa.bool_()), pa.array(y, pa.int64()), pa.array(h, pa.int32())],
                    names=["term", "edits", "form", "quoted", "toxic", "half"])
    # at most (words of the bounded sample) rows
    rows = (labelled.select("text", F.col("toxic").cast("long").alias("toxic"), crc_mod("text", 2).cast("int").alias("half"))
            .mapInArrow(trimmed(hits), "term int, edits int, form string, quoted boolean, toxic long, half int")
            .groupBy("term", "edits", "form", "quoted", "half").agg(F.sum("toxic").alias("a"), F.count("*").alias("m"))
            .collect())
    num: dict = {}
    forms: dict = {}
    for r in rows:
        if not r.quoted:
            own = forms.setdefault((r.term, r.form), {}) if r.edits else num.setdefault(r.term, {})
            own[r.half] = (r.a, r.m)
    total = lambda own: (sum(a for a, _ in own.values()), sum(m for _, m in own.values()))
    exact = {t: total(own) for t, own in num.items()}
    quoted = [(r.a, r.m) for r in rows if r.quoted]
    qa, qm = sum(a for a, _ in quoted), sum(m for _, m in quoted)
    rest_a, rest_m = exact.pop(-1, (0, 0))
    p0 = {t: (a + prior * base) / (m + prior) for t, (a, m) in exact.items()}
    return {"terms": terms, "rest": (rest_a + base) / (rest_m + 1),
            **_misspelt(p0, {t: m for t, (_, m) in exact.items()}, forms, edit_factor, prior),
            "quoted": (qa + 5.0) / (qm + 10.0)}


def _misspelt(p0: dict, weight: dict, forms: dict, factor: float, prior: float) -> dict:
    """``precision`` and ``forms`` of the model, from the terms' exact precision and
    number of documents and from (toxic documents, documents) per (term, form) and
    half of the sample."""
    new: dict = {t: [0, 0] for t in p0}
    for (t, _), own in forms.items():
        if t in new and len(own) == 1:      # new to the other half
            (a, m), = own.values()
            new[t][0] += a
            new[t][1] += m

    def ratio(t, back):
        return min(1.0, (new[t][0] + prior * back * p0[t]) / ((new[t][1] + prior) * p0[t]))
    # over all terms, each by the documents it stands in as it is spelt
    every = sum(weight[t] * ratio(t, factor) for t in p0) / max(1, sum(weight.values()))
    precision = {(t, 0): p for t, p in p0.items()} | {(t, 1): p * ratio(t, every) for t, p in p0.items()}
    seen = {}
    for (t, form), own in forms.items():
        a, m = (sum(x) for x in zip(*own.values()))
        seen[(t, form)] = (a + precision.get((t, 1), 0.0)) / (m + 1)
    return {"precision": precision, "forms": seen}


def _cover(toxic: DataFrame, common: list, rest: list, stems: tuple[int, ...], least: int = 2) -> list:
    """Those of ``rest`` that explain toxic texts without a ``common`` term: each
    turn takes the one in most texts without a term so far, ``least`` at least.
    Words that only ride along in near copies of a toxic text explain nothing and
    stay out. Works on the bounded sample."""
    number, taken = {t: i for i, t in enumerate(rest)}, set(common)

    def run(batches):
        for batch in batches:
            own = []
            for x in batch.column(0).to_pylist():
                t = _terms_of(x, stems)
                own.append([] if t & taken else sorted(number[y] for y in t if y in number))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32()))], names=["own"])
    docs = [set(r.own) for r in toxic.mapInArrow(trimmed(run), "own array<int>").where("size(own) > 0").collect()]
    where: dict[int, set[int]] = {}
    for d, own in enumerate(docs):
        for t in own:
            where.setdefault(t, set()).add(d)
    open_docs, out = set(range(len(docs))), []
    while where:
        for t in where:
            where[t] &= open_docs
        best = max(where, key=lambda t: (len(where[t]), -t))
        if len(where[best]) < least:
            break
        out.append(rest[best])
        open_docs -= where.pop(best)
    return out


def _term_batch(have: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in have], pa.string()), pa.array([s for _, s in have], pa.bool_()),
         pa.array(list(have.values()), pa.int64())], names=["term", "stem", "n"])


def _score_column(column, scan: Scanner, model: dict, speaks: float):
    """Scores, numbers of hits and terms of the rows of a text column."""
    n, unseen = len(column), model["rest"]
    hits = np.zeros(n, dtype=np.int32)
    by_doc: dict[int, dict[int, float]] = {}
    for a, _, w in K.word_blocks(column, 1 << 18):
        for d, term, edits, form, quoted in scan.block(w):
            p = model["precision"].get((term, edits), unseen)
            if edits:
                p = model["forms"].get((term, form), p)
            p *= model["quoted"] if quoted else 1.0
            hits[a + d] += 1
            if p >= speaks:
                own = by_doc.setdefault(a + d, {})
                own[term] = max(own.get(term, 0.0), p)
    score = np.full(n, unseen)
    terms: list[list[str]] = [[] for _ in range(n)]
    for d, own in by_doc.items():
        clean = 1.0 - unseen
        for t in sorted(own):
            clean *= 1.0 - own[t]
        score[d] = 1.0 - clean
        terms[d] = [model["terms"][t][0] for t in sorted(own)]
    return np.clip(score, 0.0, 1.0), hits, terms


def keep_clean(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = 0.7,
               speaks: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) that score under ``threshold``, found
    within the scan: no row is shuffled. A NULL text stays."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        scan = Scanner(model["terms"])
        for batch in batches:
            score, _, _ = _score_column(batch.column(at), scan, model, speaks)
            yield batch.filter(pa.array(score < threshold))
    return docs.mapInArrow(trimmed(run), docs.schema)


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
                    speaks: float = 0.5) -> DataFrame:
    """(doc_id, score, n_hits, terms) per input row. ``terms`` lists the distinct
    terms that spoke for toxicity. NULL and empty texts score the rate of
    documents without a term. Repeated rows score alike; other columns are
    ignored; an empty table gives an empty result."""
    ship(docs.sparkSession)

    def run(batches):
        scan = Scanner(model["terms"])
        for batch in batches:
            score, hits, terms = _score_column(batch.column(1), scan, model, speaks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(hits), pa.array(terms, pa.list_(pa.string()))],
                names=["doc_id", "score", "n_hits", "terms"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(trimmed(run), "doc_id long, score double, n_hits int, terms array<string>")


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", held_out_mod: int = 3, held_out_at: int = 1,
                    max_toxic: int = 6_000, max_clean: int = 14_000) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out part: about
    ``max_toxic`` and ``max_clean`` at most, chosen by a hash of the id, whole
    texts. An id labelled more than once is toxic if any label says so; NULL
    labels and ids are not used."""
    y = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
                      & (crc_mod(id_col, held_out_mod) != held_out_at))
         .groupBy(F.col(id_col).cast("long").alias("_lid")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")))
    y = staged(y)
    n = {r.toxic: r["count"] for r in y.groupBy("toxic").count().collect()}
    part = F.when(F.col("toxic") == 1, F.lit(min(1.0, max_toxic / max(1, n.get(1, 0))))).otherwise(
        F.lit(min(1.0, max_clean / max(1, n.get(0, 0)))))
    some = y.where((F.pmod(F.xxhash64("_lid"), F.lit(1 << 30)) / F.lit(float(1 << 30))) < part)
    text = docs.select(F.col(id_col).cast("long").alias("_did"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return staged(text.join(small(staged(some)), F.col("_did") == F.col("_lid")).select("text", "toxic"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits, terms) per input row: model
    fitted on the documents whose crc32(id) mod 3 is not 1, applied to all. A row
    with a NULL id counts as held out (it is never learned from)."""
    model = fit(training_sample(docs, labels))
    out = score_documents(docs, model)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits", "terms")

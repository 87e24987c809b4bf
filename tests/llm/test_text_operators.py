import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, clashing, edge_docs, rows, words

from sextant.llm import langmix, licence_texts, licences, linetemplates, textkernel, tiling, tokenfile, toxicity


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_mixture(spark):
    rng = random.Random(1)
    parts = {"aa": ["the", "and", "ing", "tion"], "bb": ["der", "sch", "keit", "und"]}

    def text(lang, n=60):
        return " ".join("".join(rng.choices(parts[lang], k=2)) for _ in range(n))
    docs = [(i, text(lang), lang, None, 0) for i in range(120) for lang in ["aa" if i % 2 else "bb"]]
    docs += [(1000, text("aa") + " " + text("bb"), None, None, 0)]
    df = spark.createDataFrame(docs, DOCS)
    got = {r.doc_id: r for r in langmix.identify_languages(df).collect()}
    assert all(got[i].lang_pred == lang and got[i].held_out == (crc(i) % 5 == 0) for i, _, lang, _, _ in docs[:-1])
    mix = {m.lang: m.share for m in got[1000].mixture}
    assert set(mix) == {"aa", "bb"} and mix["aa"] == pytest.approx(0.5, abs=0.1)
    assert langmix.identify_languages(spark.createDataFrame([], DOCS)).count() == 0


def test_language_of_texts_without_letters(spark):
    model = {"langs": ["x"], "logp": np.zeros((1, langmix.BUCKETS), dtype=np.float32)}
    got = rows(langmix.identify(edge_docs(spark), model), "doc_id", "lang_pred", "score")
    assert (1, "und", 0.0) in got and (2, "und", 0.0) in got and (3, "und", 0.0) in got and (5, "x", 1.0) in got


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_held_out(spark):
    rng = random.Random(3)
    bad = ["blockhead", "nitwit"]
    docs, labels = [], []
    for i in range(300):
        w, toxic = words(rng, 40), i % 4 == 0
        if toxic:
            w[rng.randrange(40)] = rng.choice(bad)
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs += [(900, "you blokhead go", "en", "s", 0), (901, None, None, None, None), (902, "", "en", "s", 0)]
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], LABELS)
    got = {r.doc_id: r for r in toxicity.toxicity(clashing(df), lab).collect()}
    assert len(got) == 303
    assert all(got[i].predicted == y and got[i].held_out == (crc(i) % 3 == 1) for i, _, y in labels)
    assert got[900].n_hits == 1 and got[901].predicted == got[902].predicted == 0
    none = spark.createDataFrame([], DOCS)
    assert toxicity.toxicity(none, lab).count() == 0
    assert toxicity.toxicity(df, spark.createDataFrame([], LABELS)).where("predicted = 1").count() == 0


def test_toxicity_of_unseen_misspellings(spark):
    rng = random.Random(9)
    bad = ["blockhead", "nitwit", "scum", "trolling", "trolled", "trollish"]
    docs, labels = [], []
    for i in range(600):
        w, toxic = words(rng, 40), i % 4 == 0
        if toxic:
            w[rng.randrange(40)] = bad[i // 4 % 6]
        elif i % 8 == 1:
            w[rng.randrange(40)] = rng.choice(["nitwits", "scud", "strolling"])       # clean words one edit away
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    new = ["you blokhead go", "what a blockheda", "such scumm here", "he is trolilng again", "they torlled me"]
    clean = ["two nitwits there", "a scud in the sky", "the black head of it", "out strolling again"]
    docs += [(9000 + i, t, "en", "s", 0) for i, t in enumerate(new + clean)]
    got = {r.doc_id: r for r in toxicity.toxicity(spark.createDataFrame(docs, DOCS),
                                                  spark.createDataFrame(labels, LABELS)).collect()}
    assert [got[9000 + i].predicted for i in range(9)] == [1] * 5 + [0] * 4
    assert all(got[i].predicted == y for i, _, y in labels)


def test_edit_factor_is_low_amid_look_alikes():
    p0, weight = {0: 0.9, 1: 0.9}, {0: 50, 1: 50}
    forms = {(1, f"form{i}"): {i % 2: (0, 1)} for i in range(20)}
    m = toxicity._misspelt(p0, weight, forms, 0.9, 2.0)
    assert m["precision"][(0, 1)] > 3 * m["precision"][(1, 1)] and m["precision"][(1, 0)] == 0.9
    alone = toxicity._misspelt(p0, weight, {(0, "f"): {0: (0, 1), 1: (0, 1)}, (0, "g"): {0: (3, 3), 1: (2, 2)}}, 0.9, 2.0)
    assert alone["forms"][(0, "f")] < 0.5 < 0.9 < alone["forms"][(0, "g")] and alone["precision"][(1, 1)] >= 0.7


def distance(a, b):
    """Restricted edit distance with swaps of neighbours, by dynamic programming."""
    d = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    d[:, 0], d[0, :] = range(len(a) + 1), range(len(b) + 1)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[-1, -1]


def test_automaton_matches_edit_distance():
    rng = random.Random(7)
    terms = [("abcde", False), ("abdce", False), ("bad", False), ("cabba", False)]
    auto = toxicity.LexiconAutomaton(terms)
    for _ in range(4000):
        w = "".join(rng.choices("abcde", k=rng.randrange(1, 8)))
        want = min(distance(w, t) if len(t) >= 5 else (0 if w == t else 9) for t, _ in terms)
        got = auto.match(w)
        assert (got[1] if got else 9) == (want if want <= 1 else 9), w


def test_quotation_lowers_the_score():
    model = {"terms": [("nitwit", False)], "precision": {(0, 0): 0.9}, "rest": 0.01, "quoted": 0.5}
    col = pa.array(["you nitwit go away now", 'he said "nitwit" and left', "plain words"])
    score, hits, _ = toxicity._score_column(col, toxicity.Scanner(model["terms"]), model, 0.4)
    assert score[0] > score[1] > score[2] and hits.tolist() == [1, 1, 0]


def greedy_tiles(a, b, k):
    """Greedy string tiling by trying every pair of places."""
    ua, ub, out = [False] * len(a), [False] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ua[i + n] and not ub[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < k:
            return out
        n, i, j = best
        ua[i:i + n], ub[j:j + n], out = [True] * n, [True] * n, out + n


def greedy_tile_list(a, b, k):
    """The tiles of ``greedy_tiles``: longest first, ties to the earlier place in a, then in b."""
    ua, ub, out = set(), set(), []
    while True:
        found = []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]
                       and i + n not in ua and j + n not in ub):
                    n += 1
                found.append((-n, i, j))
        n, i, j = min(found)
        if -n < k:
            return out
        ua.update(range(i, i - n))
        ub.update(range(j, j - n))
        out.append((i, j, -n))


def test_tiles_of_repeating_texts_match_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        alphabet = rng.choice([1, 2, 3, 6])
        a, b = ([rng.randrange(alphabet) for _ in range(rng.randrange(4, 40))] for _ in range(2))
        got = tiling.tile(np.array(a, dtype=np.uint64) + 7, np.array(b, dtype=np.uint64) + 7, 3)
        assert got == greedy_tile_list(a, b, 3)


def test_tiling_of_one_repeated_word_costs_its_length(spark):
    """200,000 times one word, or one phrase, against items of the same: neither crashes nor lists all pairs."""
    import tracemalloc
    items = [(1, "for " * 300), (2, "to be or not " * 80)]
    index = tiling.SeedIndex(items, 5)
    for i, text in ((0, "for " * 200_000), (1, "to be or not " * 50_000)):
        w = next(iter(textkernel.word_blocks(pa.array([text]))))[2]
        tracemalloc.start()
        found = list(index.tilings(w, 0.5))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert [(d, it, c) for d, it, c, _ in found] == [(0, i, 1.0)] and peak < 100e6
    df = spark.createDataFrame([(1, "for " * 40_000), (2, "for " * 3), (3, "for you " * 500)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(tiling.contaminated(df, bench), "doc_id", "item_id") == [(1, 1)]
    assert rows(tiling.drop_contaminated(df, bench, block_words=300), "doc_id") == [(2,), (3,)]


def test_tiling_matches_brute_force(spark):
    rng = random.Random(11)
    items = [(i, words(rng, 24, 40)) for i in range(6)] + [(6, words(rng, 3)), (7, [])]
    docs = []
    for d in range(40):
        w = words(rng, 30, 40)
        if d % 2:
            it = list(items[d % 6][1])
            cut = rng.randrange(6, 18)
            it = it[cut:] + it[:cut] if d % 3 else it      # reordered passage
            w[10:10] = it
        docs.append((d, w))
    df = spark.createDataFrame([(d, " ".join(w), "en", "s", 0) for d, w in docs], DOCS)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(None, None)], "item_id long, text string")
    for block in (30, 10 ** 6):
        got = {(r.doc_id, r.item_id): r.coverage for r in
               tiling.contaminated(clashing(df), bench, min_match=4, threshold=0.5, block_words=block).collect()}
        want = {}
        for d, w in docs:
            for i, it in items:
                if len(it) >= 4 and (c := greedy_tiles(w, it, 4) / len(it)) >= 0.5:
                    want[(d, i)] = pytest.approx(c)
        assert got == want and len(want) >= 20
    kept = tiling.drop_contaminated(clashing(df), bench, min_match=4, threshold=0.5)
    assert {r[0] for r in rows(kept, "doc_id")} == {d for d, _ in docs} - {d for d, _ in want}
    edge = clashing(edge_docs(spark))
    assert tiling.contaminated(edge, bench).count() == 0 and tiling.drop_contaminated(edge, bench).count() == 9
    assert tiling.drop_contaminated(edge, spark.createDataFrame([], "item_id long, text string")).count() == 9


def template_keys(line, depth=2, fields=4, least=3):
    t = ["*" if re.search("[0-9]", w) else w.lower() for w in line.split()]
    if len(t) < least:
        return []
    if t.count("*") > 2 * (len(t) - t.count("*")):      # a row of numbers stands for itself
        t = line.lower().split()
    out = [(len(t), tuple(t), None)]
    if len(t) >= max(least, depth + fields):
        for f in range(fields):
            rest = tuple(None if i >= depth and (i - depth) * fields // (len(t) - depth) == f else w
                         for i, w in enumerate(t))
            if set(rest) - {None, "*"}:
                out.append((len(t), rest, f))
    return out


def test_line_templates_match_brute_force(spark):
    rng = random.Random(2)
    docs = []
    for i in range(60):
        lines = [" ".join(words(rng, rng.randrange(1, 12), 3000)) for _ in range(4)]
        if i % 3 == 0:
            lines.insert(1, f"Visited page {rng.randrange(999)} of the site by user u{rng.randrange(99)} today ok")
        if i % 4 == 0:
            lines.append(f"all rights go to {rng.choice(['ann', 'bob', 'cy', 'di', 'ed'])} for ever")
        docs.append((i, "\n".join(lines) + ("\n" if i % 5 == 0 else "")))
    docs += [(100 + i, docs[1][1]) for i in range(9)]        # copies of one text count once
    texts = {}
    for _, t in docs:
        for line in t.split("\n"):
            for key in template_keys(line):
                texts.setdefault(key, set()).add(" ".join(t.split()))
    hot = {k for k, v in texts.items() if len(v) >= 5}
    want = []
    for d, t in docs:
        lines = t[:-1].split("\n") if t.endswith("\n") else t.split("\n")
        keep = [x for x in lines if not hot & set(template_keys(x))]
        want.append((d, t if len(keep) == len(lines) else "\n".join(keep), len(lines), len(lines) - len(keep)))
    df = clashing(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], DOCS))
    for held in (0, 10 ** 6):
        got = linetemplates.drop_recurring_lines(df, held_templates=held)
        assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect())) == sorted(want)
    assert sum(x[3] for x in want) >= 30
    out = linetemplates.drop_recurring_lines(clashing(edge_docs(spark)))
    assert out.count() == 9 and out.where("n_dropped > 0").count() == 0 and out.where("text is null").count() == 2
    assert linetemplates.drop_recurring_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_rows_of_numbers_stay_unless_they_repeat(spark):
    """Unique rows of numbers are data; a repeated one, and a template with fixed
    tokens around its fields, are not."""
    rng = random.Random(7)
    docs, want = [], {}
    for i in range(60):
        row = " ".join(str(rng.randrange(10 ** 9)) for _ in range(4))
        total = f"{rng.randrange(10 ** 6)} {rng.randrange(10 ** 6)} total {rng.randrange(10 ** 6)}"
        lines = [row, total, "7 7 7 7 7 7", f"Page {rng.randrange(999)} of {rng.randrange(999)} here"]
        docs.append((i, "\n".join(lines), "en", "s", 0))
        want[i] = row + "\n" + total
    got = linetemplates.drop_recurring_lines(spark.createDataFrame(docs, DOCS))
    assert {r.doc_id: r.text for r in got.collect()} == want


def test_long_lines_recur_from_two_texts_and_short_ones_from_ten(spark):
    def plain(n):       # words without digits, none twice
        return " ".join("".join("abcdefghij"[int(c)] for c in str(next(count))) for _ in range(n))
    count = iter(range(1000, 10 ** 6))
    lines = {"w60": (plain(60), 2), "w24": (plain(24), 2), "w17": (plain(17), 3), "w9": (plain(9), 4), "w4": (plain(4), 5),
             "w2": ("Le treque.", 10), "w1": ("Les.", 10)}
    docs, want = [], {}
    for name, (line, need) in lines.items():
        for many in (need - 1, need):
            body = line if many == need else line.replace("e", "x").replace("b", "y")
            for _ in range(many):
                own = plain(12)
                want[len(docs)] = own if many == need else own + "\n" + body
                docs.append((len(docs), own + "\n" + body, "en", "s", 0))
    for i in range(30):         # a line of variable fields only; the copy of a long text
        docs.append((len(docs), f"{i}\n{plain(12)}", "en", "s", 0))
        want[docs[-1][0]] = docs[-1][1]
    alone = plain(80)
    for _ in range(3):
        docs.append((len(docs), alone, "en", "s", 0))
        want[docs[-1][0]] = alone
    df = spark.createDataFrame(docs, DOCS)
    for held in (0, 10 ** 6):
        got = linetemplates.drop_recurring_lines(df, held_templates=held)
        assert {r.doc_id: r.text for r in got.collect()} == want


def test_token_files_round_trip(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    extra = [(7, "It's Foo's <|endoftext|>bar İstanbul ΑΣ 1,234.5 x<y don't", "en", "s", 0), (8, "a b　c ﬁ Ωß ÿŸ ×÷ é", "x", "s", 0)]
    df = clashing(edge_docs(spark).unionByName(spark.createDataFrame(extra, DOCS)))
    folder = tokenfile.token_folder(spark)
    parts = tokenfile.write_tokens(df, folder, path, length=64, part_bytes=50_000)
    got = [tuple(r) for r in tokenfile.read_documents(spark, folder, parts).orderBy("start").collect()]
    docs = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()),
                  key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    start, want, stream = 0, [], []
    for d, t in docs:
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
        stream += ids
    assert got == want
    out = []
    for r in parts.orderBy("part").collect():
        for i in range(r.n_sequences):
            ids, mask = tokenfile.read_sequence(folder, r.part, i)
            assert len(ids) == len(mask) == 64
            out += ids[mask].tolist()
    assert out == stream
    none = spark.createDataFrame([], DOCS)
    folder = tokenfile.token_folder(spark)
    assert tokenfile.read_documents(spark, folder, tokenfile.write_tokens(none, folder, path)).count() == 0


def test_licences_and_inheritance(spark):
    mit = licence_texts.NOTICES["MIT"] + "."
    body = "some words of prose that say nothing at all about terms " * 5
    docs = [("a/LICENSE", mit), ("a/b/x.txt", body), ("a/b/c/y.txt", body + "\n" + licence_texts.NOTICES["Apache-2.0"]),
            ("a/b/d/LICENSE", "All rights reserved."), ("a/b/d/z.txt", body), ("q/w.txt", body), (None, body),
            (None, mit), ("a/null.txt", None), ("a/empty.txt", ""), ("a/b/x.txt", body)]
    df = clashing(spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(docs)], "doc_id long, path string, text string"))
    got = licences.scan_licences(df)
    r = {x.doc_id: (x.licence, x.origin) for x in got.collect()}
    assert r == {0: ("MIT", "own"), 1: ("MIT", "inherited"), 2: ("Apache-2.0", "own"), 3: ("All-Rights-Reserved", "own"),
                 4: ("All-Rights-Reserved", "inherited"), 5: (None, "none"), 6: (None, "none"), 7: ("MIT", "own"),
                 8: ("MIT", "inherited"), 9: ("MIT", "inherited"), 10: ("MIT", "inherited")}
    assert "Python" not in got._jdf.queryExecution().toString()
    assert licences.scan_licences(df.limit(0)).count() == 0


def test_real_licence_texts(spark):
    """Whole licences, headers between other lines, identifiers and openings are found in a
    tree; prose about the same things is not."""
    rng = random.Random(8)
    prose = [" ".join(words(rng, 12)) for _ in range(400)]
    texts = {}
    for name, text in licence_texts.TEXTS:
        texts.setdefault(name, []).append(text)
    commented = "\n".join(" * " + line for line in texts["GPL-3.0"][0].split("\n"))
    page = "\n".join(prose[:300])
    tree = [
        ("p/LICENSE", "MIT License\n\nCopyright (c) 2019 A. Author\n\n" + texts["MIT"][0], "MIT", "own"),
        ("p/src/a.txt", prose[0], "MIT", "inherited"),
        ("p/src/b.c", "/*\n" + commented + "\n */\n" + page, "GPL-3.0", "own"),
        ("p/src/c.py", "# SPDX-License-Identifier: GPL-2.0-or-later\n" + page, "GPL-2.0", "own"),
        ("p/src/d.py", "# SPDX-License-Identifier: Strange-1.0\n" + page, "MIT", "inherited"),
        ("p/lib/COPYING", texts["LGPL-3.0"][1].replace("GNU Lesser", "GNU LESSER") + "\n\n" + page, "LGPL-3.0", "own"),
        ("p/lib/deep/e.txt", prose[1], "LGPL-3.0", "inherited"),
        ("q/apache.java", "// " + texts["Apache-2.0"][0].replace("\n", "\n// ") + "\n" + page, "Apache-2.0", "own"),
        ("q/two.txt", texts["BSD-2-Clause"][0], "BSD-2-Clause", "own"),
        ("r/three.txt", page + "\n" + texts["BSD-3-Clause"][0] + "\n" + page, "BSD-3-Clause", "own"),
        ("r/mpl.js", "/* " + texts["MPL-2.0"][0] + " */\n" + page, "MPL-2.0", "own"),
        ("r/near.txt", "The software was provided without much warning, and the rights of its users were limited.\n" + page, None, "none"),
        ("r/near2.txt", "We asked who holds the copyright and whether a licence had been granted to any person.\n" + page, None, "none"),
        ("r/long.txt", " ".join(prose) * 20, None, "none"),
        ("s/other.txt", prose[2], None, "none"),
    ]
    # other documents make ordinary words ordinary
    plain = [(f"z/{i}.txt", "the software and the rights of any person in this file\n" + prose[i], None, "none") for i in range(60)]
    rows_ = [(i, p, t) for i, (p, t, _, _) in enumerate(tree + plain)]
    got = {r.path: (r.licence, r.origin) for r in
           licences.scan_licences(spark.createDataFrame(rows_, "doc_id long, path string, text string")).collect()}
    # q/two.txt is a licence text as a whole, so its directory has a licence, but its neighbour has its own
    assert got == {p: (lic, origin) for p, _, lic, origin in tree + plain}


def test_licence_ties_go_to_the_first_name(spark):
    same = [("zeta", "Use it as you like it"), ("alpha", "Use it as you like it")]
    df = spark.createDataFrame([(1, "a", "Use it as you like it."), (None, "b", "other words")], "doc_id long, path string, text string")
    got = rows(licences.scan_licences(df, templates=same), "doc_id", "licence", "origin")
    assert set(got) == {(1, "alpha", "own"), (None, "alpha", "inherited")}

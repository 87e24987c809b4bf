import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import DOCS, clashing, edge_docs, rows, words

from sextant.llm import simhash as S


def fingerprint(text, k=3):
    ws = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").split()]
    grams = [b" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or ([b" ".join(ws)] if ws else [])
    votes = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def plain(docs, max_bits=3):
    """(doc_id, fingerprint, component_id) by comparing every pair."""
    fp = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))
    for i, j in combinations(range(len(docs)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= max_bits and root[i] != root[j]:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    low = {r: min((d for (d, _), q in zip(docs, root) if q == r and d is not None), default=None) for r in set(root)}
    return sorted(((d, f"{f:016x}", low[r]) for (d, _), f, r in zip(docs, fp, root)), key=str)


def got(df, **options):
    return sorted(rows(S.simhash_components(df, **options), "doc_id", "fingerprint", "component_id"), key=str)


def near_copies(rng, n):
    base = words(rng, 250)
    out = [base]
    for _ in range(n):                       # each a copy of any earlier one: chains of links
        ws = list(rng.choice(out))
        ws[rng.randrange(len(ws))] = f"new{rng.randrange(50)}"
        out.append(ws)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("cell_rows", [20_000, 3])
def test_against_every_pair(spark, cell_rows):
    rng = random.Random(4)
    texts = near_copies(rng, 120) + near_copies(rng, 5) + [" ".join(words(rng, 60)) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(500 + i, texts[0]) for i in range(40)]
    rng.shuffle(docs)
    df = clashing(spark.createDataFrame([(d, t, "en", "a", 1) for d, t in docs], DOCS))
    want = plain(docs)
    assert len({w[2] for w in want}) < len({w[1] for w in want})
    assert got(df, cell_rows=cell_rows) == want


def test_edges(spark):
    df = edge_docs(spark)
    assert got(df) == plain([(r.doc_id, r.text) for r in df.collect()])
    bridge = near_copies(random.Random(1), 12)
    ids = [3, None, 2, None] + list(range(20, 20 + len(bridge) - 4))
    docs = list(zip(ids, bridge))
    assert got(spark.createDataFrame([(d, t, None, None, None) for d, t in docs], DOCS)) == plain(docs)
    assert S.simhash_components(spark.createDataFrame([], DOCS)).count() == 0


def test_long_text_is_counted_in_blocks():
    rng = random.Random(2)
    long = " ".join(words(rng, S._BLOCK * 2 + 77, 900))
    one = S.fingerprint_column(pa.array(["a  B\tc d", long, None, "a b c D"]), 3)
    assert one.tolist() == [fingerprint("a b c d"), fingerprint(long), 0, one[0]]


@pytest.mark.parametrize("max_bits", range(6))
def test_anchors_cover_every_close_pair(max_bits):
    """If two points differ in at most max_bits // 2 bits of a half, one of them is sent to
    the other's home anchor, at its own distance from it."""
    reach = 1 + max_bits // 2
    moves = S.anchor_moves(reach)
    assert all(len(set(m)) == len(m) and m[0].bit_count() <= 1 for m in moves)
    rng = np.random.default_rng(0)

    def syndrome(x):
        return sum(((x & m).bit_count() & 1) << b for b, m in enumerate(S._CHECKS))
    for x in rng.integers(0, 1 << S.BITS, 40).tolist():
        home = x ^ moves[syndrome(x)][0]
        assert syndrome(home) == 0
        for flips in combinations(range(S.BITS), max_bits // 2):
            y = x
            for f in flips:
                y ^= 1 << f
            assert home in {y ^ m for m in moves[syndrome(y)]}


def test_forest_joins_what_pairs_join():
    rng = np.random.default_rng(5)
    fp = (rng.integers(0, 1 << 5, 300) | rng.integers(0, 2, 300) << 40).astype(np.uint64)
    first, homes = np.array([0, 90, 100, 250]), np.array([90, 3, 0, 50])
    a, b = S._forest(fp, first, homes, 1, pairs=200)
    got_links = set(zip(a.tolist(), b.tolist()))
    for s, e, h in zip(first, [90, 100, 250, 300], homes):
        root = {int(x): int(x) for x in fp[s:e]}

        def top(v, root=root):
            while root[v] != v:
                v = root[v]
            return v
        for i in range(s, s + h):
            for j in range(s, e):
                if int(fp[i] ^ fp[j]).bit_count() <= 1:
                    x, y = top(int(fp[i])), top(int(fp[j]))
                    root[max(x, y)] = min(x, y)
        mine = {int(x): int(x) for x in fp[s:e]}
        for x, y in got_links:
            if x in mine and y in mine and top(x) == top(y):
                i, j = top(x, mine), top(y, mine)
                mine[max(i, j)] = min(i, j)
        assert {(x, y) for x in root for y in root if top(x) == top(y)} <= {
            (x, y) for x in mine for y in mine if top(x, mine) == top(y, mine)}

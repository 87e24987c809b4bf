"""The repair agenda against a plain table of all states, row by row."""

import hashlib
import random
import re
import zlib

from cases import clashing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sextant.llm import convrepair as C

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
FULL = {"u": "user", "a": "assistant"}
STEP = {"0": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = {1: "", 2: "".join(ch for ch in x if ch not in ".!?")}.get(code, x)
        out += [] if code == 0 else [(c, t, "user" if code == 4 else r, x)] * (2 if code == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines): best of every state after every row; rows are (role, text, fault)."""
    def close(v):
        for _ in range(4):
            for q, (c, a, lines) in list(v.items()):
                for z in set(STEP[q]) & set(FULL):
                    new = (c + 2, a + "I", (*lines, FULL[z] + ":"))
                    v[STEP[q][z]] = min(v.get(STEP[q][z], new), new)
        return v

    v = close({"0": (0, "", ())})
    for role, text, fault in rows:
        w = {}
        for q, (c, a, lines) in v.items():
            found = [(q, (c + 3, a + "D", lines))]
            if fault not in ("blank", "duplicate"):
                e = int(fault == "truncated")
                if role[:1] in STEP[q]:
                    found.append((STEP[q][role[:1]], (c + e, a + "K", (*lines, f"{role}:{text}"))))
                for z in set(STEP[q]) & set(FULL):
                    found.append((STEP[q][z], (c + 2 + e, a + "R", (*lines, f"{FULL[z]}:{text}"))))
            for state, value in found:
                w[state] = min(w.get(state, value), value)
        v = close(w)
    return min(v[q] for q in ("0", "A") if q in v)


def plain(rows):
    rows = sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3].encode()))
    seen, marked, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not solid else "duplicate" if (role, text) in seen else
                 "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marked.append((role, text, fault))
    turns = {t for _, t, _, _ in rows if t is not None}
    initials = [r[:1] for r, _, _ in marked]
    cost, audit, lines = cheapest(marked)
    return dict(gaps=max(turns) - min(turns) + 1 - len(turns) if turns else 0, **counts,
                illegal=sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                cost=cost, audit=audit, repaired_sha256=hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    zero = dict(gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="", repaired_sha256=EMPTY)
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    return {c: plain(g) if g else zero for c, g in by.items()}


def result(df):
    rows = [r.asDict() for r in df.collect()]
    out = {r.pop("conv_id"): r for r in rows}
    assert len(out) == len(rows)
    return out


def conversation(rng, c, n, turns=None):
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None]
    texts = ["Yes.", "No!", "and then", "Why?", "", " \n", None, "Same.", "Ünï. ", "x.\t"]
    return [(c, rng.choice(turns) if turns else i, rng.choice(roles), rng.choice(texts)) for i in range(n)]


def test_random_conversations(spark):
    rng = random.Random(1)
    rows = [r for c in range(150) for r in conversation(rng, c, rng.randrange(1, 14))]
    rows += [r for c in range(200, 240) for r in conversation(rng, c, 9, [None, 0, 1, 2, 7, -3])]
    df = clashing(spark.createDataFrame(rows, SCHEMA)).withColumn("times", F.lit("extra")).withColumn("cost", F.lit(0))
    assert result(C.repair_damaged(df)) == expected(rows)


def test_nulls_and_empty_tables(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, None, "assistant", "A b c."),
            (1, None, "assistant", "A b c."), (2, 5, "user", None), (3, 2**62, "user", "Long. " * 30_000)]
    assert result(C.repair_damaged(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    only = [(9, gone, "user", "Hi.")]
    assert result(C.repair_damaged(spark.createDataFrame(only, SCHEMA)))[9] == expected(only)[9]
    assert C.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_hot_conversation_is_cut_into_pieces(spark):
    """One conversation of a third of all rows over many tasks, cut inside tasks too,
    within turns and among equal rows."""
    rng = random.Random(3)
    rows = conversation(rng, 7, 500) + conversation(rng, 8, 160, [3, None]) + [
        r for c in range(20, 100) for r in conversation(rng, c, 6)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows)
    for rows_, chars in ((16, 1 << 22), (4096, 40), (1, 1)):
        assert result(C.repair(C.damage(df), df, piece_rows=rows_, piece_chars=chars)) == want


ROW = st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans())


@settings(max_examples=200, deadline=None)
@given(st.lists(ROW, max_size=7))
def test_agenda_against_plain_table(rows):
    marked = [(r, f"{i}.", "blank" if must else "truncated" if cut else None) for i, (r, must, cut) in enumerate(rows)]
    cost, audit, lines = cheapest(marked)
    items = [(r, must, int(cut and not must)) for r, must, cut in rows]
    assert min(C.lightest(items, "0", "0A").values()) == (cost, audit)
    assert C.goal(C.spans(items)) == (cost, audit)
    for cut_at in range(len(items) + 1):
        assert C.goal(C.join_spans(C.spans(items[:cut_at]), C.spans(items[cut_at:]))) == (cost, audit)
    done = C.Repaired(audit)
    for role, text, _ in marked:
        done.row(role, text)
    assert done.digest() == hashlib.sha256("\n".join(lines).encode()).hexdigest()

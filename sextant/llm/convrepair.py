"""Conversation repair by Knuth's lightest-derivation agenda.

*Deduction.* An item [i, q] says that the first i rows of a conversation can be edited
so that their role initials bring the grammar ``(s?(ua)+)?`` to state q: 0 nothing yet,
S after the system row, U after a user, A after an assistant (0 and A accept). Rules,
with the initial that goes to ``audit`` and the cost that is added:

    [i, q]            ->  [i, q.r]       Insert an empty row of role r   I  2
    [i, q] + row i    ->  [i+1, q.role]  Keep                            K  0  (+1 truncated)
    [i, q] + row i    ->  [i+1, q.r]     Rerole to r                     R  2  (+1 truncated)
    [i, q] + row i    ->  [i+1, q]       Delete                          D  3
    [i, j, p, q] + [j, k, q, r] -> [i, k, p, r]                          spans in a row

A blank or duplicate row can only be deleted. Items leave a priority queue by (cost,
audit); the rules are superior functions: a conclusion is never below a premise (costs
do not fall, an audit grows at its end) and keeps the order of two values of a premise
(of two audits of one item at equal cost neither is a prefix of the other, as they
use the same rows and more inserts cost more). So the first value that leaves for an
item is its lightest, and the goal's first value is the answer.

*At scale.* Rows are range-partitioned by conversation and turn, so a conversation of a
third of the table is spread over tasks. A task reads its rows as a stream; a
conversation that lies wholly inside is solved at once. One that may reach into another
task, or is long, becomes pieces: the lightest span [i, j, p, q] for each p and q, no
text. Pieces are combined in order. Only the hash of such a conversation, which is
sequential by nature, reads its rows again as one stream, row by row.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, small, staged

SPACE = " \t\n\r\x0b\x0c"
NEXT = {"0": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
FULL = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
BLOCK = 64


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(conv_id, turn, role, text, times) after a repeatable damage by crc32 of
    ``conv_id:turn`` (a NULL counts as one space, in the texts too) modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes
    it the user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"),
                   F.coalesce(F.col(turn_col).cast("string"), space))
    code, text = F.crc32(key) % 20, F.coalesce(F.col("text").cast("string"), space)
    return (df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                      F.coalesce(F.col("role").cast("string"), space).alias("role"), text.alias("text"), code.alias("code"))
            .where("code <> 0")
            .select("conv_id", "turn", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("code") == 1, F.lit(""))
                    .when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("code") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("times")))


def lightest(rows: list, start: str, goals: str, all_goals: bool = False) -> dict:
    """{state: (cost, audit)} of the lightest derivations of [0, len(rows), start, state]
    for the states ``goals``: the first one to finalise, or every one.
    A row is (role initial, must be deleted, truncated)."""
    final, found, m = set(), {}, len(rows)
    agenda = [(0, "", 0, start)]
    while agenda:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == m and q in goals:
            found[q] = (cost, audit)
            if not all_goals or len(found) == len(goals):
                return found
        step = NEXT[q]
        for r in "ua":
            if r in step:
                heapq.heappush(agenda, (cost + 2, audit + "I", i, step[r]))
        if i < m:
            initial, must, cut = rows[i]
            heapq.heappush(agenda, (cost + 3, audit + "D", i + 1, q))
            if not must:
                if initial in step:
                    heapq.heappush(agenda, (cost + cut, audit + "K", i + 1, step[initial]))
                for r in "ua":
                    if r in step:
                        heapq.heappush(agenda, (cost + 2 + cut, audit + "R", i + 1, step[r]))
    return found


def join_spans(left: dict, right: dict) -> dict:
    """{(p, r): value} from {(p, q): value} and {(q, r): value}."""
    out: dict = {}
    for (p, q), (c1, a1) in left.items():
        for r in "0SUA":
            if (q, r) in right:
                c2, a2 = right[q, r]
                value = (c1 + c2, a1 + a2)
                if (p, r) not in out or value < out[p, r]:
                    out[p, r] = value
    return out


def spans(rows: list, starts: str = "0SUA") -> dict:
    """{(p, q): (cost, audit)} over all rows, block by block."""
    out = {(p, p): (0, "") for p in starts}
    for at in range(0, len(rows), BLOCK):
        block = rows[at:at + BLOCK]
        states = sorted({q for _, q in out})
        out = join_spans(out, {(p, q): v for p in states for q, v in lightest(block, p, "0SUA", True).items()})
    return out


def goal(values: dict) -> tuple:
    return min(values[k] for k in (("0", "0"), ("0", "A")) if k in values)


class Repaired:
    """SHA-256 of the repaired lines, fed row by row along an audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.any = audit, 0, "0", hashlib.sha256(), False

    def _line(self, role, text):
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def _forced(self):
        r = "u" if "u" in NEXT[self.state] else "a"
        self.state = NEXT[self.state][r]
        return FULL[r]

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(self._forced(), "")
            self.at += 1

    def row(self, role: str, text: str):
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = NEXT[self.state][role[:1]]
            self._line(role, text)
        elif edit == "R":
            self._line(self._forced(), text)

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


STATS = ["blank", "duplicate", "truncated", "illegal", "turns"]


class _Piece:
    """Consecutive rows of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.lines, self.chars = conv, [], [], 0
        self.stats = dict.fromkeys(STATS, 0)
        self.low = self.high = None
        self.first = self.last = None

    def add(self, turn, role, text, again):
        body, st = text.strip(SPACE), self.stats
        initial = role[:1]
        cut = bool(body) and not again and body[-1] not in ".!?"
        st["blank"] += not body
        st["duplicate"] += bool(body) and again
        st["truncated"] += cut
        if self.rows:
            st["illegal"] += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        if turn is not None and turn != self.high:
            st["turns"] += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        self.rows.append((initial, again or not body, int(cut)))
        self.lines.append((role, text))
        self.chars += len(text)


def _gaps(low, high, turns):
    return 0 if low is None else high - low + 1 - turns


OUT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
       "repaired_sha256 string")
PIECES = ("whole boolean, task int, piece long, turns long, low long, high long, first string, last string, "
          "spans array<string>, " + OUT)


def _names(schema: str) -> list[str]:
    return [c.strip().split()[0] for c in schema.split(",")]


def _arrow(rows: list, names: list, schema: pa.Schema):
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], schema.field(c).type) for c in names], names=names)


def _whole(p: _Piece) -> dict:
    cost, audit = min(lightest(p.rows, "0", "0A").values())
    done = Repaired(audit)
    for role, text in p.lines:
        done.row(role, text)
    return {"conv_id": p.conv, "whole": True, **p.stats, "gaps": _gaps(p.low, p.high, p.stats["turns"]),
            "cost": cost, "audit": audit, "repaired_sha256": done.digest()}


def _part(p: _Piece, task: int, number: int) -> dict:
    found = [f"{a}{b}{cost}:{audit}" for (a, b), (cost, audit) in spans(p.rows).items()]
    return {"conv_id": p.conv, "whole": False, "task": task, "piece": number, **p.stats, "low": p.low, "high": p.high,
            "first": p.first, "last": p.last, "spans": found}


def _runs(batches: Iterable[pa.RecordBatch], task: int, piece_rows: int, piece_chars: int):
    """Solved conversations and pieces from rows in order (conv_id, turn, role, text,
    times, later). The task's first and last conversation may reach into a neighbour."""
    now, prev, opening, number = None, None, True, 0
    for batch in batches:
        for conv, turn, role, text, times, later in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    yield _whole(now) if not opening and number == 0 else _part(now, task, number)
                    opening = False
                now, prev, number = _Piece(conv), None, 0
            elif now.chars >= piece_chars:
                yield _part(now, task, number)
                now, number = _Piece(conv), number + 1
            for _ in range(times):
                if len(now.rows) >= piece_rows:
                    yield _part(now, task, number)
                    now, number = _Piece(conv), number + 1
                now.add(turn, role, text, later or prev == (turn, role, text))
                prev = (turn, role, text)
    if now is not None:
        yield _part(now, task, number)


def _batched(rows, names, schema, size=2000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield _arrow(held, names, schema)
            held = []
    if held:
        yield _arrow(held, names, schema)


def _combined(batches: Iterable[pa.RecordBatch]):
    """One row per conversation from its pieces in order."""
    def finish(t):
        cost, audit = goal(t["spans"])
        return {**t, "gaps": _gaps(t["low"], t["high"], t["turns"]), "cost": cost, "audit": audit}

    total = None
    for batch in batches:
        for r in batch.to_pylist():
            here = {}
            for s in r["spans"]:
                cost, audit = s[2:].split(":")
                here[s[0], s[1]] = (int(cost), audit)
            if total is None or total["conv_id"] != r["conv_id"]:
                if total is not None:
                    yield finish(total)
                total = {**r, "spans": {k: v for k, v in here.items() if k[0] == "0"}}
                continue
            for c in STATS:
                total[c] += r[c]
            total["illegal"] += total["last"] + r["first"] not in LEGAL
            if r["low"] is not None:
                total["turns"] -= r["low"] == total["high"]
                total["low"], total["high"] = (r["low"] if total["low"] is None else total["low"]), r["high"]
            total["last"], total["spans"] = r["last"], join_spans(total["spans"], here)
    if total is not None:
        yield finish(total)


def _hashed(batches: Iterable[pa.RecordBatch]):
    """(conv_id, repaired_sha256) from streams of an audit followed by its rows."""
    conv, done = None, None
    for batch in batches:
        for c, head, role, text, times in zip(*(x.to_pylist() for x in batch.columns)):
            if head == 0:
                if done is not None:
                    yield {"conv_id": conv, "repaired_sha256": done.digest()}
                conv, done = c, Repaired(text)
            else:
                for _ in range(times):
                    done.row(role, text)
    if done is not None:
        yield {"conv_id": conv, "repaired_sha256": done.digest()}


def _collapse(rows: DataFrame) -> DataFrame:
    """Equal rows of a batch become one with the sum of ``times``, before they travel."""
    names = ["conv_id", "turn", "role", "text", "times"]

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by(names[:4], use_threads=False).aggregate([("times", "sum")])
            yield from t.rename_columns(names).to_batches()
    return rows.select(*names).mapInArrow(run, rows.select(*names).schema)


def repair(rows: DataFrame, originals: DataFrame, piece_rows: int = 4096, piece_chars: int = 1 << 22) -> DataFrame:
    """The cheapest repair of every conversation of ``rows`` (conv_id, turn long, role,
    text, times: how often the row stands there); one row per ``conv_id`` of
    ``originals`` (conversations without rows too): (conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256).

    Rows are taken by turn (NULL first), rows of one turn by role, then text. A NULL
    ``conv_id`` is a conversation of its own. Role and text must not be NULL
    (``damage`` writes one space). A role whose first character is not s, u or a can be
    reroled or deleted. Repeated rows are duplicates. Without rows: zeros, empty audit,
    hash of the empty string. An empty table gives an empty result. Other columns are
    ignored, whatever their names. A task holds at most ``piece_rows`` rows or
    ``piece_chars`` characters (one row at least) of a conversation; results do not
    depend on either."""
    ship(rows.sparkSession)
    rows = _collapse(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    mark = F.unhex(F.md5("text"))
    # role and text at several turns: all but the first turn are duplicates
    seen = (rows.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).groupBy("conv_id", "role", mark.alias("mark"))
            .agg(F.min(F.struct("turn")).alias("a"), F.max(F.struct("turn")).alias("b")).where("a <> b")
            .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("mark").alias("_m"), F.col("a.turn").alias("_t")))
    seen = small(staged(seen))
    match = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (mark == F.col("_m"))
    later = F.coalesce(F.col("_r").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_t")), F.lit(False))
    ordered = (rows.join(seen, match, "left").select("conv_id", "turn", "role", "text", "times", later.alias("later"))
               .repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
               .sortWithinPartitions("conv_id", "turn", "role", "text"))
    out_schema = f"conv_id {kind}, {PIECES}"
    names = _names(out_schema)

    def solve(batches):
        from pyspark import TaskContext
        yield from _batched(_runs(batches, TaskContext.get().partitionId(), piece_rows, piece_chars), names, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], out_schema).schema)
    solved = staged(ordered.mapInArrow(solve, out_schema))

    merged_schema = f"conv_id {kind}, {OUT}"
    merged_names = _names(merged_schema)

    def combine(batches):
        yield from _batched(_combined(batches), merged_names, arrow, 200)

    merged = staged(solved.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "task", "piece")
                    .mapInArrow(combine, merged_schema))

    hash_schema = f"conv_id {kind}, repaired_sha256 string"

    def digest(batches):
        yield from _batched(_hashed(batches), ["conv_id", "repaired_sha256"], arrow, 200)

    split = small(merged.select(F.col("conv_id").alias("_c")))
    texts = rows.join(split, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi").withColumn("head", F.lit(1))
    heads = merged.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), F.lit(1).cast("long").alias("times"), F.lit(0).alias("head"))
    hashes = (heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "head", "turn", "role", "text")
              .select("conv_id", "head", "role", "text", "times").mapInArrow(digest, hash_schema))
    merged = (merged.drop("repaired_sha256").join(
        hashes.select(F.col("conv_id").alias("_c"), "repaired_sha256"), F.col("conv_id").eqNullSafe(F.col("_c")))
        .select(*merged_names))
    done = solved.where("whole").select(*merged_names).unionByName(merged)
    ids = originals.select(F.col("conv_id").alias("_o")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in merged_names[1:7]]
    return (ids.join(done, F.col("_o").eqNullSafe(F.col("conv_id")), "left")
            .select(F.col("_o").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the ``damage`` done to ``conversations`` (conv_id, turn, role, text)."""
    return repair(damage(conversations), conversations)

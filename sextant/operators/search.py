"""Parameter search by successive halving over boosted trees.

Trials are rows: their parameters are hash draws, on a linear or a logarithmic scale. In
a rung every trial is scored on every fold, all in one Spark job with a row per (trial,
fold); the best share of the trials goes on to the next rung with a larger part of its
rounds, the last rung has all of them. A fit is a histogram booster inside a task over
all rows: their bins, a byte a feature, are written once. A task reads them in batches
and holds at most ``MEMORY_ROWS`` of them; above that it reads them again in each pass
and keeps its state, a few bytes a row, in files."""

from __future__ import annotations

import heapq
import math
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..session import cut_lineage, ship
from .crossfit import Booster, bounded
from .extra_trees import BATCH_ROWS, Rows
from .folds import exact_stratified_folds
from .stats import percentile_table

BINS = 32
MEMORY_ROWS = 4_000_000     # rows that a task holds at once, some 20 bytes each


@dataclass(frozen=True)
class Range:
    """Values from ``low`` to ``high``; whole numbers, both ends included, if they are ints."""
    low: float
    high: float
    log: bool = False

    def draw(self, u):
        if isinstance(self.low, int):
            return F.least(F.floor(F.lit(self.low) + u * (self.high - self.low + 1)), F.lit(self.high)).cast("double")
        if self.log:
            return F.lit(self.low) * F.pow(F.lit(self.high / self.low), u)
        return F.lit(self.low) + u * (self.high - self.low)


#: Fixed values of the source configuration: the ranges of its search.
RANGES = {
    "n_estimators": Range(300, 800),
    "learning_rate": Range(0.01, 0.1, log=True),
    "num_leaves": Range(20, 100),
    "subsample": Range(0.6, 1.0),
    "colsample": Range(0.5, 1.0),
    "min_child": Range(10, 60),
    "reg_alpha": Range(1e-4, 5.0, log=True),
    "reg_lambda": Range(1e-4, 5.0, log=True),
}


def draw_trials(spark: SparkSession, n_trials: int, ranges: dict[str, Range], seed: int) -> DataFrame:
    """(trial, one column per parameter)."""
    return spark.range(n_trials).select(F.col("id").cast("int").alias("trial"),
                                        *[r.draw(uniform("id", seed=f"{seed}:{name}")).alias(name) for name, r in ranges.items()])


def _best_cut(sums: np.ndarray, p: dict):
    """(gain, feature, bin) of the best cut, or None, of a node with the sums (3, features,
    bins) of gradients, of their slopes and of rows; rows of a bin up to the cut go left."""
    gl, hl, cl = sums.cumsum(axis=2)
    gt, ht, ct = gl[:, -1:], hl[:, -1:], cl[:, -1:]

    def strength(gs, hs):
        return np.maximum(np.abs(gs) - p["reg_alpha"], 0.0) ** 2 / (hs + p["reg_lambda"])
    gain = strength(gl, hl) + strength(gt - gl, ht - hl) - strength(gt, ht)
    gain[(cl < p["min_child"]) | (ct - cl < p["min_child"])] = -1.0
    at = int(gain.argmax())
    bins = gain.shape[1]
    return (float(gain.flat[at]), at // bins, at % bins) if gain.flat[at] > 1e-12 else None


def best_split(codes: np.ndarray, g: np.ndarray, h: np.ndarray, w: np.ndarray, bins: int, p: dict):
    """``_best_cut`` of some rows. ``codes``: bin of each row and feature."""
    return _best_cut(_node_sums(codes.T, np.zeros(len(codes), np.intp), 1, g, h, w, bins)[0], p)


def _node_sums(codes: np.ndarray, node: np.ndarray, m: int, g: np.ndarray, h: np.ndarray, w: np.ndarray, bins: int) -> np.ndarray:
    """(node, 3, feature, bin): the sums of ``g``, ``h`` and ``w``. ``codes`` holds a feature a row."""
    out = np.empty((m, 3, len(codes), bins))
    for i, c in enumerate(codes):
        flat = node * bins + c
        for j, v in enumerate((g, h, w)):
            out[:, j, i] = np.bincount(flat, v, m * bins).reshape(m, bins)
    return out


class _Tree:
    """A tree grown leaf by leaf, largest gain first, up to ``num_leaves``. Cuts are asked
    for before they are surely needed, those of many nodes in one pass over the rows; a
    node that the order of gains does not reach stays a leaf."""

    def __init__(self, p: dict):
        self.p, self.best, self.totals, self.below = p, [], [], {}

    def add(self, sums: np.ndarray) -> None:
        for node in sums:
            self.best.append(_best_cut(node, self.p))
            self.totals.append(node[:2, 0].sum(axis=1))

    def follow(self):
        """(nodes to split before the order is known, whether a node is cut)."""
        cut, queue, leaves, made = set(), [], 1, 1
        if self.best[0]:
            queue.append((-self.best[0][0], 0, 0))
        while queue and leaves < self.p["num_leaves"]:
            if queue[0][2] not in self.below:
                near = [node for *_, node in heapq.nsmallest(int(self.p["num_leaves"]) - leaves, queue)]
                return [node for node in near if node not in self.below], cut
            node = heapq.heappop(queue)[2]
            cut.add(node)
            leaves += 1
            for child in self.below[node]:
                if self.best[child]:
                    heapq.heappush(queue, (-self.best[child][0], made, child))
                made += 1
        return [], cut

    def split(self, nodes: Sequence[int]):
        """(feature, bin, left child) of each node so far; -1 where rows stay."""
        feature, at, left = (np.full(len(self.best), -1) for _ in range(3))
        for i, node in enumerate(nodes):
            child = len(self.best) + 2 * i
            self.below[node] = (child, child + 1)
            feature[node], at[node], left[node] = self.best[node][1], self.best[node][2], child
        return feature, at, left

    def leaf_of(self, cut: set) -> np.ndarray:
        """The leaf above each node."""
        out = np.arange(len(self.best))
        for node in sorted(self.below):           # a child has a larger number
            for child in self.below[node]:
                if node not in cut or out[node] != node:
                    out[child] = out[node]
        return out


def boost_rows(parts, p: dict, rounds: int, rng, bins: int = BINS, in_files: bool = False) -> Iterator[tuple]:
    """(labels, log-odds) of the held-out rows, by trees on the others. ``parts()`` gives,
    each time, the same batches (codes, a feature a row; labels; whether held out)."""
    sizes, rows, positive, d = [], 0, 0.0, 0
    for codes, y, held in parts():
        sizes.append((len(y), int((~held).sum())))
        rows, positive, d = rows + sizes[-1][1], positive + float(y[~held].sum()), len(codes)
    share = min(max(positive / max(rows, 1), 1e-6), 1 - 1e-6)
    total = sum(n for n, _ in sizes)

    with tempfile.TemporaryDirectory() as room:
        def state(name, kind):
            return np.memmap(f"{room}/{name}", kind, "w+", shape=(max(total, 1),)) if in_files else np.zeros(total, kind)
        score, at, used = state("score", np.float64), state("at", np.int16), state("used", bool)
        score[:] = math.log(share / (1 - share))

        def batches():
            i = 0
            for codes, y, held in parts():
                here = slice(i, i + len(y))
                yield here, codes, y, held
                i = here.stop
        for _ in range(rounds):
            left_rows, left_draws = rows, max(1, round(p["subsample"] * rows)) if rows else 0
            for k, (here, _, y, held) in enumerate(batches()):
                # so many of all rows, without replacement: a batch gets its share by chance
                n = sizes[k][1]
                take = left_draws if n == left_rows else int(rng.hypergeometric(n, left_rows - n, left_draws))
                left_rows, left_draws = left_rows - n, left_draws - take
                mark = np.zeros(len(y), bool)
                mark[np.flatnonzero(~held)[rng.permutation(n)[:take]]] = True
                used[here], at[here] = mark, 0
            feats = np.sort(rng.permutation(d)[:max(1, math.ceil(p["colsample"] * d))])
            tree, moves, new = _Tree(p), None, 1
            while True:
                first, sums = len(tree.best), 0
                for here, codes, y, _ in batches():
                    node = at[here].astype(np.intp)
                    if moves is not None:
                        f, last, left = moves
                        go = np.flatnonzero(left[node] >= 0)
                        on = node[go]
                        node[go] = left[on] + (codes[feats[f[on]], go] > last[on])
                        at[here] = node
                    mine = np.flatnonzero(used[here] & (node >= first))
                    prob = 1 / (1 + np.exp(-score[here][mine]))
                    sums = sums + _node_sums(codes[feats][:, mine], node[mine] - first, new, prob - y[mine], prob * (1 - prob), np.ones(len(mine)), bins)
                tree.add(sums)
                wanted, cut = tree.follow()
                if not wanted:
                    break
                moves, new = tree.split(wanted), 2 * len(wanted)
            leaf, (gs, hs) = tree.leaf_of(cut), np.array(tree.totals).T
            step = p["learning_rate"] * np.copysign(np.maximum(np.abs(gs) - p["reg_alpha"], 0.0), gs) / (hs + p["reg_lambda"])
            for here, *_ in batches() if in_files else [(slice(0, total),)]:
                score[here] -= step[leaf[at[here]]]
        for here, _, y, held in batches():
            yield y[held], np.array(score[here][held])


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def bin_codes(columns, edges) -> np.ndarray:
    return np.array([np.searchsorted(e, c, side="left") for c, e in zip(columns, edges)], np.uint8)


def boost(x: np.ndarray, y: np.ndarray, v: np.ndarray, p: dict, rounds: int, rng, bins: int = BINS) -> np.ndarray:
    """Log-odds of the rows ``v`` by trees grown leaf by leaf, largest gain first, on (x, y)."""
    both = (bin_codes(np.concatenate([x, v]).T, bin_edges(x, bins)), np.r_[y, np.zeros(len(v))], np.arange(len(x) + len(v)) >= len(x))
    return np.concatenate([s for _, s in boost_rows(lambda: [both], p, rounds, rng, bins)])


class BinnedRows:
    """Bins for each fold, labels and folds of a written table, in batches that do not
    depend on its files."""

    def __init__(self, table: DataFrame, d: int):
        self.rows, self.d = Rows(table, []), d

    def parts(self, fold: int) -> Iterator[tuple]:
        names, held, n = [*(f"_c{fold}_{i}" for i in range(self.d)), "_y", "_fold"], [], 0
        for f in self.rows.files:
            for batch in self.rows._open(f).iter_batches(BATCH_ROWS, columns=names):
                held, n = [*held, pa.Table.from_batches([batch])], n + batch.num_rows
                while n >= BATCH_ROWS:
                    whole = pa.concat_tables(held)
                    yield self._part(whole.slice(0, BATCH_ROWS), fold, names)
                    held, n = [whole.slice(BATCH_ROWS)], n - BATCH_ROWS
        if n:
            yield self._part(pa.concat_tables(held), fold, names)

    @staticmethod
    def _part(table: pa.Table, fold: int, names: Sequence[str]) -> tuple:
        *codes, y, of = (table.column(c).to_numpy() for c in names)
        return np.array(codes, np.uint8), y.astype(float), of == fold

    def score(self, fold: int, p: dict, rounds: int, rng) -> float | None:
        """The share of the rows of a fold that a fit on the others gets right."""
        many = self.rows.count() > MEMORY_ROWS
        held = None if many else list(self.parts(fold))
        right, n = 0, 0
        for y, odds in boost_rows((lambda: self.parts(fold)) if many else (lambda: held), p, rounds, rng, in_files=many):
            right, n = right + int(((odds >= 0) == (y == 1)).sum()), n + len(y)
        return right / n if n else None


def binned(rows: DataFrame, d: int, folds: int) -> BinnedRows:
    """``rows`` (_id, _y, _fold, _x0, ...) as bins, those of a fold cut at the quantiles of
    the other folds, in the order of their keys."""
    names = [f"_x{i}" for i in range(d)]
    others = rows.withColumn("_out", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).where("_out <> _fold")
    found = {r["_out"]: r for r in percentile_table(others, "_out", names, [float(q) for q in np.linspace(0, 1, BINS + 1)[1:-1]]).collect()}
    edges = [[np.unique([found[f][f"{c}_q{j}"] for j in range(BINS - 1)]) if f in found else np.zeros(0) for c in names] for f in range(folds)]
    codes = [f"_c{f}_{i}" for f in range(folds) for i in range(d)]

    def code(batches):
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in names]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c.astype(np.int8)) for e in edges for c in bin_codes(columns, e)),
                 *(batch.column(batch.schema.get_field_index(c)) for c in ("_y", "_fold"))], names=[*codes, "_y", "_fold"])
    ordered = rows.orderBy("_id", *names, "_y").select("_y", "_fold", *names)
    return BinnedRows(cut_lineage(ordered.mapInArrow(code, ", ".join([*(f"{c} tinyint" for c in codes), "_y double", "_fold int"]))), d)


def halving_search(train: DataFrame, id_col: str, label: str, features: Sequence[str],
                   ranges: dict[str, Range] | None = None, n_trials: int = 200, folds: int = 3, rungs: int = 4,
                   eta: int = 3, seed: int = 42, max_fit_rows: int | None = None) -> DataFrame:
    """(trial, parameters, rung, rounds, accuracy, spread, best) per trial: the last rung it
    reached, its rounds there, mean and standard deviation of its accuracy over the folds
    (stratified by label) in that rung, and whether it won. Of each rung the best 1 / ``eta``
    goes on (rounded up; ties to the smaller trial).

    All labelled rows are used, or about ``max_fit_rows`` of them by hash, if that is given.
    Rows without a label take no part, NULL and NaN features are 0. Without a labelled row this is an error."""
    spark = ship(train.sparkSession)
    ranges = RANGES if ranges is None else ranges
    names, feats = list(ranges), list(features)
    known = bounded(train.where(F.col(label).isNotNull()), id_col, max_fit_rows, seed).select(
        F.col(id_col).alias("_id"), F.col(label).cast("double").alias("_y"),
        *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(feats)])
    dealt = exact_stratified_folds(known, "_id", "_y", folds, seed, out="_fold").persist()
    if dealt.isEmpty():
        raise ValueError("no labelled row to fit on")
    rows = binned(dealt, len(feats), folds)
    dealt.unpersist()

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                right = rows.score(r["fold"], {c: r[c] for c in names}, r["rounds"], np.random.default_rng([seed, r["trial"], r["fold"]]))
                yield pa.RecordBatch.from_pylist([] if right is None else [{"trial": r["trial"], "right": right}],
                                                 schema=pa.schema([("trial", pa.int32()), ("right", pa.float64())]))

    trials = cut_lineage(draw_trials(spark, n_trials, ranges, seed))
    done, alive, n = [], trials, n_trials
    for rung in range(rungs):
        part = eta ** (rung - rungs + 1)
        rung_trials = alive.withColumn("rounds", F.greatest(F.lit(1), F.round(F.col("n_estimators") * part)).cast("int"))
        fits = rung_trials.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        scored = fits.repartition(min(n * folds, 8 * spark.sparkContext.defaultParallelism)).mapInArrow(run, "trial int, right double")
        means = scored.groupBy("trial").agg(F.avg("right").alias("accuracy"), F.stddev_pop("right").alias("spread"))
        result = cut_lineage(rung_trials.join(means, "trial").withColumn("rung", F.lit(rung)))
        done.append(result)
        n = math.ceil(n / eta) if rung < rungs - 1 else 1
        alive = cut_lineage(result.orderBy(F.round("accuracy", 12).desc(), "trial").limit(n).select("trial", *names))
    every = done[0]
    for result in done[1:]:
        every = every.unionByName(result)
    last = every.groupBy("trial").agg(F.max_by(F.struct("rung", "rounds", "accuracy", "spread"), "rung").alias("r"))
    won = alive.select("trial", F.lit(True).alias("best"))
    return (trials.join(last, "trial").join(won, "trial", "left")
            .select("trial", *names, "r.*", F.coalesce("best", F.lit(False)).alias("best")))


def best_parameters(search: DataFrame) -> dict[str, float]:
    """The parameters of the winning trial."""
    row = search.where("best").drop("trial", "rung", "rounds", "accuracy", "spread", "best").first()
    return row.asDict()


def booster(params: dict[str, float], features: Sequence[str], seed: int, label: str) -> Booster:
    """Spark's gradient-boosted trees with a trial's parameters: a tree of so many leaves
    becomes one of the depth that holds them; Spark has no L1 or L2 term."""
    return Booster(features, seed, label, maxIter=int(params["n_estimators"]), stepSize=params["learning_rate"],
                   maxDepth=math.ceil(math.log2(params["num_leaves"])), subsamplingRate=params["subsample"],
                   featureSubsetStrategy=str(round(params["colsample"], 6)), minInstancesPerNode=int(params["min_child"]))

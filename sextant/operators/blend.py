"""The blend as one fitted object: ``Blend(...).fit(oof)`` gives a ``BlendModel`` that is
saved, loaded and applied like any Spark ML model.

Fitting, on out-of-fold predictions: a logistic stack over the models, the weight of
the stack against the plain mean, the choice between that blend, a logistic blend with
the neural net and fixed mixes with it, the cut, and a gate for fold-wise isotonic
calibration. Applying: the same expressions, hard locks, and the group step. Only a
few numbers and the calibration curves are held; rows never leave Spark."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import evaluate
from .groups import group_consistency
from .isotonic import calibration_curves, mean_value, own_fold_value
from .models import assemble, logistic

# The mixes tried with the neural net, in order.
MIX_WEIGHTS = [0.05, 0.10, 0.15, 0.20, 0.25, 0.30]


def sigmoid(coefficients, inputs) -> Column:
    """Logistic function of intercept + sum of coefficient * input."""
    z = F.lit(float(coefficients[0]))
    for w, c in zip(coefficients[1:], inputs):
        z = z + F.lit(float(w)) * c
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


class _BlendParams(HasInputCols, HasLabelCol, HasSeed):
    netCol = Param(Params._dummy(), "netCol", "probability of the neural net", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "row key", TypeConverters.toString)
    folds = Param(Params._dummy(), "folds", "calibration folds", TypeConverters.toInt)
    digits = Param(Params._dummy(), "digits", "scores are rounded to so many digits for calibration; -1: not",
                   TypeConverters.toInt)
    stack = Param(Params._dummy(), "stack", "intercept and coefficients of the stack", TypeConverters.toListFloat)
    meta = Param(Params._dummy(), "meta", "intercept and coefficients of the blend with the net", TypeConverters.toListFloat)

    def _rounded(self, c: Column) -> Column:
        d = self.getOrDefault(self.digits)
        return c if d < 0 else F.round(c, d)

    def _models(self) -> list[Column]:
        return [F.col(c) for c in self.getInputCols()]

    def _stack_prob(self) -> Column:
        return sigmoid(self.getOrDefault(self.stack), self._models())

    def _mean(self) -> Column:
        m = self._models()
        return sum(m[1:], m[0]) / F.lit(float(len(m)))


def _candidates(blend: Column, net: Column, meta) -> dict[str, Column]:
    """Probability per candidate; an earlier one wins ties."""
    out = {"trees": blend, "lr_meta": sigmoid(meta, [blend, net])}
    for w in MIX_WEIGHTS:
        out[f"mix_{w:.2f}"] = F.lit(1 - w) * blend + F.lit(w) * net
    return out


class Blend(Estimator, _BlendParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits on one row per key: ``inputCols`` and ``netCol`` are out-of-fold
    probabilities, ``labelCol`` is 0 or 1. ``stack`` and ``meta``, where given, are used
    instead of the two logistic fits. Rows with a NULL label or probability are left
    out of the fit; an empty table cannot be fitted."""

    C1 = Param(Params._dummy(), "C1", "inverse strength of the stack's L2 term", TypeConverters.toFloat)
    C2 = Param(Params._dummy(), "C2", "inverse strength of the net blend's L2 term", TypeConverters.toFloat)

    def __init__(self, **params):
        super().__init__()
        self._setDefault(idCol="id", labelCol="label", netCol="p_net", folds=5, digits=-1, seed=42, C1=0.5, C2=0.3)
        self._set(**params)

    def _logistic(self, df: DataFrame, inputs, label, c) -> list[float]:
        tr = assemble(df.select(label, *inputs), inputs).withColumn("_label", F.col(label).cast("double"))
        m = logistic(tr.count(), c).setFeaturesCol("features").setLabelCol("_label").fit(tr)
        return [float(m.intercept), *map(float, m.coefficients)]

    def _fit(self, df: DataFrame) -> BlendModel:
        key, label, net = (self.getOrDefault(p) for p in (self.idCol, self.labelCol, self.netCol))
        inputs = self.getInputCols()
        df = df.select(key, label, net, *inputs).dropna(subset=[label, net, *inputs]).persist()
        out = BlendModel()
        self._copyValues(out, {})
        if not self.isSet(self.stack):
            out._set(stack=self._logistic(df, inputs, label, self.getOrDefault(self.C1)))
        scored = df.withColumn("_stack", out._stack_prob()).withColumn("_mean", out._mean())
        weights = evaluate.blend_weight_search(scored, label, "_stack", "_mean")
        best = evaluate.first_strict_best(weights, "weight_index").first()
        if best is None or best.weight is None:
            raise ValueError("no complete row to fit the blend on")
        out._set(weight=float(best.weight))
        scored = scored.withColumn("_blend", out._blend()).persist()
        if not self.isSet(self.meta):
            out._set(meta=self._logistic(scored.withColumnRenamed(net, "_net"), ["_blend", "_net"], label,
                                         self.getOrDefault(self.C2)))
        cands = _candidates(F.col("_blend"), F.col(net), out.getOrDefault(out.meta))
        won = evaluate.choose_candidate(scored, key, label, cands, list(cands)).where("chosen = 1").first()
        out._set(winner=won.candidate, rawAccuracy=float(won.accuracy))
        final = scored.select(key, label, cands[won.candidate].alias("_p"))
        d = self.getOrDefault(self.digits)
        folds, curves = calibration_curves(final, key, "_p", label, self.getOrDefault(self.folds), self.getOrDefault(self.seed),
                                           None if d < 0 else d)
        cal = folds.select(F.col("_y").cast("int").alias("_y"), own_fold_value(F.col("_x"), F.col("fold"), curves).alias("_c"))
        after = evaluate.best_threshold(evaluate.threshold_sweep(cal, "_c", "_y")).first()
        better = int(after.correct) > int(won.correct)
        order = sorted(curves)
        out._set(calibrated=better, calibratedAccuracy=float(after.accuracy),
                 threshold=float(after.threshold if better else won.threshold),
                 curveSizes=[len(curves[f]) for f in order],
                 curveX=[float(x) for f in order for x, _ in curves[f]],
                 curveY=[float(y) for f in order for _, y in curves[f]])
        scored.unpersist()
        df.unpersist()
        return out


class BlendModel(Model, _BlendParams, DefaultParamsReadable, DefaultParamsWritable):
    """``transform`` adds ``blend_prob`` (the winner, calibrated if that helped),
    ``threshold``, ``decision`` (lock, else probability at the cut), and, with
    ``groupCol``, ``group_prob``, ``group_adjusted`` and ``group_decision``. A NULL
    probability gives a NULL decision unless the row is locked."""

    C1 = Blend.C1
    C2 = Blend.C2
    weight = Param(Params._dummy(), "weight", "weight of the stack against the mean", TypeConverters.toFloat)
    winner = Param(Params._dummy(), "winner", "chosen candidate", TypeConverters.toString)
    rawAccuracy = Param(Params._dummy(), "rawAccuracy", "accuracy of the winner", TypeConverters.toFloat)
    calibratedAccuracy = Param(Params._dummy(), "calibratedAccuracy", "accuracy when calibrated", TypeConverters.toFloat)
    calibrated = Param(Params._dummy(), "calibrated", "calibration is used", TypeConverters.toBoolean)
    threshold = Param(Params._dummy(), "threshold", "cut", TypeConverters.toFloat)
    curveSizes = Param(Params._dummy(), "curveSizes", "points per calibration curve", TypeConverters.toListInt)
    curveX = Param(Params._dummy(), "curveX", "scores of the curves", TypeConverters.toListFloat)
    curveY = Param(Params._dummy(), "curveY", "values of the curves", TypeConverters.toListFloat)
    groupCol = Param(Params._dummy(), "groupCol", "group of a row", TypeConverters.toString)
    lockCol = Param(Params._dummy(), "lockCol", "0, 1 or NULL: decided by a rule", TypeConverters.toString)
    confidence = Param(Params._dummy(), "confidence", "mean from which a group is adjusted", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(confidence=0.75, folds=5, digits=-1)

    def with_columns(self, **params) -> BlendModel:
        """Name ``groupCol`` and ``lockCol``, or another ``confidence``."""
        return self._set(**params)

    def _blend(self) -> Column:
        w = self.getOrDefault(self.weight)
        return F.lit(w) * self._stack_prob() + F.lit(1 - w) * self._mean()

    def curves(self) -> dict:
        out, at = {}, 0
        x, y = self.getOrDefault(self.curveX), self.getOrDefault(self.curveY)
        for f, size in enumerate(self.getOrDefault(self.curveSizes)):
            out[f] = list(zip(x[at:at + size], y[at:at + size]))
            at += size
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        net = F.col(self.getOrDefault(self.netCol))
        raw = _candidates(self._blend(), net, self.getOrDefault(self.meta))[self.getOrDefault(self.winner)]
        out = df.withColumn("blend_prob", raw)
        if self.getOrDefault(self.calibrated):
            out = out.withColumn("blend_prob", mean_value(self._rounded(F.col("blend_prob")), self.curves()))
        cut = F.lit(self.getOrDefault(self.threshold))
        lock = F.col(self.getOrDefault(self.lockCol)) if self.isSet(self.lockCol) else F.lit(None).cast("int")

        def decide(p):
            return F.coalesce(lock, (p >= cut).cast("int"))
        out = out.withColumn("threshold", cut).withColumn("decision", decide(F.col("blend_prob")))
        if self.isSet(self.groupCol):
            out = group_consistency(out, self.getOrDefault(self.groupCol), "blend_prob",
                                    self.getOrDefault(self.lockCol) if self.isSet(self.lockCol) else None,
                                    self.getOrDefault(self.confidence), out="group_prob")
            out = out.withColumnRenamed("adjusted", "group_adjusted").withColumn("group_decision", decide(F.col("group_prob")))
        return out

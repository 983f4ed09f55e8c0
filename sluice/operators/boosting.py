"""Gradient-boosted trees with an L1 penalty on leaf weights.

Spark's own boosted trees have no penalty.  Here each level of a tree is one
aggregation: first and second derivatives of the logistic loss, summed per node,
feature and bin, reduced per task before the shuffle.  The best split of every
node is found from those sums in Spark; what reaches the driver is a row per
node, at most 2^depth.  With gradient sum G and Hessian sum H a leaf weighs
-T(G) / (H + l2), where T draws G towards zero by ``alpha`` and to zero within
it, and a split is worth half of what T(G)^2 / (H + l2) gains by it.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.columns import quoted
from sluice.sources.scratch import materialise

#: Gains are compared after rounding, so that the order of a sum does not decide a tie.
DIGITS = 9


@dataclass
class Tree:
    """A tree in heap order: the children of i are 2 i + 1 and 2 i + 2; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def put(self, i: int, feature: int, threshold: float, value: float) -> None:
        while len(self.feature) <= i:
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.value.append(0.0)
        self.feature[i], self.threshold[i], self.value[i] = feature, threshold, value


def shrunk(gradient: float, alpha: float) -> float:
    return math.copysign(max(abs(gradient) - alpha, 0.0), gradient)


def _shrunk(gradient: Column, alpha: float) -> Column:
    return F.signum(gradient) * F.greatest(F.abs(gradient) - F.lit(float(alpha)), F.lit(0.0))


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def tree_margin(x: Column, tree: Tree) -> Column:
    """The value of the leaf that a row's features, an array, lead to."""
    features, thresholds = F.array(*map(F.lit, tree.feature)), _doubles(tree.threshold)
    depth = len(tree.feature).bit_length() - 1
    if not depth:
        return F.lit(float(tree.value[0]))

    def down(i: Column, _: Column) -> Column:
        feature = F.element_at(features, i + 1)
        left = F.element_at(x, F.greatest(feature, F.lit(0)) + 1) <= F.element_at(thresholds, i + 1)
        return F.when(feature < 0, i).otherwise(F.when(left, 2 * i + 1).otherwise(2 * i + 2))

    return F.element_at(_doubles(tree.value), F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down) + 1)


def bin_edges(x: DataFrame, slots: int, bins: int) -> list[list[float]]:
    """Values that split each feature, at most ``bins - 1`` of them, near its quantiles; one row comes back."""
    steps = [k / bins for k in range(1, bins)]
    row = x.agg(*[F.percentile_approx(F.col("x")[i], steps, 10_000).alias(str(i)) for i in range(slots)]).first()
    return [sorted(set(row[i] or ())) for i in range(slots)]


def _binned(x: Column, edges: list[list[float]]) -> Column:
    """Per feature, how many edges lie below the value: it is at most edge b where that is b or less."""
    table = F.array(*[_doubles(e) if e else F.array().cast("array<double>") for e in edges])
    return F.transform(x, lambda v, i: F.size(F.filter(F.element_at(table, i + 1), lambda e: e < v)))


class _BoostedParams(HasFeaturesCol, HasLabelCol, HasMaxIter, HasStepSize):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "L1 penalty on leaf weights", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "L2 penalty on leaf weights", TypeConverters.toFloat)
    minHessian = Param(Params._dummy(), "minHessian", "least Hessian sum of a child", TypeConverters.toFloat)


def best_splits(rows: DataFrame, alpha: float, l2: float, least: float) -> DataFrame:
    """Per node: ``g, h`` and its best split, from ``node, g, h, bins``.

    ``best`` is null where no split gains anything; of equal gains the first
    feature and the lowest bin win.
    """
    sums = rows.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin")).groupBy(
        "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    feature = Window.partitionBy("node", "feature")
    upto = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sided = sums.select("node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
                        F.sum("g").over(feature).alias("g"), F.sum("h").over(feature).alias("h"))

    def worth(g: Column, h: Column) -> Column:
        return _shrunk(g, alpha) * _shrunk(g, alpha) / (h + F.lit(l2))

    gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
    gain = F.round((worth(F.col("gl"), F.col("hl")) + worth(gr, hr) - worth(F.col("g"), F.col("h"))) / 2, DIGITS)
    usable = (F.col("hl") >= least) & (hr >= least) & (gain > 0)
    split = F.struct(gain.alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"),
                     F.col("gl").alias("gl"), F.col("hl").alias("hl"))
    return sided.groupBy("node").agg(F.max(F.when(usable, split)).alias("best"),
                                     F.max(F.when(F.col("feature") == 0, F.col("g"))).alias("g"),
                                     F.max(F.when(F.col("feature") == 0, F.col("h"))).alias("h"))


class L1BoostedClassifier(Estimator, _BoostedParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees with logistic loss and penalties ``alpha`` (L1) and ``l2`` on leaf weights."""

    @keyword_only
    def __init__(self, *, featuresCol="inp_features", labelCol="label", maxIter=20, stepSize=0.3, maxDepth=6,
                 maxBins=32, alpha=0.0, l2=1.0, minHessian=1.0):
        super().__init__()
        self._setDefault(featuresCol="inp_features", labelCol="label", maxIter=20, stepSize=0.3, maxDepth=6,
                         maxBins=32, alpha=0.0, l2=1.0, minHessian=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "L1BoostedModel":
        get = self.getOrDefault
        alpha, l2, step = get("alpha"), get("l2"), get("stepSize")
        given = dataset.select(vector_to_array(quoted(get("featuresCol"))).alias("x"),
                               quoted(get("labelCol")).cast("double").alias("y"))
        first = given.select(F.size("x")).first()
        if first is None:
            raise ValueError("no rows to train on")
        slots = first[0]
        edges = bin_edges(given, slots, get("maxBins"))
        # A round's margins are written: the next one reads them and not all trees so far.
        rows = materialise(given.select(_binned(F.col("x"), edges).alias("bins"), "y", F.lit(0.0).alias("m")), "margins")
        trees: list[Tree] = []
        for _ in range(get("maxIter")):
            p = 1 / (1 + F.exp(-F.col("m")))
            weighted = rows.withColumns({"g": p - F.col("y"), "h": p * (1 - p)})
            tree, binned = self._grow(weighted, edges, alpha, l2, step)
            if tree.feature[0] < 0 and tree.value[0] == 0:
                break  # nothing to gain any more, and so in all later rounds
            trees.append(tree)
            rows = materialise(rows.select("bins", "y", (F.col("m") + tree_margin(F.col("bins"), binned)).alias("m")),
                               "margins")
        model = L1BoostedModel()
        model._set(trees=json.dumps([[t.feature, t.threshold, t.value] for t in trees]),
                   featuresCol=get("featuresCol"), labelCol=get("labelCol"))
        return model

    def _grow(self, rows: DataFrame, edges: list[list[float]], alpha: float, l2: float,
              step: float) -> tuple[Tree, Tree]:
        """One tree, on the features' values and on their bins."""
        tree, binned = Tree(), Tree()
        depth, least = self.getOrDefault("maxDepth"), self.getOrDefault("minHessian")
        open_nodes, at = [0], F.lit(0)

        def leaf(i: int, g: float, h: float) -> None:
            value = -step * shrunk(g, alpha) / (h + l2)
            tree.put(i, -1, 0.0, value)
            binned.put(i, -1, 0.0, value)

        for _ in range(depth):
            here = rows.withColumn("node", at).where(F.col("node").isin(open_nodes)) if open_nodes != [0] else (
                rows.withColumn("node", at))
            found = best_splits(here.select("node", "g", "h", "bins"), alpha, l2, least).collect()  # a row per node
            grown = []
            for r in sorted(found, key=lambda r: r.node):
                if r.best is None:
                    leaf(r.node, r.g, r.h)
                    continue
                feature, bin_ = -r.best.feature, -r.best.bin
                tree.put(r.node, feature, edges[feature][bin_], 0.0)
                binned.put(r.node, feature, float(bin_), 0.0)
                left, right = 2 * r.node + 1, 2 * r.node + 2
                leaf(left, r.best.gl, r.best.hl)
                leaf(right, r.g - r.best.gl, r.h - r.best.hl)
                grown += [left, right]
            if not grown:
                break
            open_nodes, at = grown, _place(F.col("bins"), binned)
        return tree, binned


def _place(bins: Column, tree: Tree) -> Column:
    """The node that a row is in so far."""
    numbered = Tree(tree.feature, tree.threshold, [float(i) for i in range(len(tree.value))])
    return tree_margin(bins, numbered).cast("int")


class L1BoostedModel(Model, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees, kept as a parameter so that they are saved with the others."""

    trees = Param(Params._dummy(), "trees", "features, thresholds and values per tree, as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="inp_features", labelCol="label")

    @property
    def forest(self) -> list[Tree]:
        return [Tree(*t) for t in json.loads(self.getOrDefault("trees"))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds ``probability``, a vector of both classes, and ``prediction``."""
        x = vector_to_array(quoted(self.getOrDefault("featuresCol")))
        given = dataset.withColumn("_x", x)
        margin = F.lit(0.0)
        for tree in self.forest:
            margin = margin + tree_margin(F.col("_x"), tree)
        p = given.withColumn("_p", 1 / (1 + F.exp(-margin)))
        return p.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).withColumn(
            "prediction", (F.col("_p") > 0.5).cast("double")).drop("_x", "_p")

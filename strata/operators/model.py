"""Models, leak-free tuning and scoring.

* ``Forest`` and ``Boosted`` are estimators over ``strata/operators/ensembles.py``: many
  fits are grown together from rows that are binned and written once.
* The leak-free pipeline is a ``pyspark.ml.Pipeline`` of three custom stages
  — population scaler, recursive feature eliminator, balanced classifier
  (SMOTE in ``fit`` only) — so all of them are refitted inside every fold.
* Scoring decides by P(positive) = ``vector_to_array(probability)[1]`` >=
  threshold; only the search's F1 reads MLlib's ``prediction`` column.
"""

from __future__ import annotations

import json
import math
import random
from collections import defaultdict
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.balance import smote
from strata.operators.ensembles import (MODEL_BYTES, NODE_BYTES, NODE_KINDS, NODES, PART_BYTES, Binned, SpreadModel,
                                        bin_rows, grow, held_confusion, keyed_rows, node_bytes, scored)
from strata.operators.prep import scaler_stats
from strata.operators.trees import UNLIMITED, Fit, TreeModel, joined
from strata.session import cut_lineage

SEED = 42


def assemble(cols: list[str], out: str = "features") -> F.Column:
    """Dense vector from double columns, JVM-side (no Python)."""
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])).alias(out)


def p_positive(df: DataFrame, prob_col: str = "probability", out: str = "p") -> DataFrame:
    """M7: P(positive class) as a double column."""
    return df.withColumn(out, vector_to_array(F.col(prob_col)).getItem(1))


class _Trees(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    """What both kinds of trees share.  ``maxDepth`` None is no limit.  A weight column must hold one weight for
    each label.  Rows that are equal in all columns are drawn together."""
    maxDepth = Param(Params._dummy(), "maxDepth", "deepest level, None for no limit")
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a leaf at least", TypeConverters.toInt)
    minSamplesSplit = Param(Params._dummy(), "minSamplesSplit", "rows of a split at least", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "columns tried: sqrt, log2, all, a number "
                                  "or, for boosting, a share of a tree's columns", TypeConverters.toString)

    def setFeaturesCol(self, value):
        return self._set(featuresCol=value)

    def setLabelCol(self, value):
        return self._set(labelCol=value)

    def _fit(self, dataset):
        label = self.getLabelCol()
        rows = keyed_rows(dataset, vector_to_array(F.col(self.getFeaturesCol())), label, F.lit(0), F.lit(0))
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else None
        weights = label_weights(dataset, label, weight) if weight else (1.0, 1.0)
        return TreesModel(grow(rows, [self.plan(0, weights)]).model(0), self.getFeaturesCol())

    def _depth(self) -> int:
        d = self.getOrDefault(self.maxDepth)
        return UNLIMITED if d is None else d


class Forest(_Trees):
    """M1: trees on Poisson bags; every split looks at a subset of the columns, and at more only without a cut there."""
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)

    @keyword_only
    def __init__(self, numTrees=100, maxDepth=None, featureSubsetStrategy="sqrt", minInstancesPerNode=1,
                 minSamplesSplit=2, weightCol=None, seed=42, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(numTrees=100, maxDepth=None, featureSubsetStrategy="sqrt", minInstancesPerNode=1,
                         minSamplesSplit=2, seed=42, featuresCol="features", labelCol="label")
        self._set(**self._input_kwargs)

    def plan(self, group: int, weights: tuple[float, float], columns: int = 0) -> Fit:
        g = self.getOrDefault
        how = g(self.featureSubsetStrategy)
        tried = {"sqrt": 0, "all": 1 << 15, "log2": max(1, int(math.log2(columns))) if columns else 0}.get(how)
        return Fit(group, "forest", g(self.numTrees), self._depth(), g(self.minSamplesSplit), g(self.minInstancesPerNode),
                   int(how) if tried is None else tried, weights=weights, seed=g(self.seed))

    def _fit(self, dataset):
        if self.getOrDefault(self.featureSubsetStrategy) != "log2":
            return super()._fit(dataset)
        width = len(dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x")).first()[0])
        return self.copy({self.featureSubsetStrategy: str(max(1, int(math.log2(width))))}).fit(dataset)


class Boosted(_Trees):
    """M2: second-order boosting of the log loss; each tree on a share of the rows and of the columns."""
    maxIter = Param(Params._dummy(), "maxIter", "trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows of a tree", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, maxIter=100, maxDepth=6, stepSize=0.3, subsamplingRate=1.0, featureSubsetStrategy="all",
                 weightCol=None, seed=42, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(maxIter=100, maxDepth=6, stepSize=0.3, subsamplingRate=1.0, featureSubsetStrategy="all",
                         minInstancesPerNode=1, minSamplesSplit=2, seed=42, featuresCol="features", labelCol="label")
        self._set(**self._input_kwargs)

    def plan(self, group: int, weights: tuple[float, float], columns: int = 0) -> Fit:
        g = self.getOrDefault
        how = g(self.featureSubsetStrategy)
        return Fit(group, "boosted", g(self.maxIter), self._depth(), step=g(self.stepSize),
                   subsample=g(self.subsamplingRate), share=1.0 if how == "all" else float(how), weights=weights,
                   seed=g(self.seed))


class TreesModel(Model):
    """Fitted trees: adds ``probability`` (a vector of both labels) and ``prediction`` (1 from P >= 0.5)."""

    def __init__(self, model: TreeModel | SpreadModel, features_col: str = "features"):
        super().__init__()
        self.model, self.features_col, self._known = model, features_col, None

    def getFeaturesCol(self) -> str:
        return self.features_col

    def getProbabilityCol(self) -> str:
        return "probability"

    @property
    def featureImportances(self):
        return Vectors.dense(self.model.importance)

    def _transform(self, dataset):
        x = vector_to_array(F.col(self.features_col))
        if isinstance(self.model, SpreadModel):
            rows = cut_lineage(dataset.withColumn("_row", F.monotonically_increasing_id()))
            known = self.model.scores(rows.select(F.col("_row").alias("row"), x.alias("x")))
            out = rows.join(known.select(F.col("row").alias("_row"), F.col("p").alias("_p")), "_row").drop("_row")
        else:
            if self._known is None:
                self._known = scored(self.model, dataset.sparkSession)
            out = dataset.withColumn("_p", self._known(x))
        p = F.col("_p")
        return (out.withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p >= 0.5).cast("double")).drop("_p"))

    def save(self, spark, path: str) -> None:
        """One Parquet row for each part of a tree, and the edges of its columns.  A file holds few large trees, as a reader takes
        many rows of a file at once."""
        m = self.model
        if isinstance(m, SpreadModel):
            largest = m.trees.agg(F.max(F.length("cut"))).first()[0]
            rows = m.trees.write.option("maxRecordsPerFile", max(1, PART_BYTES // (NODE_BYTES * largest)))
        else:
            trees = [(t, 0, *[bytearray(np.ascontiguousarray(v, k).tobytes()) for v, k in zip(tree, NODE_KINDS, strict=True)])
                     for t, tree in enumerate(zip(m.features, m.cuts, m.lefts, m.values, strict=True))]
            rows = spark.createDataFrame(trees, NODES).write
        rows.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(m.kind, [e.tolist() for e in m.edges], m.importance.tolist())],
                              "kind string, edges array<array<double>>, importance array<double>").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load(cls, spark, path: str, features_col: str = "features", model_bytes: int = MODEL_BYTES) -> TreesModel:
        head = spark.read.parquet(f"{path}/head").first()
        edges, share = [np.array(e) for e in head["edges"]], np.array(head["importance"])
        trees = spark.read.schema(NODES).parquet(f"{path}/trees").withColumn("part", F.coalesce("part", F.lit(0)))
        if node_bytes(trees) > model_bytes:
            return cls(SpreadModel(head["kind"], edges, trees, share), features_col)
        names, parts = ("feature", "cut", "left", "value"), defaultdict(list)
        for r in trees.orderBy("tree", "part").collect():
            parts[r["tree"]].append((r["part"], {c: np.frombuffer(r[c], k) for c, k in zip(names, NODE_KINDS, strict=True)}))
        whole = [joined(some) for some in parts.values()]
        return cls(TreeModel(head["kind"], edges, *[[t[c] for t in whole] for c in names], share), features_col)


def label_weights(dataset: DataFrame, label: str, weight: str) -> tuple[float, float]:
    """The weight of label 0 and of label 1."""
    got = {int(r["y"]): r for r in dataset.groupBy(F.col(label).cast("int").alias("y")).agg(
        F.min(weight).alias("lo"), F.max(weight).alias("hi")).where("y is not null").collect()}
    if any(r["lo"] != r["hi"] for r in got.values()):
        raise ValueError(f"{weight} must hold one weight for each label")
    return tuple(float(got[y]["lo"]) if y in got else 1.0 for y in (0, 1))


def random_forest(num_trees: int = 100, max_depth: int | None = None, feature_subset: str = "sqrt",
                  min_instances: int = 1, weight_col: str | None = None, seed: int = SEED,
                  features_col: str = "features", label_col: str = "label", min_split: int = 2) -> Forest:
    """M1: random forest; ``max_depth=None`` grows until its leaves are pure or smaller than ``min_split``."""
    if max_depth is not None and max_depth < 1:
        raise ValueError(f"max_depth={max_depth}: None means no limit")
    return Forest(numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy=feature_subset,
                  minInstancesPerNode=min_instances, minSamplesSplit=min_split, weightCol=weight_col, seed=seed,
                  featuresCol=features_col, labelCol=label_col)


def boosted_trees(n_iter: int = 100, max_depth: int = 6, step: float = 0.3, subsample: float = 1.0,
                  feature_subset: str = "all", weight_col: str | None = None, seed: int = SEED,
                  features_col: str = "features", label_col: str = "label") -> Boosted:
    """M2: gradient-boosted trees (logistic loss)."""
    return Boosted(maxIter=n_iter, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                   featureSubsetStrategy=feature_subset, weightCol=weight_col, seed=seed, featuresCol=features_col,
                   labelCol=label_col)


# --------------------------------------------------------------------------
# custom pipeline stages
# --------------------------------------------------------------------------
class _HasCols(Params):
    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "output vector column", TypeConverters.toString)


class PopulationScaler(Estimator, _HasCols):
    """F4 as an Estimator: (c - mean) / population std (std 0 -> 1), output a
    vector column.  Fit = one long-form aggregate; apply = one projection."""

    @keyword_only
    def __init__(self, inputCols=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        cols = self.getOrDefault(self.inputCols)
        st = {r["feature"]: (r["mean"], r["scale"]) for r in scaler_stats(dataset, cols).collect()}
        return PopulationScalerModel(cols, [st[c][0] for c in cols], [st[c][1] for c in cols],
                                     self.getOrDefault(self.outputCol))


class PopulationScalerModel(Model):
    def __init__(self, cols, means, scales, out):
        super().__init__()
        self.cols, self.means, self.scales, self.out = list(cols), list(means), list(scales), out

    def scaled(self, i: int) -> F.Column:
        return (F.col(self.cols[i]).cast("double") - F.lit(self.means[i])) / F.lit(self.scales[i])

    def _transform(self, dataset):
        z = [self.scaled(i) for i in range(len(self.cols))]
        return dataset.withColumn(self.out, array_to_vector(F.array(*z)))


def rfe_schedule(n: int, k: int, step: float | int) -> list[int]:
    """Widths visited by recursive elimination; a fractional step is a
    fixed share of the INITIAL width, the last step clipped."""
    s = int(max(1, step * n)) if 0 < step < 1 else int(step)
    widths = [n]
    while widths[-1] > k:
        widths.append(max(k, widths[-1] - s))
    return widths


def eliminate(rows: Binned, widths: dict[int, list[int]], step: float = 0.5, trees: int = 20, depth: int = 5,
              seed: int = SEED, path: list | None = None) -> dict[tuple[int, int], list[int]]:
    """F5 / F7 for many groups and widths: the columns that each ``(group, k)`` keeps.

    One round grows the ranking forests of all groups and of all different sets of columns together, from rows that
    were binned once; eliminations to several widths rank the same columns until their last round, so each set is
    ranked once.  Labels weigh as balanced classes; equal importances go by the column's place.  ``path`` takes
    (width, column) of every column that leaves."""
    kept = {(g, min(k, len(rows.edges[g]))): tuple(range(len(rows.edges[g]))) for g, ks in widths.items() for k in ks}
    left = {(g, k): rfe_schedule(len(rows.edges[g]), k, step)[1:] for g, k in kept}
    ranked: dict = {}
    while any(left.values()):
        need = sorted({(g, kept[g, k]) for (g, k), todo in left.items() if todo} - ranked.keys())
        if need:
            fits = [Fit(g, "forest", trees, depth, weights=rows.balanced(g), seed=seed, columns=some) for g, some in need]
            for i, share in grow(rows, fits).importances().items():
                some = need[i][1]
                ranked[need[i]] = [some[j] for j in sorted(range(len(some)), key=lambda j: (-share[j], j))]
        for (g, k), todo in left.items():
            if todo:
                order, target = ranked[g, kept[g, k]], todo.pop(0)
                if path is not None:
                    path += [(len(order), c) for c in order[target:]]
                kept[g, k] = tuple(sorted(order[:target]))
    return {gk: list(some) for gk, some in kept.items()}


class RecursiveEliminator(Estimator):
    """recursive feature elimination with a forest ranker; the model
    keeps the selected slots of the input vector."""
    inputCol = Param(Params._dummy(), "inputCol", "input vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output vector column", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "features to keep", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "share of the initial width (or count) removed per round",
                 TypeConverters.toFloat)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    rankerTrees = Param(Params._dummy(), "rankerTrees", "trees of the ranking forest", TypeConverters.toInt)
    rankerDepth = Param(Params._dummy(), "rankerDepth", "depth of the ranking forest", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="selected", k=50, step=0.5, labelCol="label", seed=SEED,
                 rankerTrees=20, rankerDepth=5):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="selected", k=50, step=0.5, labelCol="label", seed=SEED,
                         rankerTrees=20, rankerDepth=5)
        self._set(**self._input_kwargs)

    def fit_widths(self, dataset, ks: list[int]) -> dict:
        """The selector of each k."""
        g = self.getOrDefault
        rows = bin_rows(keyed_rows(dataset, vector_to_array(F.col(g(self.inputCol))), g(self.labelCol), F.lit(0), F.lit(0)))
        kept = eliminate(rows, {0: ks}, g(self.step), g(self.rankerTrees), g(self.rankerDepth), g(self.seed))
        return {k: SelectorModel(kept[0, k], g(self.inputCol), g(self.outputCol)) for k in ks}

    def _fit(self, dataset):
        k = self.getOrDefault(self.k)
        return self.fit_widths(dataset, [k])[k]


class SelectorModel(Model):
    def __init__(self, indices, inp, out):
        super().__init__()
        self.indices, self.inp, self.out = list(indices), inp, out

    def _transform(self, dataset):
        arr = vector_to_array(F.col(self.inp))
        return dataset.withColumn(self.out, array_to_vector(F.array(*[arr[i] for i in self.indices])))


class BalancedClassifier(Estimator):
    """M3 balancing step: ``fit`` oversamples the minority class (SMOTE on
    the feature vector) and fits the wrapped classifier; the model's
    ``transform`` is the classifier's, so validation / scoring rows are never
    resampled.  Grid parameters of the wrapped classifier pass through
    ``copy``."""
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "unique long row key", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, estimator=None, featuresCol="selected", labelCol="label", keyCol="key", k=5, seed=SEED):
        super().__init__()
        self.estimator = estimator
        self._setDefault(featuresCol="selected", labelCol="label", keyCol="key", k=5, seed=SEED)
        kw = dict(self._input_kwargs)
        kw.pop("estimator", None)
        self._set(**kw)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.estimator = self.estimator.copy(extra)
        return that

    def balanced_rows(self, dataset) -> DataFrame:
        """The oversampled rows, written once: a fit reads them many times."""
        g = self.getOrDefault
        arr = dataset.select(g(self.keyCol), g(self.labelCol), vector_to_array(F.col(g(self.featuresCol))).alias("_a"))
        d = len(arr.select("_a").first()[0])
        return self.balanced_columns(arr, [F.col("_a")[i] for i in range(d)])

    def balanced_columns(self, dataset, columns: list[F.Column]) -> DataFrame:
        """``balanced_rows`` of rows whose features are ``columns`` instead of a vector."""
        g = self.getOrDefault
        fc, lab, key = g(self.featuresCol), g(self.labelCol), g(self.keyCol)
        names = [f"_f{i}" for i in range(len(columns))]
        wide = dataset.select(key, lab, *[c.alias(n) for c, n in zip(columns, names, strict=True)])
        bal = smote(wide, key, names, lab, k=g(self.k), seed=g(self.seed))
        return cut_lineage(bal.select(assemble(names, fc), F.col(lab).cast("double").alias(lab)))

    def fit_balanced(self, rows: DataFrame, params: dict | None = None) -> BalancedModel:
        """The classifier, with ``params`` over its own, on rows balanced before."""
        g = self.getOrDefault
        est = self.estimator.copy(params or {}).setFeaturesCol(g(self.featuresCol)).setLabelCol(g(self.labelCol))
        return BalancedModel(est.fit(rows))

    def _fit(self, dataset):
        return self.fit_balanced(self.balanced_rows(dataset))


class BalancedModel(Model):
    def __init__(self, inner):
        super().__init__()
        self.inner = inner

    def _transform(self, dataset):
        return self.inner.transform(dataset)


def leakfree_estimator(classifier, input_cols: list[str], key: str, k_features: int = 50,
                      step: float = 0.5, label: str = "label", seed: int = SEED) -> Pipeline:
    """M3: scale -> RFE(k) -> SMOTE -> classifier, every step refit per fold."""
    return Pipeline(stages=[
        PopulationScaler(inputCols=input_cols, outputCol="features"),
        RecursiveEliminator(inputCol="features", outputCol="selected", k=k_features, step=step,
                            labelCol=label, seed=seed),
        BalancedClassifier(estimator=classifier, featuresCol="selected", labelCol=label, keyCol=key,
                           seed=seed)])


def f1_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0,
                                             labelCol=label, predictionCol="prediction")


def grid_search(pipeline: Pipeline, grid: list[dict], data: DataFrame, fold_col: str = "fold",
                n_folds: int = 5, label: str = "label", parallelism: int = 2):
    """M4: CrossValidator over ``grid`` (list of {Param: value}) with the
    stratified fold column, scored by positive-class F1."""
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=f1_evaluator(label),
                        numFolds=n_folds, foldCol=fold_col, parallelism=parallelism, seed=SEED)
    data = data.withColumn(label, F.col(label).cast("double"))
    return cv.fit(data)


def fold_f1(estimator, data: DataFrame, n_folds: int, fold_col: str = "fold", label: str = "label",
            parallelism: int = 4) -> float:
    """The mean F1 of ``estimator`` over the folds, without a refit on all."""
    data = data.withColumn(label, F.col(label).cast("double"))
    evaluator = f1_evaluator(label)

    def score(fold: int) -> float:
        model = estimator.fit(data.filter(F.col(fold_col) != fold))
        return evaluator.evaluate(model.transform(data.filter(F.col(fold_col) == fold)))

    with ThreadPool(parallelism) as pool:
        return sum(pool.map(inheritable_thread_target(data.sparkSession)(score), range(n_folds))) / n_folds


@dataclass
class SearchResult:
    """Mean score of each candidate, the pipeline refitted on all folds with
    the first best, and the features that each fold's own elimination kept."""
    avgMetrics: list[float]
    bestModel: object
    fold_features: list[list[int]]
    fold_scores: list[list[float]]


def fold_scalers(data: DataFrame, cols: list[str], n_folds: int, fold_col: str = "fold") -> list[dict]:
    """F4 for the training side of each fold, {column: (mean, scale)}: moments of every fold from one job, and each
    side the merge of the other folds' moments."""
    long = data.select(fold_col, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [fold_col], cols, "feature", "value")
    own = defaultdict(list)
    for r in long.groupBy(fold_col, "feature").agg(
            F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"),
            F.min("value").alias("lo"), F.max("value").alias("hi")).where("n > 0").collect():
        own[r["feature"]].append(r)
    out = []
    for fold in range(n_folds):
        side = {}
        for c in cols:
            parts = [r for r in own[c] if r[fold_col] != fold]
            n = sum(r["n"] for r in parts)
            mean = sum(r["n"] * r["mean"] for r in parts) / n if n else 0.0
            var = sum(r["n"] * (r["var"] + (r["mean"] - mean) ** 2) for r in parts) / n if n else 0.0
            same = not parts or min(r["lo"] for r in parts) == max(r["hi"] for r in parts)
            side[c] = mean, 1.0 if same or var <= 0 else math.sqrt(var)
        out.append(side)
    return out


def training_sides(data: DataFrame, n_folds: int, fold_col: str = "fold") -> DataFrame:
    """Every row once for each fold whose training side it is on, with that fold in ``side``."""
    others = F.array(*[F.lit(f) for f in range(n_folds)])
    return data.withColumn("side", F.explode(F.filter(others, lambda f: f != F.col(fold_col))))


def f1_of(tp: int, fp: int, fn: int) -> float:
    return 2 * tp / (2 * tp + fp + fn) if tp else 0.0


def leakfree_search(pipeline: Pipeline, grid: list[dict], data: DataFrame, fold_col: str = "fold", n_folds: int = 5,
                    label: str = "label", parallelism: int = 4) -> SearchResult:
    """M4 / M5: ``cross_validate``, and the pipeline refitted on all rows with the first best candidate.  What no
    candidate changes of the refit is fitted beside the folds."""
    *before, last = pipeline.getStages()

    def refit() -> tuple[list, DataFrame]:
        rows, fitted = data.withColumn(label, F.col(label).cast("double")), []
        for stage in before:
            fitted.append(stage.fit(rows))
            rows = fitted[-1].transform(rows)
        return fitted, last.balanced_rows(rows)

    with ThreadPool(1) as pool:
        whole = pool.apply_async(inheritable_thread_target(data.sparkSession)(refit))
        found = cross_validate(pipeline, grid, data, fold_col, n_folds, label, parallelism)
        fitted, rows = whole.get()
    best = max(range(len(grid)), key=lambda i: found.avgMetrics[i])
    return replace(found, bestModel=PipelineModel([*fitted, last.fit_balanced(rows, grid[best])]))


def cross_validate(pipeline: Pipeline, grid: list[dict], data: DataFrame, fold_col: str = "fold", n_folds: int = 5,
                   label: str = "label", parallelism: int = 4) -> SearchResult:
    """M3: the same scores as ``grid_search`` over a leak-free pipeline, but scaling, elimination and
    oversampling, which no candidate changes, are fitted once per fold (on that fold's training rows alone) and
    shared by all candidates.  Candidates that are trees are grown together over all folds; others one by one."""
    data = data.withColumn(label, F.col(label).cast("double"))
    scaler, chooser, last = pipeline.getStages()
    cols = scaler.getOrDefault(scaler.inputCols)
    sides = fold_scalers(data, cols, n_folds, fold_col)
    c = chooser.getOrDefault
    x = F.array(*[F.col(f).cast("double") for f in cols])       # bins, and so ranks, are the same before scaling
    k = min(c(chooser.k), len(cols))
    if k < len(cols):
        rows = bin_rows(keyed_rows(training_sides(data, n_folds, fold_col), x, label, F.lit(0), F.col("side")))
        kept = eliminate(rows, {f: [k] for f in range(n_folds)}, c(chooser.step), c(chooser.rankerTrees),
                         c(chooser.rankerDepth), c(chooser.seed))
    else:
        kept = {(f, k): list(range(len(cols))) for f in range(n_folds)}
    inside = [PipelineModel([
        PopulationScalerModel(cols, [s[f][0] for f in cols], [s[f][1] for f in cols], scaler.getOrDefault(scaler.outputCol)),
        SelectorModel(kept[fold, k], c(chooser.inputCol), c(chooser.outputCol))]) for fold, s in enumerate(sides)]

    def balanced(fold: int) -> DataFrame:
        chosen = [inside[fold].stages[0].scaled(i) for i in kept[fold, k]]
        return last.balanced_columns(data.filter(F.col(fold_col) != fold), chosen)

    with ThreadPool(n_folds) as pool:
        rows = pool.map(inheritable_thread_target(data.sparkSession)(balanced), range(n_folds))
    if isinstance(last.estimator, _Trees):
        by_fold = _tree_scores(last, grid, rows, inside, data, fold_col, label, k)
    else:
        by_fold, evaluator = [], f1_evaluator(label)
        for fold in range(n_folds):
            held = cut_lineage(inside[fold].transform(data.filter(F.col(fold_col) == fold)))
            with ThreadPool(parallelism) as pool:
                by_fold.append(pool.map(inheritable_thread_target(data.sparkSession)(
                    lambda p, f=fold, h=held: evaluator.evaluate(last.fit_balanced(rows[f], p).transform(h))), grid))
    means = [sum(f[i] for f in by_fold) / n_folds for i in range(len(grid))]
    return SearchResult(means, None, [kept[f, k] for f in range(n_folds)], by_fold)


def _tree_scores(last: BalancedClassifier, grid: list[dict], rows: list[DataFrame], inside: list[PipelineModel],
                 data: DataFrame, fold_col: str, label: str, columns: int) -> list[list[float]]:
    """F1 of each candidate on each fold.  Forests that differ only in trees, depth and smallest split are one forest,
    as large as the largest, read with their own limits."""
    chosen = F.col(last.getOrDefault(last.featuresCol))
    every = [keyed_rows(r, vector_to_array(chosen), label, F.lit(0), F.lit(f)) for f, r in enumerate(rows)]
    held = [keyed_rows(m.transform(data.filter(F.col(fold_col) == f)), vector_to_array(chosen), label, F.lit(0), F.lit(f))
            for f, m in enumerate(inside)]
    plans = [last.estimator.copy(p).plan(0, (1.0, 1.0), columns) for p in grid]
    grown: dict[Fit, int] = {}
    variants = []
    for fold in range(len(rows)):
        for p in plans:
            whole = replace(p, group=fold)
            if p.kind == "forest":
                whole = replace(whole, trees=max(q.trees for q in plans), max_depth=max(q.max_depth for q in plans),
                                min_split=min(q.min_split for q in plans))
            at = grown.setdefault(whole, len(grown))
            variants.append((at, p.trees, p.max_depth, p.min_split))
    trees = grow(bin_rows(reduce(DataFrame.unionByName, every), written=True), list(grown))
    counts = held_confusion(trees, reduce(DataFrame.unionByName, held), variants)
    f1 = [f1_of(*counts[v]) if v in counts else 0.0 for v in range(len(variants))]
    return [f1[f * len(grid):(f + 1) * len(grid)] for f in range(len(rows))]


def param_grid(classifier, values: dict) -> list[dict]:
    """Cartesian grid over parameter names of ``classifier``."""
    b = ParamGridBuilder()
    for name, vs in values.items():
        b = b.addGrid(classifier.getParam(name), vs)
    return b.build()


def random_param_maps(classifier, space: dict, n_draws: int, seed: int = SEED) -> list[dict]:
    """M5: seeded random draws from ``space`` — each value is a list (choice),
    ("int", lo, hi), ("uniform", lo, hi), ("loguniform", lo, hi) or ("share", lo, hi),
    a uniform draw as text, as MLlib's featureSubsetStrategy takes it."""
    import math
    rng = random.Random(seed)
    maps = []
    for _ in range(n_draws):
        m = {}
        for name, spec in space.items():
            p = classifier.getParam(name)
            if isinstance(spec, list):
                m[p] = rng.choice(spec)
            elif spec[0] == "int":
                m[p] = rng.randint(spec[1], spec[2])
            elif spec[0] == "uniform":
                m[p] = rng.uniform(spec[1], spec[2])
            elif spec[0] == "share":
                m[p] = f"{rng.uniform(spec[1], spec[2]):.4f}"
            else:
                m[p] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        maps.append(m)
    return maps


def search_results(cv_model, grid: list[dict]) -> list[tuple[str, float]]:
    """(params as JSON, mean CV F1) per candidate."""
    out = []
    for pm, score in zip(grid, cv_model.avgMetrics):
        out.append((json.dumps({p.name: (v if not hasattr(v, "item") else v.item()) for p, v in pm.items()},
                               sort_keys=True), float(score)))
    return out


def best_params(cv_model, grid: list[dict]) -> dict:
    import numpy as np
    i = int(np.argmax(cv_model.avgMetrics))  # first best wins ties
    return grid[i]


def selected_indices(pipeline_model) -> list[int]:
    """Indices (into the scaler's input columns) that the fitted RFE kept."""
    return list(pipeline_model.stages[1].indices)


def deployable_fit(train: DataFrame, key: str, selected: list[str], classifier, label: str = "label",
                   seed: int = SEED):
    """M6: SMOTE once on the RAW selected features, fit the population scaler
    on the resampled rows, then the classifier (T16 order)."""
    bal = smote(train.select(key, *selected, label), key, selected, label, seed=seed)
    bal = cut_lineage(bal.select(*selected, F.col(label).cast("double").alias(label)))
    scaler = PopulationScaler(inputCols=selected, outputCol="features").fit(bal)
    clf = classifier.copy().setFeaturesCol("features").setLabelCol(label).fit(scaler.transform(bal))
    return scaler, clf


def feature_importances(clf_model, features: list[str]) -> list[tuple[str, float]]:
    """M8: importances by feature name."""
    imp = clf_model.featureImportances.toArray() if hasattr(clf_model, "featureImportances") else \
        [0.0] * len(features)
    return [(f, float(w)) for f, w in zip(features, imp)]

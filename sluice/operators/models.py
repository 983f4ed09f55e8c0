"""Classifiers, the features in front of them, and what comes out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import RFormulaModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import CONVERTED, NOT_CONVERTED, class_name, quoted
from sluice.operators.boosting import L1BoostedClassifier
from sluice.operators.clean import categorical_columns, numeric_columns
from sluice.operators.impute import SUFFIX, Imputation, columns_with_gaps, fit_imputation
from sluice.operators.encode import (
    TargetEncoding, assembler, check_categories, class_names, fit_target_encoding,
    formula_encoder, scaler, string_indexer, vector_names,
)

#: Class texts behind the 0/1 label.
BINARY = (CONVERTED, NOT_CONVERTED)
SEED = 42
#: Spark's own number of split candidates per column.
DEFAULT_BINS = 32
#: Rows that justify one more task in iterative training.
ROWS_PER_TASK = 50_000


@dataclass(frozen=True)
class Recipe:
    """What to train: predictors, how to encode them, and the classifier."""

    name: str
    predictors: tuple[str, ...]
    label: str
    stages: tuple[Estimator, ...]
    classifier: Estimator
    target_means: tuple[str, ...] = ()
    indexed: tuple[str, ...] = ()
    features: str = "inp_features"
    classifier_label: str = "label"
    #: Number columns with gaps in the training rows.
    gaps: tuple[str, ...] = ()

    def with_classifier(self, **params) -> "Recipe":
        """The same recipe with other classifier parameters."""
        clone = self.classifier.copy({self.classifier.getParam(k): v for k, v in params.items()})
        return replace(self, classifier=clone)


@dataclass(frozen=True)
class FittedFeatures:
    encoding: TargetEncoding | None
    stages: PipelineModel
    classes: tuple[str, ...]
    imputation: Imputation = Imputation({})

    def transform(self, df: DataFrame) -> DataFrame:
        filled = self.imputation.transform(df)
        encoded = self.encoding.transform(filled) if self.encoding else filled
        absent = [name for name in self._labels() if name not in df.columns]
        # An indexed label that leads lack would fail, or drop them as unseen.
        known = encoded.withColumns({name: F.lit(self.classes[0]) for name in absent})
        return self.stages.transform(known).drop(*absent, *[name + "_enc" for name in absent])

    def _labels(self) -> list[str]:
        """Text labels that a formula indexes."""
        formulas = [s.getFormula() for s in self.stages.stages if isinstance(s, RFormulaModel)]
        names = [f.split("~")[0].strip() for f in formulas]
        return [n for n in names if n != "label"]


@dataclass(frozen=True)
class FunnelModel:
    """A fitted model together with the texts of its classes."""

    features: FittedFeatures
    classifier: Model = field(repr=False)
    name: str = "model"

    @property
    def classes(self) -> tuple[str, ...]:
        return self.features.classes

    def score(self, leads: DataFrame) -> DataFrame:
        """Add ``prediction``, ``probability`` and the text ``predicted_status``.

        Leads need no label; a stream is scored like a table.  Numbers that were
        missing in training too are filled.  Leads that lack one which never was
        are left out, unless the recipe keeps them; see ``coverage``.
        """
        scored = self.classifier.transform(self.features.transform(leads))
        return scored.withColumn("predicted_status", class_name(F.col("prediction"), self.classes))

    def save(self, path: str) -> None:
        stages = PipelineModel([*self.features.stages.stages, self.classifier])
        stages.write().overwrite().save(f"{path}/stages")
        encoding = self.features.encoding
        if encoding:
            encoding.save(f"{path}/target-means")
        imputation = self.features.imputation
        if imputation.medians:
            imputation.save(f"{path}/medians")
        SparkSession.active().createDataFrame(
            [(self.name, list(self.classes), encoding is not None, bool(imputation.medians))],
            "name string, classes array<string>, encoded boolean, imputed boolean",
        ).write.mode("overwrite").parquet(f"{path}/header")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FunnelModel":
        header = spark.read.parquet(f"{path}/header").first()
        *features, classifier = PipelineModel.load(f"{path}/stages").stages
        encoding = (TargetEncoding.load(spark, f"{path}/target-means")
                    if header["encoded"] else None)
        imputation = Imputation({})
        if "imputed" in header and header["imputed"]:  # models saved before had no medians
            imputation = Imputation.load(spark, f"{path}/medians")
        return cls(FittedFeatures(encoding, PipelineModel(features), tuple(header["classes"]), imputation),
                   classifier, header["name"])


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Hold a frame that is about to be read many times, with work for every core.

    The cache is only a cache: a lost part is computed again from its source.
    """
    held = df.persist()
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        # Counting fills the cache, so that asking for the partitions is free.
        tasks = min(cores, held.count() // ROWS_PER_TASK)
        if held.rdd.getNumPartitions() < tasks:
            spread = held.repartition(tasks).persist()
            spread.count()
            held.unpersist()
            held = spread
        yield held
    finally:
        held.unpersist()


def training_frame(recipe: Recipe, train: DataFrame) -> DataFrame:
    return train.select(*[quoted(c) for c in (*recipe.predictors, recipe.label)])


def fit_features(recipe: Recipe, frame: DataFrame,
                 means_on: DataFrame | None = None) -> FittedFeatures:
    """Fit everything in front of the classifier, on the training rows.

    ``means_on`` names other rows for the target means, such as all rows, which
    shows the model the labels of the held-out ones.
    """
    imputation = fit_imputation(frame, recipe.gaps)
    frame = imputation.transform(frame)
    encoding = None
    if recipe.target_means:
        encoding = fit_target_encoding(frame if means_on is None else means_on,
                                       recipe.target_means, recipe.label)
        frame = encoding.transform(frame)
    check_categories(frame, recipe.indexed)
    stages = Pipeline(stages=list(recipe.stages)).fit(frame)
    names = class_names(stages.transform(frame), recipe.classifier_label)
    return FittedFeatures(encoding, stages, tuple(names or BINARY), imputation)


def fit(recipe: Recipe, train: DataFrame, means_on: DataFrame | None = None) -> FunnelModel:
    with kept(training_frame(recipe, train)) as frame:
        features = fit_features(recipe, frame, means_on)
        ready = features.transform(frame).select(recipe.features, recipe.classifier_label)
        return FunnelModel(features, recipe.classifier.fit(ready), recipe.name)


# -- recipes ----------------------------------------------------------------
# Numbers that are missing among the rows a recipe is made for are filled with
# the median, and a column beside them says where.

def _gaps(train: DataFrame, predictors: Sequence[str]) -> tuple[str, ...]:
    return tuple(columns_with_gaps(train, predictors))


def _predictors(train: DataFrame, label: str, exclude: Sequence[str]) -> tuple[str, ...]:
    skip = {label, *exclude}
    return tuple(c for c in [*numeric_columns(train), *categorical_columns(train)] if c not in skip)


def logistic(train: DataFrame, label: str, exclude: Sequence[str] = (),
             target_means: Sequence[str] = (), max_iter: int = 1680, threshold: float = 0.5,
             handle_invalid: str = "skip") -> Recipe:
    """Formula encoding, scaling, logistic regression.

    The label may be the status text or the 0/1 label.  ``handle_invalid``
    says what becomes of rows with an unseen category: ``skip`` leaves them
    unscored, ``keep`` gives them a level of their own.
    """
    predictors = _predictors(train, label, exclude)
    texts = tuple(c for c in categorical_columns(train) if c in predictors and c not in target_means)
    return Recipe(
        "logistic", predictors, label,
        (formula_encoder(label, handle_invalid=handle_invalid), scaler()),
        LogisticRegression(featuresCol="sc_features", labelCol=f"{label}_enc",
                           maxIter=max_iter, threshold=threshold),
        target_means=tuple(target_means), indexed=texts, features="sc_features",
        classifier_label=f"{label}_enc", gaps=_gaps(train, predictors))


def _mean_encoded(train: DataFrame, label: str, exclude: Sequence[str]):
    predictors = _predictors(train, label, exclude)
    texts = tuple(c for c in categorical_columns(train) if c in predictors)
    gaps = _gaps(train, predictors)
    return predictors, texts, gaps, (assembler([*predictors, *[c + SUFFIX for c in gaps]], handle_invalid="skip"),)


def forest(train: DataFrame, label: str = "label", exclude: Sequence[str] = (),
           trees: int = 20, depth: int = 5, seed: int = SEED) -> Recipe:
    """Target means and a random forest."""
    predictors, texts, gaps, stages = _mean_encoded(train, label, exclude)
    return Recipe("forest", predictors, label, stages,
                  RandomForestClassifier(featuresCol="inp_features", labelCol=label,
                                         numTrees=trees, maxDepth=depth, seed=seed),
                  target_means=texts, classifier_label=label, gaps=gaps)


def boosted(train: DataFrame, label: str = "label", exclude: Sequence[str] = (),
            rounds: int = 20, depth: int = 5, step: float = 0.1, seed: int = SEED) -> Recipe:
    """Target means and gradient-boosted trees with logistic loss."""
    predictors, texts, gaps, stages = _mean_encoded(train, label, exclude)
    return Recipe("boosted", predictors, label, stages, _boosting(label, rounds, depth, step, seed),
                  target_means=texts, classifier_label=label, gaps=gaps)


def penalised(train: DataFrame, label: str = "label", exclude: Sequence[str] = (), rounds: int = 20,
              depth: int = 6, step: float = 0.3, alpha: float = 0.0) -> Recipe:
    """Target means and boosted trees with an L1 penalty ``alpha`` on their leaf weights."""
    predictors, texts, gaps, stages = _mean_encoded(train, label, exclude)
    return Recipe("penalised", predictors, label, stages,
                  L1BoostedClassifier(featuresCol="inp_features", labelCol=label, maxIter=rounds, maxDepth=depth,
                                      stepSize=step, alpha=alpha),
                  target_means=texts, classifier_label=label, gaps=gaps)


def indexed_boosted(train: DataFrame, label: str = "label", exclude: Sequence[str] = (),
                    rounds: int = 20, depth: int = 5, step: float = 0.1,
                    max_bins: int | None = None, seed: int = SEED) -> Recipe:
    """Frequency indices instead of target means in front of the boosted trees.

    ``max_bins`` has to cover the widest indexed column and its slot for
    unseen categories; by default it is taken from the data.
    """
    predictors = _predictors(train, label, exclude)
    texts = tuple(c for c in categorical_columns(train) if c in predictors)
    if max_bins is None:
        check_categories(train, texts)
        widest = max(train.agg(
            F.lit(0), *[F.count_distinct(quoted(c)) for c in texts]).first())
        max_bins = max(DEFAULT_BINS, widest + 1)
    gaps = _gaps(train, predictors)
    numbers = [*[c for c in predictors if c not in texts], *[c + SUFFIX for c in gaps]]
    stages = (string_indexer(texts), assembler([*numbers, *[c + "_si" for c in texts]],
                                               handle_invalid="skip"))
    classifier = _boosting(label, rounds, depth, step, seed)
    return Recipe("indexed_boosted", predictors, label, stages,
                  classifier.copy({classifier.maxBins: max_bins}),
                  indexed=texts, classifier_label=label, gaps=gaps)


def _boosting(label: str, rounds: int, depth: int, step: float, seed: int) -> GBTClassifier:
    return GBTClassifier(featuresCol="inp_features", labelCol=label, lossType="logistic",
                         maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed)


# -- importances ------------------------------------------------------------

def feature_importance(model: FunnelModel, recipe: Recipe, sample: DataFrame) -> DataFrame:
    """Importance per feature, most important first, ties by name.

    Names come from the vector's metadata, so a one-hot slot shows the level it
    stands for.  One row per feature; no data is read.
    """
    names = vector_names(model.features.transform(sample), recipe.features)
    weights = model.classifier.featureImportances.toArray().tolist()
    return (SparkSession.active()
            .createDataFrame(list(zip(names, weights)), "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))

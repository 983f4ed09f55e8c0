"""Hyper-parameter search on the validation split.

The features are fitted once per search and kept for all trials; classifier
fits run side by side.  A cut-off does not change a fit, nor does an iteration
cap that was not reached, so trials that differ in nothing else share one model
and one scan of the validation rows.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.evaluate import threshold_sweep, weighted_f1
from sluice.operators.models import (
    FittedFeatures, FunnelModel, Recipe, fit, fit_features, kept, training_frame,
)
from sluice.operators.propose import propose
from sluice.sources.tables import append_runs, run_records

CUT_OFF = "threshold"
CAP = "maxIter"


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)

    def settle(self, value):
        """A drawn value as a trial has it."""
        return value

    def read(self, text: str):
        """A value as the run table has it."""
        return next(v for v in self.values if str(v) == text)


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def draw(self, rng: random.Random):
        return self.settle(rng.uniform(self.low, self.high))

    def settle(self, value):
        return value

    def read(self, text: str):
        return float(text)


@dataclass(frozen=True)
class Stepped:
    """A uniform draw rounded to a multiple of ``step``."""

    low: float
    high: float
    step: int

    def draw(self, rng: random.Random):
        return self.settle(rng.uniform(self.low, self.high))

    def settle(self, value):
        return round(value / self.step) * self.step

    def read(self, text: str):
        return int(text)


@dataclass(frozen=True)
class SearchSpace:
    name: str
    params: Mapping[str, Choice | Uniform | Stepped]
    trials: int


# The search spaces and their numbers of trials.  An evaluation
# metric would only be reported, so it is left out.  Spark's own boosted trees
# have no L1 penalty on leaf weights; the penalised ones do.
LOGISTIC_SPACE = SearchSpace(
    "logistic", {"maxIter": Choice((100, 150, 200, 250, 300)), CUT_OFF: Uniform(0.4, 0.9)}, 10)
LOGISTIC_WIDE_SPACE = SearchSpace(
    "logistic_wide", {"maxIter": Stepped(100, 2000, 10), CUT_OFF: Uniform(0.1, 0.9)}, 32)
FOREST_SPACE = SearchSpace(
    "forest", {"maxDepth": Stepped(5, 15, 3), "numTrees": Stepped(100, 500, 10)}, 9)
BOOSTED_SPACE = SearchSpace(
    "boosted", {"maxDepth": Choice((5, 7, 10)), "stepSize": Choice((0.1, 0.2, 0.3))}, 54)
PENALISED_SPACE = SearchSpace(
    "penalised", {"maxDepth": Choice((5, 7, 10)), "alpha": Choice((0.01, 0.05, 0.1)),
                  "stepSize": Choice((0.1, 0.2, 0.3))}, 54)


def draw_trials(space: SearchSpace, trials: int | None = None, seed: int = 42) -> list[dict]:
    """The full grid where the trials cover it, else seeded random draws."""
    wanted = trials or space.trials
    if all(isinstance(p, Choice) for p in space.params.values()):
        grid = list(itertools.product(*[p.values for p in space.params.values()]))
        if len(grid) <= wanted:
            return [dict(zip(space.params, point)) for point in grid]
    rng = random.Random(seed)
    return [{name: p.draw(rng) for name, p in space.params.items()} for _ in range(wanted)]


@dataclass(frozen=True)
class SearchResult:
    """Trials as driver-side rows: there is one per fitted model or cut-off."""

    recipe: Recipe
    features: FittedFeatures
    trials: tuple[tuple[int, dict, float], ...]

    @property
    def best(self) -> dict:
        """Highest F1; the earliest trial of several."""
        return min(self.trials, key=lambda t: (-t[2], t[0]))[1]

    def frame(self, spark: SparkSession) -> DataFrame:
        return (run_records(spark, self.recipe.name, "weighted_f1", self.trials)
                .orderBy(F.desc("value"), "trial_id"))


@contextmanager
def _prepared(recipe: Recipe, train: DataFrame, validation: DataFrame, means_on: DataFrame | None
              ) -> Iterator[tuple[FittedFeatures, DataFrame, DataFrame]]:
    """Features fitted once, and both splits with them, kept for all trials."""
    columns = (recipe.features, recipe.classifier_label)
    with ExitStack() as held:
        with kept(training_frame(recipe, train)) as frame:
            features = fit_features(recipe, frame, means_on)
            ready = held.enter_context(kept(features.transform(frame).select(*columns)))
        unseen = held.enter_context(kept(features.transform(validation).select(*columns)))
        yield features, ready, unseen


def _scores(recipe: Recipe, ready: DataFrame, unseen: DataFrame, trials: Sequence[Mapping[str, object]],
            parallelism: int) -> dict[int, float]:
    """The trials' F1 by their place; trials that can share a fit do."""
    capped = isinstance(recipe.classifier, LogisticRegression)
    fits: dict[tuple, dict[int, Mapping[str, object]]] = {}
    for i, trial in enumerate(trials):
        shared = {CUT_OFF, CAP} if capped else {CUT_OFF}
        key = tuple(sorted((k, v) for k, v in trial.items() if k not in shared))
        fits.setdefault(key, {})[i] = trial

    def run(group: Mapping[int, Mapping[str, object]]) -> dict[int, float]:
        scores: dict[int, float] = {}
        while left := {i: t for i, t in group.items() if i not in scores}:
            model, members = _fit_largest(recipe, ready, left)
            scores |= _trial_scores(recipe, model.transform(unseen), members)
        return scores

    scores: dict[int, float] = {}
    with ThreadPool(min(parallelism, len(fits))) as pool:
        for part in pool.imap_unordered(run, fits.values()):
            scores |= part
    return scores


def param_search(recipe: Recipe, train: DataFrame, validation: DataFrame,
                 trials: Sequence[Mapping[str, object]], parallelism: int = 4,
                 means_on: DataFrame | None = None) -> SearchResult:
    """Fit the trials on the training rows and score them on the validation rows."""
    with _prepared(recipe, train, validation, means_on) as (features, ready, unseen):
        scores = _scores(recipe, ready, unseen, trials, parallelism)
    return SearchResult(recipe, features,
                        tuple((i, dict(t), scores[i]) for i, t in enumerate(trials)))


def recorded_trials(spark: SparkSession, space: SearchSpace, runs_table: str, run_name: str
                    ) -> list[tuple[int, dict, float]]:
    """Trials that the run table has of ``run_name`` with all parameters of the space, by number."""
    if not spark.catalog.tableExists(runs_table):
        return []
    rows = (spark.table(runs_table).where((F.col("run_name") == run_name) & (F.col("metric") == "weighted_f1")
                                          & F.col("value").isNotNull())
            .select("trial_id", "params", "value").collect())  # one row per fitted model
    found = {r["trial_id"]: ({name: p.read(r["params"][name]) for name, p in space.params.items()}, r["value"])
             for r in rows if space.params.keys() <= r["params"].keys()}
    return [(i, *found[i]) for i in sorted(found)]


def adaptive_search(recipe: Recipe, train: DataFrame, validation: DataFrame, space: SearchSpace,
                    trials: int | None = None, batch: int = 4, startup: int | None = None, seed: int = 42,
                    runs_table: str | None = None, run_name: str | None = None,
                    means_on: DataFrame | None = None) -> SearchResult:
    """A search whose trials follow from the scores of those before.

    Trials come in batches that fit side by side; the first ``startup`` of them
    (a third by default) are random.  With a ``runs_table`` each batch is recorded
    under ``run_name`` (the recipe's name by default) once it is scored, and
    a search that finds trials there goes on from them: one that was cut off
    repeats a batch at most.
    """
    wanted = trials or space.trials
    startup = -(-wanted // 3) if startup is None else startup
    run_name = run_name or recipe.name
    spark = train.sparkSession
    done = recorded_trials(spark, space, runs_table, run_name)[:wanted] if runs_table else []
    with _prepared(recipe, train, validation, means_on) as (features, ready, unseen):
        while len(done) < wanted:
            proposed = propose(space.params, [(t, v) for _, t, v in done], min(batch, wanted - len(done)),
                               startup, seed)
            scores = _scores(recipe, ready, unseen, proposed, batch)
            first = max((i for i, _, _ in done), default=-1) + 1
            new = [(first + i, t, scores[i]) for i, t in enumerate(proposed)]
            if runs_table:
                append_runs(run_records(spark, run_name, "weighted_f1", new), runs_table)
            done += new
    return SearchResult(recipe, features, tuple(done))


def _fit_largest(recipe: Recipe, ready: DataFrame, trials: Mapping[int, Mapping[str, object]]
                 ) -> tuple[Model, dict[int, Mapping[str, object]]]:
    """One fit, and the trials it stands for.

    A fit that converged before its iteration cap is the fit of every cap from
    there on, so the trial with the largest cap goes first.
    """
    cap = {i: t.get(CAP) for i, t in trials.items()}
    first = max(trials, key=lambda i: cap[i] or 0)
    params = {recipe.classifier.getParam(k): v for k, v in trials[first].items() if k != CUT_OFF}
    model = recipe.classifier.copy(params).fit(ready)
    if not isinstance(recipe.classifier, LogisticRegression) or cap[first] is None:
        return model, {i: t for i, t in trials.items() if cap[i] == cap[first]}
    needed = model.summary.totalIterations
    return model, {i: t for i, t in trials.items()
                   if cap[i] == cap[first] or (cap[i] or 0) >= needed}


def _trial_scores(recipe: Recipe, scored: DataFrame,
                  trials: Mapping[int, Mapping[str, object]]) -> dict[int, float]:
    """F1 of the trials that share one fitted model."""
    cuts = {i: float(t[CUT_OFF]) for i, t in trials.items() if CUT_OFF in t}
    if not cuts:
        f1 = weighted_f1(scored, recipe.classifier_label).first()["weighted_f1"]
        return dict.fromkeys(trials, f1)
    if len(cuts) < len(trials):
        raise ValueError("either all trials set a cut-off or none does")
    sweep = threshold_sweep(scored.withColumn("_score", vector_to_array("probability")[1]),
                            recipe.classifier_label, "_score", list(cuts.values()))
    by_cut = {r["threshold"]: r["weighted_f1"] for r in sweep.collect()}
    return {i: by_cut[t] for i, t in cuts.items()}


def retrain(recipe: Recipe, best: Mapping[str, object], train: DataFrame,
            means_on: DataFrame | None = None) -> FunnelModel:
    """Fit the best trial's parameters on the training rows."""
    return fit(recipe.with_classifier(**best), train, means_on)

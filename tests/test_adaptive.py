import random
import statistics

import pytest

from sluice.operators import models, tune
from sluice.operators.propose import propose

SPACE = tune.SearchSpace("planted", {
    "a": tune.Uniform(0.0, 1.0), "b": tune.Stepped(10, 200, 10), "c": tune.Choice(("x", "y", "z"))}, 40)


def surface(t):
    """One narrow peak at a = 0.73, b = 150, c = y."""
    return -abs(t["a"] - 0.73) - abs(t["b"] - 150) / 190 - (0.0 if t["c"] == "y" else 0.3)


def search(seed, trials=40, batch=4):
    history = []
    while len(history) < trials:
        for t in propose(SPACE.params, history, min(batch, trials - len(history)), 12, seed):
            history.append((t, surface(t)))
    return history


def test_beats_random_draws_at_equal_trials():
    ours = [max(v for _, v in search(seed)) for seed in range(30)]
    theirs = [max(map(surface, tune.draw_trials(SPACE, 40, seed))) for seed in range(30)]
    assert statistics.mean(ours) > statistics.mean(theirs) + 0.02
    assert sum(a > b for a, b in zip(ours, theirs)) >= 20


def test_proposals_stay_in_the_space_and_follow_from_history():
    history = search(5)
    for t, _ in history:
        assert 0.0 <= t["a"] <= 1.0 and t["b"] in range(10, 201, 10) and t["c"] in ("x", "y", "z")
    assert search(5) == history and search(6) != history
    late = [t for t, _ in history[24:]]
    assert sum(t["c"] == "y" for t in late) > len(late) / 2
    batch = propose(SPACE.params, history[:20], 6, 12, 1)
    assert len({t["a"] for t in batch}) == 6


def test_first_trials_are_random_and_ties_do_no_harm():
    assert len(propose(SPACE.params, [], 3, 0)) == 3
    same = [(t, 0.5) for t in tune.draw_trials(SPACE, 9)]
    assert len(propose(SPACE.params, same, 2, 4)) == 2
    point = {"a": tune.Uniform(0.5, 0.5), "c": tune.Choice(("x",))}
    assert propose(point, [({"a": 0.5, "c": "x"}, 1.0)] * 3, 1, 0) == [{"a": 0.5, "c": "x"}]


def test_search_goes_on_from_the_run_table(spark):
    rng = random.Random(2)
    rows = [(i, rng.random(), rng.choice("pqr")) for i in range(600)]
    rows = [(i, x, k, 1.0 if x + rng.gauss(0, 0.2) > 0.6 else 0.0) for i, x, k in rows]
    leads = spark.createDataFrame(rows, "id int, x double, kind string, label double")
    train, validation = leads.where("id < 400"), leads.where("id >= 400")
    recipe = models.logistic(leads, "label", ("id",))
    spark.sql("DROP TABLE IF EXISTS adaptive_test")
    space = tune.LOGISTIC_WIDE_SPACE
    half = tune.adaptive_search(recipe, train, validation, space, 6, batch=3, startup=3, runs_table="adaptive_test")
    assert [i for i, _, _ in half.trials] == list(range(6))
    whole = tune.adaptive_search(recipe, train, validation, space, 10, batch=3, startup=3,
                                 runs_table="adaptive_test")
    assert whole.trials[:6] == half.trials and [i for i, _, _ in whole.trials] == list(range(10))
    assert spark.table("adaptive_test").count() == 10
    assert tune.recorded_trials(spark, space, "adaptive_test", recipe.name) == list(whole.trials)
    assert tune.recorded_trials(spark, space, "adaptive_test", "other") == []
    again = tune.adaptive_search(recipe, train, validation, space, 10, runs_table="adaptive_test")
    assert again.trials == whole.trials and spark.table("adaptive_test").count() == 10
    at_once = tune.param_search(recipe, train, validation, [t for _, t, _ in whole.trials])
    assert [v for *_, v in at_once.trials] == pytest.approx([v for *_, v in whole.trials], abs=1e-3)
    spark.sql("DROP TABLE adaptive_test")

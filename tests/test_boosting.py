import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sluice.operators import boosting, evaluate, models, tune
from sluice.operators.split import split


def table(spark, n=160, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.0]), rng.random()
        rows.append((i, a, b, c, 1.0 if a + 0.7 * b + rng.gauss(0, 0.5) > 0.8 else 0.0))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double")
    return rows, VectorAssembler(inputCols=["a", "b", "c"], outputCol="inp_features").transform(df)


def brute(rows, edges, rounds, depth, step, alpha, l2, least):
    """Probabilities of the training rows, every split tried row by row."""
    def shrink(g):
        return math.copysign(max(abs(g) - alpha, 0.0), g)

    def grow(members, g, h, level):
        G, H = sum(g[i] for i in members), sum(h[i] for i in members)
        best = None
        if level < depth:
            for f in range(3):
                for e in edges[f]:
                    left = [i for i in members if rows[i][1 + f] <= e]
                    gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                    if hl < least or H - hl < least:
                        continue
                    gain = round((shrink(gl) ** 2 / (hl + l2) + shrink(G - gl) ** 2 / (H - hl + l2)
                                  - shrink(G) ** 2 / (H + l2)) / 2, boosting.DIGITS)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, e, left)
        if best is None:
            return dict.fromkeys(members, -step * shrink(G) / (H + l2))
        inside = set(best[3])
        return grow(best[3], g, h, level + 1) | grow([i for i in members if i not in inside], g, h, level + 1)

    m = [0.0] * len(rows)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-x)) for x in m]
        values = grow(list(range(len(rows))), [q - r[4] for q, r in zip(p, rows)], [q * (1 - q) for q in p], 0)
        m = [x + values[i] for i, x in enumerate(m)]
    return [1 / (1 + math.exp(-x)) for x in m]


@pytest.mark.parametrize("alpha, depth", [(0.0, 3), (0.6, 2), (4.0, 3)])
def test_like_brute_force(spark, alpha, depth):
    rows, df = table(spark)
    given = df.select(vector_to_array("inp_features").alias("x"))
    edges = boosting.bin_edges(given, 3, 8)
    fitted = boosting.L1BoostedClassifier(maxIter=3, maxDepth=depth, stepSize=0.4, alpha=alpha, maxBins=8).fit(df)
    got = [r[0] for r in fitted.transform(df).orderBy("id").select(vector_to_array("probability")[1]).collect()]
    assert got == pytest.approx(brute(rows, edges, 3, depth, 0.4, alpha, 1.0, 1.0), abs=1e-9)


def test_a_large_penalty_leaves_nothing(spark):
    _, df = table(spark)
    fitted = boosting.L1BoostedClassifier(maxIter=3, alpha=1000.0).fit(df)
    assert fitted.forest == []
    assert {r.prediction for r in fitted.transform(df).collect()} == {0.0}
    with pytest.raises(ValueError, match="no rows"):
        boosting.L1BoostedClassifier().fit(df.where("false"))


def test_weights_shrink_with_alpha(spark):
    _, df = table(spark)
    sizes = []
    for alpha in (0.0, 1.0, 5.0):
        tree = boosting.L1BoostedClassifier(maxIter=1, maxDepth=2, alpha=alpha).fit(df).forest[0]
        sizes.append(max(map(abs, tree.value)))
    assert sizes[0] > sizes[1] > sizes[2] > 0


def test_signal_is_found_saved_and_searched(spark, tmp_path):
    _, df = table(spark, 1200, 9)
    leads = df.drop("inp_features")
    train, validation, test = split(leads, ["id"])
    recipe = models.penalised(train, exclude=("id",), rounds=4, depth=3, alpha=0.05)
    model = models.fit(recipe, train)
    scored = model.score(test)
    assert evaluate.scorecard(scored, "label").first().weighted_f1 > 0.8
    model.save(str(tmp_path / "m"))
    again = models.FunnelModel.load(spark, str(tmp_path / "m"))
    key = lambda d: sorted((r.id, r.prediction, r.predicted_status) for r in d.collect())
    assert key(again.score(test)) == key(scored)
    found = tune.param_search(recipe, train, validation, [{"maxDepth": 2, "alpha": a, "stepSize": 0.3} for a in (0.05, 500.0)])
    assert found.best["alpha"] == 0.05
    assert len(tune.draw_trials(tune.PENALISED_SPACE)) == 27

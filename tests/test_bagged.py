"""Forests on packed blocks, against a plain tree grower with the same draws."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler

from riskloom.operators import bagged, trees
from riskloom.operators.bagged import BaggedForest, ForestModel
from riskloom.operators.models import VECTOR

NAMES = list("abcd")
N = 400


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 9, (N, 4)).astype(float)
    y = ((x[:, 0] > 4) & (x[:, 1] < 6) | (x[:, 2] > 7)).astype(float)
    z = 1e6 + x[:, 0] * 0.5 + (x[:, 3] > 2)
    pdf = pd.DataFrame(x, columns=NAMES).assign(y=y, z=z, three=(x[:, 0] // 3))
    df = VectorAssembler(inputCols=NAMES, outputCol=VECTOR).transform(spark.createDataFrame(pdf).coalesce(1)).cache()
    return df, x, pdf


def plain(x, target, times, node, tree, seed, many, depth):
    """Score of a plain recursive tree at each row, nodes numbered in the order of levels as (place in the level's list)."""
    out, numbers = np.zeros(len(x)), iter(range(1, 10**6))
    level = [(0, np.arange(len(x)))]
    for d in range(depth + 1):
        below = []
        for number, rows in level:
            w, t = times[rows], target[rows]
            mean = (w * t).sum() / w.sum()
            out[rows] = mean
            best = (0.0, None)
            if d < depth:
                for f in np.random.default_rng([seed, tree, 0, number]).permutation(x.shape[1])[:many]:
                    values = np.unique(x[:, f])
                    for cut in values[:-1]:
                        low = x[rows, f] <= cut
                        a, b = w[low].sum(), w[~low].sum()
                        if a > 0 and b > 0:
                            p, q = (w * t)[low].sum() / a, (w * t)[~low].sum() / b
                            gain = a * b / (a + b) * (p - q) ** 2
                            if gain > best[0] * (1 + 1e-9) and abs(p - q) > 1e-9:
                                best = (gain, low)
            if best[1] is not None:
                below += [(next(numbers), rows[best[1]]), (next(numbers), rows[~best[1]])]
        level = below
    return out


@pytest.mark.parametrize("task, label", [("classifier", "y"), ("regressor", "z")])
def test_forest_equals_plain_trees(points, task, label):
    df, x, pdf = points
    model = BaggedForest(featuresCol=VECTOR, labelCol=label, task=task, trees=3, maxDepth=3, maxBins=256, columnShare=2, seed=5).fit(df)
    target = pdf[label].to_numpy()
    want = np.mean([plain(x, target, bagged.drawn(5, t, 0, N).astype(float), 0, t, 5, 2, 3) for t in range(3)], axis=0)
    found = model.transform(df).toPandas()
    score = found["prediction"] if task == "regressor" else np.array([p[1] for p in found["probability"]])
    assert np.allclose(score, want, rtol=1e-12, atol=1e-9)
    assert np.allclose(trees.flattened(model).score(x), want, rtol=1e-12, atol=1e-9)


def test_small_passes_give_the_same_forest(points, monkeypatch):
    df, _, _ = points
    forest = BaggedForest(featuresCol=VECTOR, labelCol="y", trees=4, maxDepth=4, maxBins=256)
    whole = forest.fit(df).getOrDefault("fitted")
    monkeypatch.setattr(bagged, "CELLS", 100)
    assert forest.fit(df).getOrDefault("fitted") == whole
    assert max(len(t["left"]) for t in whole["trees"]) > 9


def test_forest_of_three_classes_is_saved_and_read(points, tmp_path):
    df, x, _ = points
    model = BaggedForest(featuresCol=VECTOR, labelCol="three", trees=5, maxDepth=6, maxBins=256, columnShare="all").fit(df)
    model.write().save(f"{tmp_path}/m")
    for one in (model, ForestModel.load(f"{tmp_path}/m")):
        found = one.transform(df).toPandas()
        assert (found["prediction"] == x[:, 0] // 3).all()
        assert np.allclose([p.sum() for p in found["probability"]], 1)
    with pytest.raises(ValueError, match="class 1 of 2"):
        trees.flattened(model)


def test_forest_refuses_what_it_cannot_learn(points):
    df, _, _ = points
    for label, task in (("z - 0.5", "classifier"), ("-y", "classifier"), ("null", "regressor"), ("y + 200", "classifier")):
        with pytest.raises(ValueError):
            BaggedForest(featuresCol=VECTOR, labelCol="l", task=task, trees=2).fit(df.selectExpr(VECTOR, f"cast({label} as double) l"))


def test_tiny_and_constant_tables(points):
    df, _, _ = points
    one = df.limit(1)
    assert BaggedForest(featuresCol=VECTOR, labelCol="z", task="regressor", trees=2).fit(one).transform(one).first()["prediction"] == one.first()["z"]
    same = df.selectExpr(VECTOR, "0.1D l")
    model = BaggedForest(featuresCol=VECTOR, labelCol="l", task="regressor", trees=3).fit(same)
    assert all(t["left"] == [-1] for t in model.getOrDefault("fitted")["trees"])


def test_draws_are_poisson():
    times = bagged.drawn(1, 2, 3, 1_000_000)
    assert abs(times.mean() - 1) < 0.01 and abs(times.var() - 1) < 0.01 and abs((times == 0).mean() - np.exp(-1)) < 0.005

"""Leaf-wise boosting and exact contributions against plain computation."""

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from riskloom.operators import explain, trees
from riskloom.operators.leafwise import LeafwiseBooster, LeafwiseModel, reached
from riskloom.operators.models import VECTOR, make_estimator, score_column

NAMES = list("abcdef")


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 6)).round(2)
    y = ((x[:, 0] > 0.2) & (x[:, 1] < 0.5) | (x[:, 2] > 1.2)).astype(float)
    pdf = pd.DataFrame(x, columns=NAMES).assign(y=y, z=x[:, 0] * 2 + (x[:, 3] > 0), id=np.arange(len(x)))
    df = VectorAssembler(inputCols=NAMES, outputCol=VECTOR).transform(spark.createDataFrame(pdf)).coalesce(3).cache()
    return df, x, pdf


def expected(tree, x, known, node=0):
    if tree.left[node] < 0:
        return tree.value[node]
    low, high = tree.left[node], tree.right[node]
    if tree.feature[node] in known:
        return expected(tree, x, known, low if x[tree.feature[node]] <= tree.threshold[node] else high)
    return (tree.cover[low] * expected(tree, x, known, low) + tree.cover[high] * expected(tree, x, known, high)) / tree.cover[node]


def enumerated(ensemble, x):
    """Shapley values over all subsets."""
    d, out = len(x), np.zeros(len(x))
    for tree, weight in zip(ensemble.trees, ensemble.weights):
        value = {s: expected(tree, x, set(s)) for k in range(d + 1) for s in combinations(range(d), k)}
        for i in range(d):
            for s in value:
                if i not in s:
                    out[i] += weight * (value[tuple(sorted((*s, i)))] - value[s]) / (d * comb(d - 1, len(s)))
    return out


ESTIMATORS = {
    "tree": lambda: (DecisionTreeClassifier(featuresCol=VECTOR, labelCol="y", maxDepth=5), "probability"),
    "forest": lambda: (RandomForestClassifier(featuresCol=VECTOR, labelCol="y", numTrees=4, maxDepth=4, seed=1), "probability"),
    "boosted": lambda: (GBTClassifier(featuresCol=VECTOR, labelCol="y", maxIter=4, maxDepth=3, seed=1), "margin"),
    "forest_regressor": lambda: (RandomForestRegressor(featuresCol=VECTOR, labelCol="z", numTrees=3, maxDepth=4, seed=1), "value"),
    "boosted_regressor": lambda: (GBTRegressor(featuresCol=VECTOR, labelCol="z", maxIter=3, maxDepth=3, seed=1), "value"),
    "leafwise": lambda: (LeafwiseBooster(featuresCol=VECTOR, labelCol="y", trees=4, leaves=7), "logit"),
}


@pytest.mark.parametrize("name", ESTIMATORS)
def test_contributions_equal_all_subsets_and_add_up(points, name):
    df, x, _ = points
    estimator, scale = ESTIMATORS[name]()
    model = estimator.fit(df)
    ensemble = trees.flattened(model)
    for row in (0, 17):
        assert np.allclose(trees.explained(ensemble, x[row : row + 1])[0], enumerated(ensemble, x[row]), atol=1e-10)
    scored = {r["id"]: r for r in model.transform(df).collect()}
    total = {r["id"]: (r["t"], r["base"]) for r in trees.shapley_trees(model, df, "id", NAMES).groupBy("id", "base").agg({"contribution": "sum"}).withColumnRenamed("sum(contribution)", "t").collect()}
    assert len(total) == len(x)
    for key, (t, base) in total.items():
        row = scored[key]
        score = {
            "probability": lambda: row["probability"][1], "margin": lambda: row["rawPrediction"][1], "value": lambda: row["prediction"],
            "logit": lambda: np.log(row["probability"][1] / row["probability"][0]),
        }[scale]()
        assert t + base == pytest.approx(score, abs=1e-8)


def test_other_models_have_no_tree_contributions(points):
    df, _, _ = points
    with pytest.raises(TypeError, match="not a tree model"):
        trees.flattened(LinearRegression(featuresCol=VECTOR, labelCol="z").fit(df))


@pytest.mark.parametrize("coalitions", [10, 256])
def test_kernel_contributions_of_a_linear_model(points, coalitions):
    df, x, _ = points
    names = NAMES
    target = df.withColumn("t", sum(((k + 1.0) * df[c] for k, c in enumerate(names)), df["a"] * 0))
    model = LinearRegression(featuresCol=VECTOR, labelCol="t", solver="normal").fit(target)
    few = df.where("id < 6")
    found = explain.shapley_kernel(model, few, df, "id", names, coalitions=coalitions, background_rows=900, task="regressor").collect()
    for r in found:
        k = names.index(r["feature"])
        assert r["contribution"] == pytest.approx((k + 1) * (x[r["id"], k] - x[:, k].mean()), abs=1e-6)
    assert len(found) == 36


def test_kernel_over_all_coalitions_equals_all_subsets(points):
    df, x, _ = points
    model = DecisionTreeClassifier(featuresCol=VECTOR, labelCol="y", maxDepth=4).fit(df)
    ensemble = trees.flattened(model)
    found = explain.shapley_kernel(model, df.where("id = 5"), df.where("id < 20"), "id", NAMES, background_rows=20).collect()
    value = {}
    for k in range(7):
        for s in combinations(range(6), k):
            mixed = x[:20].copy()
            mixed[:, list(s)] = x[5, list(s)]
            value[s] = ensemble.score(mixed).mean()
    for r in found:
        i = NAMES.index(r["feature"])
        want = sum((value[tuple(sorted((*s, i)))] - value[s]) / (6 * comb(5, len(s))) for s in value if i not in s)
        assert r["contribution"] == pytest.approx(want, abs=1e-8) and r["base"] == pytest.approx(value[()])


def plain_tree(bins, gradient, curvature, leaves, least_rows):
    """Best-first growth, one split at a time; returns the leaf of every row."""
    at = np.zeros(len(bins), int)

    def best(leaf):
        mine, out = at == leaf, (0.0,)
        g, h = gradient[mine].sum(), curvature[mine].sum()
        for j in range(bins.shape[1]):
            for cut in range(bins[:, j].max()):
                low = mine & (bins[:, j] <= cut)
                n, gl, hl = low.sum(), gradient[low].sum(), curvature[low].sum()
                if min(n, mine.sum() - n) >= least_rows and min(hl, h - hl) >= 1e-3:
                    gain = gl**2 / hl + (g - gl) ** 2 / (h - hl) - g**2 / h
                    if gain > out[0] + 1e-9:
                        out = (gain, j, cut)
        return out

    splits = {0: best(0)}
    while len(splits) < leaves and max(s[0] for s in splits.values()) > 1e-12:
        leaf = max(splits, key=lambda k: splits[k][0])
        _, j, cut = splits[leaf]
        new = len(splits)
        at[(at == leaf) & (bins[:, j] > cut)] = new
        splits[leaf], splits[new] = best(leaf), best(new)
    return at


@pytest.mark.parametrize("leaves", [2, 5, 9])
def test_one_tree_equals_one_split_at_a_time(points, leaves):
    df, x, pdf = points
    model = LeafwiseBooster(featuresCol=VECTOR, labelCol="z", task="regressor", trees=1, learningRate=1.0, leaves=leaves, maxBins=8, leafRows=20).fit(df)
    (tree,) = model.ensemble().trees
    assert (tree.left < 0).sum() == leaves and min(tree.cover) >= 20
    ends = LeafwiseBooster._cuts(df.select(F.array(*NAMES).alias("x")), 6, 8)
    bins = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(ends)], 1)
    z = pdf["z"].to_numpy()
    wanted = plain_tree(bins, z.mean() - z, np.ones(len(z)), leaves, 20)
    found = tree.leaves_of(x)
    assert len(set(zip(wanted.tolist(), found.tolist()))) == leaves
    assert np.allclose(tree.value[found], [(z - z.mean())[wanted == w].mean() for w in wanted])


def test_limits_draws_and_saving(points, spark, tmp_path):
    df, x, pdf = points
    settings = dict(featuresCol=VECTOR, labelCol="y", trees=12, leaves=6, maxDepth=2, leafRows=30, leafPenalty=1.0, subsample=0.7, columnShare=0.5, seed=3)
    model = LeafwiseBooster(**settings).fit(df)
    for tree in model.ensemble().trees:
        assert (tree.left < 0).sum() <= 4 and min(tree.cover) >= 30
        assert len(set(tree.feature[tree.left >= 0])) <= 3
    again = LeafwiseBooster(**settings).fit(df)
    assert again.getOrDefault("fitted") == model.getOrDefault("fitted")
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = LeafwiseModel.load(str(tmp_path / "m"))
    scores = [[r["score"] for r in score_column(m, m.transform(df)).orderBy("id").collect()] for m in (model, loaded)]
    assert scores[0] == scores[1] and np.mean((np.array(scores[0]) > 0.5) == pdf["y"]) > 0.8


def test_edges(points, spark):
    df, _, _ = points
    flat = df.withColumn("one", df["a"] * 0 + 1)
    constant = LeafwiseBooster(featuresCol=VECTOR, labelCol="one").fit(flat)
    assert constant.ensemble().trees == [] and constant.transform(df).where("prediction <> 1").count() == 0
    assert constant.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="maxBins"):
        LeafwiseBooster(featuresCol=VECTOR, labelCol="y", maxBins=1000).fit(df)


def test_leaves_of_a_block_are_those_of_a_walk():
    """Also for more nodes than small numbers hold, and for a tree of one leaf."""
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 256, (3, 50)).astype(np.uint8)
    for leaves in (1, 2, 31, 9_000):
        feature, cut, left, right = [0], [0], [-1], [-1]
        while len(left) < 2 * leaves - 1:
            node = int(rng.choice(np.flatnonzero(np.array(left) < 0))) if leaves < 100 else len(left) - 1
            feature[node], cut[node] = int(rng.integers(3)), int(rng.integers(255)) if leaves < 100 else 0
            left[node], right[node] = len(left), len(left) + 1
            for column, value in ((feature, 0), (cut, 0), (left, -1), (right, -1)):
                column += [value] * 2
        want = []
        for row in bins.T:
            at = 0
            while left[at] >= 0:
                at = left[at] if row[feature[at]] <= cut[at] else right[at]
            want.append(at)
        assert reached(bins, *(np.array(x, np.int32) for x in (feature, cut, left, right))).tolist() == want


@pytest.mark.parametrize("task", ["classifier", "regressor"])
def test_boosting_is_that_of_mllib_without_its_rows_as_objects(points, task):
    """Few values a column, so both cut halfway between them; a job per level and tree, none for the leaves of a full tree."""
    df, _, _ = points
    coarse = VectorAssembler(inputCols=NAMES, outputCol=VECTOR).transform(df.drop(VECTOR).select("id", "y", "z", *[F.round(F.col(c) * 5) / 5 + F.lit(0.0) for c in NAMES]).toDF("id", "y", "z", *NAMES))
    label, kind = ("y", GBTClassifier) if task == "classifier" else ("z", GBTRegressor)
    ours = make_estimator("boosted", task, label, n_estimators=6, max_depth=3)
    assert isinstance(ours, LeafwiseBooster)
    model = ours.fit(coarse)
    theirs = kind(featuresCol=VECTOR, labelCol=label, maxIter=6, maxDepth=3, stepSize=0.1, maxBins=256).fit(coarse)
    scores = [[r["score"] for r in score_column(m, m.transform(coarse), task).orderBy("id").collect()] for m in (model, theirs)]
    assert np.allclose(*scores)


def test_boosting_of_one_class_and_of_wrong_labels(points):
    df, _, _ = points
    flat = df.withColumn("one", df["a"] * 0 + 1)
    for task in ("classifier", "regressor"):
        model = make_estimator("boosted", task, "one", n_estimators=3, max_depth=2).fit(flat)
        assert {round(r["score"]) for r in score_column(model, model.transform(df), task).collect()} == {1}
    with pytest.raises(ValueError, match="0 or 1"):
        make_estimator("boosted", "classifier", "z", n_estimators=1).fit(df)

"""Trained trees as plain node arrays, and the exact contributions of features to their scores.

A contribution is a Shapley value: the features' average effect over all orders in which they become known, where an unknown
feature sends a row down both sides of a split in proportion to the training rows there. Along a path the
weights of all subsets of its features are carried together; entering a split extends them, a feature met again is
undone first, and at a leaf each feature is undone once to get its share. That takes leaves x depth squared steps instead of
one for every subset, and no orders are sampled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

#: Rows explained by one numpy step.
STEP = 1_024
#: A tree of at most so many nodes is scored by columns, a larger one by walking down.
SMALL_NODES = 127


@dataclass
class Tree:
    """Node 0 is the root. A row goes left if its feature is at most the threshold; leaves have ``left`` -1.
    ``cover`` is the training rows (or their weight) that reached a node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.left[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            below = x[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(below, self.left[node], self.right[node])

    def values_of(self, columns: np.ndarray) -> np.ndarray:
        """The value of each row's leaf, from ``columns`` (features x rows): a comparison of a column a split, from the leaves up. Children
        come after their parents."""
        held: dict[int, np.ndarray | float] = {}
        for node in range(len(self.left) - 1, -1, -1):
            if self.left[node] < 0:
                held[node] = self.value[node]
            else:
                below = columns[self.feature[node]] <= self.threshold[node]
                held[node] = np.where(below, held.pop(self.left[node]), held.pop(self.right[node]))
        return np.broadcast_to(held[0], columns.shape[1])

    def mean(self) -> float:
        leaf = self.left < 0
        return float((self.value[leaf] * self.cover[leaf]).sum() / self.cover[leaf].sum())


@dataclass
class Ensemble:
    """Score = ``start`` + the weighted sum of the trees. Boosted classifiers score a margin, other classifiers the probability of class 1."""

    trees: list[Tree]
    weights: list[float]
    start: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        columns = np.ascontiguousarray(x.T)
        for tree, weight in zip(self.trees, self.weights):
            total += weight * (tree.values_of(columns) if len(tree.left) <= SMALL_NODES else tree.value[tree.leaves_of(x)])
        return total

    def base(self) -> float:
        return self.start + sum(w * t.mean() for t, w in zip(self.trees, self.weights))


def _tree_of(nodes: list, share_of_one: bool) -> Tree:
    nodes = sorted(nodes, key=lambda n: n["id"])
    if any(n["split"]["numCategories"] >= 0 for n in nodes if n["leftChild"] >= 0):
        raise ValueError("splits on category sets are not explained; encode categories as columns")
    stats = [n["impurityStats"] for n in nodes]
    values = [s[1] / sum(s) if share_of_one else n["prediction"] for n, s in zip(nodes, stats)]
    # Counts per class for classifiers; count, sum and sum of squares for regressors.
    cover = [sum(s) if share_of_one else s[0] for s in stats]
    inner = [n["leftChild"] >= 0 for n in nodes]
    return Tree(
        np.array([n["split"]["featureIndex"] for n in nodes]),
        np.array([n["split"]["leftCategoriesOrThreshold"][0] if i else 0.0 for n, i in zip(nodes, inner)]),
        np.array([n["leftChild"] if i else -1 for n, i in zip(nodes, inner)]),
        np.array([n["rightChild"] if i else -1 for n, i in zip(nodes, inner)]),
        np.array(values, float),
        np.array(cover, float),
    )


def is_tree_model(model: Model) -> bool:
    model = model.stages[-1] if isinstance(model, PipelineModel) else model
    return hasattr(model, "ensemble") or type(model).__name__.startswith(("DecisionTree", "RandomForest", "GBT"))


def flattened(model: Model) -> Ensemble:
    """The nodes of a trained tree, forest or boosted model, read from its saved form."""
    model = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(model, "ensemble"):
        return model.ensemble()
    name = type(model).__name__
    if not is_tree_model(model):
        raise TypeError(f"{name} is not a tree model")
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    # As large as the model.
    saved = spark.read.parquet(f"{path}/data").collect()
    by_tree: dict[int, list] = {}
    for row in saved:
        by_tree.setdefault(row["treeID"] if "treeID" in row else 0, []).append(row["nodeData"] if "nodeData" in row else row)
    votes = name.endswith("ClassificationModel") and not name.startswith("GBT")
    if votes and model.numClasses != 2:
        raise ValueError(f"contributions are to the probability of class 1 of 2, not of {model.numClasses} classes")
    trees = [_tree_of(by_tree[k], votes) for k in sorted(by_tree)]
    weights = list(model.treeWeights) if name.startswith("GBT") else [1.0 / len(trees)] * len(trees)
    return Ensemble(trees, weights)


def _extended(paths: np.ndarray, length: int, zero: float, one: np.ndarray) -> np.ndarray:
    """Weights by number of known features after one more feature: kept with share ``zero`` if unknown, ``one`` (0 or 1 per row) if known."""
    out = np.zeros((length + 1, paths.shape[1]))
    k = np.arange(length)[:, None]
    out[:length] = zero * paths * (length - k) / (length + 1)
    out[1:] += one * paths * (k + 1) / (length + 1)
    return out


def _undone(paths: np.ndarray, zero: float, one: np.ndarray) -> np.ndarray:
    """The weights before a feature was added."""
    length = len(paths) - 1
    out = np.empty((length, paths.shape[1]))
    carried = paths[length]
    known = one > 0
    for k in range(length - 1, -1, -1):
        with_it = carried * (length + 1) / (k + 1)
        without = paths[k] * (length + 1) / (zero * (length - k))
        out[k] = np.where(known, with_it, without)
        carried = paths[k] - with_it * zero * (length - k) / (length + 1)
    return out


def contributions(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Shapley values (rows x features) of the tree's score; each row adds up to its score minus ``tree.mean()``."""
    out = np.zeros(x.shape)
    everywhere = np.ones(len(x))

    def walk(node: int, features: list[int], zeros: list[float], ones: list[np.ndarray], paths: np.ndarray) -> None:
        if tree.left[node] < 0:
            for k, feature in enumerate(features):
                share = _undone(paths, zeros[k], ones[k]).sum(0)
                out[:, feature] += share * (ones[k] - zeros[k]) * tree.value[node]
            return
        feature = int(tree.feature[node])
        zero, one = 1.0, everywhere
        if feature in features:
            k = features.index(feature)
            zero, one = zeros[k], ones[k]
            paths = _undone(paths, zero, one)
            features, zeros, ones = (x[:k] + x[k + 1 :] for x in (features, zeros, ones))
        below = (x[:, feature] <= tree.threshold[node]).astype(float)
        for child, goes in ((tree.left[node], below), (tree.right[node], 1.0 - below)):
            share = zero * tree.cover[child] / tree.cover[node]
            if share > 0:
                walk(int(child), [*features, feature], [*zeros, share], [*ones, one * goes], _extended(paths, len(features) + 1, share, one * goes))

    walk(0, [], [], [], np.ones((1, len(x))))
    return out


def explained(ensemble: Ensemble, x: np.ndarray) -> np.ndarray:
    total = np.zeros(x.shape)
    for tree, weight in zip(ensemble.trees, ensemble.weights):
        total += weight * contributions(tree, x)
    return total


def shapley_trees(model: Model, rows: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Exact contributions of a tree model: (key, feature, contribution, base), in one narrow pass.

    They add up to the model's score minus ``base``, its mean over the training rows: the probability of class 1 for single trees and
    forests, the prediction of regressors, the margin (before the logistic curve) of boosted classifiers.
    """
    ensemble = flattened(model)
    base, names = ensemble.base(), list(features)
    narrow = rows.select(F.col(key).alias("key"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names]).alias("x"))
    kind = narrow.schema["key"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, len(names))
                values = explained(ensemble, x)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(n), len(names)))),
                        pa.array(names * n, pa.string()),
                        pa.array(values.ravel()),
                        pa.array(np.full(n * len(names), base)),
                    ],
                    names=["key", "feature", "contribution", "base"],
                )

    return narrow.mapInArrow(work, f"key {kind}, feature string, contribution double, base double").withColumnRenamed("key", key)

"""Random forests whose trees grow level by level together on packed blocks of binned rows.

Rows are cut into bins once and held by the executors as in ``leafwise``. Every tree sees each row as often as a Poisson draw of mean 1 says
(MLlib's bagging); the draw is seeded by tree and block, so it is taken again in every pass instead of being kept: a row costs its bins
and label, whatever the number of trees. A pass sums weights and targets by node, drawn feature and bin in the tasks, for as many open
nodes of as many trees as ``CELLS`` allows; the sums are added up by a shuffle, a tree's nodes in one place, where their best splits are
picked. Only splits reach the driver.

Splits are those of MLlib's forests: the most of Gini impurity or variance taken away among features drawn per node, bins cut halfway between
few distinct values, a split must gain something, a single tree sees all rows and features. A leaf's value is its classes' shares, or its mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.leafwise import CLASSIFIER, REGRESSOR, LeafwiseBooster, column_count, held_blocks, reached
from riskloom.operators.trees import SMALL_NODES, Ensemble, Tree
from riskloom.session import scratch_scope

#: Cells (node, feature, bin) that a pass sums at most; a tree's nodes are dealt over passes if they have more.
CELLS = 1 << 21
#: As many classes as MLlib's trees take.
MOST_CLASSES = 100
#: Means of numbers that differ by less, relative to them, are the same but for rounding.
SAME = 1e-9
#: How often a row is drawn, for each value of 16 random bits.
_ENDS = np.round(65_536 * np.cumsum([np.exp(-1) / factorial(k) for k in range(12)]))
DRAWS = np.searchsorted(_ENDS, np.arange(65_536), "right").astype(np.uint8)


class _ForestOptions(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features")
    labelCol = Param(Params._dummy(), "labelCol", "0, 1, ... for classifiers, a number for regressors")
    task = Param(Params._dummy(), "task", "classifier or regressor")
    trees = Param(Params._dummy(), "trees", "number of trees")
    maxDepth = Param(Params._dummy(), "maxDepth", "most splits on a path")
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature, 256 at most")
    columnShare = Param(Params._dummy(), "columnShare", "features drawn for a node: a share, a number or a strategy by MLlib's name")
    seed = Param(Params._dummy(), "seed", "seed of the draws")


class Growing:
    """A tree while it grows: node arrays, each node's sums (weight, targets), and the nodes of the last level."""

    def __init__(self) -> None:
        self.feature, self.cut, self.left, self.right = [0], [0], [-1], [-1]
        self.total: list[np.ndarray | None] = [None]
        self.open = [0]

    def split(self, node: int, feature: int, cut: int, low: np.ndarray, high: np.ndarray) -> None:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.left), len(self.left) + 1
        for total in (low, high):
            self.feature.append(0)
            self.cut.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.total.append(total)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, np.int32) for x in (self.feature, self.cut, self.left, self.right))


def leaf_of(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The leaf of every row of a block (features x rows): by columns in small trees, by walking down in large ones."""
    if len(left) <= SMALL_NODES:
        return reached(bins, feature, cut, left, right)
    at = np.zeros(bins.shape[1], np.int32)
    inner = np.arange(len(at))
    while len(inner):
        node = at[inner]
        at[inner] = np.where(bins[feature[node], inner] <= cut[node], left[node], right[node])
        inner = inner[left[at[inner]] >= 0]
    return at


def drawn(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in the tree's sample."""
    return DRAWS[np.random.default_rng([seed, tree, block]).integers(0, 65_536, n, np.uint16)]


def targets_of(label: np.ndarray, classes: int, middle: float) -> list[np.ndarray]:
    """What is summed beside the weight: the label from the middle, or membership of class 1 of 2, or of every class."""
    if not classes:
        return [label - middle]
    return [(label == c).astype(float) for c in ([1] if classes == 2 else range(classes))]


def best_splits(sums: np.ndarray, columns: np.ndarray, same: float) -> tuple[np.ndarray, list]:
    """(total, split) of each node from ``sums`` (kinds x nodes x drawn features x bins, the weight first). A split is
    (feature, cut, left sums, right sums); the first drawn feature and the first bin on ties."""
    total = sums[:, :, 0].sum(2)
    left = np.cumsum(sums, 3)[..., :-1]
    right = total[:, :, None, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        low, high = left[1:] / left[0], right[1:] / right[0]
        apart = np.where(np.abs(low - high) > same * np.maximum(np.abs(low), np.abs(high)), low - high, 0.0)
        gain = left[0] * right[0] / total[0][:, None, None] * (apart**2).sum(0)
    gain = np.where((left[0] > 0) & (right[0] > 0), gain, 0.0)
    out = []
    for node in range(len(columns)):
        best = int(gain[node].argmax()) if gain[node].size else 0
        if not gain[node].size or not gain[node].flat[best] > 0:
            out.append(None)
            continue
        k, cut = np.unravel_index(best, gain[node].shape)
        out.append((int(columns[node, k]), int(cut), left[:, node, k, cut].copy(), right[:, node, k, cut].copy()))
    return total, out


class BaggedForest(Estimator, _ForestOptions, DefaultParamsReadable, DefaultParamsWritable):
    """Every row needs a label and finite features, as MLlib's forests ask."""

    def __init__(self, **options: object):
        super().__init__()
        self._set(**{
            "featuresCol": "features", "labelCol": "label", "task": CLASSIFIER, "trees": 20, "maxDepth": 5, "maxBins": 32, "columnShare": "auto", "seed": 42, **options,
        })

    def _fit(self, df: DataFrame) -> ForestModel:
        options = {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}
        if not 2 <= options["maxBins"] <= 256:
            raise ValueError("maxBins must be from 2 to 256")
        rows = df.select(vector_to_array(options["featuresCol"]).alias("x"), F.col(options["labelCol"]).cast("double").alias("y"))
        width, classes, middle = self._looked_at(rows, options["task"])
        alone = options["trees"] == 1
        share = options["columnShare"]
        if share == "auto":
            share = "all" if alone else "sqrt" if options["task"] == CLASSIFIER else "onethird"
        with scratch_scope(df.sparkSession):
            cuts = LeafwiseBooster._cuts(rows, width, options["maxBins"], True)
            bins, many = max(map(len, cuts), default=0) + 1, column_count(share, width, options["task"])
            held = held_blocks(LeafwiseBooster._blocks(rows, cuts, 0.0).select("block", "bins", "label"))

            def grown(number: int, alone: bool) -> list[Growing]:
                trees = [Growing() for _ in range(number)]
                for _ in range(max(1, options["maxDepth"])):
                    for job in self._jobs(trees, width, bins, 1 if classes <= 2 else classes, many, options["seed"]):
                        self._split(held, trees, job, classes, middle, width, alone, options)
                    # Every node that was split has its children at the next level.
                    for tree in trees:
                        tree.open = [child for node in tree.open if tree.left[node] >= 0 for child in (tree.left[node], tree.right[node])]
                # Of very few rows a tree may have drawn none.
                return [tree for tree in trees if tree.total[0][0] > 0]

            try:
                trees = grown(options["trees"], alone) or grown(1, True)
            finally:
                held.unpersist()
        saved = []
        for tree in trees:
            total = np.array(tree.total)
            shares = total[:, 1:] / total[:, :1] if classes else total[:, 1:] / total[:, :1] + middle
            saved.append({
                "feature": tree.feature, "threshold": [float(cuts[f][c]) if inner >= 0 else 0.0 for f, c, inner in zip(tree.feature, tree.cut, tree.left)],
                "left": tree.left, "right": tree.right, "values": shares.T.tolist(), "cover": total[:, 0].tolist(),
            })
        model = ForestModel()
        model._set(featuresCol=options["featuresCol"], task=options["task"], fitted={"classes": classes, "trees": saved})
        return model

    @staticmethod
    def _looked_at(rows: DataFrame, task: str) -> tuple[int, int, float]:
        """Number of features, classes (0 for numbers) and the mean label, in one pass that refuses what cannot be learnt from."""
        y = F.col("y")
        wrong = y.isNull() | F.isnan(y)
        if task == CLASSIFIER:
            wrong = wrong | (y < 0) | (y != F.floor(y))
        bad = F.col("x").isNull() | F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        found = rows.agg(
            F.max(F.size("x")).alias("width"), F.max(y).alias("top"), F.avg(y).alias("mean"),
            F.coalesce(F.max(wrong.cast("int")), F.lit(0)).alias("wrong"), F.coalesce(F.max(bad.cast("int")), F.lit(0)).alias("bad"),
        ).first()
        if found["width"] is None:
            raise ValueError("no rows to learn from")
        if found["wrong"]:
            raise ValueError("labels must be 0, 1, ..." if task == CLASSIFIER else "labels must be numbers")
        if found["bad"]:
            raise ValueError("features must be finite numbers")
        if task == REGRESSOR:
            return found["width"], 0, found["mean"]
        classes = max(2, int(found["top"]) + 1)
        if classes > MOST_CLASSES:
            raise ValueError(f"at most {MOST_CLASSES} classes, not {classes}")
        return found["width"], classes, 0.0

    @staticmethod
    def _jobs(trees: list[Growing], width: int, bins: int, kinds: int, many: int, seed: int) -> Iterator[dict[int, tuple[list[int], np.ndarray, int]]]:
        """The open nodes in passes of bounded size: (nodes, their drawn features, bins) by tree."""
        most = max(1, CELLS // (many * bins * (1 + kinds)))
        job, room = {}, most
        for number, tree in enumerate(trees):
            waiting = tree.open
            while waiting:
                part, waiting = waiting[:room], waiting[room:]
                columns = np.stack([np.random.default_rng([seed, number, 0, node]).permutation(width)[:many] for node in part])
                job[number] = (part, columns, bins)
                room -= len(part)
                if not room:
                    yield job
                    job, room = {}, most
        if job:
            yield job

    @staticmethod
    def _split(held: RDD, trees: list[Growing], job: dict, classes: int, middle: float, width: int, alone: bool, options: dict) -> None:
        """One pass: split the nodes of ``job``."""
        seed, same, depth = options["seed"], 0.0 if classes else SAME, options["maxDepth"]
        sent = []
        for number, (nodes, columns, bins) in job.items():
            slot = np.full(len(trees[number].left), -1, np.int32)
            slot[nodes] = np.arange(len(nodes))
            sent.append((number, trees[number].arrays(), slot, columns, bins))

        def work(rows: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
            kinds = 1 + (1 if classes in (0, 2) else classes)
            sums = {number: np.zeros((kinds, columns.size * bins)) for number, _, _, columns, bins in sent}
            for block, packed, label in rows:
                x = np.frombuffer(packed, np.uint8).reshape(width, -1)
                targets = targets_of(np.frombuffer(label), classes, middle)
                for number, tree, slot, columns, bins in sent:
                    at = slot[leaf_of(x, *tree)]
                    times = np.ones(len(at), np.uint8) if alone else drawn(seed, number, block, len(at))
                    kept = np.flatnonzero((at >= 0) & (times > 0))
                    if not len(kept):
                        continue
                    many, at, times = columns.shape[1], at[kept], times[kept].astype(float)
                    weights = [times, *(times * t[kept] for t in targets)]
                    total = sums[number]
                    for k in range(many):
                        cell = (at * many + k) * bins + x[columns[at, k], kept]
                        for kind, weight in enumerate(weights):
                            if total.shape[1] <= 4 * len(cell):
                                total[kind] += np.bincount(cell, weight, total.shape[1])
                            else:
                                np.add.at(total[kind], cell, weight)
            return iter(sums.items())

        drawn_for = {number: (columns, bins) for number, _, _, columns, bins in sent}

        def split(found: tuple[int, np.ndarray]) -> tuple[int, np.ndarray, list]:
            number, sums = found
            columns, bins = drawn_for[number]
            return number, *best_splits(sums.reshape(len(sums), *columns.shape, bins), columns, same)

        added = held.mapPartitions(work).reduceByKey(lambda a, b: a + b, min(len(sent), held.context.defaultParallelism))
        for number, total, splits in added.map(split).collect():
            tree = trees[number]
            for place, (node, best) in enumerate(zip(job[number][0], splits)):
                if tree.total[node] is None:
                    tree.total[node] = total[:, place]
                if best and depth:
                    tree.split(node, *best)


class ForestModel(Model, _ForestOptions, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``, and for classifiers ``probability`` as a vector: the mean of the trees' shares."""

    fitted = Param(Params._dummy(), "fitted", "classes and trees")

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", task=CLASSIFIER, fitted={"classes": 2, "trees": []})

    def _ensembles(self) -> list[Ensemble]:
        """One for the number, or for class 1 of 2, or for each of more classes."""
        found = self.getOrDefault("fitted")["trees"]
        arrays = [[np.array(t[n], kind) for n, kind in (("feature", int), ("threshold", float), ("left", int), ("right", int), ("values", float), ("cover", float))] for t in found]
        kinds = len(found[0]["values"])
        return [Ensemble([Tree(f, t, left, right, values[k], cover) for f, t, left, right, values, cover in arrays], [1.0 / len(found)] * len(found)) for k in range(kinds)]

    def ensemble(self) -> Ensemble:
        classes = self.getOrDefault("fitted")["classes"]
        if classes > 2:
            raise ValueError(f"contributions are to the probability of class 1 of 2, not of {classes} classes")
        return self._ensembles()[0]

    def _transform(self, df: DataFrame) -> DataFrame:
        ensembles = self._ensembles()
        x = vector_to_array(self.getOrDefault("featuresCol"))

        @F.pandas_udf("array<double>")
        def scores(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            values = np.array(rows.tolist(), dtype=float)
            return pd.Series(list(np.stack([e.score(values) for e in ensembles], 1)))

        if self.getOrDefault("task") == REGRESSOR:
            return df.withColumn("prediction", scores(x)[0])
        out = df.withColumn("__s", scores(x))
        if len(ensembles) == 1:
            out = out.withColumn("__s", F.array(1.0 - F.col("__s")[0], F.col("__s")[0]))
        out = out.withColumns({"probability": array_to_vector("__s"), "prediction": (F.array_position("__s", F.array_max("__s")) - 1).cast("double")})
        return out.drop("__s")

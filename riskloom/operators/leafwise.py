"""Boosting that grows each tree leaf by leaf, the best split of all leaves first.

Rows are cut into at most ``max_bins`` bins per feature and kept as packed blocks beside their label and score, which the executors hold
between passes. Sums of gradient, curvature and rows per leaf, feature and bin are added up in the tasks, and by a shuffle unless all tasks'
sums are few; only these sums reach the driver (leaves x features x bins), which picks the splits. Of two new leaves the smaller one is summed, the other is the
parent less that one.

A pass over the rows takes all leaves whose children could be needed before the tree is full, so a tree takes about as
many passes as it is deep, and the order of splits is still that of one pass per split. Scores are written with the blocks every
KEEP trees; in between, the tasks apply the few trees since then.

With ``steps="gradient"`` it is plain gradient boosting: a tree is fitted to the loss's slope by least squares, the first one to the
label itself at full weight, and a leaf steps by its mean slope, with the constants of MLlib's GBT. Curvature counts as 1 then, so one sum less is taken.

Rows and columns of a tree are drawn from seeded numbers of tree and block, so a task that is run again draws the same.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.trees import Ensemble, Tree
from riskloom.session import scratch_scope, written_once

#: Rows of a block, and trees after which the blocks are written with their scores.
BLOCK_ROWS, KEEP = 16_384, 10
#: Blocks a task writes or reads at a time.
TOGETHER = 32
#: Tasks of a pass for each core at most, and numbers of all tasks' sums up to which the driver adds them up itself.
PER_CORE, AT_ONCE = 2, 1 << 22
CLASSIFIER, REGRESSOR = "classifier", "regressor"
NEWTON, GRADIENT = "newton", "gradient"


class _BoostingOptions(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features")
    labelCol = Param(Params._dummy(), "labelCol", "0 or 1 for classifiers, a number for regressors")
    task = Param(Params._dummy(), "task", "classifier or regressor")
    trees = Param(Params._dummy(), "trees", "number of trees")
    learningRate = Param(Params._dummy(), "learningRate", "share of each tree's step that is taken")
    leaves = Param(Params._dummy(), "leaves", "most leaves of a tree")
    maxDepth = Param(Params._dummy(), "maxDepth", "most splits on a path; 0: any number")
    leafRows = Param(Params._dummy(), "leafRows", "fewest rows of a leaf")
    leafPenalty = Param(Params._dummy(), "leafPenalty", "added to a leaf's curvature: keeps its value small")
    leafCurvature = Param(Params._dummy(), "leafCurvature", "least curvature of a leaf")
    leastGain = Param(Params._dummy(), "leastGain", "a split must gain more")
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature, 256 at most")
    subsample = Param(Params._dummy(), "subsample", "share of the rows each tree sees")
    columnShare = Param(Params._dummy(), "columnShare", "share of the features each tree sees")
    steps = Param(Params._dummy(), "steps", "newton, or gradient: plain steps along the slope; columns are drawn per split then")
    seed = Param(Params._dummy(), "seed", "seed of the draws")


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    left: np.ndarray
    right: np.ndarray


def best_split(sums: np.ndarray, columns: np.ndarray, total: np.ndarray, options: dict) -> Split | None:
    """The split with the largest gain of a leaf with ``sums`` (features x bins x (gradient, curvature, rows)); the first
    feature and bin on ties."""
    penalty = options["leafPenalty"]
    left = np.cumsum(sums, 1)[:, :-1]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        if options["steps"] == GRADIENT or not penalty:
            # The distance of the two means: nothing is left of a leaf whose rows all have one slope, where the difference of large squares
            # leaves more the more rows there are.
            weight = 2 if options["steps"] == GRADIENT else 1
            low, high = left[..., weight], right[..., weight]
            gain = np.nan_to_num(low * high / total[weight] * (left[..., 0] / low - right[..., 0] / high) ** 2)
        else:
            gain = left[..., 0] ** 2 / (left[..., 1] + penalty) + right[..., 0] ** 2 / (right[..., 1] + penalty) - total[0] ** 2 / (total[1] + penalty)
    right_size = (np.minimum(left[..., 2], right[..., 2]) >= options["leafRows"]) & (np.minimum(left[..., 1], right[..., 1]) >= options["leafCurvature"])
    # Sums of doubles leave a trace where nothing is: a split without rows on a side is none.
    gain = np.where(right_size & (np.minimum(left[..., 2], right[..., 2]) > 0), gain, -np.inf)
    gain[~columns] = -np.inf
    if not gain.size or not gain.max() > max(options["leastGain"], 1e-12):
        return None
    feature, cut = np.unravel_index(int(gain.argmax()), gain.shape)
    return Split(float(gain[feature, cut]), int(feature), int(cut), left[feature, cut], right[feature, cut])


class Growing:
    """A tree while it grows: splits that are known, of which the leaves asked for ahead may not be used in the end."""

    def __init__(self) -> None:
        self.feature, self.cut, self.left, self.right = [0], [0], [-1], [-1]
        self.total: list[np.ndarray] = [np.zeros(3)]
        self.depth = [0]
        self.sums: dict[int, np.ndarray] = {}
        self.best: dict[int, Split | None] = {}

    def open(self, node: int) -> tuple[int, int]:
        """Give a leaf the children of its best split."""
        split = self.best[node]
        self.feature[node], self.cut[node] = split.feature, split.cut
        for total in (split.left, split.right):
            self.feature.append(0)
            self.cut.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.total.append(total)
            self.depth.append(self.depth[node] + 1)
        self.left[node], self.right[node] = len(self.left) - 2, len(self.left) - 1
        return self.left[node], self.right[node]

    def kept(self, split: set[int]) -> Growing:
        """The tree with these splits only: children that were summed ahead and not needed are dropped."""
        out, waiting = Growing(), [(0, 0)]
        out.total[0] = self.total[0]
        while waiting:
            node, place = waiting.pop()
            if node in split:
                out.best[place] = self.best[node]
                waiting += zip((self.left[node], self.right[node]), out.open(place))
        return out

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, np.int32) for x in (self.feature, self.cut, self.left, self.right))


def reached(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The leaf of every row of a block (features x rows). From the leaves up, a comparison of a column and a choice by small whole
    numbers a split: children come after their parents."""
    kind = np.int16 if len(left) < 1 << 14 else np.int32
    held: dict[int, np.ndarray] = {}
    for node in range(len(left) - 1, -1, -1):
        if left[node] < 0:
            held[node] = kind(node)
        else:
            low, high = held.pop(left[node]), held.pop(right[node])
            held[node] = np.multiply(bins[feature[node]] <= int(cut[node]), low - high, dtype=kind) + high
    return np.broadcast_to(held[0], bins.shape[1])


def slopes(label: np.ndarray, score: np.ndarray, task: str) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss: logistic, or half the squared error."""
    if task == REGRESSOR:
        return score - label, np.ones(len(label))
    p = 1.0 / (1.0 + np.exp(-np.clip(score, -500, 500)))
    return p - label, p * (1.0 - p)


def column_count(share: float | str, width: int, task: str) -> int:
    """How many of ``width`` columns a draw takes: a share, or a strategy by the names MLlib has for them."""
    named = {"auto": width, "all": width, "sqrt": np.ceil(np.sqrt(width)), "log2": np.ceil(np.log2(max(width, 2))), "onethird": np.ceil(width / 3)}
    if str(share) in named:
        return max(1, int(named[str(share)]))
    number = float(share)
    return max(1, min(width, round(number * width) if number <= 1 else int(number)))


BLOCK = "block long, bins binary, label binary, score binary"


def held_blocks(blocks: DataFrame) -> RDD:
    """The blocks' rows, held by the executors for many passes; to be released with ``unpersist``. They are held as the JVM hands them out, so
    no second worker stands beside a task's own."""
    tasks = PER_CORE * blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.rdd.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)


def _arrays(batch: pa.RecordBatch, at: int, width: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    block, bins, label, score = (batch.column(c)[at].as_py() for c in range(4))
    return block, np.frombuffer(bins, np.uint8).reshape(width, -1), np.frombuffer(label), np.frombuffer(score)


#: Settings unless told otherwise.
SETTINGS = {
    "featuresCol": "features", "labelCol": "label", "task": CLASSIFIER, "trees": 100, "learningRate": 0.1, "leaves": 31, "maxDepth": 0, "leafRows": 20,
    "leafPenalty": 0.0, "leafCurvature": 1e-3, "leastGain": 0.0, "maxBins": 255, "subsample": 1.0, "columnShare": 1.0, "steps": NEWTON, "seed": 42,
}


class LeafwiseBooster(Estimator, _BoostingOptions, DefaultParamsReadable, DefaultParamsWritable):
    """Options are those of ``SETTINGS``. A row without a label is left out; a feature that is not a number goes right everywhere."""

    def __init__(self, **options: object):
        super().__init__()
        self._set(**{**SETTINGS, **options})

    def _fit(self, df: DataFrame) -> LeafwiseModel:
        options = {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}
        if not 2 <= options["maxBins"] <= 256:
            raise ValueError("maxBins must be from 2 to 256")
        plain = options["steps"] == GRADIENT
        if plain:
            y = F.col(options["labelCol"]).cast("double")
            wrong = y.isNull() | F.isnan(y) if options["task"] == REGRESSOR else y.isNull() | ~y.isin(0.0, 1.0)
            if not df.where(wrong).isEmpty():
                raise ValueError("labels must be numbers" if options["task"] == REGRESSOR else "labels must be 0 or 1")
        rows = df.select(vector_to_array(options["featuresCol"]).alias("x"), F.col(options["labelCol"]).cast("double").alias("y")).where("y is not null")
        width = rows.select(F.size("x")).first()[0]
        n, mean = rows.agg(F.count("*"), F.avg("y")).first()
        if plain:
            start = 0.0
        elif options["task"] == CLASSIFIER:
            share = min(max(mean, 1e-12), 1 - 1e-12)
            start = float(np.log(share / (1 - share)))
        else:
            start = float(mean)
        with scratch_scope(df.sparkSession):
            cuts = self._cuts(rows, width, options["maxBins"], plain)
            blocks = self._blocks(rows, cuts, start)
            held = held_blocks(blocks)
            trees, fresh = [], []
            try:
                for number in range(options["trees"]):
                    grown = self._grow(held, fresh, number, width, max(map(len, cuts)) + 1, options)
                    # A plain tree without a split moves the score by the mean slope, which is 0 for squared errors after the first tree.
                    if len(grown.left) == 1 and (not plain or (number and options["task"] == REGRESSOR and options["subsample"] >= 1)):
                        break
                    step = options["learningRate"]
                    if plain:
                        # The score is twice MLlib's margin, so that its logistic curve is the probability.
                        first, later = (4.0, 8.0) if options["task"] == CLASSIFIER else (1.0, 2.0)
                        step = later * step if number else first
                    values = np.array([-t[0] / (t[1] + options["leafPenalty"]) * step if t[1] + options["leafPenalty"] > 0 else 0.0 for t in grown.total])
                    trees.append((*grown.arrays(), values, np.array([t[2] for t in grown.total])))
                    fresh.append(trees[-1][:5])
                    if len(fresh) == KEEP and number + 1 < options["trees"]:
                        blocks, fresh = self._scored(blocks, fresh, width), []
                        held.unpersist()
                        held = held_blocks(blocks)
            finally:
                held.unpersist()
        model = LeafwiseModel()
        saved = []
        for feature, cut, left, right, values, cover in trees:
            threshold = [float(cuts[f][c]) if inner >= 0 else 0.0 for f, c, inner in zip(feature, cut, left)]
            saved.append({"feature": feature.tolist(), "threshold": threshold, "left": left.tolist(), "right": right.tolist(), "value": values.tolist(), "cover": cover.tolist()})
        model._set(featuresCol=options["featuresCol"], task=options["task"], fitted={"start": start, "trees": saved})
        return model

    @staticmethod
    def _cuts(rows: DataFrame, width: int, most: int, halfway: bool = False) -> list[np.ndarray]:
        """Upper ends of all bins but the last, by feature; about equal rows in each. Few distinct values get a bin each, which ends at its
        value or ``halfway`` to the next."""

        def distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: list[np.ndarray] = [np.zeros(0)] * width
            for batch in batches:
                x = batch.column(0).flatten().to_numpy().reshape(-1, width)
                for j in range(width):
                    if len(seen[j]) <= most:
                        seen[j] = np.union1d(seen[j], x[~np.isnan(x[:, j]), j])
            # One more than enough tells that there are many.
            seen = [v[: most + 1] for v in seen]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), [len(v) for v in seen]), pa.int32()), pa.array(np.concatenate(seen))], names=["place", "v"])

        flat = rows.select(F.posexplode("x").alias("place", "v")).where("not isnan(v)")
        shares = [float(s) for s in np.linspace(0, 1, most + 1)[1:]]
        few = rows.mapInArrow(distinct, "place int, v double").groupBy("place").agg(F.collect_set("v").alias("values")).collect()
        many = [r["place"] for r in few if len(r["values"]) > most]
        cuts = [np.zeros(0)] * width
        for r in few:
            values = np.sort(r["values"])
            cuts[r["place"]] = (values[:-1] + values[1:]) / 2 if halfway else values[:-1]
        if many:
            ends = flat.where(F.col("place").isin(many)).groupBy("place").agg(F.percentile_approx("v", shares, F.lit(10_000)).alias("ends"))
            for r in ends.collect():
                cuts[r["place"]] = np.unique(r["ends"])[:-1]
        return cuts

    @staticmethod
    def _blocks(rows: DataFrame, cuts: list[np.ndarray], start: float) -> DataFrame:
        width = len(cuts)

        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 32
            for batch in batches:
                for first in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(first, BLOCK_ROWS)
                    x = part.column(0).flatten().to_numpy().reshape(-1, width)
                    bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 0).astype(np.uint8)
                    y = part.column(1).to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in (bins, y.astype(float), np.full(len(y), start)))],
                        names=["block", "bins", "label", "score"],
                    )
                    block += 1

        return written_once(rows.mapInArrow(work, BLOCK), "blocks", group_rows=TOGETHER)

    @staticmethod
    def _scored(blocks: DataFrame, fresh: list, width: int) -> DataFrame:
        """The blocks with the fresh trees in their scores."""

        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    _, bins, _, score = _arrays(batch, at, width)
                    for *tree, values in fresh:
                        score = score + values[reached(bins, *tree)]
                    yield batch.slice(at, 1).set_column(3, "score", pa.array([score.tobytes()], pa.binary()))

        return written_once(blocks.mapInArrow(work, BLOCK), "blocks", group_rows=TOGETHER)

    @staticmethod
    def _sums(held: RDD, fresh: list, tree: tuple, wanted: list[int], number: int, width: int, bins: int, options: dict) -> dict[int, np.ndarray]:
        """Gradient, curvature and rows by wanted leaf, feature and bin."""
        slot = np.full(len(tree[0]), -1)
        slot[wanted] = np.arange(len(wanted))
        task, share, seed = options["task"], options["subsample"], options["seed"]
        # Curvature is 1 then, so its sums are the rows.
        plain = options["steps"] == GRADIENT or task == REGRESSOR
        kinds, cells = 2 if plain else 3, len(wanted) * bins

        def work(rows: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
            total = np.zeros((width, kinds, cells))
            for block, packed, label, score in rows:
                x, label, score = np.frombuffer(packed, np.uint8).reshape(width, -1), np.frombuffer(label), np.frombuffer(score)
                for *done, values in fresh:
                    score = score + values[reached(x, *done)]
                gradient, curvature = slopes(label, score, task)
                where = slot[reached(x, *tree)]
                if share < 1.0:
                    where = np.where(np.random.default_rng([seed, number, block]).random(len(where)) < share, where, -1)
                kept = np.flatnonzero(where >= 0)
                first = where[kept] * bins
                weights = (gradient[kept], None) if plain else (gradient[kept], curvature[kept], None)
                for j in range(width):
                    cell = first + x[j, kept]
                    for k, weight in enumerate(weights):
                        total[j, k] += np.bincount(cell, weight, cells)
            return enumerate(total)

        sums = held.mapPartitions(work)
        if held.getNumPartitions() * width * kinds * cells > AT_ONCE:
            sums = sums.reduceByKey(lambda a, b: a + b, min(width, held.context.defaultParallelism))
        flat = np.zeros((width, kinds, cells))
        for feature, part in sums.collect():
            flat[feature] += part
        by_leaf = flat[:, (0, 1, 1) if plain else (0, 1, 2)].reshape(width, 3, len(wanted), bins).transpose(2, 0, 3, 1)
        return dict(zip(wanted, by_leaf))

    def _grow(self, held: RDD, fresh: list, number: int, width: int, bins: int, options: dict) -> Growing:
        tree = Growing()

        def drawn(*place: int) -> np.ndarray:
            columns = np.zeros(width, bool)
            columns[np.random.default_rng([options["seed"], number, *place]).permutation(width)[: column_count(options["columnShare"], width, options["task"])]] = True
            return columns

        of_tree = drawn()

        def weigh(node: int, sums: np.ndarray) -> None:
            tree.sums[node] = sums
            tree.best[node] = best_split(sums, drawn(node) if options["steps"] == GRADIENT else of_tree, tree.total[node], options)

        root = self._sums(held, fresh, tree.arrays(), [0], number, width, bins, options)[0]
        tree.total[0] = root[0].sum(0) if width else np.zeros(3)
        weigh(0, root)
        leaves = 1
        # Leaves of the tree so far with a split, best first; equal gains by age.
        waiting = [(-tree.best[0].gain, 0)] if tree.best[0] else []
        used: set[int] = set()
        while waiting and leaves < options["leaves"]:
            # Children of all leaves that may be split before the tree is full are summed in one pass.
            ahead = [node for _, node in heapq.nsmallest(options["leaves"] - leaves, waiting) if tree.left[node] < 0]
            if ahead:
                small, pairs = [], []
                for node in ahead:
                    low, high = tree.open(node)
                    if options["maxDepth"] and tree.depth[low] >= options["maxDepth"]:
                        # Not split any more, so nothing has to be summed.
                        tree.best[low] = tree.best[high] = None
                        continue
                    less, more = (low, high) if tree.total[low][2] <= tree.total[high][2] else (high, low)
                    small.append(less)
                    pairs.append((node, less, more))
                found = self._sums(held, fresh, tree.arrays(), small, number, width, bins, options) if small else {}
                for node, less, more in pairs:
                    weigh(less, found[less])
                    weigh(more, tree.sums.pop(node) - found[less])
            while waiting and leaves < options["leaves"] and tree.left[waiting[0][1]] >= 0:
                _, node = heapq.heappop(waiting)
                used.add(node)
                leaves += 1
                for child in (tree.left[node], tree.right[node]):
                    if tree.best[child]:
                        heapq.heappush(waiting, (-tree.best[child].gain, child))
        return tree.kept(used)


class LeafwiseModel(Model, _BoostingOptions, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``, and for classifiers ``probability`` as a vector."""

    fitted = Param(Params._dummy(), "fitted", "start score and trees")

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", task=CLASSIFIER, fitted={"start": 0.0, "trees": []})

    def ensemble(self) -> Ensemble:
        fitted = self.getOrDefault("fitted")
        trees = [Tree(*(np.array(t[n], kind) for n, kind in (("feature", int), ("threshold", float), ("left", int), ("right", int), ("value", float), ("cover", float)))) for t in fitted["trees"]]
        return Ensemble(trees, [1.0] * len(trees), fitted["start"])

    def _transform(self, df: DataFrame) -> DataFrame:
        ensemble = self.ensemble()

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(ensemble.score(np.array(x.tolist(), dtype=float)) if len(x) else np.zeros(0))

        score = margin(vector_to_array(self.getOrDefault("featuresCol")))
        if self.getOrDefault("task") == REGRESSOR:
            return df.withColumn("prediction", score)
        out = df.withColumn("__margin", score).withColumn("__p", 1.0 / (1.0 + F.exp(-F.col("__margin"))))
        out = out.withColumns({"probability": array_to_vector(F.array(1.0 - F.col("__p"), F.col("__p"))), "prediction": (F.col("__p") > 0.5).cast("double")})
        return out.drop("__margin", "__p")

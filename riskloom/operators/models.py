"""Model kinds, training and scoring on MLlib estimators."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.bagged import BaggedForest
from riskloom.operators.leafwise import GRADIENT, LeafwiseBooster

log = logging.getLogger(__name__)

VECTOR, SCORE = "features", "score"

# Feature values are cut into this many bins before a tree looks for splits.
TREE_BINS = 256

# Settings each kind is trained with unless told otherwise.
DEFAULTS: dict[str, dict[str, object]] = {
    "logistic": {"max_iter": 1000, "c": 1.0},
    "tree": {"max_depth": 10},
    "forest": {"n_estimators": 100, "max_depth": 10},
    "boosted": {"n_estimators": 200, "learning_rate": 0.1, "max_depth": 5},
    "light_boosted": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 5, "num_leaves": 31},
}

_TREES = {
    ("tree", "classifier"): DecisionTreeClassifier,
    ("tree", "regressor"): DecisionTreeRegressor,
}


def make_estimator(
    kind: str, task: str = "classifier", label: str = "label", seed: int = 42, n_rows: int | None = None, **settings: object
) -> Estimator:
    """Estimator of a kind; ``settings`` override the defaults of that kind.

    The strength ``c`` of a logistic regression weighs the summed loss against the penalty, so
    its penalty per row is 1 / (c * rows) and the number of training rows is needed.
    """
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model kind {kind!r}, expected one of {sorted(DEFAULTS)}")
    if task not in ("classifier", "regressor"):
        raise ValueError(f"unknown task {task!r}")
    chosen = {**DEFAULTS[kind], **settings}
    if kind == "logistic":
        if task != "classifier":
            raise ValueError("a logistic regression only classifies")
        return LogisticRegression(
            featuresCol=VECTOR,
            labelCol=label,
            maxIter=int(chosen["max_iter"]),
            regParam=1.0 / (float(chosen["c"]) * max(1, n_rows or 1)),
            elasticNetParam=0.0,
            standardization=False,
        )
    if kind == "light_boosted":
        # Leaf by leaf; the other settings of the estimator can be given under these names.
        names = {
            "n_estimators": "trees", "learning_rate": "learningRate", "max_depth": "maxDepth", "num_leaves": "leaves", "leaf_rows": "leafRows",
            "leaf_penalty": "leafPenalty", "least_gain": "leastGain", "subsample": "subsample", "column_share": "columnShare",
        }
        return LeafwiseBooster(featuresCol=VECTOR, labelCol=label, task=task, seed=seed, **{names[k]: v for k, v in chosen.items()})
    if kind == "boosted":
        # Whole trees of the depth by plain gradient steps, as MLlib's own boosting takes them.
        depth = int(chosen["max_depth"])
        return LeafwiseBooster(
            featuresCol=VECTOR, labelCol=label, task=task, seed=seed, trees=int(chosen["n_estimators"]), learningRate=float(chosen["learning_rate"]),
            maxDepth=depth, leaves=2**depth, leafRows=1, leafCurvature=0.0, maxBins=TREE_BINS, steps=GRADIENT,
            subsample=float(chosen.get("subsample", 1.0)), columnShare=chosen.get("column_share", 1.0),
        )
    options = {"featuresCol": VECTOR, "labelCol": label, "seed": seed, "maxDepth": int(chosen["max_depth"]), "maxBins": TREE_BINS}
    if kind == "forest":
        return BaggedForest(task=task, trees=int(chosen["n_estimators"]), **options)
    return _TREES[kind, task](**options)


def score_column(model: PipelineModel, scored: DataFrame, task: str = "classifier") -> DataFrame:
    """Add ``score``: the probability of class 1, or the prediction of a model without one."""
    if task == "classifier" and "probability" in scored.columns:
        return scored.withColumn(SCORE, vector_to_array("probability")[1])
    return scored.withColumn(SCORE, F.col("prediction").cast("double"))


class ModelTrainer:
    """Trains and applies one model kind at a time."""

    def __init__(self, kind: str, task: str = "classifier", seed: int = 42, **settings: object):
        self.set_kind(kind, task, seed, **settings)

    def set_kind(self, kind: str, task: str = "classifier", seed: int = 42, **settings: object) -> None:
        """Choose a kind; a model trained before is forgotten."""
        make_estimator(kind, task, seed=seed, **settings)
        self.kind, self.task, self.seed, self.settings = kind, task, seed, settings
        self.model: PipelineModel | None = None

    @property
    def parameters(self) -> Mapping[str, object]:
        return {**DEFAULTS[self.kind], **self.settings, "task": self.task, "seed": self.seed}

    def train(self, df: DataFrame, features: Sequence[str], label: str) -> PipelineModel | None:
        """Fit on the frame; an empty one is skipped with a message."""
        n_rows = df.count()
        if n_rows == 0:
            log.warning("no rows to train %s on", self.kind)
            return None
        assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR)
        estimator = make_estimator(self.kind, self.task, label, self.seed, n_rows, **self.settings)
        rows = assembler.transform(df).select(VECTOR, F.col(label).cast("double").alias(label))
        self.model = PipelineModel([assembler, estimator.fit(rows)])
        return self.model

    def predict(self, df: DataFrame) -> DataFrame:
        """The frame with a ``score`` column; an empty frame gives an empty result."""
        if self.model is None:
            raise RuntimeError(f"model {self.kind!r} is not trained yet")
        return predict(self.model, df, self.task)


def predict(model: PipelineModel, df: DataFrame, task: str = "classifier") -> DataFrame:
    return score_column(model, model.transform(df), task).select(*df.columns, SCORE)

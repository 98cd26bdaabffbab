"""The passes of boosting over its blocks."""

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.core.rdd import PipelinedRDD
from pyspark.ml.feature import VectorAssembler

from riskloom.operators import leafwise
from riskloom.operators.leafwise import LeafwiseBooster
from riskloom.operators.models import VECTOR

NAMES = list("abcd")


@pytest.fixture(scope="module")
def points(spark):
    x = np.random.default_rng(8).integers(0, 9, (400, 4)).astype(float)
    y = ((x[:, 0] > 4) & (x[:, 1] < 6) | (x[:, 2] > 7)).astype(float)
    pdf = pd.DataFrame(x, columns=NAMES).assign(y=y)
    return VectorAssembler(inputCols=NAMES, outputCol=VECTOR).transform(spark.createDataFrame(pdf).coalesce(1)).cache(), x


def test_a_boosting_pass_is_one_job(points, spark):
    df, _ = points
    passes, sums = [], LeafwiseBooster._sums

    def counted(*args):
        spark.sparkContext.setJobGroup("pass", "pass")
        passes.append(1)
        try:
            return sums(*args)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    LeafwiseBooster._sums = staticmethod(counted)
    try:
        LeafwiseBooster(featuresCol=VECTOR, labelCol="y", trees=3, steps="gradient", leaves=4, leafRows=1).fit(df)
    finally:
        LeafwiseBooster._sums = staticmethod(sums)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("pass")
    assert len(passes) >= 6 and len(jobs) == len(passes)


def test_sums_added_by_a_shuffle_give_the_same_trees(points, monkeypatch):
    df, x = points
    many = df.repartition(5)
    booster = LeafwiseBooster(featuresCol=VECTOR, labelCol="y", trees=3, leaves=5, leafRows=5)
    first = booster.fit(many).ensemble().score(x)
    monkeypatch.setattr(leafwise, "AT_ONCE", 0)
    assert np.allclose(booster.fit(many).ensemble().score(x), first)


def test_a_leaf_of_one_slope_is_not_split_however_many_rows_it_has():
    """The sums of many equal slopes are off by rounding, and their squares by more than any least gain."""
    rows = np.array([900_001, 1_300_007, 700_003, 500_009])

    def added(n: int, slope: float = 10 / 7, block: int = 16_384) -> float:
        one = np.add.accumulate(np.full(block, slope))[-1]
        return np.add.accumulate(np.full(n // block, one))[-1] + np.add.accumulate(np.full(n % block, slope))[-1]

    sums = np.stack([np.array([added(n) for n in rows]), rows, rows], 1)[None]
    options = {**leafwise.SETTINGS, "task": "regressor"}
    assert leafwise.best_split(sums, np.ones(1, bool), sums[0].sum(0), options) is None
    sums[0, 2, 0] *= 1.5
    found = leafwise.best_split(sums, np.ones(1, bool), sums[0].sum(0), options)
    assert found.cut == 1


def test_blocks_are_held_without_a_second_worker_and_read_some_at_a_time(points, spark, monkeypatch):
    df, x = points
    monkeypatch.setattr(leafwise, "BLOCK_ROWS", 8)
    rows = df.selectExpr("array(a, b, c, d) AS x", "y").coalesce(1)
    blocks = LeafwiseBooster._blocks(rows, [np.arange(8.0)] * 4, 0.0)
    held = leafwise.held_blocks(blocks)
    try:
        assert not isinstance(held, PipelinedRDD)
        assert sum(len(np.frombuffer(label)) for _, _, label, _ in held.collect()) == len(x)
    finally:
        held.unpersist()
    groups = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in blocks.inputFiles()]
    assert max(g.row_group(i).num_rows for g in groups for i in range(g.num_row_groups)) <= leafwise.TOGETHER

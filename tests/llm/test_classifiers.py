import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskloom.llm.learning import held_out
from riskloom.llm.quality import co_train, content_features, fit_quality, metadata_features, score_quality, without_low_quality
from riskloom.llm.toxicity import Sparse, Words, fit_nnpu, fit_toxicity, score_toxicity, train

LABELS = "doc_id long, quality int, toxic int"


def auc(y, scores):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(y))
    ranks[order] = np.arange(1, len(y) + 1)
    positive = int(y.sum())
    return (ranks[y == 1].sum() - positive * (positive + 1) / 2) / (positive * (len(y) - positive))


def test_held_out_is_crc32_modulo_four(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_nnpu_finds_positives_among_unlabelled():
    rng = np.random.default_rng(1)
    ids = np.arange(40)
    clean = lambda: np.flatnonzero(rng.random(40) < 0.2)
    toxic = lambda: np.union1d(clean(), rng.choice(4, 2, replace=False))
    positive = Sparse([toxic() for _ in range(200)], ids)
    truth = rng.random(2000) < 0.1
    unlabelled = Sparse([toxic() if t else clean() for t in truth], ids)
    w, b = fit_nnpu(positive, unlabelled, 0.1)
    assert auc(truth.astype(int), unlabelled.dot(w) + b) > 0.8
    assert set(np.argsort(-w)[:4]) == {0, 1, 2, 3}


def test_toxicity_without_positives_or_labels(spark, docs_of, edge_pairs):
    docs = docs_of(edge_pairs)
    none = spark.createDataFrame([], LABELS)
    rows = score_toxicity(docs, fit_toxicity(docs, none)).collect()
    assert len(rows) == len(edge_pairs) and all(r.score < 1e-5 and r.predicted == 0 for r in rows)
    only_clean = spark.createDataFrame([(1, 1, 0), (3, None, None), (None, 1, 1), (8, 0, 0), (8, 0, 0)], LABELS)
    assert all(r.predicted == 0 for r in score_toxicity(docs, fit_toxicity(docs, only_clean)).collect())
    assert score_toxicity(docs_of([]), Words(np.zeros(0, np.uint32), np.zeros(0), 0.0)).count() == 0
    assert train([], [], 0.5).score(np.zeros(0, np.uint32)) == pytest.approx(0.5)


def test_toxicity_query_on_held_out_labels(spark):
    tables = "/root/testdata/sf0.1"
    scores = entry.queries()["op2_toxicity"](spark, tables)
    assert scores.count() == spark.read.parquet(f"{tables}/documents.parquet").count()
    rows = scores.where("held_out").join(spark.read.parquet(f"{tables}/labels.parquet"), "doc_id").collect()
    y = np.array([r.toxic for r in rows])
    assert auc(y, np.array([r.score for r in rows])) > 0.9
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_quality_query_on_held_out_labels(spark):
    tables = "/root/testdata/sf0.01"
    scores = entry.queries()["op7_quality"](spark, tables)
    rows = scores.where("held_out").join(spark.read.parquet(f"{tables}/labels.parquet"), "doc_id").collect()
    right = np.mean([r.kept == bool(r.quality) for r in rows])
    assert right > 0.95
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.97


def test_co_training_uses_both_views():
    rng = np.random.default_rng(3)
    y = (rng.random(3000) < 0.5).astype(float)
    views = [np.column_stack([y + rng.normal(0, s, 3000), rng.normal(0, 1, 3000)]) for s in (0.4, 0.6)]
    gold, pool, test = slice(0, 100), slice(100, 2000), slice(2000, 3000)
    model = co_train([v[gold] for v in views], y[gold], [v[pool] for v in views])
    scores = model.score(views[0][test], views[1][test])
    single = auc(y[test], views[0][test][:, 0])
    assert auc(y[test], scores) > single
    # Calibrated: the mean score is near the share of good rows.
    assert abs(scores.mean() - y[test].mean()) < 0.07


def test_quality_edge_cases(spark, docs_of, edge_pairs):
    docs = docs_of(edge_pairs)
    none = spark.createDataFrame([], LABELS)
    assert without_low_quality(docs, none).count() == len(edge_pairs)
    assert without_low_quality(docs, none).columns == docs.columns
    bare = docs.select("doc_id", "text")
    assert score_quality(bare, fit_quality(bare, none)).count() == len(edge_pairs)
    assert without_low_quality(docs_of([]), none).count() == 0
    assert all(np.isfinite(content_features(t)).all() for _, t in edge_pairs)
    assert np.isfinite(metadata_features(None, None, None)).all()

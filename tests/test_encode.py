import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from riskloom.operators import encode
from riskloom.operators.dictionary import SparseEncoder, SparseEncoderModel, as_vectors
from riskloom.operators.encode import FeatureEncoder

ROWS = [(1, 1.0, "b", "p"), (2, None, "a", "q"), (3, 4.0, None, "7"), (4, 10.0, "b", None)]
KIND = "id int, x double, s string, other string"


def test_fills_scales_and_categories(spark):
    df = spark.createDataFrame(ROWS, KIND)
    model = FeatureEncoder(numbers=["x", "absent"], categories=["s"], keep=["id"]).fit(df)
    out = model.transform(df)
    assert out.columns == ["x", "s_a", "s_b", "other", "id"]
    filled = np.array([1.0, 4.0, 4.0, 10.0])
    rows = sorted(out.collect(), key=lambda r: r["id"])
    assert [r["x"] for r in rows] == pytest.approx((filled - filled.mean()) / filled.std())
    assert [(r["s_a"], r["s_b"]) for r in rows] == [(0, 1), (1, 0), (0, 1), (0, 1)]
    assert [r["other"] for r in rows] == [0.0, 0.0, 7.0, 0.0]


def test_new_data_uses_fitted_statistics(spark):
    model = FeatureEncoder(numbers=["x"], categories=["s"], keep=["id"], remainder="drop").fit(spark.createDataFrame(ROWS, KIND))
    new = spark.createDataFrame([(9, None, "unseen", "z")], KIND)
    row = model.transform(new).first()
    assert (row["s_a"], row["s_b"]) == (0.0, 0.0)
    assert row["x"] == pytest.approx((4.0 - 4.75) / np.std([1.0, 4.0, 4.0, 10.0]))


def test_constant_column_is_not_scaled(spark):
    df = spark.createDataFrame([(0.1,)] * 7, "x double")
    assert [r["x"] for r in FeatureEncoder(numbers=["x"]).fit(df).transform(df).collect()] == pytest.approx([0.0] * 7, abs=1e-12)


def test_other_fills(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (5.0,), (None,)], "x double")
    assert encode.fit_number_fills(df, ["x"], "mean")["x"] == pytest.approx(7 / 3)
    assert encode.fit_number_fills(df, ["x"], "most_frequent")["x"] == 1.0
    with pytest.raises(ValueError):
        encode.fit_number_fills(df, ["x"], "guess")


def test_ties_go_to_the_smallest_category(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), ("a",), (None,)], "s string")
    assert encode.fit_category_fills(df, ["s"]) == {"s": "a"}


def test_too_many_categories_are_refused(spark):
    df = spark.range(20).selectExpr("cast(id as string) as s")
    with pytest.raises(ValueError):
        FeatureEncoder(categories=["s"], maxCategories=10).fit(df)


def test_any_number_of_categories_is_encoded(spark):
    df = spark.range(1500).selectExpr("concat('v', cast(id as string)) as s", "id")
    model = FeatureEncoder(categories=["s"], keep=["id"]).fit(df)
    assert len(model.feature_names()) == 1500
    row = model.transform(df.where("id = 7")).first()
    assert row["s_v7"] == 1.0 and row["s_v8"] == 0.0


def test_numeric_categories_in_numeric_order(spark):
    df = spark.createDataFrame([(10.0,), (9.0,), (0.0,)], "s double")
    model = FeatureEncoder(categories=["s"]).fit(df)
    assert model.feature_names() == ["s_0.0", "s_9.0", "s_10.0"]
    assert [tuple(r) for r in model.transform(df).collect()] == [(0, 0, 1), (0, 1, 0), (1, 0, 0)]


def test_saved_model_gives_the_same_rows(spark, tmp_path):
    df = spark.createDataFrame(ROWS, KIND)
    model = PipelineModel([FeatureEncoder(numbers=["x"], categories=["s"], keep=["id"]).fit(df)])
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    assert sorted(PipelineModel.load(path).transform(df).collect()) == sorted(model.transform(df).collect())


def test_sparse_encoder_with_many_categories(spark, tmp_path):
    """200,000 categories: the driver gets none, and every row finds its own place."""
    n = 200_000
    df = spark.range(2 * n).select("id", F.format_string("c%07d", F.col("id") % n).alias("many"), (F.col("id") % 2).cast("string").alias("few"), F.col("id").cast("double").alias("x"))
    encoder = SparseEncoder(dictionary=str(tmp_path / "d"), numbers=["x"], categories=["many", "few"], keep=["id"], numberStrategy="mean")
    model = encoder.fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    model = SparseEncoderModel.load(str(tmp_path / "model"))
    assert model.size() == 1 + n + 2
    assert not any(isinstance(v, (list, dict)) and len(v) > 3 for v in model.getOrDefault("fitted").values())
    out = model.transform(df)
    wanted = F.array(F.lit(0).cast("long"), F.col("id") % n + 1, n + 1 + F.col("id") % 2)
    assert out.where(F.col("places") != wanted).count() == 0 and out.count() == 2 * n


def test_sparse_rows_as_vectors_train_a_model(spark, tmp_path):
    rows = [(i, "a" if i % 3 else "b", float(i % 7), float(i % 3 == 0)) for i in range(120)] + [(200, None, None, 0.0)]
    df = spark.createDataFrame(rows, "id int, kind string, x double, y double")
    model = SparseEncoder(dictionary=str(tmp_path / "d"), numbers=["x"], categories=["kind"], keep=["id", "y"], numberStrategy="mean").fit(df)
    fresh = spark.createDataFrame([(1, "never seen", 1.0, 0.0), (2, None, None, 0.0)], df.schema)
    assert [(r.id, r.places) for r in model.transform(fresh).orderBy("id").collect()] == [(1, [0]), (2, [0, 1])]
    table = as_vectors(model.transform(df), model.size())
    vectors = {r.id: r.features for r in table.collect()}
    assert vectors[1].size == 3 and vectors[1].indices.tolist() == [0, 1] and vectors[3].indices.tolist() == [0, 2]
    scored = LogisticRegression(labelCol="y").fit(table).transform(table)
    assert scored.where("prediction <> y").count() == 0
    assert model.transform(df.limit(0)).count() == 0

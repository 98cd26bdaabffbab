import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import explore


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(
        {
            "id": np.arange(500),
            "x": np.round(rng.gamma(2.0, 10.0, 500), 2),
            "y": rng.normal(size=500),
            "c": rng.choice(["a", "b", "c"], 500),
            "flat": 2.5,
        }
    )
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.col("id") % 50 != 3, F.col("x")))
    return df.withColumn("c", F.when(F.col("id") % 40 != 7, F.col("c"))).cache()


@pytest.fixture(scope="module")
def pdf(frame):
    return frame.toPandas()


def test_profile_and_missing(frame, pdf):
    got = {r["feature"]: (r["non_null"], r["missing"]) for r in explore.profile_columns(frame).collect()}
    assert got == {c: (int(pdf[c].notna().sum()), int(pdf[c].isna().sum())) for c in pdf}
    assert [r["feature"] for r in explore.missing_report(frame).collect()] == ["c", "x"]
    assert explore.missing_mask(frame).where("x").count() == int(pdf.x.isna().sum())


def test_describe(frame, pdf):
    got = explore.describe_numeric(frame, ["x", "y"]).toPandas().set_index("feature")
    want = pdf[["x", "y"]].describe().T
    assert np.allclose(got[["count", "mean", "std", "min", "q25", "q50", "q75", "max"]].to_numpy(float), want.to_numpy(float))


def test_exact_means_do_not_depend_on_row_order(spark):
    cents = [0.1, 0.2, 0.3, 1e9, 0.1, 0.7]
    for values in (cents, cents[::-1]):
        rows = spark.createDataFrame([(v, 1.0) for v in values] + [(None, 2.0)], "v double, w double")
        got = {r["feature"]: r["mean"] for r in explore.describe_numeric(rows, ["v", "w"], 2).collect()}
        assert got == {"v": 100000000140 / 100 / 6, "w": 8 / 7}
    # A value beyond whole units: the plain mean.
    wide = spark.createDataFrame([(1e40,), (3e40,)], "v double")
    assert explore.describe_numeric(wide, ["v"], 2).first()["mean"] == 2e40


@pytest.mark.parametrize("column", ["x", "y", "flat"])
def test_histogram(frame, pdf, column):
    counts, edges = np.histogram(pdf[column].dropna(), bins=50)
    got = explore.histogram(frame, column).orderBy("bin").toPandas()
    assert got["n"].tolist() == counts.tolist()
    assert np.allclose(got["low"], edges[:-1]) and np.allclose(got["high"], edges[1:])


def test_density(frame, pdf):
    got = explore.density_curve(frame, "x").orderBy("point").toPandas()
    x = pdf.x.dropna().to_numpy()
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x) / width) ** 2).sum(axis=1) / (len(x) * width * np.sqrt(2 * np.pi))
    assert np.allclose(got["x"], grid) and np.allclose(got["density"], want)
    assert explore.density_curve(frame, "flat").count() == 0


def test_box_by_category_in_either_order(frame, pdf):
    got = explore.box_by_category(frame, "x", "c").toPandas().set_index("c").sort_index()
    again = explore.box_by_category(frame, "c", "x").toPandas().set_index("c").sort_index()
    assert got.equals(again[got.columns])
    for c, part in pdf.dropna(subset=["c", "x"]).groupby("c"):
        q1, q2, q3 = part.x.quantile([0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = part.x[(part.x >= lo) & (part.x <= hi)]
        assert got.loc[c].tolist() == pytest.approx([len(part), q1, q2, q3, inside.min(), inside.max(), len(part) - len(inside)])
    for pair in (("x", "y"), ("c", "c")):
        with pytest.raises(ValueError):
            explore.box_by_category(frame, *pair)


def test_outliers(frame, pdf):
    x = pdf.x.dropna()
    q1, q3 = x.quantile([0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    n = int(((x < lo) | (x > hi)).sum())
    row = explore.iqr_outliers(frame, "x").first()
    assert (row["lower"], row["upper"], row["outliers"]) == pytest.approx((lo, hi, n))
    assert row["outlier_percent"] == pytest.approx(100 * n / len(x))
    assert explore.outlier_sample(frame, "x", ["id"]).count() == min(5, n)


def test_correlations(frame, pdf):
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in explore.correlation_matrix(frame, ["x", "y", "flat"]).collect()}
    assert len(got) == 9
    assert got["x", "y"] == got["y", "x"] == pytest.approx(pdf.x.corr(pdf.y))
    assert got["x", "x"] == 1.0 and got["flat", "flat"] is None and got["x", "flat"] is None


def test_crosstab(spark, frame, pdf):
    got = explore.crosstab(frame.withColumn("even", F.col("id") % 2), "c", "even").toPandas().set_index("c").sort_index()
    want = pd.crosstab(pdf.c, pdf.id % 2)
    assert got.to_numpy().tolist() == want.to_numpy().tolist()
    with pytest.raises(ValueError):
        explore.crosstab(frame, "id", "c")


def test_frequencies_and_classes(frame, pdf):
    got = [(r["c"], r["n"]) for r in explore.category_frequencies(frame, "c").collect()]
    assert sorted(got) == sorted(pdf.c.value_counts().items())
    assert [n for _, n in got] == sorted((n for _, n in got), reverse=True)
    shares = {r["c"]: r["share"] for r in explore.class_distribution(frame, "c").collect()}
    assert shares == pytest.approx(pdf.c.value_counts(normalize=True).to_dict())


def test_pairs_use_complete_rows(frame, pdf):
    got = explore.pair_bins(frame, ["x", "y"], 10).toPandas()
    whole = pdf.dropna(subset=["x", "y"])
    both = got[(got.feature_x == "x") & (got.feature_y == "y")]
    want, _, _ = np.histogram2d(whole.x, whole.y, bins=10)
    table = np.zeros((10, 10))
    table[both.bin_x, both.bin_y] = both.n
    assert (table == want).all()
    assert (got.groupby(["feature_x", "feature_y"]).n.sum() == len(whole)).all()


def test_months(spark):
    df = spark.createDataFrame(
        [("2024-01-05", 1.0, "t"), ("2024-01-20", 3.0, "t"), ("2024-03-01", 5.0, "t"), ("bad", 9.0, "t")], "t string, v double, s string"
    )
    rows = explore.monthly_trend(df, "t", ["v", "s", "absent"]).select(F.date_format("YearMonth", "yyyy-MM"), "v").collect()
    assert [tuple(r) for r in rows] == [("2024-01", 2.0), ("2024-03", 5.0)]
    with pytest.raises(ValueError):
        explore.monthly_trend(df, "t", ["s"])


def test_analysis_by_name_skips_empty_frames(frame):
    assert explore.analyse(frame.where("false"), "describe") is None
    assert explore.analyse(frame, "frequencies", "c").count() == 3
    assert explore.analyse(frame, explore.box_summary, ["x"]).count() == 1


@pytest.mark.parametrize("column", ["absent", "c"])
def test_wrong_columns_are_refused(frame, column):
    for analysis in (explore.histogram, explore.iqr_outliers, explore.density_curve):
        with pytest.raises(ValueError):
            analysis(frame, column)

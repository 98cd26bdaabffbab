import pytest
from pyspark.sql import functions as F

from riskloom.operators import clean, derive
from riskloom.sources import tables


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, float("nan")), (None, float("nan")), (2, 1.0)], "a int, b double")
    assert clean.drop_exact_duplicates(df).count() == 3
    assert clean.duplicate_report(df).first()[:] == (5, 3, 2, 2, 1)


def test_report_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert clean.duplicate_report(df).first()[:] == (0, 0, 0, 2, 0)


def test_types_are_corrected_where_columns_exist(spark):
    df = spark.createDataFrame([("2024-01-01", "7"), ("x", "y"), (None, None)], "t string, n string")
    rows = clean.correct_types(df, ["t", "absent"], ["n", "absent"]).select(F.unix_seconds("t"), "n").collect()
    assert [tuple(r) for r in rows] == [(1704067200, 7.0), (0, 0.0), (0, 0.0)]


def test_everything_becomes_a_number(spark):
    df = spark.createDataFrame([("12", True, 3, "k")], "a string, b boolean, c int, key string")
    df = df.withColumn("t", F.lit("1970-01-01 00:00:05").cast("timestamp")).withColumn("n", F.lit("1970-01-01 00:00:07").cast("timestamp_ntz"))
    assert clean.ensure_numeric(df, exclude=["key"]).first().asDict() == {
        "a": 12.0, "b": 1.0, "c": 3.0, "key": "k", "t": 5.0, "n": 7.0
    }


def test_fills(spark):
    df = spark.createDataFrame([(None, None, 1), (float("nan"), "b", None)], "x double, s string, i int")
    assert [tuple(r) for r in clean.fill_missing(df).collect()] == [(0.0, "missing_value", 1), (0.0, "b", 0)]


def test_fill_for_scoring(spark):
    df = spark.createDataFrame(
        [(1.0, "a", "5", None), (None, "b", "x", None), (4.0, "b", None, None), (2.0, None, "1", None)],
        "x double, s string, n string, e string",
    )
    rows = clean.fill_for_scoring(df, numbers_from_text=["n"]).collect()
    assert [tuple(r) for r in rows] == [
        (1.0, "a", 5.0, "missing"), (2.0, "b", 0.0, "missing"), (4.0, "b", 0.0, "missing"), (2.0, "b", 1.0, "missing")
    ]


def test_ids_for_scoring(spark):
    df = spark.createDataFrame([(7, 0), (None, 1)], "user_id int, n int")
    rows = clean.scoring_ids(df, "ecommerce", row_key="n").collect()
    assert [(r["CustomerId"], r["TransactionId"]) for r in rows] == [("7", "7_0"), ("nan", "nan_1")]
    rows = clean.scoring_ids(df.drop("user_id"), "ecommerce", row_key="n").collect()
    assert [(r["CustomerId"], r["TransactionId"]) for r in rows] == [("CUST_0", "TXN_0"), ("CUST_1", "TXN_1")]
    card = df.withColumn("TransactionId", F.lit("mine"))
    rows = clean.scoring_ids(card, "card", row_key="n").collect()
    assert [(r["CustomerId"], r["TransactionId"]) for r in rows] == [("CC_CUST_0", "mine"), ("CC_CUST_1", "mine")]
    with pytest.raises(ValueError):
        clean.scoring_ids(df, "other")


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(5).write.parquet(path)
    df = spark.read.parquet(path)
    numbers = [r["n"] for r in clean.number_rows(df, "n").collect()]
    assert sorted(numbers) == list(range(1000))
    assert {r["id"]: i for i, r in enumerate(df.collect())} == {r["id"]: r["n"] for r in clean.number_rows(df, "n").collect()}


def test_missing_feature_inputs(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert derive.add_refund_flag(df).first()["IsRefund"] == 0
    row = derive.add_calendar_features(df).first()
    assert tuple(row[c] for c in derive.CALENDAR_FEATURES) == (0, 0, 0, 0) and row["time_since_signup"] == 0.0


def test_reading_what_is_not_there(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, ip string").schema
    for path in ("/no/such/file.csv",):
        empty = tables.read_delimited(spark, path, schema=schema)
        assert empty.count() == 0 and empty.columns == ["a", "ip"]
        assert tables.read_delimited(spark, path).count() == 0
    assert tables.read_delimited(spark, str(tmp_path), kind="xlsx", schema=schema).count() == 0


def test_delimiters_and_types(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("a|ip|x\n1|1.5|2\n2|3.25|4\n")
    df = tables.read_delimited(spark, str(path), delimiter="|", kind="txt", column_types={"ip": "string"})
    assert df.dtypes == [("a", "int"), ("ip", "string"), ("x", "int")]
    assert [r["ip"] for r in df.orderBy("a").collect()] == ["1.5", "3.25"]


def test_processed_tables_are_reused(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "processed")
    assert tables.read_or_build(spark, path, build).count() == 3
    assert tables.read_or_build(spark, path, build).count() == 3
    assert len(calls) == 1
    tables.read_or_build(spark, path, build, rebuild=True)
    assert len(calls) == 2

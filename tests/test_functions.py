import math

from pyspark.sql import functions as F

from riskloom.functions import calendar, coerce, labels
from riskloom.functions.hashing import digest, unit, word
from riskloom.functions.network import ip_to_int


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def results(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_addresses(spark):
    known = {
        "192.168.1.1": 3232235777, "10.0.0.255": 167772415, "255.255.255.255": 4294967295, "0.0.0.0": 0,
        "invalid.ip": 0, None: None, "1.2.3": 16909056, "1.2.3.4.5": 16909060, "300.0.0.0": 300 << 24,
        "1.2d.3.4": 16777216 + 768 + 4, "": 0,
    }
    assert results(column(spark, known), ip_to_int(F.col("x"))) == list(known.values())


def test_numeric_addresses_keep_their_integer_part(spark):
    assert results(column(spark, ["732758368.8", None, "x"]), ip_to_int(F.col("x"), "numeric")) == [732758368, None, 0]


def test_numbers_from_text(spark):
    df = column(spark, ["12", " 1e3 ", "abc", None, "nan", "12d", "3.5f", "-0.5"])
    kind = df.schema["x"].dataType
    assert results(df, coerce.number_or_zero(F.col("x"), kind)) == [12.0, 1000.0, 0.0, 0.0, 0.0, 0.0, 0.0, -0.5]


def test_missing_numbers(spark):
    df = column(spark, [1.0, None, math.nan], "double")
    assert results(df, coerce.number_or_null(F.col("x"), df.schema["x"].dataType)) == [1.0, None, None]


def test_times_from_text(spark):
    df = column(spark, ["2024-02-01 10:00:00", "not a date", None])
    got = results(df, F.unix_seconds(coerce.timestamp_or_epoch(F.col("x"), df.schema["x"].dataType)))
    assert got == [1706781600, 0, 0]


def test_epoch_seconds_round_down(spark):
    df = column(spark, ["1969-12-31 23:59:59.5", "1970-01-01 00:00:01.9", None])
    assert results(df, coerce.epoch_seconds(F.col("x").try_cast("timestamp"))) == [-1.0, 1.0, 0.0]


def test_calendar(spark):
    df = column(spark, ["2024-01-01 05:06:07", None]).select(F.col("x").cast("timestamp"))
    parts = df.select(*calendar.calendar_parts(F.col("x")).values()).collect()
    assert [tuple(r) for r in parts] == [(5, 0, 1, 2024), (0, 0, 0, 0)]


def test_gaps_are_never_negative(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-02 12:00:00"), ("2024-01-02 00:00:00", "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00")],
        "a string, b string",
    ).select(*[F.col(c).cast("timestamp") for c in "ab"])
    assert results(df, calendar.non_negative(calendar.gap_days(F.col("a"), F.col("b")))) == [1.5, 0.0, 0.0]


def test_labels(spark):
    df = column(spark, [0.49, 0.5, None], "double")
    assert results(df, labels.label_at(F.col("x"))) == [0, 1, None]
    assert results(spark.range(1), labels.ratio_or_zero(F.lit(0), F.lit(0))) == [0.0]


def test_hash_draws(spark):
    import hashlib

    df = column(spark, ["a"])
    want = hashlib.md5(b"42|a").hexdigest()
    d = digest(42, F.col("x"))
    assert df.select(d, word(d, 1), unit(d, 0)).first()[:] == (
        want, int(want[8:16], 16), int(want[:8], 16) / 2**32
    )

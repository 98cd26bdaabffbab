"""One-hot encoding for columns of any number of categories: a stored dictionary, looked up by join, and sparse rows.

The dictionary is a table (feature, value, place). It is counted, ordered by range and numbered by Spark; the driver gets
one number per range and the most frequent value of each column. A row becomes its places and
values: first the standardised numbers, then a 1 for each category it has. Values that were not there when fitting have
no place, as in the dense encoder; a null takes the place of the most frequent value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import encode, modes
from riskloom.session import scratch_path, written_once

PLACES, VALUES = "places", "values"
#: Low bits of Spark's row ids count the rows of a partition.
ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[str], first: int, name: str) -> DataFrame:
    """``df`` with ``place`` from ``first`` up in the order of the columns, without a task that sees all rows.

    Rows are dealt to ranges and sorted inside; a range begins where the ones before it end.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id())
    ranges = written_once(ranges, name)
    part = F.shiftright("__row", ROW_BITS).cast("int")
    counts = ranges.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row per range
    starts, total = {}, first
    for row in counts:
        starts[row["part"]] = total
        total += row["count"]
    if not starts:
        return ranges.withColumn("place", F.lit(0).cast("long")).drop("__row")
    at = F.create_map(*[x for k, v in starts.items() for x in (F.lit(k).cast("int"), F.lit(v).cast("long"))])
    place = F.element_at(at, part) + F.col("__row").bitwiseAND((1 << ROW_BITS) - 1)
    return ranges.withColumn("place", place).drop("__row")


class _SparseOptions(Params):
    numbers = Param(Params._dummy(), "numbers", "columns to fill and standardise")
    categories = Param(Params._dummy(), "categories", "columns to fill and one-hot encode")
    keep = Param(Params._dummy(), "keep", "columns passed on untouched, such as key and label")
    dictionary = Param(Params._dummy(), "dictionary", "path of the stored dictionary")
    numberStrategy = Param(Params._dummy(), "numberStrategy", "fill for missing numbers")


class SparseEncoder(Estimator, _SparseOptions, DefaultParamsReadable, DefaultParamsWritable):
    """Fit fills and scales, and write the dictionary to ``dictionary`` (a path the model reads later; replaced if it is there)."""

    @keyword_only
    def __init__(self, *, dictionary: str | None = None, numbers: Sequence[str] = (), categories: Sequence[str] = (), keep: Sequence[str] = (), numberStrategy: str = "median"):
        super().__init__()
        self._setDefault(numbers=[], categories=[], keep=[], numberStrategy="median")
        self._set(**{n: list(v) if isinstance(v, (list, tuple)) else v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> SparseEncoderModel:
        numbers = [c for c in self.getOrDefault("numbers") if c in df.columns]
        categories = [c for c in self.getOrDefault("categories") if c in df.columns]
        fills = encode.fit_number_fills(df, numbers, self.getOrDefault("numberStrategy"))
        scales = encode.fit_scales(df, numbers, fills)
        path = self.getOrDefault("dictionary")
        if categories:
            counts = written_once(modes.category_counts(df, categories), "categories")
        else:
            counts = df.sparkSession.createDataFrame([], "feature string, value string, n long")
        best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).getField("value").alias("value"))
        order = F.array_position(F.array(*[F.lit(c) for c in categories]) if categories else F.array().cast("array<string>"), F.col("feature"))
        places = numbered(counts.withColumn("order", order), ["order", "value"], len(numbers), "places")
        places.select("feature", "value", "place", "n").write.mode("overwrite").partitionBy("feature").parquet(path)
        size = len(numbers) + counts.count()
        model = SparseEncoderModel()
        model._set(
            dictionary=path,
            keep=self.getOrDefault("keep"),
            fitted={
                "numbers": {c: [fills[c], *scales[c]] for c in numbers},
                "categories": {c: None for c in categories} | {r["feature"]: r["value"] for r in best.collect()},
                "size": size,
            },
        )
        return model


class SparseEncoderModel(Model, _SparseOptions, DefaultParamsReadable, DefaultParamsWritable):
    """Kept columns, ``places`` (rising) and ``values`` of each row; zeros are left out only for categories."""

    fitted = Param(Params._dummy(), "fitted", "fills and scales, most frequent categories, and the number of places")

    def __init__(self):
        super().__init__()
        self._setDefault(keep=[], fitted={"numbers": {}, "categories": {}, "size": 0})

    def size(self) -> int:
        return self.getOrDefault("fitted")["size"]

    def dictionary_table(self) -> DataFrame:
        shape = "value string, place long, n long, feature string"
        return SparkSession.active().read.schema(shape).parquet(self.getOrDefault("dictionary"))

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = self.getOrDefault("fitted")
        kept = [c for c in self.getOrDefault("keep") if c in df.columns]
        numbers = [
            ((encode._filled_number(df, c, {c: fill}) - F.lit(mean)) / F.lit(scale)).alias(f"__number_{i}")
            for i, (c, (fill, mean, scale)) in enumerate(fitted["numbers"].items())
        ]
        texts = [
            F.coalesce(encode.quoted(c).cast("string"), F.lit(most)).alias(f"__text_{i}") for i, (c, most) in enumerate(fitted["categories"].items())
        ]
        out = df.select(*[encode.quoted(c) for c in kept], *numbers, *texts)
        dictionary = self.dictionary_table()
        for i, c in enumerate(fitted["categories"]):
            # A partition of the dictionary per column. Spark sends a small one to all tasks; a large one is joined by a
            # shuffle on the value, where a very common value of the rows is split at run time.
            places = dictionary.where(F.col("feature") == c).select(F.col("value").alias(f"__text_{i}"), F.col("place").alias(f"__place_{i}"))
            out = out.join(places, f"__text_{i}", "left")
        found = F.array(*[F.col(f"__place_{i}") for i in range(len(texts))]) if texts else F.array().cast("array<bigint>")
        found = F.filter(found, lambda p: p.isNotNull())
        fixed = F.array(*[F.lit(i).cast("long") for i in range(len(numbers))]) if numbers else F.array().cast("array<bigint>")
        values = F.array(*[F.col(f"__number_{i}") for i in range(len(numbers))]) if numbers else F.array().cast("array<double>")
        # The dictionary is numbered column by column, so the places rise already.
        return out.select(
            *[encode.quoted(c) for c in kept],
            F.concat(fixed, found).alias(PLACES),
            F.concat(values, F.transform(found, lambda p: F.lit(1.0))).alias(VALUES),
        )


def as_vectors(encoded: DataFrame, size: int, column: str = "features") -> DataFrame:
    """The encoded rows with an MLlib sparse vector instead of places and values, as a stored table.

    Parquet keeps a vector as these four fields, so it is written in plain columns and read as a vector.
    """
    others = [c for c in encoded.columns if c not in (PLACES, VALUES)]
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.col(PLACES).cast("array<int>").alias("indices"), F.col(VALUES).alias("values"))
    plain = encoded.select(*[encode.quoted(c) for c in others], vector.alias(column))
    path = scratch_path(encoded.sparkSession, "vectors")
    plain.write.parquet(path)
    shape = T.StructType([f for f in plain.schema.fields if f.name != column]).add(column, VectorUDT())
    return encoded.sparkSession.read.schema(shape).parquet(path)

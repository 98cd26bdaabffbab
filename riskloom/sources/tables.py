"""Delimited and parquet sources and sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import scratch_path

log = logging.getLogger(__name__)

DELIMITED_KINDS = ("csv", "txt")


def _override(schema: T.StructType, overrides: Mapping[str, str | T.DataType]) -> T.StructType:
    fields = []
    for field in schema.fields:
        wanted = overrides.get(field.name, field.dataType)
        if isinstance(wanted, str):
            wanted = T._parse_datatype_string(wanted)
        fields.append(T.StructField(field.name, wanted, True))
    return T.StructType(fields)


def read_delimited(
    spark: SparkSession,
    path: str,
    delimiter: str = ",",
    kind: str = "csv",
    schema: T.StructType | None = None,
    column_types: Mapping[str, str | T.DataType] | None = None,
) -> DataFrame:
    """Read a headed text table lazily.

    With a ``schema`` nothing is scanned up front; without one, types are inferred in a
    pass over the file. ``column_types`` replaces the type of single columns, so an
    address column can stay text. An unsupported kind or a path that cannot be read is
    logged and gives an empty frame with the columns that are known.
    """
    empty = spark.createDataFrame([], _override(schema or T.StructType([]), column_types or {}))
    if kind not in DELIMITED_KINDS:
        log.error("unsupported kind %r, expected one of %s", kind, DELIMITED_KINDS)
        return empty
    reader = spark.read.option("header", True).option("sep", delimiter)
    try:
        if schema is None:
            schema = reader.option("inferSchema", True).csv(path).schema
        return reader.option("inferSchema", False).schema(_override(schema, column_types or {})).csv(path)
    except AnalysisException as problem:
        log.error("cannot read %s: %s", path, problem.getCondition())
        return empty


def read_delimited_checked(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows, refused lines) of a text table, from one pass.

    A line is refused when it has too few or too many fields, when a quote is not closed, or when a field does not read as its
    column's type (an empty field is a null). Refused lines come whole, with the reason, the file and where
    in it the block begins that holds them. The pass writes both to the shared folder; types are given, so none is spent on inferring them.
    """
    line = "__line"
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]).add(line, T.StringType())
    raw = spark.read.options(header=header, sep=delimiter, mode="PERMISSIVE", columnNameOfCorruptRecord=line).schema(texts).csv(path)
    quotes = F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit("")))
    shape = F.when(F.col(line).isNotNull(), F.when(quotes % 2 == 1, F.lit("open quote")).otherwise(F.lit("number of fields")))
    cells = {f.name: F.col(f"`{f.name}`") for f in schema.fields}
    typed = {name: cells[name].try_cast(f.dataType) for name, f in zip(cells, schema.fields)}
    wrong = [F.when(cells[n].isNotNull() & typed[n].isNull(), F.lit(f"{n} is not {f.dataType.simpleString()}")) for n, f in zip(cells, schema.fields)]
    whole = F.coalesce(F.col(line), F.concat_ws(delimiter, *[F.coalesce(c, F.lit("")) for c in cells.values()]))
    both = raw.select(
        F.struct(*[typed[n].alias(n) for n in typed]).alias("row"),
        F.struct(whole.alias("line"), F.coalesce(shape, *wrong).alias("reason"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).alias("refusal"),
    )
    path = scratch_path(spark, "checked-lines")
    both.withColumn("refused", F.col("refusal.reason").isNotNull()).write.partitionBy("refused").parquet(path)
    kept = spark.read.schema(T.StructType([*both.schema.fields, T.StructField("refused", T.BooleanType())])).parquet(path)
    return kept.where("not refused").select("row.*"), kept.where("refused").select("refusal.*")


def write_features(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``; text output carries a header row."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False
) -> DataFrame:
    """Use the table at ``path`` when it is complete, else build it, write it and read it back.

    A table is complete when its success marker is there, which a writer leaves last.
    """
    if not rebuild:
        if is_complete(spark, path):
            return spark.read.parquet(path)
        log.info("no complete table at %s, building it", path)
    write_features(build(), path)
    return spark.read.parquet(path)

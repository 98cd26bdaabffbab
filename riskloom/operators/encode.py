"""Imputing, standardising and one-hot encoding with statistics fitted once and re-applied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import coerce
from riskloom.operators import modes
from riskloom.operators.quantiles import exact_quantiles


def quoted(name: str) -> Column:
    """Column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fit_number_fills(df: DataFrame, columns: Sequence[str], strategy: str = "median") -> dict[str, float]:
    """Value put in place of a missing number: exact median, mean or most frequent value.

    ``zero`` is for columns known to have no missing numbers left.
    """
    if not columns or strategy == "zero":
        return dict.fromkeys(columns, 0.0)
    if strategy == "median":
        found = {c: v[0.5] for c, v in exact_quantiles(df, columns, [0.5]).items()}
    elif strategy == "mean":
        row = df.agg(*[F.avg(coerce.number_or_null(quoted(c), df.schema[c].dataType)).alias(c) for c in columns]).first()
        found = row.asDict()
    elif strategy == "most_frequent":
        found = {c: None if v is None else float(v) for c, v in modes.most_frequent(df, columns).items()}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return {c: 0.0 if v is None else v for c, v in found.items()}


def fit_category_fills(df: DataFrame, columns: Sequence[str], strategy: str = "most_frequent") -> dict[str, str | None]:
    """Value put in place of a missing category: the most frequent, the smallest on ties."""
    if strategy != "most_frequent":
        raise ValueError(f"unknown strategy {strategy!r}")
    return modes.most_frequent(df, columns) if columns else {}


def fit_scales(df: DataFrame, columns: Sequence[str], fills: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation after filling; a constant column gets divisor 1."""
    if not columns:
        return {}
    filled = {c: _filled_number(df, c, fills) for c in columns}
    row = df.agg(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(filled.values())],
        *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(filled.values())],
        # Rounding can leave a tiny deviation on a constant column; compare the ends instead.
        *[(F.min(v) < F.max(v)).alias(f"v{i}") for i, v in enumerate(filled.values())],
    ).first()
    return {
        c: (row[f"m{i}"] or 0.0, row[f"s{i}"] if row[f"v{i}"] and row[f"s{i}"] else 1.0)
        for i, c in enumerate(columns)
    }


def _filled_number(df: DataFrame, column: str, fills: dict[str, float]) -> Column:
    return F.coalesce(coerce.number_or_null(quoted(column), df.schema[column].dataType), F.lit(float(fills[column])))


class _EncoderOptions(Params):
    numbers = Param(Params._dummy(), "numbers", "columns to fill and standardise")
    categories = Param(Params._dummy(), "categories", "columns to fill and one-hot encode")
    keep = Param(Params._dummy(), "keep", "columns passed on untouched, such as key and label")
    numberStrategy = Param(Params._dummy(), "numberStrategy", "fill for missing numbers")
    categoryStrategy = Param(Params._dummy(), "categoryStrategy", "fill for missing categories")
    remainder = Param(Params._dummy(), "remainder", "'passthrough' or 'drop' all other columns")
    maxCategories = Param(Params._dummy(), "maxCategories", "most categories of one column; None: any number")


class FeatureEncoder(Estimator, _EncoderOptions, DefaultParamsReadable, DefaultParamsWritable):
    """Fit fills, scales and categories; columns that do not exist are skipped."""

    @keyword_only
    def __init__(
        self,
        *,
        numbers: Sequence[str] = (),
        categories: Sequence[str] = (),
        keep: Sequence[str] = (),
        numberStrategy: str = "median",
        categoryStrategy: str = "most_frequent",
        remainder: str = "passthrough",
        maxCategories: int | None = None,
    ):
        super().__init__()
        self._set(**{n: list(v) if isinstance(v, (list, tuple)) else v for n, v in self._input_kwargs.items() if v is not None})
        for name, value in (
            ("numbers", []), ("categories", []), ("keep", []), ("numberStrategy", "median"),
            ("categoryStrategy", "most_frequent"), ("remainder", "passthrough"), ("maxCategories", None),
        ):
            self._setDefault(**{name: value})

    def _fit(self, df: DataFrame) -> FeatureEncoderModel:
        def option(name: str):
            return self.getOrDefault(name)

        numbers = [c for c in option("numbers") if c in df.columns]
        categories = [c for c in option("categories") if c in df.columns]
        fills = fit_number_fills(df, numbers, option("numberStrategy"))
        scales = fit_scales(df, numbers, fills)
        if option("categoryStrategy") != "most_frequent":
            raise ValueError(f"unknown strategy {option('categoryStrategy')!r}")
        values, most = modes.category_lists(df, categories, option("maxCategories")) if categories else ({}, {})
        for c in categories:
            if isinstance(df.schema[c].dataType, T.NumericType):
                values[c] = sorted(values[c], key=float)
        model = FeatureEncoderModel()
        model._set(
            keep=option("keep"),
            remainder=option("remainder"),
            fitted={
                "numbers": {c: [fills[c], *scales[c]] for c in numbers},
                "categories": values,
                "category_fills": most,
            },
        )
        return model


class FeatureEncoderModel(Model, _EncoderOptions, DefaultParamsReadable, DefaultParamsWritable):
    """One projection: standardised numbers, one-hot columns, other columns as numbers, kept columns."""

    fitted = Param(Params._dummy(), "fitted", "fills, scales and categories by column")

    def __init__(self):
        super().__init__()
        self._setDefault(keep=[], remainder="passthrough", fitted={"numbers": {}, "categories": {}, "category_fills": {}})

    def feature_names(self) -> list[str]:
        """Numeric and one-hot columns, in output order."""
        fitted = self.getOrDefault("fitted")
        return [*fitted["numbers"], *[f"{c}_{v}" for c, values in fitted["categories"].items() for v in values]]

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted, keep = self.getOrDefault("fitted"), self.getOrDefault("keep")
        used = {*fitted["numbers"], *fitted["categories"], *keep}
        out: list[Column] = []
        for name, (fill, mean, scale) in fitted["numbers"].items():
            out.append(((_filled_number(df, name, {name: fill}) - F.lit(mean)) / F.lit(scale)).alias(name))
        for name, values in fitted["categories"].items():
            value = F.coalesce(quoted(name).cast("string"), F.lit(fitted["category_fills"].get(name)))
            out += [F.when(value == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{name}_{v}") for v in values]
        if self.getOrDefault("remainder") == "passthrough":
            out += [
                coerce.number_or_zero(quoted(f.name), f.dataType).alias(f.name)
                for f in df.schema.fields
                if f.name not in used
            ]
        out += [quoted(c) for c in keep if c in df.columns]
        return df.select(*out)

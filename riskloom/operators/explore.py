"""Exploratory analysis: the numbers behind the usual tables and charts.

Every analysis is a function from a frame to a small frame. Results that become bin edges or
bounds (extremes, quartiles) are fetched as scalars first, so the main pass filters and bins on
literals.
"""

from __future__ import annotations

import itertools
import logging
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import coerce
from riskloom.functions.calendar import month_start
from riskloom.functions.labels import percent_of
from riskloom.operators.clean import numeric_columns
from riskloom.operators.encode import quoted
from riskloom.operators.modes import category_counts
from riskloom.operators.quantiles import exact_quantiles, exact_quantiles_by

log = logging.getLogger(__name__)

# Reach of the whiskers, bins of a histogram, points of a density curve, and the
# number of distinct values from which a column no longer counts as categorical.
WHISKER = 1.5
BINS = 50
CURVE_POINTS = 200
MANY_VALUES = 50


def _number(df: DataFrame, column: str) -> Column:
    return coerce.number_or_null(quoted(column), df.schema[column].dataType)


def _present(df: DataFrame, column: str) -> Column:
    """Not missing: neither null nor NaN."""
    filled = quoted(column).isNotNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        filled = filled & ~F.isnan(quoted(column))
    return filled


def require_numeric(df: DataFrame, *columns: str) -> None:
    for column in columns:
        if column not in df.columns:
            raise ValueError(f"no column {column!r}")
        if not isinstance(df.schema[column].dataType, T.NumericType):
            raise ValueError(f"column {column!r} is not numeric")


# --- columns and missing values ------------------------------------------------------------


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, filled and missing count and missing percent of each column, from one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_present(df, c)).alias(f"filled_{i}") for i, c in enumerate(df.columns)],
    )
    kinds = dict(df.dtypes)
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(kinds[c]).alias("dtype"),
                F.col(f"filled_{i}").alias("non_null"),
                (F.col("rows") - F.col(f"filled_{i}")).alias("missing"),
                percent_of(F.col("rows") - F.col(f"filled_{i}"), F.col("rows")).alias("missing_percent"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counted.select(F.inline(lines))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, most first."""
    report = profile_columns(df).where("missing > 0").select("feature", "missing", "missing_percent")
    return report.orderBy(F.col("missing").desc(), "feature")


def missing_mask(df: DataFrame) -> DataFrame:
    """The frame with each value replaced by whether it is missing."""
    return df.select(*[(~_present(df, c)).alias(c) for c in df.columns])


def missing_blocks(df: DataFrame, key: str, block_rows: int) -> DataFrame:
    """Missing values per block of keys and column: a mask that stays readable at any size."""
    columns = [c for c in df.columns if c != key]
    block = F.floor(F.col(key) / F.lit(block_rows)).alias("block")
    counted = df.groupBy(block).agg(*[F.count_if(~_present(df, c)).alias(f"n_{i}") for i, c in enumerate(columns)])
    lines = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"n_{i}").alias("missing")) for i, c in enumerate(columns)]
    )
    return counted.select("block", F.inline(lines))


# --- one column ----------------------------------------------------------------------------


def _mean(value: Column, scale: int | None) -> Column:
    """Mean of a column; with ``scale`` of its values in whole units of that many decimals, whose exact sum
    does not depend on the order of the rows. Where a value does not fit, the plain mean is taken."""
    plain = F.avg(value)
    if scale is None:
        return plain
    units = F.round(value * F.lit(10.0**scale)).try_cast("decimal(28,0)")
    exact = F.try_divide(F.sum(units).cast("double") / F.lit(10.0**scale), F.count(value))
    return F.when(F.count(units) == F.count(value), exact).otherwise(plain)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, mean_scale: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each numeric column.

    With ``mean_scale`` means are exact over values of that many decimals.
    """
    names = numeric_columns(df, columns)
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(_number(df, c)).alias("count"),
                _mean(_number(df, c), mean_scale).alias("mean"),
                F.stddev_samp(_number(df, c)).alias("std"),
                F.min(_number(df, c)).alias("min"),
                *[F.lit(quartiles[c][p]).cast("double").alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
                F.max(_number(df, c)).alias("max"),
            ).alias(f"c{i}")
            for i, c in enumerate(names)
        ]
    )
    return stats.select(F.inline(F.array(*[f"c{i}" for i in range(len(names))])))


def category_frequencies(df: DataFrame, feature: str) -> DataFrame:
    """Values with their counts, most frequent first; missing values are left out."""
    counts = df.where(quoted(feature).isNotNull()).groupBy(quoted(feature).alias(feature))
    return counts.agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), quoted(feature))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Share of each class among labelled rows."""
    counts = df.where(quoted(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select(label, "n", (F.col("n") / total).alias("share"))


def distinct_guard(df: DataFrame, columns: Sequence[str], limit: int = MANY_VALUES) -> DataFrame:
    """Exact number of distinct values of each column and whether it exceeds the limit."""
    counts = category_counts(df, columns).groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_values"))
    return counts.withColumn("too_many", F.col("distinct_values") > limit)


def distinct_values(df: DataFrame, column: str) -> int:
    return df.agg(F.count_distinct(quoted(column))).first()[0]


def _extent(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value; a column of one value is widened by a half on both sides."""
    row = df.agg(
        *[F.min(_number(df, c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(_number(df, c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    found = {}
    for i, c in enumerate(columns):
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        if low is not None:
            found[c] = (low, high) if low < high else (low - 0.5, high + 0.5)
    return found


def bin_edge(index: Column, low: float, high: float, bins: int) -> Column:
    return F.lit(low) + index * F.lit((high - low) / bins)


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin from 0; the last bin includes its right edge.

    A value that rounding put on the wrong side of an edge is moved by comparing with the edge.
    """
    last = bins - 1
    guess = F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(bins)), F.lit(last)).cast("int")
    return (
        F.when(value < bin_edge(guess, low, high, bins), guess - 1)
        .when((guess < last) & (value >= bin_edge(guess + 1, low, high, bins)), guess + 1)
        .otherwise(guess)
    )


def histogram(df: DataFrame, feature: str, bins: int = BINS) -> DataFrame:
    """Count per equal-width bin between the extremes, empty bins included."""
    require_numeric(df, feature)
    spark = df.sparkSession
    extent = _extent(df, [feature])
    if not extent:
        return spark.createDataFrame([], "bin int, low double, high double, n long")
    low, high = extent[feature]
    value = _number(df, feature)
    counts = df.where(value.isNotNull()).groupBy(bin_of(value, low, high, bins).alias("bin"))
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    scaffold = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return scaffold.join(counts, "bin", "left").select(
        "bin",
        bin_edge(F.col("bin"), low, high, bins).alias("low"),
        F.when(F.col("bin") == bins - 1, F.lit(high)).otherwise(bin_edge(F.col("bin") + 1, low, high, bins)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density_curve(df: DataFrame, feature: str, points: int = CURVE_POINTS) -> DataFrame:
    """Gaussian kernel density at evenly spaced points between the extremes, Scott's bandwidth.

    Each task adds up the kernels of its rows at all points, so only ``points`` numbers per task
    are shuffled.
    """
    require_numeric(df, feature)
    spark = df.sparkSession
    values = df.select(_number(df, feature).alias("x")).where("x is not null")
    stats = values.agg(F.count("x"), F.min("x"), F.max("x"), F.stddev_samp("x")).first()
    n, low, high, spread = stats
    if n < 2 or not spread:
        return spark.createDataFrame([], "point int, x double, density double")
    width = spread * n ** (-0.2)
    step = (high - low) / (points - 1)
    grid = low + np.arange(points) * step

    def add_kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(points)
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(x), 4_096):
                z = (grid[:, None] - x[None, start : start + 4_096]) / width
                total += np.exp(-0.5 * z * z).sum(axis=1)
        yield pa.RecordBatch.from_pydict({"point": np.arange(points, dtype=np.int32), "part": total})

    parts = values.mapInArrow(add_kernels, "point int, part double")
    scale = 1.0 / (n * width * math.sqrt(2.0 * math.pi))
    return parts.groupBy("point").agg((F.sum("part") * F.lit(scale)).alias("density")).select(
        "point", (F.lit(low) + F.col("point") * F.lit(step)).alias("x"), "density"
    )


def box_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 box lengths) and values beyond them."""
    require_numeric(df, *features)
    quartiles = exact_quantiles(df, features, [0.25, 0.5, 0.75])
    known = [c for c in features if quartiles[c][0.5] is not None]
    lines = []
    for i, c in enumerate(known):
        q1, q2, q3 = (quartiles[c][p] for p in (0.25, 0.5, 0.75))
        value = _number(df, c)
        within = value.between(F.lit(q1 - WHISKER * (q3 - q1)), F.lit(q3 + WHISKER * (q3 - q1)))
        lines.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.count(value).alias("n"),
                F.lit(q1).alias("q1"),
                F.lit(q2).alias("median"),
                F.lit(q3).alias("q3"),
                F.min(F.when(within, value)).alias("whisker_low"),
                F.max(F.when(within, value)).alias("whisker_high"),
                F.count_if(~within).alias("outliers"),
            ).alias(f"c{i}")
        )
    if not known:
        return df.sparkSession.createDataFrame(
            [], "feature string, n long, q1 double, median double, q3 double, whisker_low double, "
            "whisker_high double, outliers long"
        )
    return df.agg(*lines).select(F.inline(F.array(*[f"c{i}" for i in range(len(known))])))


# --- outliers ------------------------------------------------------------------------------


def iqr_bounds(df: DataFrame, feature: str) -> tuple[float, float, float] | None:
    """Length of the box and the two bounds; None for a column without values."""
    require_numeric(df, feature)
    found = exact_quantiles(df, [feature], [0.25, 0.75])[feature]
    if found[0.25] is None:
        return None
    iqr = found[0.75] - found[0.25]
    return iqr, found[0.25] - WHISKER * iqr, found[0.75] + WHISKER * iqr


def iqr_outliers(df: DataFrame, feature: str) -> DataFrame:
    """One row: box length, bounds, number of outliers and their percent of the values."""
    bounds = iqr_bounds(df, feature)
    if bounds is None:
        return df.sparkSession.createDataFrame(
            [], "feature string, iqr double, lower double, upper double, outliers long, outlier_percent double"
        )
    iqr, low, high = bounds
    value = _number(df, feature)
    beyond = F.count_if((value < F.lit(low)) | (value > F.lit(high)))
    return df.agg(
        F.lit(feature).alias("feature"),
        F.lit(iqr).alias("iqr"),
        F.lit(low).alias("lower"),
        F.lit(high).alias("upper"),
        beyond.alias("outliers"),
        percent_of(beyond, F.count(value)).alias("outlier_percent"),
    )


def outlier_sample(df: DataFrame, feature: str, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` outliers in order of the keys."""
    bounds = iqr_bounds(df, feature)
    rows = df.select(*keys, feature)
    if bounds is None:
        return rows.limit(0)
    value = _number(df, feature)
    return rows.where((value < F.lit(bounds[1])) | (value > F.lit(bounds[2]))).orderBy(*keys, feature).limit(n)


# --- two columns ---------------------------------------------------------------------------


def box_by_category(df: DataFrame, first: str, second: str) -> DataFrame:
    """Box summary of the numeric column for each value of the other; either order of arguments."""
    numeric = [isinstance(df.schema[c].dataType, T.NumericType) for c in (first, second)]
    if numeric[0] == numeric[1]:
        raise ValueError(f"one of {first!r} and {second!r} must be numeric and the other must not")
    category, number = (second, first) if numeric[0] else (first, second)
    quartiles = exact_quantiles_by(df, category, number, [0.25, 0.5, 0.75])
    # One row per category: AQE broadcasts it when small and splits busy categories otherwise.
    rows = df.select(category, _number(df, number).alias("value")).where("value is not null").join(quartiles, category)
    reach = F.lit(WHISKER) * (F.col("q_2") - F.col("q_0"))
    within = F.col("value").between(F.col("q_0") - reach, F.col("q_2") + reach)
    return rows.groupBy(category, "n", "q_0", "q_1", "q_2").agg(
        F.min(F.when(within, F.col("value"))).alias("whisker_low"),
        F.max(F.when(within, F.col("value"))).alias("whisker_high"),
        F.count_if(~within).alias("outliers"),
    ).withColumnsRenamed({"q_0": "q1", "q_1": "median", "q_2": "q3"})


def _correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; null when either is constant."""
    left, right = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(left, right), F.stddev_pop(left) * F.stddev_pop(right))


def correlation(df: DataFrame, first: str, second: str) -> DataFrame:
    require_numeric(df, first, second)
    return df.agg(
        F.lit(first).alias("feature_a"),
        F.lit(second).alias("feature_b"),
        _correlation(_number(df, first), _number(df, second)).alias("r"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all pairs of numeric columns, in long form with both orders and the diagonal.

    Each pair uses the rows where both are present; r is null when either is constant there. One
    pass finds the means, a second adds up products of the centred columns batch by batch, so
    only one number per pair and task is shuffled, however many columns there are.
    """
    names = numeric_columns(df, columns)
    values = df.select(*[_number(df, c).alias(f"c{i}") for i, c in enumerate(names)])
    row = values.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in values.columns],
        *[(F.min(c) < F.max(c)).alias(f"varies_{c}") for c in values.columns],
    ).first()
    means = np.array([row[f"mean_{c}"] or 0.0 for c in values.columns])
    varies = [bool(row[f"varies_{c}"]) for c in values.columns]
    d = len(names)

    def add_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, d, d))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - means
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            sums += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        i, j = np.divmod(np.arange(d * d), d)
        parts = dict(zip(("n", "s", "ss", "p"), sums.reshape(4, -1)))
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), **parts})

    kind = "i int, j int, n double, s double, ss double, p double"
    sums = values.mapInArrow(add_products, kind).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss", "p")])
    # (i, j) holds the sums of column i over rows where j is present; (j, i) those of column j.
    other = sums.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("t"), F.col("ss").alias("tt"))
    both = sums.join(F.broadcast(other), ["i", "j"])

    def spread(total: str, squares: str) -> Column:
        value = F.col(squares) - F.try_divide(F.col(total) * F.col(total), F.col("n"))
        # What rounding leaves of a column that is constant over these rows.
        return F.when(value > F.lit(1e-13) * F.col(squares), value)

    covariance = F.col("p") - F.try_divide(F.col("s") * F.col("t"), F.col("n"))
    r = F.try_divide(covariance, F.sqrt(spread("s", "ss")) * F.sqrt(spread("t", "tt")))
    flags = F.array(*[F.lit(v) for v in varies])
    usable = F.get(flags, F.col("i")) & F.get(flags, F.col("j"))
    labels = F.array(*[F.lit(c) for c in names])
    return both.select(
        F.get(labels, F.col("i")).alias("feature_a"),
        F.get(labels, F.col("j")).alias("feature_b"),
        F.when(usable & r.isNotNull(), F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(r)).alias("r"),
    )


def crosstab_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Counts of value pairs in long form; pairs with a missing side are left out."""
    return df.na.drop(subset=[first, second]).groupBy(first, second).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, first: str, second: str) -> DataFrame:
    """One row per value of the first column and one count column per value of the second.

    Numeric columns with many values are refused.
    """
    for column in (first, second):
        if isinstance(df.schema[column].dataType, T.NumericType) and distinct_values(df, column) > MANY_VALUES:
            raise ValueError(f"{column!r} has too many values for a cross-tabulation")
    counts = crosstab_counts(df, first, second)
    # Spark refuses more pivot values than spark.sql.pivotMaxValues.
    table = counts.groupBy(first).pivot(second).agg(F.sum("n"))
    return table.fillna(0, subset=[c for c in table.columns if c != first])


def scatter_bins(df: DataFrame, first: str, second: str, bins: int = BINS) -> DataFrame:
    """Number of complete pairs per cell of an equal-width grid."""
    require_numeric(df, first, second)
    return pair_bins(df, [first, second], bins).where("feature_x <> feature_y").select("bin_x", "bin_y", "n")


def scatter_sample(df: DataFrame, first: str, second: str, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` complete pairs, chosen by a seeded hash of the key."""
    from riskloom.operators.sampling import seeded_sample

    require_numeric(df, first, second)
    return seeded_sample(df.na.drop(subset=[first, second]).select(*keys, first, second), keys, n, seed)


def pair_bins(df: DataFrame, columns: Sequence[str] | None = None, bins: int = BINS) -> DataFrame:
    """Grid counts of every pair of numeric columns over complete rows.

    The diagonal (a column with itself) holds its histogram, with equal bins on both axes. Each
    task adds up grids of fixed size, so a row is never copied per pair, and at most ``bins * bins``
    numbers per pair and task are shuffled.
    """
    names = numeric_columns(df, columns)
    complete = df.select(*[_number(df, c).alias(c) for c in names]).na.drop()
    extent = _extent(complete, names)
    if not extent:
        return df.sparkSession.createDataFrame(
            [], "feature_x string, feature_y string, bin_x int, bin_y int, n long"
        )
    placed = complete.select(*[bin_of(F.col(c), *extent[c], bins).alias(f"b{i}") for i, c in enumerate(names)])
    pairs = list(itertools.combinations_with_replacement(range(len(names)), 2))
    size = bins * bins

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(pairs), size), dtype=np.int64)
        for batch in batches:
            at = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            for p, (i, j) in enumerate(pairs):
                counts[p] += np.bincount(at[i] * bins + at[j], minlength=size)
        pair, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"pair": pair.astype(np.int32), "cell": cell.astype(np.int32), "n": counts[pair, cell]}
        )

    summed = placed.mapInArrow(add_up, "pair int, cell int, n long").groupBy("pair", "cell").agg(F.sum("n").alias("n"))
    xs, ys = (F.array(*[F.lit(names[pair[side]]) for pair in pairs]) for side in (0, 1))
    return summed.select(
        F.get(xs, F.col("pair")).alias("feature_x"),
        F.get(ys, F.col("pair")).alias("feature_y"),
        F.floor(F.col("cell") / bins).cast("int").alias("bin_x"),
        (F.col("cell") % bins).alias("bin_y"),
        "n",
    )


# --- time ----------------------------------------------------------------------------------


def monthly_trend(df: DataFrame, time_col: str, metrics: Sequence[str], mean_scale: int | None = None) -> DataFrame:
    """Mean of each numeric metric per month, in order; rows without a readable time are left out.

    With ``mean_scale`` means are exact over values of that many decimals.
    """
    usable = numeric_columns(df, metrics)
    for metric in set(metrics) - set(usable):
        log.warning("metric %s is missing or not numeric and is skipped", metric)
    if time_col not in df.columns or not usable:
        raise ValueError("a time column and at least one numeric metric are needed")
    when = coerce.timestamp_or_null(F.col(time_col), df.schema[time_col].dataType).cast("timestamp")
    months = df.withColumn("YearMonth", month_start(when)).where("YearMonth is not null").groupBy("YearMonth")
    return months.agg(*[_mean(_number(df, m), mean_scale).alias(m) for m in usable]).orderBy("YearMonth")


# --- choosing an analysis by name ----------------------------------------------------------

ANALYSES: dict[str, Callable[..., DataFrame]] = {
    "profile": profile_columns,
    "describe": describe_numeric,
    "missing": missing_report,
    "missing_mask": missing_mask,
    "frequencies": category_frequencies,
    "classes": class_distribution,
    "histogram": histogram,
    "density": density_curve,
    "box": box_summary,
    "outliers": iqr_outliers,
    "box_by_category": box_by_category,
    "correlation": correlation,
    "correlations": correlation_matrix,
    "crosstab": crosstab,
    "scatter": scatter_bins,
    "pairs": pair_bins,
    "months": monthly_trend,
}


def analyse(df: DataFrame, analysis: str | Callable[..., DataFrame], *args: object, **options: object) -> DataFrame | None:
    """Run an analysis chosen at run time; an empty frame is skipped with a message."""
    if df.isEmpty():
        log.warning("the frame is empty; %s is skipped", analysis)
        return None
    chosen = ANALYSES[analysis] if isinstance(analysis, str) else analysis
    return chosen(df, *args, **options)

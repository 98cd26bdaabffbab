"""Exact quantiles with linear interpolation, for columns too large to sort in one place.

An approximate sketch brackets each wanted rank between two values. One counting pass checks
the bracket and tells how many values lie below and inside it; brackets that still hold too
many rows are narrowed again by a sketch of their own rows. Only the values inside the final
brackets are grouped and ranked. Only a few scalars per quantile reach the driver, and the
answer never depends on how good the sketch was.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import coerce
from riskloom.operators.running import running_totals

SETTLE_ROWS = 200_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Bracket:
    """Values in [low, high] hold the ranks first..second of one column; `below` lie under low."""

    column: str
    share: float
    first: int
    second: int
    weight: float
    low: float
    high: float
    below: int = 0
    inside: int = 0

    def holds(self, value: Column) -> Column:
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))

    @property
    def covers(self) -> bool:
        return self.below <= self.first and self.second < self.below + self.inside


def _number(df: DataFrame, column: str) -> Column:
    return coerce.number_or_null(F.col(column), df.schema[column].dataType)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    settle_rows: int = SETTLE_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, dict[float, float | None]]:
    """``{column: {share: value}}`` over non-null, non-NaN values; None for an empty column.

    The value at share p of n sorted values is that at position p*(n-1), interpolated.
    """
    values = df.select(*[_number(df, c).alias(c) for c in columns])
    slack = 3.0 / accuracy
    wanted = sorted({min(1.0, max(0.0, p + d)) for p in shares for d in (-slack, slack)})
    stats = values.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.min(c).alias(f"min_{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"max_{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, wanted, accuracy).alias(f"cuts_{i}") for i, c in enumerate(columns)],
    ).first()

    answers: dict[str, dict[float, float | None]] = {c: {p: None for p in shares} for c in columns}
    brackets = []
    for i, column in enumerate(columns):
        n = stats[f"n_{i}"]
        if n == 0:
            continue
        least, most = stats[f"min_{i}"], stats[f"max_{i}"]
        cut = dict(zip(wanted, stats[f"cuts_{i}"]))
        for p in shares:
            position = p * (n - 1)
            first = int(math.floor(position))
            bracket = _Bracket(column, p, first, min(first + 1, n - 1), position - first, least, most, 0, n)
            if n > settle_rows:
                low, high = min(1.0, max(0.0, p - slack)), min(1.0, max(0.0, p + slack))
                bracket.low = cut[low] if low > 0.0 else least
                bracket.high = cut[high] if high < 1.0 else most
            brackets.append(bracket)

    large = [b for b in brackets if stats[f"n_{columns.index(b.column)}"] > settle_rows]
    _settle(values, large, stats, columns, settle_rows, accuracy)
    for bracket, (left, right) in zip(brackets, _ranked(values, brackets)):
        weight, gap = bracket.weight, right - left
        # Counting from the nearer end keeps the rounding error small.
        value = left + gap * weight if weight < 0.5 else right - gap * (1.0 - weight)
        answers[bracket.column][bracket.share] = value
    return answers


def _count(values: DataFrame, brackets: list[_Bracket]) -> None:
    row = values.agg(
        *[F.count_if(F.col(b.column) < F.lit(b.low)).alias(f"below_{i}") for i, b in enumerate(brackets)],
        *[F.count_if(b.holds(F.col(b.column))).alias(f"inside_{i}") for i, b in enumerate(brackets)],
    ).first()
    for i, bracket in enumerate(brackets):
        bracket.below, bracket.inside = row[f"below_{i}"], row[f"inside_{i}"]


def _settle(
    values: DataFrame, brackets: list[_Bracket], stats, columns: Sequence[str], settle_rows: int, accuracy: int
) -> None:
    """Narrow until every bracket covers its ranks and holds few rows, or one value only."""
    open_brackets = brackets
    slack = 3.0 / accuracy
    while open_brackets:
        _count(values, open_brackets)
        for bracket in open_brackets:
            if not bracket.covers:
                # The sketch missed: go back to the whole column and narrow from there.
                i = columns.index(bracket.column)
                bracket.low, bracket.high = stats[f"min_{i}"], stats[f"max_{i}"]
                bracket.below, bracket.inside = 0, stats[f"n_{i}"]
        open_brackets = [b for b in open_brackets if b.inside > settle_rows and b.low < b.high]
        if not open_brackets:
            return
        cuts = values.agg(
            *[
                F.percentile_approx(
                    F.when(b.holds(F.col(b.column)), F.col(b.column)),
                    [
                        max(0.0, (b.first - b.below) / b.inside - slack),
                        min(1.0, (b.second - b.below) / b.inside + slack),
                    ],
                    accuracy,
                ).alias(f"cut_{i}")
                for i, b in enumerate(open_brackets)
            ]
        ).first()
        narrowed = []
        for i, bracket in enumerate(open_brackets):
            low, high = cuts[f"cut_{i}"]
            if (low, high) != (bracket.low, bracket.high):
                bracket.low, bracket.high = low, high
                narrowed.append(bracket)
        open_brackets = narrowed


def _ranked(values: DataFrame, brackets: list[_Bracket]) -> list[tuple[float, float]]:
    """The values at the two ranks of each bracket; a bracket of one value answers itself."""
    known = {i: (b.low, b.low) for i, b in enumerate(brackets) if b.low == b.high}
    wide = [b for b in brackets if b.low < b.high]
    found = iter(_rank_inside(values, wide))
    return [known[i] if i in known else next(found) for i in range(len(brackets))]


def _rank_inside(values: DataFrame, brackets: list[_Bracket]) -> list[tuple[float, float]]:
    if not brackets:
        return []
    spans: dict[tuple[str, float, float], int] = {}
    for bracket in brackets:
        spans.setdefault((bracket.column, bracket.low, bracket.high), len(spans))
    hits = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("span"),
                    F.when(F.col(c).between(F.lit(low), F.lit(high)), F.col(c)).alias("value"),
                )
                for (c, low, high), i in spans.items()
            ]
        ),
        lambda hit: hit["value"].isNotNull(),
    )
    any_hit = F.lit(False)
    for column, low, high in spans:
        any_hit = any_hit | F.col(column).between(F.lit(low), F.lit(high))
    counted = (
        values.where(any_hit).select(F.inline(hits)).groupBy("span", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("upto", upto)
    # Rank r (from 0, inside the span) sits at the first value whose running count exceeds r.
    picks = [
        F.min(F.when((F.col("span") == spans[(b.column, b.low, b.high)]) & (F.col("upto") > rank - b.below), F.col("value")))
        for b in brackets
        for rank in (b.first, b.second)
    ]
    row = ranked.agg(*[p.alias(f"v{i}") for i, p in enumerate(picks)]).first()
    return [(row[f"v{2 * i}"], row[f"v{2 * i + 1}"]) for i in range(len(brackets))]


def exact_quantiles_by(df: DataFrame, by: str, column: str, shares: Sequence[float]) -> DataFrame:
    """One row per group with its size ``n`` and an exact quantile per share, named ``q_0``, ``q_1``, ….

    Equal values are merged before anything is ordered and each group is ordered in ranges,
    so one very large group is spread over many tasks. Rows with a null group or value are
    left out.
    """
    counted = (
        df.select(by, _number(df, column).alias("value"))
        .where(F.col(by).isNotNull() & F.col("value").isNotNull())
        .groupBy(by, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = running_totals(counted, "value", {"upto": "n"}, by=[by])
    sizes = counted.groupBy(by).agg(F.sum("n").alias("n"))
    ranked = upto.drop("n").join(sizes, by)
    picks = []
    for i, share in enumerate(shares):
        position = F.lit(float(share)) * (F.col("n") - 1)
        picks.append(F.min(F.when(F.col("upto") > F.floor(position), F.col("value"))).alias(f"__left_{i}"))
        picks.append(F.min(F.when(F.col("upto") > F.least(F.floor(position) + 1, F.col("n") - 1), F.col("value"))).alias(f"__right_{i}"))
    out = ranked.groupBy(by, "n").agg(*picks)
    for i, share in enumerate(shares):
        position = F.lit(float(share)) * (F.col("n") - 1)
        left, right, weight = F.col(f"__left_{i}"), F.col(f"__right_{i}"), position - F.floor(position)
        gap = right - left
        value = F.when(weight < 0.5, left + gap * weight).otherwise(right - gap * (F.lit(1.0) - weight))
        out = out.withColumn(f"q_{i}", value)
    return out.select(by, "n", *[f"q_{i}" for i in range(len(shares))])

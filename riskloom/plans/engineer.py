"""Data preparation run: both raw tables cleaned, prepared, written and reported on."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame

from riskloom.operators import clean, resample
from riskloom.plans import prepare
from riskloom.session import scratch_scope, written_alone
from riskloom.sources import runs, tables

log = logging.getLogger(__name__)


@dataclass
class Prepared:
    """Rows as re-read from the written table, and class shares before and after oversampling."""

    rows: DataFrame
    imbalance: DataFrame | None


def prepare_table(
    rows: DataFrame,
    preparation: Pipeline,
    label: str,
    key: str,
    path: str,
    fmt: str = "parquet",
    seed: int = 42,
) -> Prepared | None:
    """Prepare one raw table, write it to ``path`` and report its imbalance from the written table.

    The preparation must keep ``key`` and ``label``. An empty table is skipped with a message.
    The fitted preparation is saved next to the table.
    """
    if rows.isEmpty():
        log.warning("no raw rows for %s; skipped", path)
        return None
    spark = rows.sparkSession
    # The tables of features and of oversampling are deleted as soon as what they are for is written.
    with scratch_scope(spark):
        fitted, prepared = prepare.fit_transform(preparation, clean.label_to_int(rows, label))
        tables.write_features(clean.fill_missing(prepared), path, fmt)
    runs.save_model(fitted, f"{path}-preparation")
    written = spark.read.schema(prepared.schema).option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    features = fitted.stages[-1].feature_names()
    if label not in written.columns:
        return Prepared(written, resample.imbalance_report(written, label, key, features, seed=seed))
    return Prepared(written, written_alone(spark, "imbalance", lambda: resample.imbalance_report(written, label, key, features, seed=seed)))


def prepare_both(
    ecommerce: DataFrame,
    ranges: DataFrame,
    card: DataFrame,
    out_dir: str,
    ecommerce_key: str,
    card_key: str,
    card_numbers: Sequence[str] = prepare.CARD_NUMBERS,
    money_scale: int | None = None,
) -> dict[str, Prepared | None]:
    """Prepare the e-commerce and the card table under ``out_dir``."""
    canonical = prepare.to_canonical(ecommerce, ranges)
    return {
        "ecommerce": prepare_table(
            canonical,
            prepare.ecommerce_preparation(keep=[ecommerce_key, prepare.ECOMMERCE_LABEL], money_scale=money_scale),
            prepare.ECOMMERCE_LABEL,
            ecommerce_key,
            f"{out_dir}/ecommerce_prepared",
        ),
        "card": prepare_table(
            card,
            prepare.card_preparation(card_numbers, keep=[card_key, prepare.CARD_LABEL]),
            prepare.CARD_LABEL,
            card_key,
            f"{out_dir}/card_prepared",
        ),
    }

"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled side is a sample of all documents, with
whatever labels they have hidden. With p the share of toxic documents (the class prior, from the
training labels), the risk of a classifier f under the logistic loss l is

    p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)])

The bracket estimates the risk on the negatives; it cannot be negative, so where a step has
driven it below zero, the next one goes back up its slope instead of fitting further.

Features are the words a document contains (present or not, so long texts are not diluted), screened to
those whose presence differs between positives and unlabelled by ``SCREEN`` standard errors. Several
classifiers, each without one fold of the sample, are averaged; with linear classifiers that is again one.

Only words count: label, language, source and key are no inputs. Scoring is one narrow pass over whole
texts with a table of at most ``MOST_WORDS`` weights.

Bounds (documented samples, by a hash of the key): ``MOST_POSITIVE``, ``MOST_UNLABELLED``. Defined results: null and
empty texts score the intercept; without any positive label the score is the class prior (0 without
labels); a document labelled twice is toxic if any of its labels says so; null labels are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import over_slices, quoted
from riskloom.llm.learning import at_most, held_out, sigmoid
from riskloom.session import written_once

MOST_POSITIVE = 4_000
MOST_UNLABELLED = 16_000
MOST_WORDS = 4_000
SCREEN = 4.0
FOLDS = 3
STEPS = 300
THRESHOLD = 0.3

WORD = re.compile(r"[^\W\d_]+")


def word_ids(text: str | None) -> np.ndarray:
    """The distinct words of a text as sorted 32-bit hashes."""
    words = set(WORD.findall(text.lower())) if text else ()
    return np.unique(np.array([xxhash.xxh32_intdigest(w.encode("utf-8")) for w in words], dtype=np.uint32))


@dataclass
class Words:
    """A linear classifier over word hashes (sorted)."""

    ids: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.ids, found)
        at[at == len(self.ids)] = 0
        total = self.weights[at][self.ids[at] == found].sum() if len(self.ids) and len(found) else 0.0
        return float(sigmoid(np.array([self.intercept + total]))[0])


class Sparse:
    """Rows of present features."""

    def __init__(self, rows: list[np.ndarray], ids: np.ndarray) -> None:
        kept = [np.searchsorted(ids, r[np.isin(r, ids, assume_unique=True)]) for r in rows]
        self.columns = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(len(rows)), [len(k) for k in kept])
        self.rows, self.width = len(rows), len(ids)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=w[self.columns], minlength=self.rows)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, weights=g[self.owner], minlength=self.width)


def screened(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """The words whose presence differs most between the two samples."""
    names, inverse = np.unique(np.concatenate([*positive, *unlabelled]), return_inverse=True)
    split = sum(map(len, positive))
    in_p = np.bincount(inverse[:split], minlength=len(names)) / max(len(positive), 1)
    in_u = np.bincount(inverse[split:], minlength=len(names)) / max(len(unlabelled), 1)
    # One row more on either side keeps rare words from standing out.
    even = (in_p * len(positive) + in_u * len(unlabelled) + 1) / (len(positive) + len(unlabelled) + 2)
    error = np.sqrt(even * (1 - even) * (1 / max(len(positive), 1) + 1 / max(len(unlabelled), 1)))
    z = np.abs(in_p - in_u) / error
    top = np.argsort(-z, kind="stable")[:MOST_WORDS]
    return np.sort(names[top[z[top] >= SCREEN]])


def fit_nnpu(positive: Sparse, unlabelled: Sparse, prior: float, steps: int = STEPS, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the non-negative risk."""
    width = positive.width
    w, mean, square = (np.zeros(width + 1) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        fp, fu = positive.dot(w[:-1]) + w[-1], unlabelled.dot(w[:-1]) + w[-1]
        # Logistic loss: l(f) = log(1 + exp(-f)); slopes are -sigmoid(-f) and sigmoid(f).
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        up = -prior * sigmoid(-fp) / len(fp)
        down_p, down_u = -prior * sigmoid(fp) / len(fp), sigmoid(fu) / len(fu)
        if negative < 0:
            up, down_p, down_u = np.zeros_like(up), -down_p, -down_u
        gp = up + down_p
        slope = np.append(positive.back(gp) + unlabelled.back(down_u) + l2 * w[:-1], gp.sum() + down_u.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope * slope
        w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Words:
    if not positive or not unlabelled or not 0 < prior < 1:
        inside = min(max(prior, 1e-6), 1 - 1e-6)
        return Words(np.zeros(0, np.uint32), np.zeros(0), float(np.log(inside / (1 - inside))))
    ids = screened(positive, unlabelled)
    folds = FOLDS if min(len(positive), len(unlabelled)) >= 2 * FOLDS else 1
    total, intercept = np.zeros(len(ids)), 0.0
    for fold in range(folds):
        p = [r for i, r in enumerate(positive) if folds == 1 or i % folds != fold]
        u = [r for i, r in enumerate(unlabelled) if folds == 1 or i % folds != fold]
        w, b = fit_nnpu(Sparse(p, ids), Sparse(u, ids), prior)
        total += w / folds
        intercept += b / folds
    return Words(ids, total, intercept)


def sample_words(rows: DataFrame) -> list[np.ndarray]:
    """The word hashes of the (bounded) rows' texts, in a fixed order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [word_ids(t).tobytes() for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.binary())], ["id", "words"])

        return over_slices(batches, found)

    gathered = rows.select("id", "text").mapInArrow(work, f"id {dict(rows.dtypes)['id']}, words binary").collect()
    # Packed: four bytes a word, so both samples take some tens of megabytes.
    gathered.sort(key=lambda r: (str(r["id"]), bytes(r["words"])))
    return [np.frombuffer(bytes(r["words"]), dtype=np.uint32) for r in gathered]


def fit_toxicity(df: DataFrame, labels: DataFrame, key_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Words:
    """The classifier, learnt from rows that are not held out."""
    rows = df.select(quoted(key_col).alias("id"), quoted(text_col).alias("text")).where(~held_out(F.col("id")))
    known = labels.select(quoted(key_col).alias("id"), quoted(label_col).alias("label")).where("label IS NOT NULL AND id IS NOT NULL")
    known = written_once(known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label")), "labels")
    count, toxic = known.agg(F.count("*"), F.coalesce(F.sum(F.expr("int(label = 1)")), F.lit(0))).first()
    positive = at_most(known.where("label = 1").select("id"), "id", MOST_POSITIVE, toxic, "positive")
    unlabelled = at_most(rows, "id", MOST_UNLABELLED, rows.count(), "unlabelled")
    prior = toxic / count if count else 0.0
    return train(sample_words(rows.join(positive, "id", "left_semi")), sample_words(unlabelled), prior)


def score_toxicity(df: DataFrame, model: Words, key_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: key, held_out, score, predicted."""
    rows = df.select(quoted(key_col).alias("id"), quoted(text_col).alias("text"))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = sent.value

        def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [classifier.score(word_ids(t)) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

        return over_slices(batches, scored)

    out = rows.mapInArrow(work, f"id {dict(rows.dtypes)['id']}, score double")
    return out.select(
        F.col("id").alias(key_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

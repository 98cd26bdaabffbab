"""Document quality by co-training two views.

The *content* view sees what the text is made of: shares of capitals, digits, signs, blanks and
non-ASCII bytes, repetition of words and lines, word and line lengths. The *metadata* view sees language, source
and recorded length. Each view has its own logistic classifier. In every round each classifier
labels the unlabelled pool; those it is most sure of, in the class balance of the gold labels, become
training rows of the *other* view, at less weight than gold. A view that is sure of nothing passes
nothing on. After the rounds both views are calibrated on gold labels they never saw (Platt scaling), and one
more logistic over the two calibrated views scores every document.

Labels teach only outside the held-out quarter (see ``learning.held_out``), which is left for measuring.
Bounds (documented samples, by a hash of the key): ``MOST_LABELLED`` and ``MOST_POOL`` rows of a few
dozen numbers each are gathered to train; scoring is one narrow pass over whole texts.

Defined results: a null text is empty; missing metadata is a value of its own; unseen sources score
through the other features; with labels of one class only, or none, every document scores that class's share
(1 without labels: nothing is rejected unjudged); a document labelled twice is good if any label
says so; metadata columns that the table lacks count as missing.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import over_slices, quoted
from riskloom.llm.learning import at_most, fit_logistic, held_out, logits, sigmoid
from riskloom.session import written_once

MOST_LABELLED = 20_000
MOST_POOL = 20_000
ROUNDS = 4
#: Share of the pool a view may pass on per round, and how sure it must be.
PASSED = 0.05
SURE = 0.95
PSEUDO_WEIGHT = 0.3
THRESHOLD = 0.5
BUCKETS = 32
METADATA = ("lang", "source", "n_chars")

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
LETTERS = UPPER + bytes(range(97, 123))
# Signs that running text rarely holds; full stops, commas, quotes and brackets are left out.
SIGNS = b"!#$%&*+/<=>@\\^_`{|}~"
HIGH = bytes(range(128, 256))


def content_features(text: str | None) -> list[float]:
    text = text or ""
    data = text.encode("utf-8")
    size = len(data)
    words = text.split()
    count = len(words)
    lines = text.split("\n")

    def share(letters: bytes) -> float:
        return (size - len(data.translate(None, letters))) / max(size, 1)

    counts = Counter(words)
    letters = share(LETTERS)
    again = sum(a == b for a, b in zip(words, words[1:]))
    line_counts = Counter(lines)
    shares = [
        share(UPPER) / max(letters, 0.01),
        share(DIGITS),
        share(SIGNS),
        share(HIGH),
        data.count(b"|") / max(count, 1),
        again / max(count, 1),
        max(counts.values(), default=0) / max(count, 1),
        len(counts) / max(count, 1),
        1 - len(line_counts) / len(lines),
        sum(1 for w in words if not w[-1].isalnum()) / max(count, 1),
    ]
    # Roots spread small shares; the square keeps the large ones apart.
    return (
        [min(s, 4.0) for s in shares]
        + [min(s, 4.0) ** 0.5 for s in shares]
        + [np.log1p(count), np.log1p(len(lines)), min(size / max(count, 1), 40.0) / 10]
    )


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    out = [0.0] * (2 * BUCKETS)
    for at, value in ((0, lang), (BUCKETS, source)):
        out[at + zlib.crc32(b"" if value is None else b"=" + value.encode("utf-8")) % BUCKETS] = 1.0
    size = np.log1p(max(n_chars or 0, 0))
    return [*out, size / 10, (size / 10) ** 2, float(n_chars is None)]


def vectors(rows: DataFrame) -> DataFrame:
    """(id, content, metadata) of rows (id, text, lang, source, n_chars)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = [batch.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars")]
            content = [content_features(t) for t in columns[0]]
            metadata = [metadata_features(*m) for m in zip(*columns[1:])]
            kind = pa.list_(pa.float64())
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(content, kind), pa.array(metadata, kind)], ["id", "content", "metadata"]
            )

        return over_slices(batches, found)

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(work, f"id {kind}, content array<double>, metadata array<double>")


@dataclass
class View:
    """A standardised logistic classifier with its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return logits((x - self.mean) / self.scale, self.weights)

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


def fit_view(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    return View(mean, scale, fit_logistic((x - mean) / scale, y, weight, l2=1.0))


@dataclass
class Quality:
    views: tuple[View, View] | None
    combined: np.ndarray
    share: float

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        if self.views is None:
            return np.full(len(content), self.share)
        x = np.column_stack([v.calibrated(m) for v, m in zip(self.views, (content, metadata))])
        return sigmoid(logits(x, self.combined))


def co_train(gold: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray]) -> Quality:
    """``gold`` and ``pool`` hold the content and the metadata matrix of the same rows."""
    if len(y) < 20 or y.min() == y.max():
        return Quality(None, np.zeros(3), float(y.mean()) if len(y) else 1.0)
    # Every fifth gold row of each class calibrates and never trains a view.
    apart = np.zeros(len(y), dtype=bool)
    for label in (0, 1):
        apart[np.flatnonzero(y == label)[::5]] = True
    train = ~apart
    extra: list[list[np.ndarray]] = [[np.zeros(0, np.int64), np.zeros(0)] for _ in gold]

    def fitted(v: int) -> View:
        rows, labels = extra[v]
        x = np.vstack([gold[v][train], pool[v][rows]])
        weight = np.concatenate([np.ones(train.sum()), np.full(len(rows), PSEUDO_WEIGHT)])
        return fit_view(x, np.concatenate([y[train], labels]), weight)

    views = [fitted(0), fitted(1)]
    for _ in range(ROUNDS):
        given = []
        for v in (0, 1):
            p = sigmoid(views[v].raw(pool[v])) if len(pool[v]) else np.zeros(0)
            rows, labels = [], []
            for label, sure in ((1, p), (0, 1 - p)):
                most = max(1, int(PASSED * len(p) * np.mean(y[train] == label)))
                best = np.argsort(-sure, kind="stable")[:most]
                best = best[sure[best] >= SURE]
                rows.append(best)
                labels.append(np.full(len(best), float(label)))
            given.append((np.concatenate(rows), np.concatenate(labels)))
        for v in (0, 1):
            rows, labels = given[1 - v]
            new = ~np.isin(rows, extra[v][0])
            extra[v] = [np.append(extra[v][0], rows[new]), np.append(extra[v][1], labels[new])]
        views = [fitted(0), fitted(1)]
    for v, view in enumerate(views):
        platt = fit_logistic(view.raw(gold[v][apart])[:, None], y[apart], l2=1e-3)
        view.slope, view.shift = float(platt[0]), float(platt[1])
    x = np.column_stack([view.calibrated(m[apart]) for view, m in zip(views, gold)])
    return Quality((views[0], views[1]), fit_logistic(x, y[apart], l2=1e-2), float(y.mean()))


def standard(df: DataFrame, key_col: str, text_col: str, extra: list | None = None) -> DataFrame:
    """(id, text, lang, source, n_chars) of ``df``; columns it lacks are null."""
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    columns = [(quoted(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in METADATA]
    return df.select(quoted(key_col).alias("id"), quoted(text_col).alias("text"), *columns, *(extra or []))


def fit_quality(df: DataFrame, labels: DataFrame, key_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Quality:
    rows = standard(df, key_col, text_col).where(~held_out(F.col("id")))
    known = labels.select(quoted(key_col).alias("id"), quoted(label_col).alias("label")).where("label IS NOT NULL AND id IS NOT NULL")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").cast("double").alias("label"))
    known = written_once(known, "labels")
    gold = vectors(rows.join(at_most(known, "id", MOST_LABELLED, known.count(), "gold"), "id", "left_semi"))
    gold = gold.join(known, "id")
    rest = rows.join(known, "id", "left_anti")
    rest = vectors(at_most(rest, "id", MOST_POOL, rows.count(), "pool"))

    def matrices(gathered: list) -> list[np.ndarray]:
        widths = [len(content_features("")), len(metadata_features(None, None, None))]
        return [np.array([r[c] for r in gathered], dtype=float).reshape(-1, n) for c, n in zip(("content", "metadata"), widths)]

    taught = sorted(gold.collect(), key=lambda r: (str(r["id"]), r["content"]))
    pool = sorted(rest.collect(), key=lambda r: (str(r["id"]), r["content"]))
    y = np.array([r["label"] for r in taught], dtype=float)
    return co_train(matrices(taught), y, matrices(pool))


def score_quality(df: DataFrame, model: Quality, key_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` as one struct column ``columns``, with score and kept."""
    rows = standard(df, key_col, text_col, [F.struct("*").alias("columns")])
    sent = df.sparkSession.sparkContext.broadcast(model)
    inner = rows.select("columns", *[F.col(c) for c in ("text", *METADATA)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = [batch.column(c).to_pylist() for c in ("text", *METADATA)]
            content = np.array([content_features(t) for t in columns[0]])
            metadata = np.array([metadata_features(*m) for m in zip(*columns[1:])])
            scores = sent.value.score(content, metadata)
            return pa.RecordBatch.from_arrays([batch.column("columns"), pa.array(scores)], ["columns", "score"])

        return over_slices(batches, scored)

    schema = T.StructType([T.StructField("columns", inner.schema["columns"].dataType), T.StructField("score", T.DoubleType())])
    return inner.mapInArrow(work, schema).withColumn("kept", F.col("score") >= threshold)


def without_low_quality(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``df`` that are good enough, with all their columns."""
    return score_quality(df, fit_quality(df, labels)).where("kept").select("columns.*")

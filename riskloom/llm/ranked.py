"""Ranked lexical search: every document scored for each item, through K2-treaps over shards of the documents.

``build_index`` counts terms on bytes first (the impacts need the corpus' mean length), then cuts each input split into shards of at most
CELLS distinct (term, document) pairs and stores a treap per shard: rows are the shard's terms by falling document count, columns
its documents by key. ``search`` adds up the document counts of the items' terms over the shards, then opens every
treap for each item and keeps the best documents of a task; only these are shuffled. Items travel in blocks of at most BLOCK
(item, term) pairs, whatever their number.

Defined cases: a null text has no terms and no shard. A null or repeated key is a document of its own; among equal scores null keys come last.
A repeated item gives its rows again; an item without a term that occurs gives none. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import quoted
from riskloom.llm.treap import Treap, best_columns, build
from riskloom.session import written_once

#: Distinct (term, document) pairs and documents after which a shard is closed; (item, term) pairs sent at a time.
CELLS = 500_000
COLUMNS = 1 << 16
BLOCK = 200_000
#: Shards a task writes or reads at a time, each of some 10 MB.
TOGETHER = 2

#: Bytes of terms: ASCII digits and letters, and all bytes of other characters.
IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BLANK = bytes(b if IN_TERM[b] else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms in their order, with only A-Z lower-cased."""
    return text.encode("utf-8").translate(_BLANK).lower().split() if text else []


@dataclass
class Totals:
    documents: int
    terms: int

    def norm(self, n: np.ndarray) -> np.ndarray:
        """A document's m, from its number of terms."""
        return 75 + 25 * n * self.documents // max(self.terms, 1)

    def impact(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))


@dataclass
class Index:
    shards: DataFrame
    totals: Totals
    kind: str


def count_terms(df: DataFrame, text: str) -> Totals:
    """Documents with a term and all terms: starts of runs of term bytes, counted without cutting a text."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(0).slice(start, 64)]
                inside = IN_TERM[np.frombuffer(b"\0" + b"\0".join(texts), np.uint8)]
                begins = np.flatnonzero(inside[1:] & ~inside[:-1])
                ends = np.cumsum([len(t) + 1 for t in texts])
                terms += len(begins)
                documents += len(np.unique(np.searchsorted(ends, begins, "right")))
        yield pa.RecordBatch.from_pydict({"documents": pa.array([documents], pa.int64()), "terms": pa.array([terms], pa.int64())})

    row = df.select(quoted(text)).mapInArrow(work, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first()
    return Totals(row[0] or 0, row[1] or 0)


def last_if_none(key):
    return (True, 0) if key is None else (False, key)


#: How a treap's arrays are stored.
STORED = {"marks": "u1", "peaks": "<i4", "rows": "<i4", "columns": "<u2"}
SHARD = "keys array<{kind}>, terms binary, counts binary, depth int, marks binary, peaks binary, rows binary, columns binary"


class Shard:
    """Documents gathered for one treap: numbers only, beside one dictionary of the terms."""

    def __init__(self) -> None:
        self.keys: list = []
        self.places: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.cells = 0

    def add(self, key: object, counts: Counter) -> None:
        places = self.places
        self.keys.append(key)
        self.rows.append(np.fromiter((places.setdefault(t, len(places)) for t in counts), np.int32, len(counts)))
        self.tf.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.cells += len(counts)

    def full(self, more: int) -> bool:
        return bool(self.keys) and (self.cells + more > CELLS or len(self.keys) == COLUMNS)

    def packed(self, totals: Totals, kind: pa.DataType) -> pa.RecordBatch:
        """The shard's row: its treap, its keys in column order and its terms, space-joined, in row order."""
        order = sorted(range(len(self.keys)), key=lambda k: last_if_none(self.keys[k]))
        lengths = np.array([len(self.rows[k]) for k in order])
        sizes = np.array([self.tf[k].sum() for k in order], np.int64)
        rows, tf = np.concatenate([self.rows[k] for k in order]), np.concatenate([self.tf[k] for k in order])
        columns = np.repeat(np.arange(len(order), dtype=np.int32), lengths)
        df = np.bincount(rows, minlength=len(self.places))
        falling = np.argsort(-df, kind="stable")
        rank = np.empty(len(falling), np.int32)
        rank[falling] = np.arange(len(falling))
        names = list(self.places)
        impacts = totals.impact(tf, np.repeat(totals.norm(sizes), lengths)).astype(np.int32)
        tree = build(rank[rows], columns, impacts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([[self.keys[k] for k in order]], pa.list_(kind)),
                pa.array([b" ".join(names[k] for k in falling.tolist())], pa.binary()),
                pa.array([df[falling].astype("<i4").tobytes()], pa.binary()),
                pa.array([tree.depth], pa.int32()),
                *(pa.array([getattr(tree, n).astype(kind).tobytes()], pa.binary()) for n, kind in STORED.items()),
            ],
            names=["keys", "terms", "counts", "depth", *STORED],
        )


def build_index(df: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    totals = count_terms(df, text)
    rows = df.select(quoted(key).alias("key"), quoted(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, arrow = Shard(), None
        for batch in batches:
            arrow = batch.column(0).type
            for at in range(batch.num_rows):
                counts = Counter(terms_of(batch.column(1)[at].as_py()))
                if not counts:
                    continue
                if shard.full(len(counts)):
                    yield shard.packed(totals, arrow)
                    shard = Shard()
                shard.add(batch.column(0)[at].as_py(), counts)
        if shard.keys:
            yield shard.packed(totals, arrow)

    shards = rows.where(F.length("text") > 0).mapInArrow(work, SHARD.format(kind=kind))
    return Index(written_once(shards, "treaps", group_rows=TOGETHER), totals, kind)


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, Counter]]]:
    """(item, its terms) in lists of at most BLOCK terms (one item may pass it alone); one list is in the driver at a time."""
    block, size = [], 0
    for row in items.select(quoted(item).alias("item"), quoted(text).alias("text")).toLocalIterator():
        counts = Counter(terms_of(row["text"]))
        if block and size + len(counts) > BLOCK:
            yield block
            block, size = [], 0
        if counts:
            block.append((row["item"], counts))
            size += len(counts)
    if block:
        yield block


def document_counts(index: Index, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of the wanted terms occurs; only the shards' term lists are read."""
    sent = index.shards.sparkSession.sparkContext.broadcast(wanted)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for at in range(batch.num_rows):
                names, counts = batch.column(0)[at].as_py().split(), np.frombuffer(batch.column(1)[at].as_py(), "<i4")
                for place, name in enumerate(names):
                    if name in sent.value:
                        total[name] += int(counts[place])
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(total), pa.binary()), "df": pa.array(list(total.values()), pa.int64())})

    found = index.shards.select("terms", "counts").mapInArrow(work, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in found.collect()}  # at most one row per wanted term


def search(index: Index, items: DataFrame, count: int = 20, item: str = "item_id", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The ``count`` best documents of each row of ``items``: item, rank, key, score."""
    item_kind = items.select(quoted(item)).schema[0].dataType.simpleString()
    schema = f"place long, item {item_kind}, key {index.kind}, score long"
    spark = items.sparkSession
    items_type = items.select(quoted(item)).limit(0).toArrow().schema[0].type
    first, found = 0, None
    for block in item_blocks(items, item, text):
        df = document_counts(index, set().union(*(counts for _, counts in block)))
        weights = {t: index.totals.weight(d) for t, d in df.items()}
        sent = spark.sparkContext.broadcast([(name, {t: weights[t] * n for t, n in counts.items() if t in weights}) for name, counts in block])

        def work(batches: Iterable[pa.RecordBatch], sent=sent, first=first) -> Iterator[pa.RecordBatch]:
            block = sent.value
            wanted = set().union(*(w for _, w in block))
            best: list[list[tuple]] = [[] for _ in block]
            arrow = None
            for batch in batches:
                arrow = batch.schema.field("keys").type.value_type
                for at in range(batch.num_rows):
                    keys = batch.column("keys")[at].values.to_pylist()
                    # The arrays are views of the batch.
                    parts = {n: np.frombuffer(batch.column(n)[at].as_buffer(), kind) for n, kind in STORED.items()}
                    tree = Treap(batch.column("depth")[at].as_py(), **parts)
                    places = {t: k for k, t in enumerate(batch.column("terms")[at].as_py().split()) if t in wanted}
                    for number, (_, terms) in enumerate(block):
                        mine = [(places[t], w) for t, w in terms.items() if t in places]
                        least = best[number][-1][0] if len(best[number]) == count else 1
                        rows, weight = np.array(mine, np.int64).reshape(-1, 2).T
                        hits = best_columns(tree, rows, weight, count, least)
                        if hits:
                            merged = best[number] + [(s, keys[c]) for s, c in hits]
                            best[number] = sorted(merged, key=lambda x: (-x[0], last_if_none(x[1])))[:count]
            if arrow is not None:
                flat = [(first + number, block[number][0], k, s) for number, hits in enumerate(best) for s, k in hits]
                columns = [pa.array(list(c), kind) for c, kind in zip(list(zip(*flat)) or [()] * 4, (pa.int64(), items_type, arrow, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["place", "item", "key", "score"])

        one = index.shards.mapInArrow(work, schema)
        found = one if found is None else found.union(one)
        first += len(block)
    if found is None:
        found = spark.createDataFrame([], schema)
    best_first = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= count)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")

"""Benchmark decontamination by a distributed positional inverted index of the training tokens.

*Index.* Documents are cut into shards of bounded size. A shard stores, for each term, its postings:
the positions (in the shard's running word count) of every occurrence, in order. Shards are rows of
a written table, so the index is stored once, spread like the documents, and can be searched again;
nothing is shuffled to build it. It may be limited to the terms that the tests use.

*Search.* A window is a run of test words. Its terms are taken from the rarest of the shard on: the
rarest term's positions, moved back by the term's offset, are the candidate starts; each further
term keeps the candidates that its own moved list contains. What is left after the last term are the
exact phrase occurrences (that do not cross documents). Proximity matches ask that all terms of a
window occur, in any order, within a span of words.

*Size of the tests.* Windows are sent to the tasks in blocks of ``BLOCK`` windows; a larger test
set is searched block by block over the stored index, and the hits of the blocks are united per document.

Words: A-Z is lower-cased, then every run of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.
Defined results: a null text has no words; a test item without words has no window; one with fewer
words than a window is one window; equal items are hit together; repeated rows are judged each by
itself; a null item_id is written as an empty string; an empty benchmark marks nothing; a document
longer than a shard is a shard of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import TEXTS, quoted
from riskloom.session import written_once

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words of a shard of the index.
SHARD_WORDS = 400_000
#: Windows that are sent to the tasks at once (about 100 bytes each).
BLOCK = 200_000
INDEX = (
    "shard long, doc_ids array<long>, ends array<long>, terms array<string>, term_ends array<long>, positions binary"
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(UPPER) if not text.isascii() else text.lower()) if text else []


def build_index(
    df: DataFrame, key_col: str = "doc_id", text_col: str = "text", terms: frozenset[str] | None = None
) -> DataFrame:
    """The stored index of ``df``: one row a shard. ``terms``: leave out all other terms."""
    rows = df.select(quoted(key_col).cast("long").alias("key"), quoted(text_col).alias("text"))
    sent = df.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        part, number = TaskContext.get().partitionId() << 32, 0
        known: dict[str, int] = {t: i for i, t in enumerate(sorted(wanted))} if wanted is not None else {}
        keys: list[int | None] = []
        ends: list[int] = []
        codes: list[np.ndarray] = []
        total = 0

        def closed() -> pa.RecordBatch:
            nonlocal known
            every = np.concatenate(codes) if codes else np.zeros(0, np.int32)
            order = np.argsort(every, kind="stable")
            ranked = every[order]
            skip = int(np.searchsorted(ranked, 0))
            order, ranked = order[skip:], ranked[skip:]
            present, counts = np.unique(ranked, return_counts=True)
            names = list(known)
            out = pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([part + number], pa.int64()),
                    "doc_ids": pa.array([keys], pa.list_(pa.int64())),
                    "ends": pa.array([ends], pa.list_(pa.int64())),
                    "terms": pa.array([[names[i] for i in present]], pa.list_(pa.string())),
                    "term_ends": pa.array([np.cumsum(counts)], pa.list_(pa.int64())),
                    "positions": pa.array([order.astype("<u4").tobytes()], pa.binary()),
                }
            )
            if wanted is None:
                known = {}
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                piece = batch.slice(start, 128)
                for key, text in zip(piece.column("key").to_pylist(), piece.column("text").to_pylist()):
                    words = words_of(text)
                    if wanted is None:
                        code = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int32)
                    else:
                        look = known.get
                        code = np.array([look(w, -1) for w in words], dtype=np.int32)
                    keys.append(key)
                    codes.append(code)
                    total += len(words)
                    ends.append(total)
                    if total >= SHARD_WORDS:
                        yield closed()
                        number += 1
                        keys, ends, codes, total = [], [], [], 0
        if keys:
            yield closed()

    return written_once(rows.mapInArrow(work, INDEX), "postings")


class ShardIndex:
    """The postings of one shard, ready to be searched."""

    def __init__(self, row: dict) -> None:
        self.keys = row["doc_ids"]
        self.ends = np.array(row["ends"], dtype=np.int64)
        self.positions = np.frombuffer(row["positions"], dtype="<u4").astype(np.int64)
        stops = row["term_ends"]
        self.place = {t: (a, b) for t, a, b in zip(row["terms"], [0, *stops[:-1]], stops)}

    def postings(self, term: str) -> np.ndarray:
        start, end = self.place.get(term, (0, 0))
        return self.positions[start:end]

    def document_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, side="right")

    def phrase(self, words: tuple[str, ...]) -> np.ndarray:
        """Start positions of the exact phrase, by intersection from the rarest term on."""
        sizes = []
        for offset, word in enumerate(words):
            start, end = self.place.get(word, (0, 0))
            if start == end:
                return np.zeros(0, np.int64)
            sizes.append((end - start, offset))
        sizes.sort()
        starts = self.postings(words[sizes[0][1]]) - sizes[0][1]
        for _, offset in sizes[1:]:
            other = self.postings(words[offset])
            at = np.searchsorted(other, starts + offset)
            at[at == len(other)] = 0
            starts = starts[other[at] == starts + offset]
            if not len(starts):
                return starts
        starts = starts[starts >= 0]
        return starts[self.document_of(starts) == self.document_of(starts + len(words) - 1)]

    def near(self, words: tuple[str, ...], span: int) -> np.ndarray:
        """Positions of the rarest term around which all terms occur within ``span`` words of one
        document; the span starts or ends anywhere."""
        terms = sorted(set(words), key=lambda w: len(self.postings(w)))
        rare = self.postings(terms[0])
        if not len(rare):
            return rare
        hits = np.zeros(len(rare), dtype=bool)
        documents = self.document_of(rare)
        first = np.concatenate(([0], self.ends))[documents]
        last = self.ends[documents] - 1
        # Each start of a span that holds the rare term; spans are short.
        for back in range(span):
            low = np.maximum(rare - back, first)
            high = np.minimum(rare - back + span - 1, last)
            good = np.ones(len(rare), dtype=bool)
            for term in terms[1:]:
                other = self.postings(term)
                good &= np.searchsorted(other, high, "right") > np.searchsorted(other, low, "left")
            hits |= good
        return rare[hits]


def runs_of(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of [start, start + length) as disjoint, sorted runs."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], (starts + lengths)[order]
    reach = np.maximum.accumulate(stops)
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))
    return starts[new], reach[last]


def windows_of(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """The test windows: (words, item_ids), one row for each distinct word sequence, written once."""
    rows = items.select(quoted(id_col).cast("string").alias("item"), quoted(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = words_of(row["text"])
                count = max(1, len(words) - window + 1) if words else 0
                if count:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "item": pa.array([row["item"] or ""] * count, pa.string()),
                            "words": pa.array([words[i : i + window] for i in range(count)], pa.list_(pa.string())),
                        }
                    )

    windows = rows.mapInArrow(work, "item string, words array<string>")
    windows = windows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return written_once(windows.withColumn("number", F.monotonically_increasing_id()), "windows")


def blocks_of(windows: DataFrame, size: int) -> Iterator[list[tuple[tuple[str, ...], list[str]]]]:
    """The windows in lists of at most ``size``; only one list is in the driver at a time."""
    block = []
    for row in windows.toLocalIterator():
        block.append((tuple(row["words"]), row["items"]))
        if len(block) == size:
            yield block
            block = []
    yield block


HITS = "shard long, place int, doc_id long, n_words long, starts array<long>, stops array<long>, items array<string>"


def phrase_hits(index: DataFrame, windows: DataFrame, every_document: bool = True) -> DataFrame:
    """Per document and block: the runs of hit words and the items whose windows occur.
    The first block has a row for every document, so none is lost."""
    context = index.sparkSession.sparkContext
    found = None
    for number, block in enumerate(blocks_of(windows, BLOCK)):
        sent = context.broadcast(block)
        keep_all = every_document and number == 0

        def work(batches: Iterator[pa.RecordBatch], sent=sent, keep_all=keep_all) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    yield from searched(row, sent.value, keep_all)

        one = index.mapInArrow(work, HITS)
        found = one if found is None else found.union(one)
    return found


def searched(row: dict, block: list[tuple[tuple[str, ...], list[str]]], keep_all: bool) -> Iterator[pa.RecordBatch]:
    index = ShardIndex(row)
    starts, lengths, whose = [], [], {}
    for words, items in block:
        hits = index.phrase(words)
        if len(hits):
            starts.append(hits)
            lengths.append(np.full(len(hits), len(words)))
            for document in np.unique(index.document_of(hits)).tolist():
                whose.setdefault(document, set()).update(items)
    runs: dict[int, tuple[list[int], list[int]]] = {}
    begins = np.concatenate(([0], index.ends))
    if starts:
        low, high = runs_of(np.concatenate(starts), np.concatenate(lengths))
        # Runs of neighbouring documents can touch; they are cut at the border.
        for a, b in zip(low.tolist(), high.tolist()):
            while a < b:
                document = int(index.document_of(np.array([a]))[0])
                stop = min(b, int(index.ends[document]))
                mine = runs.setdefault(document, ([], []))
                mine[0].append(a - int(begins[document]))
                mine[1].append(stop - int(begins[document]))
                a = stop
    places = range(len(index.keys)) if keep_all else sorted(whose)
    for first in range(0, len(places), 1000):
        part = places[first : first + 1000]
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([row["shard"]] * len(part), pa.int64()),
                "place": pa.array(part, pa.int32()),
                "doc_id": pa.array([index.keys[p] for p in part], pa.int64()),
                "n_words": pa.array([int(index.ends[p] - begins[p]) for p in part], pa.int64()),
                "starts": pa.array([runs.get(p, ([], []))[0] for p in part], pa.list_(pa.int64())),
                "stops": pa.array([runs.get(p, ([], []))[1] for p in part], pa.list_(pa.int64())),
                "items": pa.array([sorted(whose.get(p, ())) for p in part], pa.list_(pa.string())),
            }
        )


RESULT = (
    "shard long, place int, doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
)


def document_hits(df: DataFrame, items: DataFrame, window: int = 10, key_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = windows_of(items, window, item_col, item_text_col)
    index = build_index(df, key_col, text_col, search_terms(windows))
    hits = phrase_hits(index, windows)
    united = hits.groupBy("shard", "place").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("stops")).alias("stops"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in ("shard", "place", "doc_id", "n_words")}
            n_hit, n_items, digests = [], [], []
            for starts, stops, names in zip(*(batch.column(n).to_pylist() for n in ("starts", "stops", "items"))):
                hit = 0
                if starts:
                    low, high = np.array(starts), np.array(stops)
                    low, high = runs_of(low, high - low)
                    hit = int((high - low).sum())
                n_hit.append(hit)
                n_items.append(len(names))
                digests.append(hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())
            yield pa.RecordBatch.from_pydict(
                columns
                | {
                    "n_hit": pa.array(n_hit, pa.int64()),
                    "n_items": pa.array(n_items, pa.int64()),
                    "items_sha256": pa.array(digests, pa.string()),
                    "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_()),
                }
            )

    return united.mapInArrow(work, RESULT).drop("shard", "place")


#: Distinct test terms up to which the index is limited to them; beyond, it holds all terms.
MOST_TERMS = 1_000_000


def search_terms(windows: DataFrame) -> frozenset[str] | None:
    terms = windows.select(F.explode("words").alias("term")).distinct().limit(MOST_TERMS + 1).collect()
    return None if len(terms) > MOST_TERMS else frozenset(row["term"] for row in terms)


MATCH = "doc_id long, item string, position long"


def matches(df: DataFrame, items: DataFrame, window: int = 10, span: int | None = None, key_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Single matches: (doc_id, item, position). Without ``span`` the starts of exact phrases; with
    it the places of a window's rarest term around which all its terms lie within ``span`` words."""
    windows = windows_of(items, window, item_col, item_text_col)
    index = build_index(df, key_col, text_col, search_terms(windows))
    context = df.sparkSession.sparkContext
    found = None
    for block in blocks_of(windows, BLOCK):
        sent = context.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    shard = ShardIndex(batch.slice(at, 1).to_pylist()[0])
                    begins = np.concatenate(([0], shard.ends))
                    for words, names in sent.value:
                        hits = shard.phrase(words) if span is None else shard.near(words, span)
                        if len(hits):
                            documents = shard.document_of(hits)
                            keys = [shard.keys[d] for d in documents.tolist()]
                            for name in names:
                                yield pa.RecordBatch.from_pydict(
                                    {
                                        "doc_id": pa.array(keys, pa.int64()),
                                        "item": pa.array([name] * len(hits), pa.string()),
                                        "position": pa.array(hits - begins[documents], pa.int64()),
                                    }
                                )

        one = index.mapInArrow(work, MATCH)
        found = one if found is None else found.union(one)
    return found.distinct()


def without_contaminated(df: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``df`` with no hit word, with all their columns; a null doc_id is judged by its text too."""
    numbered_rows = written_once(df.select(F.struct("*").alias("columns"), F.monotonically_increasing_id().alias("row")), "rows", TEXTS)
    texts = numbered_rows.select("row", F.col("columns.text").alias("text"))
    bad = document_hits(texts, items, window, key_col="row").where("contaminated").select(F.col("doc_id").alias("row"))
    # Written first, so that Spark knows their size: a few are broadcast under its own limit and the texts
    # stay where they are; many are joined by a shuffle.
    bad = written_once(bad, "contaminated")
    return numbered_rows.join(bad, "row", "left_anti").select("columns.*")

"""Near-duplicates by 64-bit SimHash, found through a byte-position inverted index with count filtering.

*Fingerprint.* Words (runs without ASCII white space, A-Z lower-cased) form three-word shingles,
repeats included; a bit is set if it is set in more than half of the shingles' XXH64 values.

*Index and count filter.* A fingerprint is eight positional bytes. Two fingerprints that differ in
at most d bits differ in at most d bytes, so of the eight (position, byte) postings they share at
least 8 - d: the guaranteed minimum. Tallying single bytes would compare almost everything with
everything, since a posting has only 256 values; the tally is therefore taken in one step: a pair
reaches the minimum exactly if it agrees on some set of 8 - d positions. Each fingerprint is posted
once for each such set under its bytes there (28 postings for d = 2); a list holds the fingerprints
that share the minimum number of positional bytes, and no pair that can qualify is in no list.

*Verification.* A list's fingerprints differ only in d bytes, so for d = 2 it has at most 65,536
members: bounded, whatever the corpus. Links (at most d differing bits) inside it are verified by
exclusive or, in short lists pair by pair and in long ones by looking up the 136 neighbours of each
member, and a spanning forest of the links is kept: a list never gives more edges than members, and no
connection is lost. Only distinct fingerprints are indexed; copies meet in their fingerprint.

*Groups.* Components of the links are found by star contraction; a component's id is its smallest
doc_id. A fingerprint that a third of the corpus shares is reduced and looked up in buckets.

Defined results: null and empty texts have fingerprint 0 and are linked like any other; texts of one
or two words have one shingle; a null doc_id takes part and gets its group's id (null if the group has no
other); repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE, TEXTS, components, numbered, quoted, shuffle_partitions, smallest_of_group
from riskloom.session import written_alone, written_once

SEED = 42
SHINGLE = 3
DISTANCE = 2
BYTES = 8
#: Lists up to this length are compared pair by pair, longer ones by neighbour look-up; both are exact.
SHORT = 64
BIT_SUMS = np.arange(64, dtype=np.uint64)


def hashes_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.array(list(map(xxhash.xxh64_intdigest, grams, repeat(SEED))), dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit over the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 8192):
        octets = hashes[start : start + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """(id, fp) of every row; fp as a signed 64-bit number."""
    rows = df.select(quoted(key_col).alias("id"), quoted(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                piece = batch.slice(start, SLICE)
                prints = [fingerprint(hashes_of(t)) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], ["id", "fp"]
                )

    return rows.mapInArrow(work, f"id {dict(rows.dtypes)['id']}, fp long")


def forest(values: np.ndarray, distance: int, free: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of places, of the links among distinct ``values``, which differ
    only in the bits of ``free``."""
    n = len(values)
    if n <= SHORT:
        left, right = np.triu_indices(n, 1)
        near = np.bitwise_count(values[left] ^ values[right]) <= distance
        links = zip(left[near].tolist(), right[near].tolist())
    else:
        order = np.argsort(values)
        ranked = values[order]
        masks = [np.bitwise_or.reduce(c) for k in range(1, distance + 1) for c in combinations(free, k)]

        def found() -> Iterator[tuple[int, int]]:
            for mask in masks:
                other = ranked ^ mask
                at = np.searchsorted(ranked, other)
                at[at == n] = 0
                hit = np.flatnonzero((ranked[at] == other) & (ranked < other))
                yield from zip(order[hit].tolist(), order[at[hit]].tolist())

        links = found()
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Verified links (u, v) among the distinct fingerprints of ``prints`` (node, fp), as nodes:
    enough of them that all connections are there."""
    sets = list(combinations(range(BYTES), BYTES - distance))
    # The bytes of a set of positions, as a mask of the fingerprint.
    masks = [sum(0xFF << (8 * p) for p in positions) for positions in sets]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    postings = prints.select(
        "node", "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("kind", "part")
    )
    lists = postings.groupBy("kind", "part").agg(F.collect_list(F.struct("fp", "node")).alias("members"))
    lists = lists.where(F.size("members") > 1).select("kind", "members.fp", "members.node")
    bits = [
        np.array([1 << (8 * p + b) for p in range(BYTES) if p not in positions for b in range(8)], dtype=np.uint64)
        for positions in sets
    ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, nodes = batch.column("fp"), batch.column("node")
            out: list[tuple[int, int]] = []
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                values = fps[i].values.to_numpy().view(np.uint64)
                names = nodes[i].values.to_numpy()
                for a, b in forest(values, distance, bits[kind]):
                    out.append((int(names[a]), int(names[b])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["u", "v"])

    return lists.mapInArrow(work, "u long, v long")


def near_duplicates(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """Rows (row, id, fp, best): ``best`` is the row (id, row) that is first of its group."""
    rows = numbered(with_fingerprints(df, key_col, text_col), "fingerprints")
    spread = shuffle_partitions(df.sparkSession)
    grouped = written_once(smallest_of_group(rows, ["fp"], ["id", "row"], spread), "same-fingerprint")
    # One node for each distinct fingerprint: the first of its rows.
    nodes = grouped.where("row = best.row").select(F.col("row").alias("node"), "fp", "best")
    joined = components(links(nodes.select("node", "fp"), distance))
    # A component's root is not among its nodes.
    joined = joined.union(joined.select("root", "root").distinct().toDF("node", "root"))
    # The first row of each component, over its fingerprints.
    members = nodes.join(joined, "node").select("node", "root", "best")
    spread_members = members.withColumn("_bucket", F.pmod(F.xxhash64("node"), F.lit(spread)))
    leaf = spread_members.groupBy("_bucket", "root").agg(F.min("best").alias("first"))
    tops = leaf.groupBy("root").agg(F.min("first").alias("first"))
    tops = leaf.select("_bucket", "root").join(tops, "root")
    heads = spread_members.join(tops, ["_bucket", "root"]).select("node", "first")
    moved = written_once(heads, "group-heads")
    # Rows reach their group through (fingerprint's first row, bucket), as in smallest_of_group.
    keyed = grouped.select("row", "id", "fp", "best", F.col("best.row").alias("node")).withColumn(
        "_bucket", F.pmod(F.xxhash64("row"), F.lit(spread))
    )
    reached = keyed.select("_bucket", "node").distinct().join(moved, "node")
    out = keyed.join(reached, ["_bucket", "node"], "left")
    return out.select("row", "id", "fp", F.coalesce("first", "best").alias("best"))


def not_first(rows: DataFrame) -> DataFrame:
    """(node) of the ``rows`` (node, id, text) that are not first of their group; equal ids by node."""
    first = near_duplicates(rows.select(F.struct(F.col("id").isNull().alias("none"), "id", "node").alias("key"), "text"), "key", "text")
    return first.where("row <> best.row").select(F.col("id.node").alias("node"))


def without_near_duplicates(df: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are first of their group, with all their columns."""
    held = written_once(df.select(F.struct("*").alias("columns"), F.monotonically_increasing_id().alias("node")), "rows", TEXTS)
    columns = quoted("columns")
    texts = held.select("node", columns.getField(key_col).alias("id"), columns.getField(text_col).alias("text"))
    leaving = written_alone(df.sparkSession, "leaving", lambda: not_first(texts))
    return held.join(leaving, "node", "left_anti").select("columns.*")

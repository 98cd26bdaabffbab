"""Removal of repeated byte strings: every byte covered by a ``length``-byte string that also starts earlier.

*Sampled suffixes.* Order all suffixes of all documents and every repeat of 100 bytes is an interval of
suffixes with a common prefix of 100. Merging the orders of shards byte by byte takes a pass over all
bytes for each byte of common prefix, so the order is built for a sample of suffixes that loses no
repeat: a position is kept (an anchor) if the hash of its 32-byte gram is the smallest in some window of
69 grams. Every 100-byte string holds an anchor, and equal strings hold the same one at the same offset.

*Shard runs and their merge.* A task sorts the anchors of its texts by (gram, hash of the whole
168-byte context), the run of its shard. Runs meet by gram: an interval of equal grams is
refined by context. Members of a refined interval after the first are repeats along their whole context. Intervals whose
contexts differ are refined once more: their contexts are fetched and every 100-byte string around the anchor
is compared, which settles the repeats that begin or end inside a context.

*Hot grams.* Copies of one context meet in a task already, and one stays for each task. A gram with a
great many different contexts (a share above ``HOT_SHARE`` of the anchors; at most 1/``HOT_SHARE`` such grams can exist,
so their list is bounded) is refined at once to its 100-byte strings, whose hashes spread it over the cluster. No
interval that one task holds has more than about twice that share.

*Strings are judged on the input*; spans are united per document and cut out of the text at the end.

Equality is decided by 64-bit polynomial hashes of 100 to 168 bytes together with the gram's. Texts longer than
``PIECE`` are worked on in overlapping pieces. Defined results: a null text is empty; a null doc_id
comes after all others; documents with equal doc_id are ordered by a hash of their text; repeated rows (equal doc_id and text)
are one document and get the same result; texts under 100 bytes lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import quoted, shuffle_partitions
from riskloom.session import written_once

LENGTH = 100
GRAM = 32
#: Grams in a window; every string of LENGTH bytes has exactly this many.
WINDOW = LENGTH - GRAM + 1
LEFT, RIGHT = WINDOW - 1, LENGTH
CONTEXT = LEFT + RIGHT
HOT_SHARE = 1 / 5000
PIECE = 1 << 20
#: Bytes of text hashed at once, and anchors of one sorted run.
CHUNK = 2 << 20
RUN = 500_000
NULL_ID = (1 << 63) - 1

ANCHOR = np.dtype(
    [("g", "<u8"), ("c", "<u8"), ("id", "<i8"), ("h", "<u4"), ("pos", "<i4"), ("left", "u1"), ("right", "u1")]
)
SPAN = np.dtype([("id", "<i8"), ("h", "<u4"), ("start", "<i4"), ("stop", "<i4")])
REQUEST = np.dtype([("g", "<u8"), ("id", "<i8"), ("h", "<u4"), ("pos", "<i4")])
NEAR = np.dtype([*REQUEST.descr, ("left", "u1"), ("right", "u1"), ("bytes", "u1", (CONTEXT,))])

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n."""
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            for k, base in enumerate((BASE, INVERSE)):
                out = np.full(n, base, dtype=np.uint64)
                out[0] = 1
                _powers[k] = np.multiply.accumulate(out)
    return _powers[0][:n], _powers[1][:n]


def mixed(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def sliding(values: np.ndarray, size: int, pick: Callable) -> np.ndarray:
    """pick over each window of ``size`` values (shorter result)."""
    done = 1
    while done * 2 <= size:
        values = pick(values[:-done], values[done:])
        done *= 2
    if done < size:
        values = pick(values[: -(size - done)], values[size - done :])
    return values


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def anchors_of(pieces: list[tuple[int, int, int, int, int, bytes]], hot: np.ndarray) -> np.ndarray:
    """Anchor records of pieces (id, h, base, keep_from, keep_to, bytes): positions in
    [keep_from, keep_to) of the piece are kept. Anchors of ``hot`` grams become their strings."""
    data = np.frombuffer(b"".join(p[5] for p in pieces), dtype=np.uint8)
    sizes = np.array([len(p[5]) for p in pieces])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, ANCHOR)
    sums = prefix_hashes(data)
    inverse = powers(n + 1)[1]
    with np.errstate(over="ignore"):
        grams = (sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1]
    order = np.maximum((mixed(grams) >> np.uint64(32)).astype(np.uint32), 1)
    # Windows must lie inside one piece.
    for end in ends[:-1]:
        order[max(0, end - GRAM + 1) : end] = 0xFFFFFFFF
    lowest = sliding(order, WINDOW, np.minimum)
    for end in ends[:-1]:
        lowest[max(0, end - LENGTH + 1) : end] = 0
    for begin, size in zip(begins, sizes):
        if size < LENGTH:
            lowest[begin : begin + size] = 0
    padded = np.zeros(len(order) + WINDOW - 1, np.uint32)
    padded[WINDOW - 1 : WINDOW - 1 + len(lowest)] = lowest
    at = np.flatnonzero(sliding(padded, WINDOW, np.maximum) == order)
    owner = np.searchsorted(ends, at, side="right")
    inside = at - begins[owner]
    fields = [np.array([p[k] for p in pieces]) for k in range(5)]
    kept = (inside >= fields[3][owner]) & (inside < fields[4][owner])
    at, owner, inside = at[kept], owner[kept], inside[kept]
    out = np.zeros(len(at), ANCHOR)
    left = np.minimum(inside, LEFT)
    right = np.minimum(ends[owner] - at, RIGHT)
    with np.errstate(over="ignore"):
        context = (sums[at + right] - sums[at - left]) * inverse[at - left]
        context = mixed(context + left.astype(np.uint64) * BASE + right.astype(np.uint64) * INVERSE)
    out["g"], out["c"], out["left"], out["right"] = grams[at], context, left, right
    out["id"], out["h"], out["pos"] = fields[0][owner], fields[1][owner], inside + fields[2][owner]
    if not len(hot) or not len(out):
        return out
    is_hot = hot[np.minimum(np.searchsorted(hot, out["g"]), len(hot) - 1)] == out["g"]
    parts = [out[~is_hot]]
    out, at = out[is_hot], at[is_hot]
    for back in range(WINDOW if len(out) else 0):
        fits = (out["left"] >= back) & (out["right"] >= LENGTH - back)
        one = out[fits].copy()
        start = at[fits] - back
        with np.errstate(over="ignore"):
            one["g"] = mixed((sums[start + LENGTH] - sums[start]) * inverse[start] + np.uint64(1))
        one["c"], one["left"], one["right"] = 0, 0, LENGTH
        one["pos"] -= back
        parts.append(one)
    return np.concatenate(parts)


def order_of(records: np.ndarray) -> np.ndarray:
    """Sort order by (g, c, place)."""
    places = np.lexsort((records["pos"], records["h"], records["id"]))
    ranked = records[places]
    again = np.lexsort((ranked["c"], ranked["g"]))
    return places[again]


def spans_of(records: np.ndarray) -> np.ndarray:
    """The strings around repeated anchors."""
    out = np.zeros(len(records), SPAN)
    out["id"], out["h"] = records["id"], records["h"]
    out["start"] = records["pos"] - records["left"].astype(np.int32)
    out["stop"] = records["pos"] + records["right"].astype(np.int32)
    return out[out["stop"] - out["start"] >= LENGTH]


def first_and_spans(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first record of each (g, c), in order, and the spans of the others."""
    records = records[order_of(records)]
    new = np.ones(len(records), dtype=bool)
    new[1:] = (records["g"][1:] != records["g"][:-1]) | (records["c"][1:] != records["c"][:-1])
    first = np.flatnonzero(new)
    head = records[np.repeat(first, np.diff(np.append(first, len(records))))] if len(first) else records
    # A repeated row of the document that comes first is that document.
    other = ~new & ((records["id"] != head["id"]) | (records["h"] != head["h"]) | (records["pos"] != head["pos"]))
    return records[new], spans_of(records[other])


ROWS = "kind int, bucket int, data binary"


def dealt(kind: int, records: np.ndarray, keys: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Records packed by bucket of their key, one row a bucket."""
    if not len(records):
        return
    target = (mixed(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(target, kind="stable")
    records, target = records[order], target[order]
    cuts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
    for start in range(0, len(cuts), 64):
        some = cuts[start : start + 64]
        stops = np.append(cuts[start + 1 : start + 65], len(records))[: len(some)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(some), kind, np.int32)),
                pa.array(target[some]),
                pa.array([records[a:b].tobytes() for a, b in zip(some, stops)], pa.binary()),
            ],
            ["kind", "bucket", "data"],
        )


def document_key(records: np.ndarray) -> np.ndarray:
    return records["id"].astype(np.uint64) ^ (records["h"].astype(np.uint64) << np.uint64(20))


def unpacked(table: pa.Table, kind: int, dtype: np.dtype) -> np.ndarray:
    kinds = table.column("kind").to_pylist()
    data = table.column("data")
    return np.frombuffer(b"".join(data[i].as_py() for i, k in enumerate(kinds) if k == kind), dtype=dtype)


def pieces_of(key: int, h: int, data: bytes) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    margin = CONTEXT
    for start in range(0, len(data), PIECE):
        low, high = max(0, start - margin), min(len(data), start + PIECE + margin)
        yield key, h, low, start - low, min(start + PIECE, len(data)) - low, data[low:high]


def anchor_runs(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[np.ndarray]:
    """Anchor records of the texts, a bounded run at a time."""
    held: list[np.ndarray] = []
    pieces: list = []
    size = count = 0
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            for key, h, text in zip(*(part.column(c).to_pylist() for c in ("key", "h", "text"))):
                data = text.encode("utf-8")
                if len(data) < LENGTH:
                    continue
                for piece in pieces_of(key, h, data):
                    pieces.append(piece)
                    size += len(piece[5])
                    if size >= CHUNK:
                        held.append(anchors_of(pieces, hot))
                        count += len(held[-1])
                        pieces, size = [], 0
                        if count >= RUN:
                            yield np.concatenate(held)
                            held, count = [], 0
    if pieces:
        held.append(anchors_of(pieces, hot))
    if held:
        yield np.concatenate(held)


def hot_grams(rows: DataFrame) -> np.ndarray:
    """Grams with very many contexts, sorted. A gram with twice ``HOT_SHARE`` of all anchors has at least
    that share in the reports of the runs where it is frequent, so every such gram is found."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in anchor_runs(batches, np.zeros(0, np.uint64)):
            first, _ = first_and_spans(run)
            grams, counts = np.unique(first["g"], return_counts=True)
            often = counts >= max(2, HOT_SHARE * len(first))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(grams[often].view(np.int64), 0)),
                    pa.array(np.append(counts[often], 0).astype(np.int64)),
                    pa.array(np.append(np.zeros(often.sum(), np.int64), len(first))),
                ],
                ["g", "n", "total"],
            )

    reports = written_once(rows.mapInArrow(work, "g long, n long, total long"), "gram-reports")
    total = reports.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    least = max(1000, int(HOT_SHARE * total))
    hot = reports.groupBy("g").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("g").collect()
    return np.sort(np.array([r["g"] for r in hot], dtype=np.int64).view(np.uint64))


SPANS, ANCHORS, REQUESTS, NEARS = 0, 1, 2, 3


def documents_of(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    key = F.coalesce(quoted(key_col).cast("long"), F.lit(NULL_ID))
    return df.select(key.alias("key"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("h"), text.alias("text"))


def merge_runs(rows: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """Packed spans (kind 0) and requests for contexts (kind 2), by document bucket."""
    sent = rows.sparkSession.sparkContext.broadcast(hot)

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in anchor_runs(batches, sent.value):
            first, spans = first_and_spans(run)
            yield from dealt(ANCHORS, first, first["g"], buckets)
            # Spans travel with the anchors and are passed on.
            yield from dealt(SPANS, spans, document_key(spans), buckets)

    def merge(table: pa.Table) -> pa.Table:
        first, spans = first_and_spans(unpacked(table, ANCHORS, ANCHOR))
        spans = np.concatenate([spans, unpacked(table, SPANS, SPAN)])
        new = np.ones(len(first), dtype=bool)
        new[1:] = first["g"][1:] != first["g"][:-1]
        sizes = np.diff(np.append(np.flatnonzero(new), len(first)))
        several = first[np.repeat(sizes, sizes) > 1] if len(first) else first
        wanted = np.zeros(len(several), REQUEST)
        for name in REQUEST.names:
            wanted[name] = several[name]
        out = [*dealt(SPANS, spans, document_key(spans), buckets), *dealt(REQUESTS, wanted, document_key(wanted), buckets)]
        return pa.Table.from_batches(out, schema=PACKED)

    runs = rows.mapInArrow(sort_runs, ROWS)
    return written_once(runs.groupBy("bucket").applyInArrow(merge, ROWS), "merged-runs")


PACKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary())])


def per_document(packed: DataFrame, kind: int, dtype: np.dtype) -> DataFrame:
    """(key, h, data): the records of each document, from rows packed by document bucket."""

    def gather(table: pa.Table) -> pa.Table:
        records = unpacked(table, kind, dtype)
        records = records[np.lexsort((records["h"], records["id"]))]
        new = np.ones(len(records), dtype=bool)
        new[1:] = (records["id"][1:] != records["id"][:-1]) | (records["h"][1:] != records["h"][:-1])
        cuts = np.flatnonzero(new)
        data = [records[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(records)))]
        return pa.table(
            {
                "key": pa.array(records["id"][cuts], pa.int64()),
                "h": pa.array(records["h"][cuts].astype(np.int64)),
                "data": pa.array(data, pa.binary()),
            }
        )

    return packed.where(F.col("kind") == kind).groupBy("bucket").applyInArrow(gather, "key long, h long, data binary")


def contexts(rows: DataFrame, merged: DataFrame, buckets: int) -> DataFrame:
    """The contexts that were asked for, packed by gram bucket."""
    joined = rows.join(per_document(merged, REQUESTS, REQUEST), ["key", "h"]).select("text", "data")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                for text, data in zip(part.column("text").to_pylist(), part.column("data").to_pylist()):
                    wanted = np.frombuffer(data, dtype=REQUEST)
                    source = np.frombuffer(b"\0" * LEFT + text.encode("utf-8") + b"\0" * RIGHT, dtype=np.uint8)
                    size = len(source) - CONTEXT
                    out = np.zeros(len(wanted), NEAR)
                    for name in REQUEST.names:
                        out[name] = wanted[name]
                    out["left"] = np.minimum(wanted["pos"], LEFT)
                    out["right"] = np.minimum(size - wanted["pos"], RIGHT)
                    views = np.lib.stride_tricks.sliding_window_view(source, CONTEXT)
                    out["bytes"] = views[wanted["pos"]]
                    held.append(out)
                    count += len(out)
                    if count >= 50_000:
                        whole = np.concatenate(held)
                        yield from dealt(NEARS, whole, whole["g"], buckets)
                        held, count = [], 0
        if held:
            whole = np.concatenate(held)
            yield from dealt(NEARS, whole, whole["g"], buckets)

    return joined.mapInArrow(fetch, ROWS)


def refine(near: np.ndarray) -> np.ndarray:
    """Spans of the strings around equal grams that also start earlier."""
    near = near[np.lexsort((near["pos"], near["h"], near["id"]))]
    # Repeated rows of a document ask twice.
    if len(near):
        same = np.zeros(len(near), dtype=bool)
        same[1:] = True
        for name in ("id", "h", "pos", "g"):
            same[1:] &= near[name][1:] == near[name][:-1]
        near = near[~same]
    n = len(near)
    spans = []
    sums = np.zeros((n, CONTEXT + 1), np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, n, 8192):
            block = near["bytes"][start : start + 8192].astype(np.uint64) + np.uint64(1)
            np.cumsum(block * powers(CONTEXT)[0], axis=1, out=sums[start : start + 8192, 1:])
        inverse = powers(CONTEXT + 1)[1]
        salt = mixed(near["g"] + BASE)
        for offset in range(WINDOW):
            fits = np.flatnonzero((near["left"] >= LEFT - offset) & (near["right"] >= LENGTH - LEFT + offset))
            if len(fits) < 2:
                continue
            keys = mixed((sums[fits, offset + LENGTH] - sums[fits, offset]) * inverse[offset]) ^ salt[fits]
            order = np.argsort(keys, kind="stable")
            ranked = keys[order]
            again = fits[order[1:][ranked[1:] == ranked[:-1]]]
            one = np.zeros(len(again), SPAN)
            one["id"], one["h"] = near["id"][again], near["h"][again]
            one["start"] = near["pos"][again] - LEFT + offset
            one["stop"] = one["start"] + LENGTH
            spans.append(one)
    return united(np.concatenate(spans)) if spans else np.zeros(0, SPAN)


def united(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans of each document as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["h"], spans["id"]))]
    new = np.ones(len(spans), dtype=bool)
    new[1:] = (spans["id"][1:] != spans["id"][:-1]) | (spans["h"][1:] != spans["h"][:-1])
    # A running maximum per document: documents are moved apart so that one maximum does for all.
    document = np.cumsum(new) - 1
    apart = document.astype(np.int64) << 32
    reach = np.maximum.accumulate(apart + spans["stop"])
    cut = new.copy()
    cut[1:] |= apart[1:] + spans["start"][1:] > reach[:-1]
    heads = np.flatnonzero(cut)
    out = spans[heads].copy()
    out["stop"] = (reach[np.append(heads[1:], len(spans)) - 1] - apart[heads]).astype(np.int32)
    return out


def repeat_spans(df: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, h, data): the packed spans of every document that has any."""
    buckets = 2 * shuffle_partitions(df.sparkSession)
    merged = merge_runs(rows, hot_grams(rows), buckets)

    def refined(table: pa.Table) -> pa.Table:
        spans = refine(unpacked(table, NEARS, NEAR))
        return pa.Table.from_batches([*dealt(SPANS, spans, document_key(spans), buckets)], schema=PACKED)

    edges = contexts(rows, merged, buckets).groupBy("bucket").applyInArrow(refined, ROWS)
    return per_document(merged.where(F.col("kind") == SPANS).union(edges), SPANS, SPAN)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"


def without_repeats(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per row of ``df``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, the bytes that stay."""
    rows = documents_of(df, key_col, text_col)
    joined = rows.join(repeat_spans(df, rows), ["key", "h"], "left").select("key", "text", "data")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                out: list[tuple] = []
                for key, text, data in zip(*(part.column(c).to_pylist() for c in ("key", "text", "data"))):
                    source = text.encode("utf-8")
                    spans = united(np.frombuffer(data or b"", dtype=SPAN))
                    kept, at = [], 0
                    for a, b in zip(spans["start"].tolist(), spans["stop"].tolist()):
                        kept.append(source[at:a])
                        at = b
                    kept.append(source[at:])
                    rest = b"".join(kept)
                    out.append(
                        (None if key == NULL_ID else key, len(source), len(source) - len(rest), len(spans),
                         hashlib.sha256(rest).hexdigest(), rest if keep_text else None)
                    )
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return joined.mapInArrow(cut, RESULT)

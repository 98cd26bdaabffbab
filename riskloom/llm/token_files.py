"""Token-id files with a minimal perfect hash index from document keys to places.

A shard is one binary file of consecutive documents in key order::

    magic "RLTOKID1", header length (u4), header (JSON: item size, documents, ids, levels)
    bit levels of the hash function        u8 words
    fingerprints, one a slot               u4
    record numbers, one a slot             u4
    offsets, documents + 1                 u8   (ids before each document of the shard)
    keys, documents                        i8, and a null flag u1
    ids                                    u2 or u4, back to back, little-endian

The hash function is built level by level: every key hashes to a bit of a level; keys that are alone
on their bit are placed, the others go on to the next, half-full again. A key's slot is the number
of set bits before its own, so slots are exactly 0..n-1 and a lookup is a few hashes and one rank.
A key that is not in the shard would reach some slot too; the stored fingerprint, taken from
another hash, turns it away, and the stored key settles it.

Documents are put in order by ranges of the key, so shards are written where their rows lie and
their sizes follow the rows. One row a shard (name, key range, counts) forms the manifest; running
totals over it give every document its global start.

Defined results: a null text is empty and has the end id alone; a null key comes first; equal keys
stay next to each other, ordered by text, and a lookup returns all of them; an empty table has no shards.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import quoted, shuffle_partitions
from riskloom.llm.encoding import encoder
from riskloom.llm.files import fetch, publish
from riskloom.session import scratch_path, written_once

MAGIC = b"RLTOKID1"
#: A shard is closed at this many bytes of ids.
SHARD_BYTES = 16 << 20
#: Bits of a level for each key still to place.
ROOM = 2.0
MANIFEST = "shard string, part long, number long, docs long, ids long, first_key long, last_key long"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing function of integer keys."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        sums = [np.cumsum(np.bitwise_count(words), dtype=np.int64) for words in levels]
        totals = np.cumsum([0] + [int(s[-1]) for s in sums])
        self.before = [np.concatenate(([0], s[:-1])) + t for s, t in zip(sums, totals)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(64, int(np.ceil(len(keys) * ROOM / 64)) * 64)
            at = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            words = np.zeros(size // 64, dtype=np.uint64)
            placed = at[alone]
            np.bitwise_or.at(words, placed // 64, np.uint64(1) << (placed % 64).astype(np.uint64))
            levels.append(words)
            keys = keys[~alone]
            if len(levels) > 200:
                raise ValueError("the keys are not distinct")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has the key's bit."""
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for number, words in enumerate(self.levels):
            if not len(left):
                break
            at = (mixed(keys[left], number) % np.uint64(len(words) * 64)).astype(np.int64)
            word, bit = words[at // 64], (at % 64).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[left[hit]] = (self.before[number][at // 64] + below)[hit]
            left = left[~hit]
        return found


class Shard:
    """A shard's content, read from its bytes."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a token-id file")
        (length,) = struct.unpack_from("<I", data, 8)
        head = json.loads(data[12 : 12 + length])
        at = 12 + length

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        docs, distinct = head["docs"], head["distinct"]
        self.hash = PerfectHash([take("<u8", n) for n in head["levels"]])
        self.prints = take("<u4", distinct)
        self.records = take("<u4", distinct)
        self.offsets = take("<u8", docs + 1).astype(np.int64)
        self.keys = take("<i8", docs)
        self.nulls = take("u1", docs).astype(bool)
        self.ids = take("<u2" if head["item"] == 2 else "<u4", head["ids"])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first record of each key, -1 for keys that are not here."""
        slots = self.hash.slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == fingerprints(keys[known])
        out = np.full(len(keys), -1, dtype=np.int64)
        out[known] = self.records[slots[known]]
        known[known] = self.keys[out[known]] == keys[known]
        out[~known] = -1
        return out

    def ids_of(self, record: int) -> np.ndarray:
        return self.ids[self.offsets[record] : self.offsets[record + 1]]


def shard_bytes(keys: list[int | None], ids: list[bytes], wide: bool) -> bytes:
    """The file of consecutive documents; ``ids`` are little-endian 32-bit ids of each."""
    docs = len(keys)
    lengths = np.array([len(one) // 4 for one in ids], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype("<u8")
    payload = np.frombuffer(b"".join(ids), dtype="<u4")
    if not wide:
        payload = payload.astype("<u2")
    nulls = np.array([key is None for key in keys], dtype="u1")
    numbers = np.array([0 if key is None else key for key in keys], dtype="<i8")
    first = np.flatnonzero(nulls == 0)
    distinct, at = np.unique(numbers[first], return_index=True)
    hashed = PerfectHash.build(distinct)
    slots = hashed.slots(distinct)
    prints, records = np.empty(len(distinct), "<u4"), np.empty(len(distinct), "<u4")
    prints[slots] = fingerprints(distinct)
    records[slots] = first[at]
    head = json.dumps(
        {"item": 4 if wide else 2, "docs": docs, "distinct": len(distinct), "ids": int(offsets[-1]),
         "levels": [len(words) for words in hashed.levels]}
    ).encode()
    parts = [MAGIC, struct.pack("<I", len(head)), head]
    parts += [words.astype("<u8").tobytes() for words in hashed.levels]
    parts += [x.tobytes() for x in (prints, records, offsets, numbers, nulls, payload)]
    return b"".join(parts)


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, blanks_matter: bool,
    key_col: str = "doc_id", text_col: str = "text", shard_size: int = SHARD_BYTES,
) -> DataFrame:
    """Encode every text, write shards below ``folder``, and return their manifest."""
    rows = df.select(quoted(key_col).cast("long").alias("key"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(shuffle_partitions(df.sparkSession), "key").sortWithinPartitions("key", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, blanks_matter)
        wide = max(encode.tokenizer.get_vocab_size() - 1, end_id) > 0xFFFF
        end = struct.pack("<I", end_id)
        part, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        ids: list[bytes] = []
        size = 0

        def closed() -> pa.RecordBatch:
            name = f"{part:06d}-{number:05d}.ids"
            publish(f"{folder}/{name}", shard_bytes(keys, ids, wide))
            real = [key for key in keys if key is not None]
            return pa.RecordBatch.from_pydict(
                {
                    "shard": [name], "part": [part], "number": [number], "docs": [len(keys)],
                    "ids": [sum(map(len, ids)) // 4],
                    "first_key": pa.array([real[0] if real else None], pa.int64()),
                    "last_key": pa.array([real[-1] if real else None], pa.int64()),
                }
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                piece = batch.slice(start, 128)
                for key, one in zip(piece.column("key").to_pylist(), encode.encode(piece.column("text").to_pylist())):
                    keys.append(key)
                    ids.append(one + end)
                    size += len(one) + 4
                    if size >= shard_size:
                        yield closed()
                        number += 1
                        keys, ids, size = [], [], 0
        if keys:
            yield closed()

    return written_once(ordered.mapInArrow(work, MANIFEST), "token-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """``manifest`` with ``start``: the ids in all shards before. One row a shard, so a few million
    rows at most; totals per part come first, so that the parts alone are ordered in one place."""
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_part_start"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(parts, "part").select(
        "shard", (F.col("_part_start") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).alias("shard_start")
    )


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Every document of the shards: key, start, n_tokens, ids_crc32 — read back through the index."""
    # Each shard's start goes to its task with its name, so the documents need no join.
    names = with_starts(manifest).repartition(shuffle_partitions(spark))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, shard_start in zip(batch.column("shard").to_pylist(), batch.column("shard_start").to_pylist()):
                shard = Shard(fetch(f"{folder}/{name}"))
                real = np.flatnonzero(~shard.nulls)
                found = shard.find(shard.keys[real])
                # Equal keys lie together; the index points at their first record.
                same = np.concatenate(([False], shard.keys[real][1:] == shard.keys[real][:-1])) if len(real) else []
                if len(real) and not np.all((found == real) | same):
                    raise ValueError(f"the index of {name} does not lead to its documents")
                lengths = np.diff(shard.offsets)
                crcs = [zlib.crc32(shard.ids_of(i).astype("<u4").tobytes()) for i in range(len(lengths))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(shard.keys, mask=shard.nulls),
                        "start": shard.offsets[:-1] + shard_start,
                        "n_tokens": lengths,
                        "ids_crc32": np.array(crcs, dtype=np.int64),
                    }
                )

    return names.mapInArrow(work, "key long, start long, n_tokens long, ids_crc32 long")


#: Shards whose key ranges are sent to the tasks of a lookup.
MOST_ROUTED = 5_000_000


def lookup(spark: SparkSession, folder: str, manifest: DataFrame, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(key, ids) of the wanted keys that exist, one row a document, by constant-time access.

    The manifest's key ranges (16 bytes a shard, refused beyond ``MOST_ROUTED`` shards) tell which
    shards can hold a key; each wanted shard is opened once. Null keys are not looked up.
    """
    ranges = manifest.where("first_key IS NOT NULL").select("first_key", "last_key", "shard").limit(MOST_ROUTED + 1)
    rows = sorted(tuple(r) for r in ranges.collect())
    if len(rows) > MOST_ROUTED:
        raise ValueError("too many shards to route in one piece; look the keys up per part")
    firsts = np.array([r[0] for r in rows], dtype=np.int64)
    lasts = np.array([r[1] for r in rows], dtype=np.int64)
    names = [r[2] for r in rows]
    wanted = keys.where(quoted(key_col).isNotNull()).select(quoted(key_col).cast("long").alias("key")).distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("key").to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(lasts, values, "left"), np.searchsorted(firsts, values, "right")
            pairs = [(names[i], int(v)) for v, a, b in zip(values, low, high) for i in range(a, b)]
            if pairs:
                yield pa.RecordBatch.from_pydict({"shard": [p[0] for p in pairs], "key": [p[1] for p in pairs]})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for batch in batches:
            for at, key in zip(batch.column("shard").to_pylist(), batch.column("key").to_pylist()):
                if at != name:
                    name, shard = at, Shard(fetch(f"{folder}/{at}"))
                record = int(shard.find(np.array([key]))[0])
                while 0 <= record < len(shard.keys) and shard.keys[record] == key:
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key], "ids": pa.array([shard.ids_of(record).tolist()], pa.list_(pa.int64()))}
                    )
                    record += 1

    routed = wanted.mapInArrow(route, "shard string, key long").repartition("shard").sortWithinPartitions("shard", "key")
    return routed.mapInArrow(read, "key long, ids array<long>")


def token_files(
    df: DataFrame, tokenizer: str, end_id: int, blanks_matter: bool, key_col: str = "doc_id", text_col: str = "text"
) -> tuple[str, DataFrame]:
    """Write token-id files to a new folder: (folder, manifest)."""
    folder = scratch_path(df.sparkSession, "token-ids")
    return folder, write_token_files(df, folder, tokenizer, end_id, blanks_matter, key_col, text_col)

"""Vector bin packing of training examples into sequences by the dot-product heuristic.

An example has a demand in several dimensions: tokens, segments, loss-bearing tokens. A sequence
has a limit in each. The open sequence takes, of the examples at hand that fit in every dimension,
the one whose demand (as shares of the limits) has the greatest dot product with the room left:
examples that use what the sequence has most of. Ties go to the earlier example. When nothing fits,
the sequence is closed, or, where examples may be cut, the largest example is cut to fill the gap.

Each task packs the rows of its own input split, with a pool of bounded size, so there is no
shuffle and no group; what a split leaves open at its end is at most one sequence. Where cutting is
allowed that rest becomes sequences whose lengths are powers of two, which need no padding.

Rows of a split are read in order and the heuristic draws nothing at random, so a task that runs
again packs its split the same way. A sequence's number is (split number << 32) + its number there.

Defined results: a null text is empty (its end id alone is packed); an example beyond a limit by
itself raises an error when it must not be cut; demands that are null count as 0; negative ones
raise; an empty table gives an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import quoted
from riskloom.llm.encoding import encoder

#: Examples a task chooses from at once.
POOL = 256
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Packer:
    """The open sequence of one task and the pool of examples that wait for it."""

    def __init__(self, limits: Sequence[int], pool: int = POOL) -> None:
        self.limits = np.array(limits, dtype=np.int64)
        self.scale = 1.0 / self.limits
        self.demands = np.zeros((pool, len(self.limits)), dtype=np.int64)
        self.shares = np.zeros((pool, len(self.limits)))
        self.payloads: list[object] = [None] * pool
        self.age = np.full(pool, np.iinfo(np.int64).max)
        self.used = np.zeros(pool, dtype=bool)
        self.free = list(range(pool))[::-1]
        self.room = self.limits.copy()
        self.sequence = 0
        self.seen = 0

    def add(self, demand: Sequence[int], payload: object) -> None:
        if any(d < 0 for d in demand):
            raise ValueError("a demand is negative")
        at = self.free.pop()
        self.demands[at] = demand
        self.shares[at] = self.demands[at] * self.scale
        self.payloads[at], self.used[at] = payload, True
        self.age[at] = self.seen
        self.seen += 1

    @property
    def full(self) -> bool:
        return not self.free

    def __len__(self) -> int:
        return len(self.payloads) - len(self.free)

    def best(self) -> int:
        """The pool's place of the example to take next, -1 if none fits."""
        fits = self.used & np.all(self.demands <= self.room, axis=1)
        if not fits.any():
            return -1
        scores = np.where(fits, self.shares @ (self.room * self.scale), -1.0)
        ties = np.flatnonzero(scores == scores.max())
        return int(ties[np.argmin(self.age[ties])])

    def largest(self) -> int:
        """The place of the longest waiting example (first dimension)."""
        return int(np.argmax(np.where(self.used, self.demands[:, 0], -1)))

    def take(self, at: int) -> object:
        self.room = self.room - self.demands[at]
        payload, self.payloads[at], self.used[at] = self.payloads[at], None, False
        self.free.append(at)
        return payload

    def close(self) -> None:
        if (self.room < self.limits).any():
            self.sequence += 1
            self.room = self.limits.copy()


def pack_examples(df: DataFrame, key_col: str, demand_cols: Sequence[str], limits: Sequence[int]) -> DataFrame:
    """Place whole examples: (key, sequence_id, position, and their demands), one row an example.

    ``demand_cols`` and ``limits`` go together, for instance tokens, segments and loss-bearing
    tokens of a conversation. Equal keys are separate examples.
    """
    names = [f"demand_{i}" for i in range(len(limits))]
    kind = dict(df.dtypes)[key_col]
    rows = df.select(
        quoted(key_col).alias("key"),
        *[F.coalesce(quoted(c).cast("long"), F.lit(0)).alias(n) for c, n in zip(demand_cols, names)],
    )
    schema = f"key {kind}, {', '.join(f'{n} long' for n in names)}, sequence_id long, position long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        packer, position, key_type = Packer(limits), 0, None

        def place(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal position
            out = []
            while len(packer) > least:
                at = packer.best()
                if at < 0:
                    packer.close()
                    position = 0
                    continue
                demand = packer.demands[at].tolist()
                out.append((packer.take(at), *demand, first + packer.sequence, position))
                position += 1
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], key_type), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                    ["key", *names, "sequence_id", "position"],
                )

        for batch in batches:
            key_type = batch.schema.field("key").type
            for row in batch.to_pylist():
                demand = [row[n] for n in names]
                if any(d > m for d, m in zip(demand, limits)):
                    raise ValueError(f"example {row['key']!r} is larger than a sequence")
                packer.add(demand, row["key"])
                if packer.full:
                    yield from place(POOL // 2)
        yield from place(0)

    return rows.mapInArrow(work, schema)


def power_lengths(total: int, largest: int) -> list[int]:
    """``total`` as a sum of powers of two, largest first, none above ``largest``."""
    return [1 << bit for bit in range(largest.bit_length() - 1, -1, -1) if total >> bit & 1]


def pack_documents(
    df: DataFrame, tokenizer: str, end_id: int, length: int = 1024, segments: int = 1024, loss_tokens: int = 1024,
    key_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Tokenise documents and pack them, cut where that fills a sequence; ``length`` is a power of
    two. One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Whole multiples of ``length`` are sequences of their own. The rests are packed under the three
    limits (every id of a document bears loss, so its demand there is its length). The last
    sequence of a task is cut into sequences of power-of-two lengths.
    """
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    rows = df.select(quoted(key_col).cast("long").alias("key"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True)
        end = struct.pack("<I", end_id)
        next_id = TaskContext.get().partitionId() << 32
        packer = Packer((length, segments, loss_tokens))
        done: list[tuple] = []
        held: list[tuple] = []  # the open sequence's pieces: key, start, ids, doc_tokens

        def put(pieces: list[tuple]) -> None:
            """One finished sequence."""
            nonlocal next_id
            offset = 0
            for key, start, ids, tokens in pieces:
                done.append((key, start, len(ids) // 4, zlib.crc32(ids), tokens, next_id, offset))
                offset += len(ids) // 4
            next_id += 1

        def close() -> None:
            nonlocal held
            packer.close()
            put(held)
            held = []

        def fill(least: int) -> None:
            while len(packer) > least:
                at = packer.best()
                if at >= 0:
                    held.append(packer.take(at))
                elif packer.room.min() > 0:
                    # Nothing fits whole: cut the longest example to the room that is left.
                    key, start, ids, tokens = packer.take(at := packer.largest())
                    packer.room = packer.room + packer.demands[at]
                    size = int(min(packer.room[0], packer.room[2]))
                    held.append((key, start, ids[: size * 4], tokens))
                    packer.room = packer.room - (size, 1, size)
                    rest = ids[size * 4 :]
                    packer.add((len(rest) // 4, 1, len(rest) // 4), (key, start + size, rest, tokens))
                if packer.room.min() == 0:
                    close()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                piece = batch.slice(first, 128)
                coded = encode.encode(piece.column("text").to_pylist())
                for key, ids in zip(piece.column("key").to_pylist(), coded):
                    ids += end
                    tokens = len(ids) // 4
                    whole = tokens - tokens % length
                    for start in range(0, whole, length):
                        put([(key, start, ids[start * 4 : (start + length) * 4], tokens)])
                    if tokens > whole:
                        packer.add((tokens - whole, 1, tokens - whole), (key, whole, ids[whole * 4 :], tokens))
                    if packer.full:
                        fill(POOL // 2)
                if done:
                    yield batch_of(done)
                    done.clear()
        fill(0)
        # The open rest, in sequences that need no padding.
        sizes = power_lengths(sum(len(p[2]) // 4 for p in held), length)
        for size in sizes:
            pieces, room = [], size
            while room:
                key, start, ids, tokens = held[0]
                take = min(room, len(ids) // 4)
                pieces.append((key, start, ids[: take * 4], tokens))
                room -= take
                if take == len(ids) // 4:
                    held.pop(0)
                else:
                    held[0] = (key, start + take, ids[take * 4 :], tokens)
            put(pieces)
        if done:
            yield batch_of(done)

    return rows.mapInArrow(work, PIECES)

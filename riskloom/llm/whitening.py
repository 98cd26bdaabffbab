"""Whitening of embeddings along their exact principal components.

The scatter of the distinct whole-number vectors is summed exactly. Its characteristic polynomial is found without
any rounding, by Hessenberg reduction modulo many primes (spread over tasks) and Chinese remaindering; its largest
roots are isolated by counting sign changes and closed in on to 96 bits after the point; each component is a vector of the
null space of the shifted matrix, by inverse iteration (one root per task).

What travels whole is one matrix of dimensions x dimensions, never rows. Elimination takes time of the order of
dimensions cubed per prime and per component.

Defined cases: a null vector and one with a null or non-finite entry are dropped. Of vectors of several lengths those of the
commonest length (the greater, on ties) are kept. An entry whose whole number passes a long is cut to its limits. Repeated vectors count
once in the fit and each get their rows; null and repeated keys are kept. A direction without any spread is no
component, so constant, single or no vectors give no rows. ``deviation`` is null where it passes a long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.charpoly import FRACTION, coefficient_bound, largest_roots, null_vectors, primes_for, recombined, residues
from riskloom.llm.common import quoted
from riskloom.session import scratch_scope, written_once

#: x = floor(SCALE * entry) + SHIFT; sums are taken without the shift, which no covariance depends on.
SCALE = 64
SHIFT = 1_000_000
LOW, HIGH = -(1 << 63), (1 << 63) - 1
#: Vectors multiplied at a time, and bits of the parts they are cut into: sums of products stay below 2**53.
BLOCK = 4096
PART = 20
#: Exact sums leave a task as digits of so many bits.
DIGIT = 30


@dataclass
class Whitening:
    size: int
    n: int
    sums: list[int]
    roots: list[float]
    shares: list[float]
    components: np.ndarray
    identity_error: float


def whole_numbers(vectors: pa.Array, size: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(places of the rows kept, their floor(SCALE * entry) as int64); None keeps nothing to a length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == size)
    if size == 0 or not len(places):
        return places[:0], np.zeros((0, size or 0), np.int64)
    taken = vectors.take(pa.array(places))
    flat = taken.flatten()
    entries = pc.fill_null(pc.cast(flat, pa.float64(), safe=False), np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
    good = np.isfinite(entries).all(1)
    # A double times a power of two is exact; one that overflows is beyond a long anyway.
    with np.errstate(over="ignore"):
        scaled = np.floor(entries[good] * SCALE)
    top = HIGH - SHIFT
    inside = (scaled >= float(LOW)) & (scaled < 2.0**63)
    y = np.where(inside, scaled, 0).astype(np.int64)
    y = np.minimum(np.where(inside, y, np.where(scaled > 0, top, LOW)), top)
    return places[good], y


def packed(y: np.ndarray) -> list[bytes]:
    """Each vector in the narrowest whole numbers that hold it, so equal vectors are equal bytes."""
    most = np.maximum(y.max(1), -1 - y.min(1))
    return [row.astype("<i2" if m < 1 << 15 else "<i4" if m < 1 << 31 else "<i8").tobytes() for row, m in zip(y, most.tolist())]


def unpacked(values: list[bytes], size: int) -> np.ndarray:
    kinds = {2 * size: "<i2", 4 * size: "<i4", 8 * size: "<i8"}
    if not values:
        return np.zeros((0, size), np.int64)
    if len({len(v) for v in values}) == 1:
        return np.frombuffer(b"".join(values), kinds[len(values[0])]).reshape(-1, size).astype(np.int64)
    return np.stack([np.frombuffer(v, kinds[len(v)]).astype(np.int64) for v in values])


def commonest_length(df: DataFrame, vector: str) -> int:
    finite = F.forall(quoted(vector), lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) != float("inf")))
    lengths = df.where(quoted(vector).isNotNull() & finite).groupBy(F.size(quoted(vector)).alias("size")).count()
    first = lengths.where("size > 0").orderBy(F.desc("count"), F.desc("size")).first()
    return 0 if first is None else int(first["size"])


def fit_list(df: DataFrame, vector: str, size: int) -> DataFrame:
    """The distinct whole-number vectors, packed; equal ones merge before they are shuffled."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                _, y = whole_numbers(batch.column(0).slice(start, BLOCK), size)
                if len(y):
                    yield pa.RecordBatch.from_pydict({"x": pa.array(packed(y), pa.binary())})

    return written_once(df.select(quoted(vector).alias("v")).mapInArrow(work, "x binary").distinct(), "fit-list")


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y in Python integers: parts of PART bits are multiplied in doubles without rounding."""
    most = int(max(y.max(), -1 - y.min(), 1))
    parts, rest = [], y
    for _ in range(0, most.bit_length() + 1, PART):
        parts.append((rest & ((1 << PART) - 1)).astype(np.float64))
        rest = rest >> PART
    # What is left is 0 or -1: the sign.
    parts.append(rest.astype(np.float64))
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts[i:], i):
            if a.any() and b.any():
                product = (a.T @ b).astype(np.int64).astype(object)
                total = total + ((product if i == j else product + product.T) << (PART * (i + j)))
    return total


def moments(rows: DataFrame, size: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, sums of products) of the packed vectors, exact. Tasks send digits of their own sums, which Spark adds up."""
    upper = np.triu_indices(size)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(size, object), np.zeros((size, size), object)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                y = unpacked(batch.column(0).slice(start, BLOCK).to_pylist(), size)
                n += len(y)
                # Sums of the low and high halves fit a long.
                sums = sums + (y & 0xFFFFFFFF).sum(0).astype(object) + ((y >> 32).sum(0).astype(object) << 32)
                products = products + exact_products(y)
        if n:
            places, digits, values = [], [], []
            for place, value in enumerate([n, *sums, *products[upper]]):
                digit = 0
                while value not in (0, -1):
                    places.append(place)
                    digits.append(digit)
                    values.append(value & ((1 << DIGIT) - 1))
                    value, digit = value >> DIGIT, digit + 1
                if value == -1:
                    places.append(place)
                    digits.append(digit)
                    values.append(-1)
            yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.int64()), "digit": pa.array(digits, pa.int32()), "value": pa.array(values, pa.int64())})

    added = rows.mapInArrow(work, "place long, digit int, value long").groupBy("place", "digit").agg(F.sum("value").alias("value"))
    flat = [0] * (1 + size + len(upper[0]))
    # At most a few digits per pair of dimensions.
    for row in added.toLocalIterator():
        flat[row["place"]] += row["value"] << (DIGIT * row["digit"])
    products = np.zeros((size, size), object)
    products[upper] = flat[1 + size :]
    products = products + np.triu(products, 1).T
    return flat[0], flat[1 : 1 + size], products


def characteristic(spark: SparkSession, scatter: list[list[int]], trace: int) -> list[int]:
    """The polynomial's coefficients from power 0 up; primes are dealt to tasks."""
    primes = primes_for(coefficient_bound(trace, len(scatter)))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = [int(p) for p in batch.column(0).to_pylist()]
            for start in range(0, len(mine), 16):
                part = mine[start : start + 16]
                found = residues(scatter, part)
                yield pa.RecordBatch.from_pydict({"p": pa.array(part, pa.int64()), "rest": pa.array(found.tolist(), pa.list_(pa.int64()))})

    table = spark.createDataFrame([(p,) for p in primes], "p long")
    rest = {row["p"]: row["rest"] for row in table.repartition(max(1, len(primes) // 16), "p").mapInArrow(work, "p long, rest array<long>").collect()}
    return recombined(np.array([rest[p] for p in primes], np.int64), primes)


def principal(spark: SparkSession, scatter: list[list[int]], roots: list[tuple[int, int]], most: int) -> np.ndarray:
    """Unit vectors of the roots in their order, one root per task."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = null_vectors(scatter, int(row["root"]), row["count"])
                yield pa.RecordBatch.from_pydict({"number": pa.array([row["number"]], pa.int32()), "vectors": pa.array([vectors.tolist()], pa.list_(pa.list_(pa.float64())))})

    rows = [(k, str(root), count) for k, (root, count) in enumerate(roots)]
    table = spark.createDataFrame(rows, "number int, root string, count int").repartition(len(rows), "number")
    found = sorted(table.mapInArrow(work, "number int, vectors array<array<double>>").collect(), key=lambda row: row["number"])
    return np.array([v for row in found for v in row["vectors"]])[:most]


def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """y - sums / n, each within a rounding of the exact value: the whole part of the mean goes in whole numbers."""
    if len(y) and max(int(y.max()), -int(y.min())) >= 1 << 52:
        return ((y.astype(object) * n - np.array(sums, object)) / n).astype(np.float64)
    whole = [s // n for s in sums]
    rest = np.array([(s - w * n) / n for s, w in zip(sums, whole)])
    return (y - np.array(whole, np.int64)).astype(np.float64) - rest


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n y - sums)**2, exact."""
    most = max(max(int(y.max()), -int(y.min())) * n + max(abs(s) for s in sums), 1) if len(y) else 1
    if y.shape[1] * most * most <= HIGH:
        away = y * n - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    away = y.astype(object) * n - np.array(sums, object)
    return [v if v <= HIGH else None for v in (away * away).sum(1).tolist()]


def fit_whitening(df: DataFrame, vector: str = "embedding", most: int = 16) -> Whitening:
    """The components of the distinct vectors; see the module's text for dropped rows."""
    spark = df.sparkSession
    size = commonest_length(df, vector)
    none = Whitening(size, 0, [0] * size, [], [], np.zeros((0, size)), 0.0)
    if size == 0:
        return none
    with scratch_scope(spark):
        rows = fit_list(df, vector, size)
        n, sums, products = moments(rows, size)
        if n == 0:
            return none
        matrix = n * products - np.outer(np.array(sums, object), np.array(sums, object))
        scatter = [[int(x) for x in row] for row in matrix]
        trace = sum(scatter[i][i] for i in range(size))
        if trace == 0:
            return Whitening(size, n, sums, [], [], np.zeros((0, size)), 0.0)
        roots = largest_roots(characteristic(spark, scatter, trace), most, trace)
        components = principal(spark, scatter, roots, most)
        each = [root for root, count in roots for _ in range(count)][:most]
        # The covariance is the scatter over n**2.
        values = [root / (n * n << FRACTION) for root in each]
        fit = Whitening(size, n, sums, values, [root / (trace << FRACTION) for root in each], components, 0.0)
        fit.identity_error = identity_error(rows, fit)
    return fit


def projected(y: np.ndarray, fit: Whitening) -> np.ndarray:
    return centred(y, fit.n, fit.sums) @ fit.components.T / np.sqrt(np.array(fit.roots))


def identity_error(rows: DataFrame, fit: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity: its sums are taken after centring."""
    count = len(fit.roots)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products, n = np.zeros(count), np.zeros((count, count)), 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                w = projected(unpacked(batch.column(0).slice(start, BLOCK).to_pylist(), fit.size), fit)
                total, products, n = total + w.sum(0), products + w.T @ w, n + len(w)
        if n:
            values = np.concatenate([total, products.ravel()])
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(values)), pa.int32()), "value": pa.array(values)})

    sums = rows.mapInArrow(work, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    values = np.zeros(count + count * count)
    for row in sums:
        values[row["place"]] = row["value"]
    mean, products = values[:count] / fit.n, values[count:].reshape(count, count) / fit.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(count)).max())


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, fit: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per kept row of ``df`` and component."""
    rows = df.select(quoted(key).alias("key"), quoted(vector).alias("vector"))
    kind = rows.schema["key"].dataType.simpleString()
    count = len(fit.roots)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if count else 0, BLOCK):
                part = batch.slice(start, BLOCK)
                places, y = whole_numbers(part.column(1), fit.size)
                if not len(y):
                    continue
                w = projected(y, fit)
                away = deviations(y, fit.n, fit.sums)
                repeat = np.repeat(np.arange(len(y)), count)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(places[repeat])),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(y))),
                        pa.array(np.full(len(repeat), fit.n, np.int64)),
                        pa.array(away, pa.int64()).take(pa.array(repeat)),
                        pa.array(w.ravel()),
                        pa.array(np.tile(np.array(fit.shares), len(y))),
                        pa.array(np.full(len(repeat), fit.identity_error)),
                    ],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(work, f"key {kind}, {RESULT}").withColumnRenamed("key", key)

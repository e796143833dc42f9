"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels in a window of scores.

Vectors are made whole numbers, and scores are their inner products, exact: matrices of residues modulo primes below 1024
are multiplied in float32, where sums of products of residues stay below 2**24 and are exact, and the Chinese remainder
theorem puts the signed scores together from the residues.  As many primes are taken as the longest vector demands, for
a score is at most the greatest squared length.

The anchors are a stated set of queries and meet all rows in blocks.  They go to the tasks in slices of at most
``SLICE_BYTES``, one after the other, so what is broadcast is bounded and the rows are read in place, without a shuffle of
vectors.  A task keeps the best rows of every anchor of the slice, and the few of all tasks are ranked by a window over the
anchor.  Two readings: first positives, among rows of the anchor's label, then negatives, once the positives' scores
give their windows.  Of rows alike in label and vector only as many as can be chosen are looked at in a batch, the first
by id.

Defined results: rows with a null id, a null label, a null vector, a null or non-finite component or no component take no
part, nor do rows whose squared length as whole numbers is above 2**52 (their scores would not be safe in a long).
Vectors of different lengths have no score with each other.  Rows alike in id, label and whole numbers are one row; rows that share
only the id are rows of their own.  Ties of score go to the smaller id.  An empty table, or one without anchors, gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score is from LOW to HIGH hundredths of the positive's.
LOW, HIGH = 50, 95
#: Vectors of anchors that are broadcast at once, in bytes.
SLICE_BYTES = 16 << 20
#: Squared lengths up to here keep scores, and hundredfold scores, in a long.
LARGEST = 1 << 52
#: Rows and anchors whose scores are held at once.
ROWS, ANCHORS = 2048, 1024
#: Greatest absolute residue: primes are below twice this.
_HALF = 511
_NONE = np.iinfo(np.int64).min

# -- exact products ------------------------------------------------------------------


@cache
def primes_for(largest: int) -> tuple[int, ...]:
    """Primes whose product is above twice ``largest``, from the greatest below 1024 down."""
    found: list[int] = []
    product, p = 1, 2 * _HALF + 1
    while product <= 2 * largest:
        if all(p % q for q in range(2, 32)):
            found.append(p)
            product *= p
        p -= 1
    return tuple(found)


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """Components modulo a prime, between -prime/2 and prime/2, in float32."""
    half = prime // 2
    return ((matrix + half) % prime - half).astype(np.float32)


def residue_product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """``a @ b.T`` modulo the prime, from 0: float32 products over as many columns as stay exact."""
    width = (1 << 24) // _HALF**2
    total = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], width):
        total += (a[:, at : at + width] @ b[:, at : at + width].T).astype(np.int32) % prime
    return total % prime


def reconstruct(parts: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Signed whole numbers from their residues, digit by digit in the mixed radix of the primes."""
    value = parts[0].astype(np.int64)
    radix = primes[0]
    for part, prime in zip(parts[1:], primes[1:], strict=True):
        digit = (part - value) % prime * pow(radix, -1, prime) % prime
        value += digit * radix
        radix *= prime
    return np.where(value > radix // 2, value - radix, value)


class Residues:
    """A matrix of whole numbers by its residues, to be multiplied by others of the same primes."""

    def __init__(self, matrix: np.ndarray, primes: tuple[int, ...]):
        self.primes, self.parts = primes, [residues(matrix, p) for p in primes]

    def take(self, at) -> Residues:
        made = object.__new__(Residues)
        made.primes, made.parts = self.primes, [p[at] for p in self.parts]
        return made

    def scores(self, other: Residues) -> np.ndarray:
        """All inner products of the rows of both."""
        return reconstruct([residue_product(a, b, p) for a, b, p in zip(self.parts, other.parts, self.primes, strict=True)], self.primes)


# -- vectors -------------------------------------------------------------------------

_VECTORS = T.StructType().add("id", "long").add("label", "long").add("query", "boolean").add("vector", "binary").add("size", "long")


def _floored(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(3)
            counts = pa.compute.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
            whole = np.floor(scale * values.flatten().to_numpy(zero_copy_only=False))
            ends = np.cumsum(counts)
            squares = np.add.reduceat(whole * whole, ends - counts) if len(counts) else whole
            keep = squares <= LARGEST
            data = np.where(np.abs(whole) < 1 << 31, whole, 0).astype("<i4").tobytes()
            vectors = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            lengths = pa.array(np.where(keep, squares, 0).astype(np.int64))
            arrays = [*batch.columns[:3], pa.array(vectors, pa.binary()), lengths]
            yield pa.RecordBatch.from_arrays(arrays, names=_VECTORS.names).filter(pa.array(keep))

    return run


def whole_vectors(rows: DataFrame, key: str, label: str, vector: str, query: Column, scale: float = SCALE) -> DataFrame:
    """``id, label, query, vector, size`` of the rows that take part, each once: floor(scale * x) as little-endian int32, and the squared length."""
    known = rows.select(
        F.col(key).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.coalesce(query, F.lit(False)).alias("query"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is above infinity
    taking = known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & finite)
    return taking.mapInArrow(_floored(scale), _VECTORS).groupBy("id", "label", "vector").agg(F.bool_or("query").alias("query"), F.max("size").alias("size"))


class _Table:
    """Rows of one dimension: ids, labels, whole components."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ids, self.labels, self.matrix = ids, labels, matrix

    def take(self, at) -> _Table:
        return _Table(self.ids[at], self.labels[at], self.matrix[at])

    def first_of_copies(self, keep: int) -> _Table:
        """By id, and of rows alike in label and vector the first ``keep``."""
        rows = self.take(np.argsort(self.ids, kind="stable"))
        whole = np.ascontiguousarray(np.column_stack([rows.labels.astype(np.int64), rows.matrix.astype(np.int64)]))
        kinds = np.unique(whole.view(np.dtype((np.void, whole.shape[1] * 8))).ravel(), return_inverse=True)[1]
        order = np.argsort(kinds, kind="stable")
        starts = np.searchsorted(kinds[order], kinds[order])
        return rows.take(np.sort(order[np.arange(len(order)) - starts < keep]))


def _tables(ids: pa.Array, labels: pa.Array, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, _Table]]:
    """The rows of a batch by dimension, with their places in it."""
    cells = vectors.to_pylist()
    sizes = np.array([len(c) // 4 for c in cells], np.int64)
    i, k = ids.to_numpy(zero_copy_only=False), labels.to_numpy(zero_copy_only=False)
    for d in np.unique(sizes).tolist():
        at = np.nonzero(sizes == d)[0]
        matrix = np.frombuffer(b"".join([cells[x] for x in at.tolist()]), "<i4").reshape(-1, d)
        yield d, at, _Table(i[at], k[at], matrix)


# -- selection -----------------------------------------------------------------------


class _Best:
    """The ``k`` best (score, id) of each of many lists: highest scores, then smallest ids."""

    def __init__(self, lists: int, k: int):
        self.scores, self.ids = np.full((lists, k), _NONE), np.zeros((lists, k), np.int64)

    def offer(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Offer allowed scores (lists x columns); the columns' ids are in ascending order."""
        k = self.scores.shape[1]
        allowed &= scores >= self.scores[lists, -1][:, None]
        if np.count_nonzero(allowed) > 32 * len(lists) and scores.shape[1] > k:
            wide = np.where(allowed, scores, _NONE)
            allowed &= scores >= np.partition(wide, wide.shape[1] - k, axis=1)[:, -k][:, None]
        row, column = np.nonzero(allowed)
        if not len(row):
            return
        touched = np.unique(row)
        held = self.scores[lists[touched]]
        old = np.nonzero(held != _NONE)
        rows = np.concatenate([touched[old[0]], row])
        values = np.concatenate([held[old], scores[row, column]])
        names = np.concatenate([self.ids[lists[touched]][old], ids[column]])
        order = np.lexsort((names, -values, rows))
        rows, values, names = rows[order], values[order], names[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < k
        at, place = lists[rows[kept]], place[kept]
        self.scores[at, place], self.ids[at, place] = values[kept], names[kept]

    def batch(self, groups: int) -> pa.RecordBatch:
        """``anchor, slot, id, score``, where ``groups`` lists belong to an anchor."""
        at, place = np.nonzero(self.scores != _NONE)
        arrays = [at // groups, (at % groups).astype(np.int32), self.ids[at, place], self.scores[at, place]]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=_FOUND.names)


_FOUND = T.StructType().add("anchor", "long").add("slot", "integer").add("id", "long").add("score", "long")


def _blocks(n: int, size: int) -> Iterator[slice]:
    return (slice(at, at + size) for at in range(0, n, size))


def _positives(anchors: dict[int, tuple[np.ndarray, _Table]], total: int, primes: tuple[int, ...], k: int):
    """Best other rows of each anchor's label, of the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(total, k)
        for batch in batches:
            for d, _, table in _tables(*batch.columns):
                if d not in anchors:
                    continue
                places, queries = anchors[d]
                rows = table.first_of_copies(k + 1)
                for label in np.intersect1d(rows.labels, queries.labels).tolist():
                    asked = np.nonzero(queries.labels == label)[0]
                    same = rows.take(rows.labels == label)
                    for block in _blocks(len(same.ids), ROWS):
                        some = same.take(block)
                        factors = Residues(some.matrix, primes)
                        for part in _blocks(len(asked), ANCHORS):
                            mine = queries.take(asked[part])
                            scores = Residues(mine.matrix, primes).scores(factors)
                            allowed = np.ones(scores.shape, bool)
                            itself = np.nonzero(mine.ids[:, None] == some.ids[None, :])
                            alike = (mine.matrix[itself[0]] == some.matrix[itself[1]]).all(axis=1)
                            allowed[itself[0][alike], itself[1][alike]] = False
                            best.offer(places[asked[part]], scores, some.ids, allowed)
        yield best.batch(1)

    return run


def _negatives(anchors: dict[int, tuple[np.ndarray, _Table]], low: np.ndarray, high: np.ndarray, primes: tuple[int, ...], k: int):
    """Best rows of other labels in the window of each positive, of the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = low.shape[1]
        best = _Best(low.size, k)
        for batch in batches:
            for d, _, table in _tables(*batch.columns):
                if d not in anchors:
                    continue
                places, queries = anchors[d]
                rows = table.first_of_copies(k)
                for block in _blocks(len(rows.ids), ROWS):
                    some = rows.take(block)
                    factors = Residues(some.matrix, primes)
                    for part in _blocks(len(places), ANCHORS):
                        mine, at = queries.take(part), places[part]
                        scores = Residues(mine.matrix, primes).scores(factors)
                        other = mine.labels[:, None] != some.labels[None, :]
                        for slot in range(slots):
                            inside = other & (scores >= low[at, slot][:, None]) & (scores <= high[at, slot][:, None])
                            best.offer(at * slots + slot, scores, some.ids, inside)
        yield best.batch(slots)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each anchor and slot over all tasks, with their ``rank`` from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _slices(rows: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The anchors with their ``slice``, and how many slices there are, none with more than ``limit`` bytes of vectors unless it is one vector."""
    weight = F.octet_length("vector") + 24
    anchors = stored(rows.where("query").withColumn("hash", F.xxhash64("id", "label", "vector")), "anchors")
    total = anchors.agg(F.sum(weight)).first()[0] or 0
    slices = -(-2 * total // limit) if total > limit else min(1, total)
    while slices > 1:
        sizes = anchors.groupBy(F.pmod("hash", F.lit(slices))).agg(F.sum(weight).alias("n"), F.max(weight).alias("largest"))
        if not sizes.where((F.col("n") > limit) & (F.col("n") > F.col("largest"))).count():
            break
        slices *= 2
    return anchors.withColumn("slice", F.pmod("hash", F.lit(max(slices, 1)))), slices


_MINED = (
    T.StructType().add("anchor_id", "long").add("positive_id", "long").add("rank", "integer").add("negative_id", "long")
    .add("positive_score", "long").add("negative_score", "long")
)


def mine_negatives(
    rows: DataFrame,
    queries: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per anchor, positive and negative with their scores; anchors are the rows for which ``queries`` holds.

    Negatives are ranked for each anchor and positive from 1, the highest score first.
    """
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, rows.count() >> 17)
    table = stored(whole_vectors(rows, key, label, vector, queries, scale).repartition(parts, "id", "label", "vector"), "vectors")
    primes = primes_for(table.agg(F.max("size")).first()[0] or 0)
    anchors, slices = _slices(table, slice_bytes)
    blocks = table.select("id", "label", "vector")
    mined = [spark.createDataFrame([], _MINED)]
    for k in range(slices):
        held = anchors.where(F.col("slice") == k).select("id", "label", "vector").toArrow().combine_chunks()
        if not held.num_rows:
            continue
        columns = [c.combine_chunks() for c in held.columns]
        groups = {d: (at, found) for d, at, found in _tables(*columns)}
        ids = columns[0].to_numpy(zero_copy_only=False)
        found = blocks.mapInArrow(_broadcast(spark, _positives, groups, len(ids), primes, positives), _FOUND)
        first = stored(_ranked(found, positives), "positives").toArrow().to_pydict()  # a few rows per anchor of the slice
        anchor, slot = np.array(first["anchor"], np.int64), np.array(first["rank"], np.int64) - 1
        scores = np.array(first["score"], np.int64)
        lows, highs = np.full((len(ids), positives), 1), np.zeros((len(ids), positives), np.int64)
        lows[anchor, slot], highs[anchor, slot] = -(-low * scores // 100), high * scores // 100
        found = blocks.mapInArrow(_broadcast(spark, _negatives, groups, lows, highs, primes, negatives), _FOUND)
        named = spark.createDataFrame(
            pa.table({"anchor": anchor, "slot": slot.astype(np.int32), "anchor_id": ids[anchor], "positive_id": first["id"], "positive_score": scores})
        )
        picked = _ranked(found, negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        joined = picked.join(named, ["anchor", "slot"])
        mined.append(stored(joined.select(*_MINED.names), "mined"))
    out = mined[0]
    for more in mined[1:]:
        out = out.unionByName(more)
    return out


def _broadcast(spark, make, *args):
    """A task's function whose arguments, bounded by the slice, are sent once to an executor."""
    shared = spark.sparkContext.broadcast(args)
    return lambda batches: make(*shared.value)(batches)

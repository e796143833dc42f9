"""Language-model scores by context-tree weighting over bytes.

The next byte is coded as eight binary decisions.  Each decision, named by the bits before it (a prefix), has a context
tree of its own over the bytes before, up to ``DEPTH`` of them.  A node estimates its bit by Krichevsky-Trofimov
from the training counts and is mixed, half and half, with its children: the weighted probability of the training
text under all prunings of the tree.  The predictive probability of a bit is then the mix, along the path of its
context, of the nodes' estimates with their posterior weights; its logarithms add up to the code length.

Texts are lower-cased (A-Z) and end with a zero byte; before the first byte there are zeros.  What a score needs of
a text is its runs of ``DEPTH`` + 1 bytes, so the work goes:

* documents are dealt to buckets of about ``BUCKET_BYTES`` by hash; a bucket lists its distinct runs and words, with their
  numbers in its training documents;
* the lists are dealt anew to parts by the last two context bytes (runs) and by hash (words).  Lists of a part are added up
  ``FAN`` at a time, then the sums of those, until one list of distinct runs is left, and each part of the tree is weighted; the two
  uppermost levels, at most 65,280 nodes, are put together on the driver;
* logarithms and counts go back the same way, from every sum to the lists it was made of, so every bucket is given those of just
  what it lists, and scores its documents in a stream.

Nothing is broadcast but those two levels, no list is larger than a bucket's texts, and no task holds more than ``FAN`` lists of
a part beside their sum, however many buckets there are.  The distinct runs with the same last two context bytes are weighted by
one task: a few percent of the distinct runs, which grow far slower than the text.  Logarithms are added up as whole numbers, rounded at 2**-40, so reruns agree.

Defined results: a null or empty text is its end alone; a null id counts as the empty text where documents
are told apart; without training documents every count is 0 and every bit has probability 1/2.  Repeated rows are
scored alike.  Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, utf8

DEPTH = 5
BUCKET_BYTES = 32 << 20
FOLDS, HELD_OUT = 5, 1
#: Lists that one task adds up, and parts that a bucket's lists are cut into at most.
FAN, PARTS = 32, 4096

_RUN_BITS = 8 * (DEPTH + 1)
_DOC_BITS = 64 - _RUN_BITS
#: Bytes of text, and texts, that are sorted at once.
_BATCH, _BATCH_TEXTS = 2 << 20, 1 << _DOC_BITS
_UNIT = 1 << 40
_HALF = math.log(0.5)

# -- runs of bytes -------------------------------------------------------------------


def runs_of(texts: list[bytes]) -> np.ndarray:
    """Every run of context and next byte of every text, sorted, each with the place of its text in the low bits."""
    pad = bytes(DEPTH)
    data = b"".join([pad + t + b"\0" for t in texts]) + bytes(8)
    windows = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,)).astype(np.uint64)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(owner)) + DEPTH * owner
    packed = (windows[at] >> np.uint64(_DOC_BITS)) << np.uint64(_DOC_BITS) | owner.astype(np.uint64)
    packed.sort()
    return packed


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs, or the sums of their weights."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    first = np.nonzero(np.concatenate([[True], values[1:] != values[:-1]]))[0]
    if weights is None:
        return values[first], np.diff(np.concatenate([first, [len(values)]]))
    return values[first], np.add.reduceat(weights, first)


def merged(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several lists of distinct values with counts as one."""
    values, counts = np.concatenate([v for v, _ in lists]), np.concatenate([c for _, c in lists])
    order = np.argsort(values, kind="stable")
    return counted(values[order], counts[order])


# -- the tree ------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for positive numbers."""
    y = x + 8
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def _mixed(kt: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.logaddexp(_HALF + kt, _HALF + below)


class Levels:
    """Runs and their counts at every depth of one part of the tree, and where each run's shorter one is."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray, least: int):
        self.least, self.keys, self.counts, self.up = least, {DEPTH: runs}, {DEPTH: counts.astype(np.float64)}, {}
        for d in range(DEPTH - 1, least - 1, -1):
            shorter = self.keys[d + 1] & np.uint64((1 << 8 * (d + 1)) - 1)
            order = np.argsort(shorter, kind="stable")
            self.keys[d], self.counts[d] = counted(shorter[order], self.counts[d + 1][order])
            self.up[d + 1] = np.searchsorted(self.keys[d], shorter)

    def decision(self, bit: int) -> tuple[dict[int, np.ndarray], dict[int, tuple[np.ndarray, ...]]]:
        """For one of the eight bits: the node of every run, and the nodes' counts, estimates and weighted probabilities."""
        node, stats, below = {}, {}, None
        for d in range(DEPTH, self.least - 1, -1):
            keys = self.keys[d]
            prefix = keys >> np.uint64(8 - bit)
            first = np.concatenate([[True], prefix[1:] != prefix[:-1]])
            node[d] = np.cumsum(first) - 1
            size = int(node[d][-1]) + 1
            one = (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
            a = np.bincount(node[d], np.where(one, 0, self.counts[d]), size)
            b = np.bincount(node[d], np.where(one, self.counts[d], 0), size)
            kt = log_kt(a, b)
            if below is None:
                weighted = kt
            else:
                starts, logs = below
                weighted = _mixed(kt, np.bincount(node[d][self.up[d + 1][starts]], logs, size))
            below = np.nonzero(first)[0], weighted
            stats[d] = a, b, kt, weighted
        return node, stats


def upper_sums(runs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """What the nodes of depth one get from this part: their number, zeros, ones, and logarithms, whole and units."""
    total = np.zeros((4, 1 << 16))
    if len(runs):
        levels = Levels(runs, counts, 2)
        keys = levels.keys[2]
        for bit in range(8):
            node, stats = levels.decision(bit)
            first = np.nonzero(np.concatenate([[True], node[2][1:] != node[2][:-1]]))[0]
            prefix = (1 << bit) | ((keys[first] & np.uint64(255)) >> np.uint64(8 - bit)).astype(np.int64)
            place = ((keys[first] >> np.uint64(8)) & np.uint64(255)).astype(np.int64) << 8 | prefix
            a, b, _, weighted = stats[2]
            whole = np.floor(weighted)
            for row, values in zip(total, (a, b, whole, np.round((weighted - whole) * _UNIT)), strict=True):
                row += np.bincount(place, values, 1 << 16)
    used = np.nonzero(total.any(axis=0))[0]
    return used, *(row[used].astype(np.int64) for row in total)


class Upper:
    """The nodes of depth zero and one: zeros, ones and weight of stopping at each."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, whole: np.ndarray, units: np.ndarray):
        self.one = self._level(nodes, zeros, ones, whole + units / _UNIT, 1 << 16)
        a, b, _, weighted = self.one
        prefix = np.arange(1 << 16) & 255
        self.zero = self._level(prefix, a, b, weighted, 1 << 8)

    @staticmethod
    def _level(nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, logs: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
        a, b, below = (np.bincount(nodes, v, size) for v in (zeros, ones, logs))
        kt = log_kt(a, b)
        weighted = _mixed(kt, below)
        return a, b, np.exp(_HALF + kt - weighted), weighted


def _estimate(a: np.ndarray, b: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (np.where(one, b, a) + 0.5) / (a + b + 1)


def log10_probabilities(runs: np.ndarray, counts: np.ndarray, upper: Upper) -> np.ndarray:
    """log10 of the predictive probability of each run's last byte; the runs of whole pairs of last context bytes."""
    logs = np.zeros(len(runs))
    if not len(runs):
        return logs
    levels = Levels(runs, counts, 2)
    byte = (runs & np.uint64(255)).astype(np.int64)
    last = ((runs >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
    for bit in range(8):
        node, stats = levels.decision(bit)
        one = (byte >> (7 - bit) & 1).astype(bool)
        chance, at = None, np.arange(len(runs))
        for d in range(DEPTH, 1, -1):
            a, b, kt, weighted = (x[node[d][at]] for x in stats[d])
            here = _estimate(a, b, one)
            stop = np.exp(_HALF + kt - weighted)
            chance = here if chance is None else stop * here + (1 - stop) * chance
            if d > 2:
                at = levels.up[d][at]
        prefix = (1 << bit) | (byte >> (8 - bit))
        for (a, b, stop, _), place in ((upper.one, last << 8 | prefix), (upper.zero, prefix)):
            chance = stop[place] * _estimate(a[place], b[place], one) + (1 - stop[place]) * chance
        logs += np.log10(chance)
    return logs


# -- buckets -------------------------------------------------------------------------


def _pack(array: np.ndarray) -> bytes:
    return zlib.compress(array.tobytes(), 1)


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype)


_RISING = np.uint64  # sorted runs are kept as differences, which compress well


def _pack_runs(runs: np.ndarray) -> bytes:
    return _pack(np.diff(runs, prepend=_RISING(0)))


def _unpack_runs(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _part_of_run(runs: np.ndarray, parts: int) -> np.ndarray:
    pair = (runs >> np.uint64(8)) & np.uint64(0xFFFF)
    return (pair * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(parts)


class Listing:
    """Distinct runs and words of one bucket, and their numbers in its training documents."""

    def __init__(self) -> None:
        self.lists: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: Counter[bytes] = Counter()
        self.other: set[bytes] = set()
        self.ends = 0
        self.texts: dict[bool, list[bytes]] = {True: [], False: []}
        self.held: dict[bool, int] = {True: 0, False: 0}

    def add(self, text: bytes, train: bool) -> None:
        self.texts[train].append(text)
        self.held[train] += len(text)
        if train:
            self.words.update(text.split())
            self.ends += 1
        else:
            self.other.update(text.split())
        if self.held[train] > _BATCH or len(self.texts[train]) == _BATCH_TEXTS:
            self._count(train)

    def _count(self, train: bool) -> None:
        if self.texts[train]:
            runs, counts = counted(runs_of(self.texts[train]) >> np.uint64(_DOC_BITS))
            self.lists.append((runs, counts if train else np.zeros(len(runs), np.int64)))
            self.texts[train], self.held[train] = [], 0
        if len(self.lists) > 16:
            self.lists = [merged(self.lists)]

    def rows(self, bucket: int, parts: int) -> Iterator[tuple]:
        self._count(True)
        self._count(False)
        runs, counts = merged(self.lists)
        part = _part_of_run(runs, parts)
        for p in np.unique(part).tolist():
            mine = part == p
            yield bucket, "runs", p, _pack_runs(runs[mine]), _pack(counts[mine])
        dealt: dict[int, list[bytes]] = {}
        for w in self.words.keys() | self.other:
            dealt.setdefault(zlib.crc32(w) % parts, []).append(w)
        for p, words in dealt.items():
            words.sort()
            yield bucket, "words", p, _pack_words(words), _pack(np.array([self.words[w] for w in words], np.int64))
        yield bucket, "ends", 0, b"", _pack(np.array([self.ends], np.int64))


_LISTS = T.StructType().add("bucket", "long").add("kind", "string").add("part", "long").add("keys", "binary").add("counts", "binary")
_LIST_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
_SUMS = T.StructType().add("node", "long").add("zeros", "long").add("ones", "long").add("whole", "long").add("units", "long")
SCORED = (
    T.StructType().add("key", "string").add("held_out", "boolean").add("n_bytes", "long").add("n_tokens", "long").add("n_known", "long")
    .add("base_score", "double").add("score", "double")
)


def _arrow(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _list_buckets(parts: int):
    """Documents, those of a bucket together, to lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, listing = None, Listing()
        for batch in batches:
            for b, train, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    if bucket is not None:
                        yield _arrow(list(listing.rows(bucket, parts)), _LIST_TYPES, _LISTS.names)
                    bucket, listing = b, Listing()
                listing.add((text or b"").lower(), train)
        if bucket is not None:
            yield _arrow(list(listing.rows(bucket, parts)), _LIST_TYPES, _LISTS.names)

    return run


def _words_of(keys: bytes) -> list[bytes]:
    return zlib.decompress(keys).split(b"\n")


def _pack_words(words: list[bytes]) -> bytes:
    return zlib.compress(b"\n".join(words), 1)


def _rows_of(table: pa.Table) -> Iterator[tuple[str, bytes, bytes | None]]:
    return zip(*(table[c].to_pylist() for c in ("kind", "keys", "counts")), strict=True)


def _merge_lists(table: pa.Table) -> pa.Table:
    """Some buckets' lists of one part as one."""
    rows = list(_rows_of(table))
    if rows[0][0] == "runs":
        runs, counts = merged([(_unpack_runs(k), _unpack(c, np.int64)) for _, k, c in rows])
        keys = _pack_runs(runs)
    else:
        total: dict[bytes, int] = {}
        for _, k, c in rows:
            for w, n in zip(_words_of(k), _unpack(c, np.int64).tolist(), strict=True):
                total[w] = total.get(w, 0) + n
        words = sorted(total)
        keys, counts = _pack_words(words), np.array([total[w] for w in words], np.int64)
    first = table.slice(0, 1)
    for name, value in (("keys", keys), ("counts", _pack(counts))):
        first = first.set_column(first.schema.get_field_index(name), name, pa.array([value], pa.binary()))
    return first


def _sum_part(table: pa.Table) -> pa.Table:
    ((_, keys, counts),) = _rows_of(table)
    return pa.table([pa.array(c) for c in upper_sums(_unpack_runs(keys), _unpack(counts, np.int64))], names=_SUMS.names)


def _weigh_part(upper: Upper):
    def run(table: pa.Table) -> pa.Table:
        ((_, keys, counts),) = _rows_of(table)
        logs = log10_probabilities(_unpack_runs(keys), _unpack(counts, np.int64), upper)
        return table.set_column(table.schema.get_field_index("counts"), "counts", pa.array([_pack(logs)], pa.binary()))

    return run


def _total_words(table: pa.Table) -> pa.Table:
    """Numbers of tokens and of different words of a part in the training documents."""
    ((_, _, packed),) = _rows_of(table)
    counts = _unpack(packed, np.int64)
    return pa.table({"n": pa.array([int(counts.sum())]), "v": pa.array([int((counts > 0).sum())])})


def _hand_down(table: pa.Table) -> pa.Table:
    """The values of a sum, in the first row, for each of the lists it was made of."""
    table = table.sort_by("below").drop_columns(["above", "below"])
    (kind, keys, values), *lists = _rows_of(table)
    if kind == "runs":
        runs, logs = _unpack_runs(keys), _unpack(values, np.float64)
        given = [_pack(logs[np.searchsorted(runs, _unpack_runs(k))]) for _, k, _ in lists]
    else:
        known = dict(zip(_words_of(keys), _unpack(values, np.int64).tolist(), strict=True))
        given = [_pack(np.array([known[w] for w in _words_of(k)], np.int64)) for _, k, _ in lists]
    below = table.slice(1)
    return below.set_column(below.schema.get_field_index("counts"), "counts", pa.array(given, pa.binary()))


def _sums_of(lists: DataFrame, buckets: int, fan: int) -> list[DataFrame]:
    """The lists, the sums of ``fan`` buckets' lists, the sums of those, and so on: one list per part at last."""
    levels = [lists]
    while buckets > 1:
        buckets = math.ceil(buckets / fan)
        grouped = levels[-1].withColumn("bucket", F.call_function("div", F.col("bucket"), F.lit(fan).cast("bigint")))
        levels.append(stored(grouped.groupBy("kind", "part", "bucket").applyInArrow(_merge_lists, _LISTS), "lists"))
    return levels


def _values_of(valued: DataFrame, levels: list[DataFrame], fan: int) -> DataFrame:
    """The values of the last level's lists, handed down to those of the first."""
    for k in range(len(levels) - 2, -1, -1):
        above = valued.select(F.col("bucket").alias("above"), F.lit(False).alias("below"), *_LISTS.names)
        parent = F.call_function("div", F.col("bucket"), F.lit(fan).cast("bigint")).alias("above")
        own = [c for c in _LISTS.names if c != "counts"]
        below = levels[k].select(parent, F.lit(True).alias("below"), *own, F.lit(None).cast("binary").alias("counts"))
        valued = above.unionByName(below).groupBy("kind", "part", "above").applyInArrow(_hand_down, _LISTS)
        if k:
            valued = stored(valued, "values")
    return valued


class Scorer:
    """Scores the documents of one bucket with what the bucket was given."""

    def __init__(self, ends: int, tokens: int, types: int):
        self.ends, self.least = ends, tokens + 0.5 * (types + 1)
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: dict[bytes, int] = {}
        self.model: tuple[np.ndarray, np.ndarray] | None = None
        self.held: list[tuple] = []
        self.size = 0

    def learn(self, kind: str, keys: bytes, values: bytes) -> None:
        if kind == "runs":
            self.runs.append((_unpack_runs(keys), _unpack(values, np.float64)))
        else:
            self.words.update(zip(_words_of(keys), _unpack(values, np.int64).tolist(), strict=True))

    def _log(self, count: int) -> float:
        return math.log10((count + 0.5) / self.least)

    def add(self, key: str | None, train: bool, text: bytes) -> None:
        self.held.append((key, not train, text))
        self.size += len(text)

    def rows(self) -> list[tuple]:
        """Rows of the documents held."""
        if not self.held:
            return []
        if self.model is None:
            runs, logs = (np.concatenate(x) for x in zip(*self.runs, strict=True))
            order = np.argsort(runs, kind="stable")
            self.model, self.runs = (runs[order], logs[order]), []
        keys, logs = self.model
        pairs, counts = counted(runs_of([t for _, _, t in self.held]))
        value = logs[np.searchsorted(keys, pairs >> np.uint64(_DOC_BITS))]
        owner = (pairs & np.uint64((1 << _DOC_BITS) - 1)).astype(np.int64)
        scores = np.bincount(owner, counts * value, len(self.held)).tolist()
        out = []
        for (key, held_out, text), score in zip(self.held, scores, strict=True):
            tokens = Counter(text.split())
            seen = [(n, self.words[w]) for w, n in tokens.items()] + [(1, self.ends)]
            known = sum(n for n, c in seen if c)
            base = math.fsum(n * self._log(c) for n, c in seen)
            out.append((key, held_out, len(text), sum(n for n, _ in seen), known, base, score))
        self.held, self.size = [], 0
        return out


_ROWS = (
    T.StructType().add("bucket", "long").add("first", "integer").add("kind", "string").add("keys", "binary").add("counts", "binary")
    .add("key", "string").add("train", "boolean").add("text", "binary")
)


def _score_buckets(ends: int, tokens: int, types: int):
    """Per bucket first what it was given, then its documents."""
    kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, scorer = None, None
        for batch in batches:
            for b, first, kind, keys, values, key, train, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    if scorer is not None and scorer.held:
                        yield _arrow(scorer.rows(), kinds, SCORED.names)
                    bucket, scorer = b, Scorer(ends, tokens, types)
                if first == 0:
                    scorer.learn(kind, keys, values)
                    continue
                scorer.add(key, train, (text or b"").lower())
                if scorer.size > _BATCH or len(scorer.held) == _BATCH_TEXTS:
                    yield _arrow(scorer.rows(), kinds, SCORED.names)
        if scorer is not None and scorer.held:
            yield _arrow(scorer.rows(), kinds, SCORED.names)

    return run


# -- the operator --------------------------------------------------------------------


def is_held_out(key: str) -> Column:
    """One document in five by a checksum of its id."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def language_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES, fan: int = FAN) -> DataFrame:
    """Per document: key, whether it was held out, counts, both log10 probabilities, and the code length per byte."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(buckets)).cast("bigint").alias("bucket"),
        F.col(key).cast("string").alias("key"),
        (~is_held_out(key)).alias("train"),
        utf8(text).alias("text"),
    )
    dealt = rows.select("bucket", "train", "text").repartition("bucket").sortWithinPartitions("bucket")
    lists = stored(dealt.mapInArrow(_list_buckets(min(buckets, PARTS)), _LISTS), "lists")
    ends = sum(int(_unpack(bytes(r["counts"]), np.int64)[0]) for r in lists.where(F.col("kind") == "ends").select("counts").toLocalIterator())
    levels = _sums_of(lists.where(F.col("kind") != "ends"), buckets, fan)
    of = lambda kind: levels[-1].where(F.col("kind") == kind)

    # At most 256 * 255 nodes.
    sums = of("runs").groupBy("part").applyInArrow(_sum_part, _SUMS).groupBy("node").agg(*[F.sum(c).alias(c) for c in _SUMS.names[1:]])
    nodes = sums.toPandas().astype("int64").sort_values("node")
    upper = Upper(*(nodes[c].to_numpy() for c in _SUMS.names))
    weighed = of("runs").groupBy("part").applyInArrow(_weigh_part(upper), _LISTS)

    totals = of("words").groupBy("part").applyInArrow(_total_words, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    tokens, types = (totals["n"] or 0) + ends, (totals["v"] or 0) + (ends > 0)

    given = _values_of(weighed.unionByName(of("words")), levels, fan).select(
        "bucket",
        F.lit(0).alias("first"),
        "kind",
        "keys",
        "counts",
        F.lit(None).cast("string").alias("key"),
        F.lit(None).cast("boolean").alias("train"),
        F.lit(None).cast("binary").alias("text"),
    )
    own = rows.select("bucket", F.lit(1).alias("first"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("binary").alias("keys"), F.lit(None).cast("binary").alias("counts"), "key", "train", "text")
    together = given.unionByName(own).repartition("bucket").sortWithinPartitions("bucket", "first")
    scored = together.select(*_ROWS.names).mapInArrow(_score_buckets(ends, tokens, types), SCORED)
    return scored.select(
        F.col("key").cast(docs.schema[key].dataType).alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )

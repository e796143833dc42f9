"""Documents drawn by how much more likely the target's words make them than the corpus's own words.

Features are the words of a text, or its words and pairs of neighbours joined by a space; a feature's bucket is the
CRC-32 of its bytes modulo the number of buckets.  A bucket's gain is the logarithm of its smoothed share in the target
over that in the corpus, a document's weight the mean gain of its features.  The documents with the highest sum of weight
and a Gumbel number of their own are drawn, which is a draw without replacement in proportion to exp(weight).

Words are many, and few of them are most of a text.  Every task counts its features and gives the frequent ones by
themselves (the head: at most one in ``HEAD`` of its features each, so at most ``HEAD`` of them), and all others already
added up by bucket after a CRC of each.  Both parts together are the exact totals of all buckets.  The corpus's most frequent
words come back to the tasks with the state of the CRC after them, and the most frequent pairs with their buckets; what is
in neither takes its CRC, a pair from the state of its first word on.  So results do not depend on what is in the head.

The head has at most ``HEAD`` words and pairs of at most ``LONGEST`` bytes, which bounds what is broadcast; the driver holds
it and the gains.  Ranks come from a sort by ranges: only documents at or above the score where the draw ends are sorted.

Defined results: a null or empty text has no features and weight 0; it has a score, but as it has too few words it is not
drawn.  Every row counts and may be drawn, copies too; rows alike in score and id stand in the order of their features.  A
null id is drawn as ``null`` and stands after all others of its score.  An empty target makes all gains follow the corpus
alone, an empty corpus gives no rows.  Other columns are ignored, or kept as they are by ``resampled_documents``.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, bare_words, packed, stored, utf8

BUCKETS = 10_000
HEAD = 1 << 15
#: Longest feature of the head, in bytes.
LONGEST = 64
#: Features a worker holds before it adds rare ones up, or forgets what it looked up.
HELD = 300_000
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"

COUNTS = T.StructType().add("feature", "binary").add("bucket", "integer").add("n", "long")


def _features(words: list[bytes], pairs: bool) -> list[bytes]:
    return words + [b"%b %b" % p for p in zip(words, words[1:], strict=False)] if pairs else words


def _counter(buckets: int, pairs: bool, head: int):
    """The features of a task: frequent ones with their counts, the others as counts of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        totals = np.zeros(buckets, np.int64)
        seen = 0

        def add_up() -> None:
            rare = [f for f, n in counts.items() if n * head < seen or len(f) > LONGEST]
            at = np.fromiter((zlib.crc32(f) % buckets for f in rare), np.int64, len(rare))
            np.add.at(totals, at, np.fromiter((counts.pop(f) for f in rare), np.int64, len(rare)))

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _features(bare_words(text), pairs)
                counts.update(found)
                seen += len(found)
                if len(counts) > HELD:
                    add_up()
        add_up()
        held = np.nonzero(totals)[0]
        features = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(features + [None] * len(held), pa.binary()),
                pa.array([None] * len(features) + held.tolist(), pa.int32()),
                pa.array([*counts.values(), *totals[held].tolist()], pa.int64()),
            ],
            names=COUNTS.names,
        )

    return run


def feature_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, pairs: bool = False, head: int = HEAD) -> DataFrame:
    """Counts that add up to those of all features: of frequent ones by ``feature``, of all others by ``bucket``."""
    return stored(texts.select(utf8(text)).mapInArrow(_counter(buckets, pairs, head), COUNTS), "features")


def bucket_totals(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features are in every bucket, exactly."""
    bucket = F.coalesce(F.col("bucket"), (F.crc32("feature") % buckets).cast("int"))
    totals = np.zeros(buckets, np.int64)
    for row in counts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).collect():
        totals[row["bucket"]] = row["n"]
    return totals


def frequent_features(counts: DataFrame, head: int = HEAD) -> list[bytes]:
    """The most frequent features, at most ``head``."""
    listed = counts.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("n").alias("n"))
    return [bytes(r["feature"]) for r in listed.orderBy(F.desc("n"), "feature").limit(head).collect()]


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the logarithm by which each bucket's share in the target is above that in the source."""
    s, t, buckets = int(source.sum()), int(target.sum()), len(source)
    return [math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)]


class _Words(dict):
    """Gains of words: the head is known, others take their CRC and are remembered for a while."""

    def __init__(self, gain: list[int], head: list[bytes]):
        self.gain = gain
        self.head = {w: gain[zlib.crc32(w) % len(gain)] for w in head}
        super().__init__(self.head)

    def __missing__(self, word: bytes) -> int:
        found = self.gain[zlib.crc32(word) % len(self.gain)]
        if len(word) <= LONGEST:
            if len(self) > HELD:
                self.clear()
                self.update(self.head)
            self[word] = found
        return found


class _Pairs:
    """Gains of pairs: from the head, else from the state of the first word's CRC on."""

    def __init__(self, gain: list[int], head: list[bytes]):
        self.gain = gain
        self.states = {w: zlib.crc32(w + b" ") for w in head if b" " not in w}
        self.head = {tuple(p.split(b" ")): gain[zlib.crc32(p) % len(gain)] for p in head if b" " in p}

    def total(self, words: list[bytes]) -> int:
        known, states, gain, size = self.head, self.states, self.gain, len(self.gain)
        total = 0
        for pair in zip(words, words[1:], strict=False):
            found = known.get(pair)
            if found is None:
                state = states.get(pair[0])
                if state is None:
                    state = zlib.crc32(pair[0] + b" ")
                found = gain[zlib.crc32(pair[1], state) % size]
            total += found
        return total


_SCORERS: dict[str, tuple[_Words, _Pairs | None]] = {}


def weighed(docs: DataFrame, gain: list[int], head: list[bytes], text: str = "__text", pairs: bool = False) -> DataFrame:
    """Append ``n_words``, ``n_features`` and ``weight``, the floored mean gain of the features."""
    shared, name = docs.sparkSession.sparkContext.broadcast((gain, head)), uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if name not in _SCORERS:
            _SCORERS.clear()
            known, listed = shared.value
            _SCORERS[name] = _Words(known, [f for f in listed if b" " not in f]), _Pairs(known, listed) if pairs else None
        word_gain, pair_gain = _SCORERS[name]
        n_words, n_features, weights = [], [], []
        for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
            words = bare_words(t)
            total, n = sum(map(word_gain.__getitem__, words)), len(words)
            n_words.append(n)
            if pair_gain:
                total += pair_gain.total(words)
                n += max(0, n - 1)
            n_features.append(n)
            weights.append(total // n if n else 0)
        return [pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(weights, pa.int64())]

    return add_columns(docs, [text], T.StructType().add("n_words", "long").add("n_features", "long").add("weight", "long"), run)


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Append ``rank``: 1, 2, 3, ... for the drawn rows, the highest scores among those with enough words, else null."""
    enough = F.col("n_words") >= least_words
    # Scores are whole numbers between -50,000 and 70,000: one window holds a row for each.
    scores = scored.where(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    sums = scores.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
    drawn = scored.where(enough).count() * percent // 100
    last = sums.where(F.col("above") < drawn).agg(F.min("score")).first()[0]
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    chosen = enough & (F.col("score") >= last)
    # Rows alike in all of the order are alike, so a salt may part them.
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features")]
    ranges = scored.where(chosen).withColumn("__salt", F.rand(7)).repartitionByRange(*order, "__salt").sortWithinPartitions(*order)
    placed = stored(ranges.drop("__salt").withColumn("__place", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("__place", 33).alias("__part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))  # a row per task
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    numbered = placed.withColumn("__part", part).join(bases, "__part")
    rank = F.col("__base") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    numbered = numbered.withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.where(~F.coalesce(chosen, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint"))
    return numbered.select(*scored.columns, "rank").unionByName(rest)


def _scored(docs: DataFrame, target: DataFrame, key: str, text: str, target_text: str, buckets: int, pairs: bool, seed: str, rows: bool, head: int) -> DataFrame:
    counts = feature_counts(docs, text, buckets, pairs, head)
    wanted = bucket_totals(feature_counts(target, target_text, buckets, pairs, head), buckets)
    gain = gains(bucket_totals(counts, buckets), wanted)
    working = {"id": F.col(key), "__text": utf8(text)}
    source = packed(docs, **working) if rows else docs.select(*[c.alias(n) for n, c in working.items()])
    found = weighed(source, gain, frequent_features(counts, head), pairs=pairs)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((number + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    return stored(found.withColumn("score", F.col("weight") + gumbel), "scores")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    pairs: bool = False,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
    head: int = HEAD,
) -> DataFrame:
    """Every document's id, ``n_features``, ``weight``, ``score`` and its ``rank`` among the drawn ones, else null."""
    scored = _scored(docs, target, key, text, target_text, buckets, pairs, seed, False, head)
    return ranked(scored, percent, least_words).select(F.col("id").alias(key), "n_features", "weight", "score", "rank")


def resampled_documents(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    pairs: bool = False,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
    head: int = HEAD,
) -> DataFrame:
    """The drawn documents, whole rows as they are given."""
    scored = _scored(docs, target, key, text, target_text, buckets, pairs, seed, True, head)
    return ranked(scored, percent, least_words).where(F.col("rank").isNotNull()).select("__row.*")

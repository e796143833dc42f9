"""Mixing sources to target weights by balanced sampling with the cube method.

Targets: the sources, in code-point order with null last, weigh 5, 2, 1, repeating, and
share 150 % of all words; a target stops at twice its source's size and the excess is shared
anew by weight until none is above.

A source that is to be taken ``rate`` times gives every document ``floor(rate)`` times, and once more
with probability ``rate - floor(rate)``.  Which ones is decided by the cube method: the vector of
probabilities moves along directions that leave the sums of words and of documents as they
are (the null space of these two constraints) until an entry reaches 0 or 1.  Three undecided documents
always have such a direction, so at most two stay undecided; the large ones are decided first.

A flight over any part of a source keeps that part's sums, so the documents of a source
fly in blocks of about ``BLOCK``, spread by hash; the undecided two of each block fly again together,
and so on until one block per source is left.  There the landing takes, of the four outcomes for the
two last documents, the one that comes nearest to the word total.  Random numbers come from the source's number,
the block and the round: reruns agree.

Defined results: a null text has size 0; a document of size 0 is decided like any other and takes no words; a source
whose documents are all empty has target 0 and nothing of it is taken; an empty table gives no rows.  Ids may be null or repeat.  Columns
are carried along whatever their names.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_to_unique
from .common import packed, plain_words, stored

# Weights by place, share of all words, and most times a source is taken.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0

BLOCK = 512
#: Sources whose targets the driver works out and broadcasts; those of more are worked out over all tasks.
MAX_SOURCES = 100_000

_NEAR = 1e-9


def source_targets(
    sizes: dict[str | None, int], weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> dict[str | None, float]:
    """Words to take of each source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    open_ = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, targets = share * sum(sizes.values()), dict.fromkeys(order, 0.0)
    while open_:
        total = sum(open_.values())
        full = [s for s, w in open_.items() if w * left / total > most * sizes[s]]
        if not full:
            return targets | {s: w * left / total for s, w in open_.items()}
        for s in full:
            targets[s] = most * sizes[s]
            del open_[s]
        left -= sum(targets[s] for s in full)
    return targets


def _named() -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("__source")), F.lit(""))


def spread_targets(
    sums: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``source_targets`` of any number of sources, as columns ``__no, __target, __rate`` beside ``__source_size``.

    Sources are numbered in order by ranges.  The words that one unit of weight gets only rise as full sources are put
    aside, so every round is one sum over the sources: those full at the level before give what they hold.
    """
    order = F.col("__source").asc_nulls_last()
    parts = sums.sparkSession.sparkContext.defaultParallelism
    sorted_ = sums.repartitionByRange(parts, order).sortWithinPartitions(order)
    # Stored, so that places stay what they are; a place is the row's number within its partition.
    placed = stored(sorted_.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__in")), "sources")
    counts = {r["__part"]: r["count"] for r in placed.groupBy("__part").count().collect()}  # one row per partition
    bases = [sum(n for q, n in counts.items() if q < p) for p in range(parts)]
    base = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in bases]), F.col("__part") + 1)
    rows = placed.withColumn("__no", base + F.col("__in")).drop("__part", "__in")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__no") % len(weights) + 1).cast("int"))
    full = F.lit(False)
    level, before = 0.0, None
    while True:
        found = rows.agg(
            F.sum(F.col("__source_size").cast("decimal(38,0)")).alias("all"),
            F.sum(F.when(full, F.col("__source_size").cast("decimal(38,0)"))).alias("full"),
            F.sum(F.when(~full, weight)).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if found["n"] == before or not found["weight"]:
            break
        before = found["n"]
        level = (share * float(found["all"] or 0) - most * float(found["full"] or 0)) / found["weight"]
        full = weight * F.lit(level) > most * F.col("__source_size")
    target = F.when(full, most * F.col("__source_size")).otherwise(weight * F.lit(level))
    rows = rows.withColumn("__target", target)
    return rows.withColumn("__rate", F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0))


# -- flight and landing --------------------------------------------------------------


def _direction(size: float, pool: np.ndarray) -> np.ndarray | None:
    """How the pool makes up, spread as evenly as it can, for one more document of a size; None where it cannot."""
    n, mean = len(pool), pool.mean() if len(pool) else 0.0
    apart = pool - mean
    spread = float(apart @ apart)
    if spread > 0:
        return -1.0 / n - apart * ((size - mean) / spread)
    return np.full(n, -1.0 / n) if n and size == mean else None


def fly(chance: np.ndarray, sizes: np.ndarray, draw: random.Random, land: bool = False) -> np.ndarray:
    """Decide all but two documents without changing the sums of words and documents; with ``land`` all.

    ``sizes`` descends.  Each document in turn goes towards 0 or 1 while the undecided ones after it make up for
    it, each a little: the large ones are decided while there are many small ones to balance them.
    """
    chance, sizes = chance.copy(), sizes.astype(np.float64)
    undecided = np.nonzero((chance > 0) & (chance < 1))[0]
    some: list[int] = []
    while len(undecided):
        first, pool = undecided[0], undecided[1:]
        others = _direction(sizes[first], sizes[pool])
        if others is None:
            some.append(int(first))
            undecided = pool
            continue
        u, c = np.concatenate([[1.0], others]), chance[undecided]
        with np.errstate(divide="ignore"):
            ahead = np.where(u > 0, (1 - c) / u, np.where(u < 0, -c / u, np.inf)).min()
            back = np.where(u > 0, c / u, np.where(u < 0, (c - 1) / u, np.inf)).min()
        c = c + u * (ahead if draw.random() * (ahead + back) < back else -back)
        c[c < _NEAR], c[c > 1 - _NEAR] = 0.0, 1.0
        chance[undecided] = c
        undecided = undecided[(c > 0) & (c < 1)]
    if land and some:

        def missed(taken: tuple[int, ...]) -> tuple[float, float]:
            words = sum((t - chance[k]) * float(sizes[k]) for k, t in zip(some, taken, strict=True))
            return abs(words), abs(sum(t - chance[k] for k, t in zip(some, taken, strict=True)))

        chance[some] = min(product((0, 1), repeat=len(some)), key=missed)
    return chance


def _flight(round_: int, last: bool):
    """One round over one block of one source."""

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("__hash").to_numpy(), -table.column("__size").to_numpy()))
        table = table.take(pa.array(order))
        source, block = table.column("__no")[0].as_py(), table.column("__block")[0].as_py()
        draw = random.Random(f"{source},{block},{round_}")
        chance = fly(table.column("__chance").to_numpy(), table.column("__size").to_numpy(), draw, last)
        at = table.schema.get_field_index("__chance")
        return table.set_column(at, "__chance", pa.array(chance, pa.float64()))

    return run


def _decided() -> Column:
    return (F.col("__chance") <= 0) | (F.col("__chance") >= 1)


def balanced(units: DataFrame, most_units: int, block: int = BLOCK) -> DataFrame:
    """Rows ``__no, __size, __hash, __chance, __units`` and others with every chance decided to 0 or 1.

    ``__units`` is the number of rows of the source; ``most_units`` the largest of them.
    """
    done, round_ = None, 0
    while True:
        blocks = F.greatest(F.ceil(F.col("__units") / block), F.lit(1)).cast("bigint")
        dealt = units.withColumn("__blocks", blocks).withColumn("__block", F.pmod(F.xxhash64("__hash", F.lit(round_)), F.col("__blocks")))
        last = most_units <= block
        flown = dealt.where(~_decided()).groupBy("__no", "__block").applyInArrow(_flight(round_, last), dealt.schema)
        flown = stored(flown, "flight")
        for part in [flown.where(_decided())] + ([dealt.where(_decided())] if round_ == 0 else []):
            done = part if done is None else done.unionByName(part)
        if last:
            return done
        # At most two documents of a block are left.
        units = flown.where(~_decided()).withColumn("__units", 2 * F.col("__blocks")).drop("__blocks", "__block")
        most_units, round_ = 2 * math.ceil(most_units / block), round_ + 1


def _mixed(rows: DataFrame, weights: Sequence[int], share: float, most: float, block: int) -> DataFrame:
    """Rows with ``__source, __size, __id, __hash`` get ``__source_size, __target, __copies``."""
    rows = _parted(rows, block)
    sums = rows.groupBy("__source").agg(F.sum("__size").alias("__source_size"), F.count(F.lit(1)).alias("__units"))
    sources = sums.limit(MAX_SOURCES + 1).collect()
    if len(sources) > MAX_SOURCES:
        plan = spread_targets(stored(sums, "sources"), weights, share, most).withColumn("__s", _named()).drop("__source")
        joined = join_to_unique(rows.withColumn("__s", _named()), plan, "__s", "left").drop("__s")
        most_units = plan.agg(F.max("__units")).first()[0]
    else:
        targets = source_targets({r["__source"]: r["__source_size"] for r in sources}, weights, share, most)
        number = {s: k for k, s in enumerate(targets)}
        table = [(s, n, size, units, targets[s], targets[s] / size if size else 0.0) for s, size, units in sources for n in [number[s]]]
        schema = "s string, __no long, __source_size long, __units long, __target double, __rate double"
        # At most MAX_SOURCES rows.
        plan = F.broadcast(rows.sparkSession.createDataFrame(table, schema))
        joined = rows.join(plan, F.col("__source").eqNullSafe(F.col("s")), "left").drop("s")
        most_units = max((r["__units"] for r in sources), default=0)
    units = joined.withColumn("__chance", F.col("__rate") - F.floor("__rate"))
    done = balanced(units, most_units, block)
    return done.withColumn("__copies", (F.floor("__rate") + F.col("__chance")).cast("int"))


def _working(text: str, source: str, key: str) -> dict[str, Column]:
    size = F.size(plain_words(F.col(text))).cast("bigint")
    return {"__source": F.col(source), "__size": size, "__id": F.col(key), "__hash": F.xxhash64(F.col(key), F.octet_length(F.col(text)))}


def _parted(rows: DataFrame, block: int) -> DataFrame:
    """Rows of an id that more than a block of rows share are told apart by their places in the table.

    Else copies, or rows without an id, would share one block whatever its hash.  All other rows keep their hash, which
    does not depend on their places.
    """
    hot = rows.groupBy("__id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(F.col("__id").alias("__hot"), F.lit(True).alias("__many"))
    ids = hot.count()
    if not ids:
        return rows.drop("__id")
    hot = F.broadcast(hot) if ids <= MAX_SOURCES else hot
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    joined = placed.join(hot, F.col("__id").eqNullSafe(F.col("__hot")), "left")
    own = F.when(F.col("__many"), F.xxhash64("__hash", "__place")).otherwise(F.col("__hash"))
    return joined.withColumn("__hash", own).drop("__id", "__hot", "__many", "__place")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: key, ``size``, ``source_size``, ``target``, ``taken`` words, and the ``copies`` of it."""
    rows = docs.select(F.col(key).alias("__key"), *[c.alias(n) for n, c in _working(text, source, key).items()])
    rows = stored(rows, "sizes")  # small, and read by every pass instead of the texts
    return _mixed(rows, weights, share, most, block).select(
        F.col("__key").alias(key),
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).cast("bigint").alias("taken"),
        F.col("__copies").alias("copies"),
    )


def mixed_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """The documents, all columns, as often as the mix takes them."""
    done = _mixed(packed(docs, **_working(text, source, key)), weights, share, most, block)
    return done.where("__copies > 0").select("__row", F.explode(F.array_repeat(F.lit(1), F.col("__copies")))).select("__row.*")

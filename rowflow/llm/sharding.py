"""Extendible hashing: shards that fit a byte limit, found through a directory of hash prefixes.

A document's key is hashed to 60 bits.  A bucket is a prefix of these bits; one whose
documents exceed the limit is split on the next bit, the others stay as they are.  The
directory lists, for every prefix of its own length, the bucket it belongs to.

The directory's first length follows from the total size, so it has a handful of entries
per shard.  Where a bucket needs more bits than that, only its documents are read again
for a longer prefix.  Documents are never collected; Spark joins them with the directory
and itself decides by its size whether to broadcast it.

Defined results: a null key hashes like an empty one, a null text has 0 bytes, an empty
table gives no shard.  Rows whose keys are equal share all bits and cannot be parted: when
they alone exceed the limit, as a single larger document does, their bucket ends at the
first bit that isolates them and is marked ``oversize``; a key that names the row (several
columns may) avoids it.  Columns of the table are carried along; one that is named like a column of the
result, in whatever case, is kept as ``given_<name>`` (with as many ``given_`` as make it a new name).
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored

BITS = 60
SHARD_BYTES = 64 << 20
#: Bits of the directory beyond the least number that could do, and bits added per refinement.
SPARE, STEP = 3, 8

SHARD = ("n_bytes", "shard", "shard_depth", "shard_docs", "shard_bytes", "oversize")


def key_bits(key: Iterable[str]) -> Column:
    """60 bits of the MD5 of the key."""
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws(",", *parts)), 1, BITS // 4), 16, 10).cast("bigint")


def given_names(columns: Iterable[str], own: Iterable[str]) -> dict[str, str]:
    """Names under which columns are kept beside a result's own columns."""
    columns = list(columns)
    taken = {c.lower() for c in own} | {c.lower() for c in columns}
    names = {}
    for c in columns:
        name = c
        if c.lower() in {o.lower() for o in own}:
            while name.lower() in taken:
                name = f"given_{name}"
            taken.add(name.lower())
        names[c] = name
    return names


def _prefix(depth: int) -> Column:
    return F.shiftright("__h", BITS - depth)


def _directory(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """Prefixes of ``high`` bits with the bucket they belong to, sought at depths ``low`` to ``high``.

    ``shard_depth`` is null where no prefix up to ``high`` bits fits.
    """
    cells = rows.groupBy(_prefix(high).alias("__cell")).agg(
        F.sum("__bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.min("__h").alias("lo"), F.max("__h").alias("hi")
    )
    cells = stored(cells, "cells")
    depths = cells.withColumn("d", F.explode(F.sequence(F.lit(low), F.lit(high))))
    up = F.expr(f"shiftright(__cell, {high} - d)")
    nodes = depths.groupBy("d", up.alias("p")).agg(
        F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    fits = (F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi")) | (F.col("d") == BITS)
    leaf = F.struct(F.col("d"), F.col("p"), F.col("shard_docs"), F.col("shard_bytes"))
    placed = depths.select("__cell", F.col("d"), up.alias("p")).join(nodes.where(fits).select("d", "p", "shard_docs", "shard_bytes"), ["d", "p"])
    leaves = placed.groupBy("__cell").agg(F.min(leaf).alias("leaf"))
    return cells.select("__cell").join(leaves, "__cell", "left").select(
        "__cell",
        F.col("leaf.d").alias("shard_depth"),
        F.lpad(F.bin("leaf.p"), F.col("leaf.d"), F.lit("0")).alias("shard"),
        F.col("leaf.shard_docs").alias("shard_docs"),
        F.col("leaf.shard_bytes").alias("shard_bytes"),
    )


def extendible_shards(
    docs: DataFrame, limit: int = SHARD_BYTES, key: Iterable[str] = ("doc_id",), text: str = "text", rows: bool = True
) -> DataFrame:
    """``docs`` with the columns of ``SHARD``; with ``rows=False`` the key and these only."""
    key = list(key)
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")
    light = docs.select(key_bits(key).alias("__h"), size.alias("__bytes"))
    total = light.agg(F.sum("__bytes")).first()[0] or 0
    high = min(BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SPARE)
    heavy = packed(docs, __h=key_bits(key), __bytes=size) if rows else docs.select(*key, key_bits(key).alias("__h"), size.alias("__bytes"))
    kept = ["__row"] if rows else key
    out, low = None, 0
    while True:
        directory = stored(_directory(light, limit, low, high), "directory")
        open_cells = directory.where(F.col("shard_depth").isNull()).select("__cell")
        last = open_cells.isEmpty()
        placed = heavy.withColumn("__cell", _prefix(high)).join(directory.where(F.col("shard_depth").isNotNull()), "__cell").select(
            *kept,
            F.col("__bytes").alias("n_bytes"),
            "shard",
            "shard_depth",
            "shard_docs",
            "shard_bytes",
            (F.col("shard_bytes") > limit).alias("oversize"),
        )
        out = placed if out is None else out.unionByName(placed)
        if last:
            break
        light = light.withColumn("__cell", _prefix(high)).join(open_cells, "__cell", "left_semi").drop("__cell")
        heavy = heavy.withColumn("__cell", _prefix(high)).join(open_cells, "__cell", "left_semi").drop("__cell")
        low, high = high + 1, min(BITS, high + STEP)
    if not rows:
        return out
    return out.select(*[F.col(f"__row.`{c}`").alias(n) for c, n in given_names(docs.columns, SHARD).items()], *SHARD)

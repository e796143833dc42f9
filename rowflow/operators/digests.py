"""Where two tables differ: a tree of digests over hash prefixes of the key, opened only where it differs.

A row's digest covers every column with its nulls: what is null is told from what is empty, and a value cannot move to the
column beside it unseen.  Digests of rows add up, so those of a prefix need no order and follow from those of the longer
prefixes.  Two trees are compared from the root down, a level at a time; only rows below differing leaves are read
again, and compared by key.  Trees are small, at most 2**bits rows, so they may come from different systems.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_cleared, work_dir
from .latest import META

#: Bits of the leaves, and of one level.
LEAF_BITS = 16
LEVEL_BITS = 4

#: Into how many parts the contents of a table are dealt that are compared at once.
PARTS = 2


def _parts(columns: Iterable[Column]) -> list[Column]:
    """Values and null flags side by side: the hash functions skip nulls."""
    out = []
    for c in columns:
        out += [c.isNull(), c]
    return out


def row_hash(columns: Iterable[Column]) -> Column:
    """A 64-bit hash of all columns, nulls included."""
    return F.xxhash64(*_parts(columns))


def _second_hash(columns: Iterable[Column]) -> Column:
    return F.xxhash64(F.lit("second"), *_parts(columns))


def _digests(columns: list[Column]) -> list[Column]:
    """Number of rows, and the sums of two hashes, exact."""
    return _sums(row_hash(columns), _second_hash(columns))


def _sums(first: Column, second: Column) -> list[Column]:
    total = lambda c: F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("row_count"), total(first).alias("first"), total(second).alias("second")]


def leaf_of(keys: Iterable[str], bits: int = LEAF_BITS) -> Column:
    """The leaf of a row: the leading bits of a hash of its key."""
    return F.shiftrightunsigned(row_hash(F.col(k) for k in keys), 64 - bits).cast("int")


def digest_tree(rows: DataFrame, keys: Iterable[str], bits: int = LEAF_BITS, step: int = LEVEL_BITS) -> DataFrame:
    """``level, prefix, row_count, first, second``: every level's prefixes that have rows, from the root (level 0)."""
    columns = [F.col(c) for c in sorted(rows.columns)]
    return _tree(rows, leaf_of(keys, bits), _digests(columns), bits, step)


def _tree(rows: DataFrame, leaf: Column, digests: list[Column], bits: int, step: int) -> DataFrame:
    leaves = rows.groupBy(leaf.alias("prefix")).agg(*digests)
    depths = list(range(0, bits, step)) + [bits]
    levels = F.explode(F.array(*[F.struct(F.lit(d).alias("level"), F.shiftright("prefix", bits - d).alias("prefix")) for d in depths]))
    spread = leaves.select(levels.alias("node"), "row_count", "first", "second").select("node.*", "row_count", "first", "second")
    sums = [F.sum(c).cast(t).alias(c) for c, t in (("row_count", "bigint"), ("first", "decimal(38,0)"), ("second", "decimal(38,0)"))]
    return spread.groupBy("level", "prefix").agg(*sums)


_SAME = ("row_count", "first", "second")


def _among(rows: DataFrame, value: Column, wanted: list[int]) -> DataFrame:
    """Rows whose value is one of many: joined, where a condition of as many literals would take the driver long to put together."""
    listed = rows.sparkSession.createDataFrame([(w,) for w in wanted], "__wanted int")
    return rows.join(F.broadcast(listed), value == F.col("__wanted"), "left_semi")


def differing_leaves(source: DataFrame, target: DataFrame, bits: int = LEAF_BITS, step: int = LEVEL_BITS) -> list[int]:
    """Leaves whose digests differ, at most ``2**bits``; of each level only the children of differing prefixes are compared."""
    depths = list(range(0, bits, step)) + [bits]
    found, above = [0], 0
    for depth in depths:
        parent = F.shiftright("prefix", depth - above)
        ours, theirs = (_among(t.where(F.col("level") == depth), parent, found).drop("level") for t in (source, target))
        renamed = theirs.select(F.col("prefix").alias("__prefix"), *[F.col(c).alias(f"__{c}") for c in _SAME])
        joined = ours.join(renamed, F.col("prefix") == F.col("__prefix"), "full_outer")
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in _SAME])
        found = [r[0] for r in joined.where(~same).select(F.coalesce("prefix", "__prefix")).collect()]
        if not found:
            return []
        above = depth
    return sorted(found)


def content_differences(source: DataFrame, target: DataFrame, keys: Iterable[str], bits: int = LEAF_BITS, step: int = LEVEL_BITS) -> DataFrame:
    """Keys whose rows are ``missing`` in the target, ``extra`` there, or ``changed``, as ``kind``.

    Keys are unique in both.  The tables are read once, and their keys with two hashes a row are written to the work
    folder; trees come from those, and what lies in differing leaves is compared, hash against hash.
    """
    keys = list(keys)
    columns = [F.col(c) for c in sorted(source.columns)]
    digest = F.struct(row_hash(columns).alias("a"), _second_hash(columns).alias("b")).alias("digest")
    folder, spark = work_dir(source.sparkSession, "digests"), source.sparkSession
    sides = []
    for name, rows in (("source", source), ("target", target.select(*source.columns))):
        hashed = rows.select(*keys, digest)
        hashed.write.parquet(f"{folder}/{name}")
        sides.append(spark.read.schema(hashed.schema).parquet(f"{folder}/{name}"))
    leaf = leaf_of(keys, bits)
    trees = [_tree(t, leaf, _sums(F.col("digest.a"), F.col("digest.b")), bits, step).persist() for t in sides]
    try:
        leaves = differing_leaves(*trees, bits, step)
    finally:
        for tree in trees:
            tree.unpersist()
    ours, theirs = (_among(t, leaf, leaves) for t in sides)
    renamed = theirs.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("digest").alias("__digest"))
    joined = ours.join(renamed, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "full_outer")
    kind = F.when(F.col("__digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").when(F.col("digest") != F.col("__digest"), "changed")
    named = [F.when(F.col("digest").isNull(), F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return joined.select(*named, kind.alias("kind")).where(F.col("kind").isNotNull())


def content_checksums(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and an order-free checksum of all columns per table: the root of its tree."""
    parts = []
    for name, df in tables.items():
        root = df.agg(*_digests([F.col(c) for c in sorted(df.columns) if c not in META]))
        parts.append(root.select(F.lit(name).alias("table"), "row_count", F.concat_ws("/", "first", "second").alias("checksum")))
    return reduce(DataFrame.unionByName, parts)


def collected_checksums(tables: Mapping[str, Callable[[Column], DataFrame]], keys: Mapping[str, Iterable[str]], parts: int = PARTS) -> DataFrame:
    """``content_checksums``, worked out now, one table after another and each in ``parts`` by a hash of its keys.

    A table gives its rows under a condition on its keys; digests add up, so the parts are the whole.  What a part shuffles is
    gone before the next begins.
    """
    found = []
    for name, rows in tables.items():
        part = F.pmod(row_hash(F.col(k) for k in keys[name]), F.lit(parts))
        sums = [0, 0, 0]
        for n in range(parts):
            df = rows(part == n)
            with shuffles_cleared(df.sparkSession):
                row = df.agg(*_digests([F.col(c) for c in sorted(df.columns) if c not in META])).first()
            sums = [a + int(b) for a, b in zip(sums, row, strict=True)]
        found.append((name, sums[0], f"{sums[1]}/{sums[2]}"))
    return df.sparkSession.createDataFrame(found, "table string, row_count bigint, checksum string")

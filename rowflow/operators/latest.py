"""From row changes to current rows.

A change frame has the table's columns plus ``op`` and ``seq``; a delete carries at
least the key.  Duplicates, late rows and replays need no special treatment: the
result depends only on the set of changes, not on their order or number.  ``seq`` orders
the changes of a key; changes with the same key and ``seq`` are copies of one change.

Select the columns you need *before* reducing: the winning row is moved as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

META = ("op", "seq")


def latest_by_key(changes: DataFrame, keys: Iterable[str], seq: str = "seq") -> DataFrame:
    """The change with the highest ``seq`` of every key, whole row.

    Should copies differ against the rule, a row beats a delete and then the greater row
    wins, so a retried task cannot choose otherwise.  The maximum is combined on the map side: however often one
    key changes, each task ships a single row for it.
    """
    keys = list(keys)
    rest = [c for c in changes.columns if c not in keys and c != seq]
    newest = F.max(F.struct(seq, (F.col("op") != "d").alias("__exists"), *rest)).alias("newest")
    return (
        changes.groupBy(*keys)
        .agg(newest)
        .select(*[F.col(c) if c in keys else F.col(f"newest.{c}").alias(c) for c in changes.columns])
    )


def live_keys(changes: DataFrame, keys: Iterable[str], seq: str = "seq") -> DataFrame:
    """Keys that exist after all changes, for counts and reference checks.

    Two numbers per key decide, so this hashes where whole rows would have to be sorted.
    """
    keys = list(keys)
    deleted = F.col("op") == "d"
    ends = changes.groupBy(*keys).agg(
        F.max(F.when(~deleted, F.col(seq))).alias("__put"), F.max(F.when(deleted, F.col(seq))).alias("__gone")
    )
    alive = F.col("__put").isNotNull() & (F.col("__gone").isNull() | (F.col("__put") >= F.col("__gone")))
    return ends.where(alive).select(*keys)


def drop_tombstones(newest: DataFrame) -> DataFrame:
    """Rows that still exist, without the change columns."""
    return newest.where(F.col("op") != "d").drop(*META)


def current_rows(changes: DataFrame, keys: Iterable[str], seq: str = "seq") -> DataFrame:
    """The table after all changes: newest image per key, deleted keys gone."""
    return drop_tombstones(latest_by_key(changes, keys, seq))


def merge_newest(stored: DataFrame, newest: DataFrame, keys: Iterable[str], null_safe: bool = False) -> DataFrame:
    """Fold one-row-per-key changes into one-row-per-key stored state; the higher ``seq`` wins.

    Both sides keep tombstones.  The stored side is only joined, never aggregated, so a
    hash-bucketed table is merged in place and only the changes are shuffled.
    """
    keys = list(keys)
    rest = [c for c in stored.columns if c not in keys]
    renamed = newest.select(*[F.col(c).alias(f"__new_{c}") for c in stored.columns])
    same = [
        F.col(k).eqNullSafe(F.col(f"__new_{k}")) if null_safe else F.col(k) == F.col(f"__new_{k}") for k in keys
    ]
    joined = stored.join(renamed, same, "full_outer")
    take_new = F.col("seq").isNull() | (F.col("__new_seq") > F.col("seq"))
    return joined.select(
        *[F.coalesce(F.col(k), F.col(f"__new_{k}")).alias(k) for k in keys],
        *[F.when(take_new, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in rest],
    ).select(*stored.columns)

"""Set-based inserts, updates and deletes that emit change events.

Events are ``op, seq, before, after`` with full row images.  ``seq`` is the commit
position of the statement, the same for all its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LOAD_TIME, NO_DEFAULT, Table
from .numbering import number_rows


def _seq(seq: int | Column) -> Column:
    return (F.lit(seq) if isinstance(seq, int) else seq).cast("bigint").alias("seq")


def _image(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


def _no_image(df: DataFrame) -> Column:
    return F.lit(None).cast(df.schema)


def insert_events(rows: DataFrame, seq: int | Column) -> DataFrame:
    """One insert per row."""
    return rows.select(F.lit("c").alias("op"), _seq(seq), _no_image(rows).alias("before"), _image(rows).alias("after"))


def update_events(
    current: DataFrame,
    where: Column,
    assign: Mapping[str, Column],
    seq: int | Column,
    touched: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Updates of the matching rows whose image changes.

    ``touched`` is the column that takes the statement time by itself; it is set on rows
    that change and is no change on its own.
    """
    types = {f.name: f.dataType for f in current.schema.fields}
    old = {c: F.col(c) for c in current.columns}
    new = old | {c: e.cast(types[c]) for c, e in assign.items()}
    changes = F.lit(False)
    for c in assign:
        changes = changes | ~new[c].eqNullSafe(old[c])
    if touched and touched not in assign:
        new[touched] = (as_of if as_of is not None else F.localtimestamp()).cast(types[touched])
    return current.where(where).where(changes).select(
        F.lit("u").alias("op"),
        _seq(seq),
        _image(current).alias("before"),
        F.struct(*[e.alias(c) for c, e in new.items()]).alias("after"),
    )


def delete_events(
    current: DataFrame, where: Column | DataFrame, seq: int | Column, on: Iterable[str] | None = None
) -> DataFrame:
    """Deletes of the rows that match a predicate, or whose ``on`` columns occur in a frame.

    The frame form is the join or subquery delete: a semi join, so a row is deleted once
    however many partners it has.
    """
    doomed = current.join(where, list(on or []), "left_semi") if isinstance(where, DataFrame) else current.where(where)
    return doomed.select(
        F.lit("d").alias("op"), _seq(seq), _image(current).alias("before"), _no_image(current).alias("after")
    )


def event_rows(events: DataFrame, keys: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Events as a change frame: ``op``, ``seq`` and the columns of the row, and ``keep`` of the event's own.

    A delete carries its key alone.  An update that moves a row to another key becomes a
    delete of the old key and an insert of the new one.
    """
    keys, keep = list(keys), list(keep)
    fields = events.schema["after"].dataType.fieldNames()
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}"))
    moved = (F.col("op") == "u") & F.col("before").isNotNull() & moved
    ops = F.when(moved, F.array(F.lit("d"), F.lit("c"))).otherwise(F.array("op"))
    parts = events.select("seq", *keep, "before", "after", F.explode(ops).alias("op"))
    gone = F.col("op") == "d"

    def value(c: str) -> Column:
        if c not in keys:
            return F.when(~gone, F.col(f"after.{c}"))
        old, new = F.col(f"before.{c}"), F.col(f"after.{c}")
        return F.when(gone, F.coalesce(old, new)).otherwise(F.coalesce(new, old))

    return parts.select("op", "seq", *keep, *[value(c).alias(c) for c in fields])


def assign_keys(rows: DataFrame, current: DataFrame, key: str, order: str) -> DataFrame:
    """Give new rows the keys after the greatest existing one, in ``order``."""
    highest = current.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("highest"))
    numbered = number_rows(rows, order, name="__rn")
    return numbered.select(
        (highest.scalar() + F.col("__rn")).alias(key), *[c for c in rows.columns if c != key]
    )


def fill_defaults(rows: DataFrame, table: Table, as_of: Column | None = None) -> DataFrame:
    """Add the columns a source omitted, with their declared defaults, in declared order.

    A default is for an omitted column only: an explicit null stays and is left to the
    contract check.
    """
    now = as_of if as_of is not None else F.localtimestamp()
    out = []
    for c in table.columns:
        if c.name in rows.columns:
            out.append(F.col(c.name).cast(c.type).alias(c.name))
        elif c.default is LOAD_TIME:
            out.append(now.cast(c.type).alias(c.name))
        elif c.default is not NO_DEFAULT:
            out.append(F.lit(c.default).cast(c.type).alias(c.name))
        elif c.name in table.key:
            continue  # assigned later
        else:
            raise ValueError(f"{table.name}.{c.name} has no default and must be given")
    return rows.select(*out)

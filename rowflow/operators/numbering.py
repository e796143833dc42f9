"""Distributed row numbers over an integer order column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Order values per range: a range is one sorted run of one task.
WIDTH = 1 << 16
# Blocks that one window may hold, and levels of runs of them: 64 bits less those of a block.
FAN_BITS = 16
LEVELS = 2


def _one(keep: Column | None) -> Column:
    return F.lit(1) if keep is None else F.when(keep, 1).otherwise(0)


def block_of(order: str, width: int) -> Column:
    """The range of ``width`` order values that a row falls in."""
    return F.call_function("div", F.col(order).cast("bigint"), F.lit(width).cast("bigint"))


def block_offsets(
    df: DataFrame, order: str, by: Iterable[str] = (), width: int = WIDTH, keep: Column | None = None
) -> DataFrame:
    """``by, __block, __rows, __offset``: the counted rows of each range, and of the group before it."""
    by = list(by)
    totals = df.groupBy(*by, block_of(order, width).alias("__block")).agg(F.sum(_one(keep)).alias("__rows"))
    return _running(totals, by, "__block", "__rows", "__offset", LEVELS)


def _running(totals: DataFrame, by: list[str], block: str, rows: str, name: str, levels: int) -> DataFrame:
    """``by, block, rows, name``: with the rows of the group in smaller blocks.

    Sparse keys make as many blocks as rows, so one window over all of them would be one task.  Blocks are
    summed in runs of 2**16 numbers, and the runs are treated alike: a window never holds more than 2**16 rows,
    at the top because no more leading bits are left.
    """
    if levels == 0:
        before = Window.partitionBy(*by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(*by, block, rows, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(name))
    run, own = f"{block}_", f"{name}_"
    parts = totals.withColumn(run, F.shiftright(block, FAN_BITS))
    above = _running(parts.groupBy(*by, run).agg(F.sum(rows).alias(rows)), by, run, rows, own, levels - 1)
    before = Window.partitionBy(*by, run).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    inside = parts.withColumn(name, F.coalesce(F.sum(rows).over(before), F.lit(0)))
    joined = inside.alias("inside").join(above.alias("above"), [F.col(f"inside.{c}").eqNullSafe(F.col(f"above.{c}")) for c in [*by, run]])
    return joined.select(*[F.col(f"inside.{c}").alias(c) for c in [*by, block, rows]], (F.col(f"inside.{name}") + F.col(f"above.{own}")).alias(name))


def number_rows(
    df: DataFrame,
    order: str,
    by: Iterable[str] = (),
    name: str = "rn",
    width: int = WIDTH,
    keep: Column | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, 3, … in ``order`` within ``by``.

    A plain window would sort a whole group in one task.  Here the order column is cut
    into ranges of ``width`` values: rows are numbered inside their range, and the counts
    of the ranges, one small row each, give every range its offset.  ``order`` must be a
    whole number that is unique within ``by`` (a sequence or a key).

    With ``keep`` only matching rows are counted; the others get the number of the last
    counted row before them, or 0.
    """
    by = list(by)
    offsets = block_offsets(df, order, by, width, keep) if offsets is None else offsets
    inside = (
        Window.partitionBy(*by, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    blocks = df.withColumn("__block", block_of(order, width))
    numbered = blocks.withColumn("__inner", F.sum(_one(keep)).over(inside))
    return numbered.join(offsets, [*by, "__block"]).select(
        *df.columns, (F.col("__offset") + F.col("__inner")).cast("bigint").alias(name)
    )

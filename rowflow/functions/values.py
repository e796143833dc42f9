"""Money, elapsed time and reproducible draws, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, precision: int = 12) -> Column:
    """Exact amount with two decimals, halves away from zero."""
    return value.cast(f"decimal({precision},2)")


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Quantity times unit price, exact to the cent."""
    return money(quantity.cast("decimal(10,0)") * money(unit_price, 10))


def elapsed_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between two zoneless timestamps, whatever the session's zone."""
    gap = end - start  # an interval: no zone takes part
    minutes = (F.extract(F.lit("DAY"), gap) * 24 + F.extract(F.lit("HOUR"), gap)) * 60 + F.extract(F.lit("MINUTE"), gap)
    return minutes.cast("bigint") * 60000 + F.floor(F.extract(F.lit("SECOND"), gap) * 1000).cast("bigint")


def draw(row: Column, salt: str, bound: int) -> Column:
    """A whole number in ``[0, bound)`` that depends on the row number and the salt alone.

    Unlike ``rand`` it gives the same rows under any partitioning, so a lost task that
    is run again regenerates exactly what it produced before.
    """
    digest = F.md5(F.concat(F.lit(salt + ":"), row.cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return number % F.lit(bound).cast("bigint")


def draw_letters(row: Column, salt: str, length: int) -> Column:
    """Up to 32 lower-case letters drawn like :func:`draw`."""
    digest = F.md5(F.concat(F.lit(salt + ":"), row.cast("string")))
    return F.translate(F.substring(digest, 1, length), "0123456789", "ghijklmnop")


def pick(words: list[str], index: Column) -> Column:
    """The word at a zero-based position."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index + 1).cast("int"))

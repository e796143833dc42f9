"""Joins of rows with hot keys to a frame that has every key once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least this share of the rows; so there are at most 200.
HOT_SHARE = 0.005


def hot_keys(rows: DataFrame, column: str, share: float = HOT_SHARE) -> list:
    """Keys that hold at least ``share`` of the rows, at most ``1 / share`` of them.

    One pass over the key column with a heavy-hitter sketch that is merged on the way.  The
    sketch's error is far below the share; a key it judged wrongly would only be joined the
    other way, with the same result.
    """
    k = int(1 / share)
    sketch = F.call_function("approx_top_k", F.col(column), F.lit(k), F.lit(16 * k))
    top = rows.agg(sketch.alias("top"), F.count(column).alias("n")).first()
    return [item["item"] for item in top["top"] or [] if item["item"] is not None and item["count"] >= share * top["n"]]


def join_to_unique(rows: DataFrame, unique: DataFrame, column: str, how: str, hot: list | None = None) -> DataFrame:
    """``rows.join(unique, column, how)`` that no single key can slow down.

    Adaptive execution splits a hot partition only where both sides come straight from a
    shuffle, which an aggregated side does not.  Here the rows of hot keys stay where they
    are: ``unique`` has one row for each of these few keys, and that is broadcast.  All
    other rows are joined as usual.  ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how!r} cannot be split by the left side's keys")
    hot = hot_keys(rows, column) if hot is None else hot
    if not hot:
        return rows.join(unique, column, how)
    is_hot = F.coalesce(F.col(column).isin(hot), F.lit(False))
    at_home = rows.where(is_hot).join(F.broadcast(unique.where(is_hot)), column, how)
    return at_home.unionByName(rows.where(~is_hot).join(unique.where(~is_hot), column, how))

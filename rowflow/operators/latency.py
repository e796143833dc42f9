"""Probe latencies and their statistics.

Latencies are whole milliseconds and a failed probe is -1.  All of them lie below the
probe timeout, which bounds the number of distinct values, however many probes there are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import check_status, elapsed_ms, latency_color, latency_label, latency_status
from ..functions.labels import PROBE_TIMEOUT
from ..schemas import TABLES
from .numbering import block_of, block_offsets, number_rows

# Fixed value: probes kept per table.
HISTORY = 100


def probe_latency(probes: DataFrame, observed: DataFrame, timeout_ms: int = PROBE_TIMEOUT) -> DataFrame:
    """Probes ``probe_seq, table, marker, insert_ts`` with the time until their marker was visible.

    The first sighting counts.  A marker that never showed, or not in time, is a failure; one that was seen before
    its insert (clocks that differ) counts as visible at once.
    """
    first = observed.groupBy("table", "marker").agg(F.min("visible_ts").alias("visible_ts"))
    elapsed = elapsed_ms(F.col("insert_ts"), F.col("visible_ts"))
    waited = F.when(elapsed < 0, 0).otherwise(elapsed)
    joined = probes.join(first, ["table", "marker"], "left").withColumn("__waited", waited)
    in_time = F.coalesce(F.col("__waited") < timeout_ms, F.lit(False))
    return joined.select(
        "probe_seq",
        "table",
        "marker",
        F.when(in_time, F.col("__waited")).otherwise(F.lit(-1)).cast("bigint").alias("latency_ms"),
        in_time.alias("success"),
    )


def last_n(probes: DataFrame, n: int = HISTORY) -> DataFrame:
    """The newest ``n`` successful probes of each table: the history every statistic is over.

    Each task keeps its own newest ``n`` before anything is shuffled.
    """
    newest = Window.partitionBy("table").orderBy(F.col("probe_seq").desc())
    kept = probes.where(F.col("latency_ms") >= 0).withColumn("__rn", F.row_number().over(newest))
    return kept.where(F.col("__rn") <= n).drop("__rn")


def _rank(count: Column, percent: int) -> Column:
    """One-based rank of the floor-rank percentile: zero-based index ``min(n*p, n-1)``."""
    index = F.call_function("div", count * F.lit(percent), F.lit(100).cast("bigint"))
    return F.least(index, count - 1) + 1


def value_stats(values: DataFrame, value: str, percents: Iterable[int], by: Iterable[str] = ()) -> DataFrame:
    """Exact ``n, avg_ms, min_ms, max_ms`` and floor-rank percentiles of a whole-number column.

    Equal values are counted first, on the map side.  The sorted part then holds one row per
    distinct value, which the probe timeout bounds, and not one per measurement; a table with
    most of the probes costs no more than the others.
    """
    by = list(by)
    return counted_stats(values.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n")), value, percents, by)


def counted_stats(counts: DataFrame, value: str, percents: Iterable[int], by: Iterable[str] = ()) -> DataFrame:
    """The same of values that come once each with how often there are, ``n``."""
    by, percents = list(by), list(percents)
    counted = counts.select(*by, F.col(value).alias("__v"), F.col("n").alias("__n"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumns({"__upto": F.sum("__n").over(upto), "__all": F.sum("__n").over(group)})
    total = F.sum("__n")
    return ranked.groupBy(*by).agg(
        total.alias("n"),
        (F.sum(F.col("__v") * F.col("__n")).cast("double") / total.cast("double")).alias("avg_ms"),
        F.min("__v").alias("min_ms"),
        F.max("__v").alias("max_ms"),
        *[F.min(F.when(F.col("__upto") >= _rank(F.col("__all"), p), F.col("__v"))).alias(f"p{p}_ms") for p in percents],
    )


def _each_table(probes: DataFrame, tables: Iterable[str]) -> DataFrame:
    return probes.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table"))


def latency_stats(probes: DataFrame, tables: Iterable[str] = tuple(TABLES), percents: Iterable[int] = (95, 99)) -> DataFrame:
    """Statistics per table, all 0 for a table without values.

    Failures (-1) are left out.  Pass ``last_n(...)`` for the bounded history.
    """
    counts = probes.where(F.col("latency_ms") >= 0).groupBy("table", "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    return stats_of_counts(counts, tables, percents)


def stats_of_counts(counts: DataFrame, tables: Iterable[str] = tuple(TABLES), percents: Iterable[int] = (95, 99)) -> DataFrame:
    """The same from a histogram ``table, latency_ms, n``."""
    stats = counted_stats(counts.where(F.col("latency_ms") >= 0), "latency_ms", percents, ["table"])
    return _each_table(counts, tables).join(stats, "table", "left").fillna(0)


def latency_overall(probes: DataFrame, percents: Iterable[int] = (95,)) -> DataFrame:
    """One row over all tables together; all 0 without values."""
    stats = value_stats(probes.where(F.col("latency_ms") >= 0), "latency_ms", percents)
    return stats.fillna(0)


def last_latency(probes: DataFrame, tables: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """Latency of the newest probe per table: -1 after a failure, 0 before any probe."""
    return last_of(probes.groupBy("table").agg(F.max_by("latency_ms", "probe_seq").alias("last_ms")), tables)


def last_of(newest: DataFrame, tables: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """The same from the newest latency ``table, last_ms`` of the tables that were probed."""
    known = newest.select("table", F.col("last_ms").alias("__last"))
    return _each_table(newest, tables).join(known, "table", "left").select(
        "table", F.coalesce(F.col("__last"), F.lit(0)).cast("bigint").alias("last_ms")
    )


def running_stats(probes: DataFrame, n: int = HISTORY, width: int = 1 << 14) -> DataFrame:
    """Average and p95 of the table's last ``n`` successes, after every single probe.

    One table may hold most of the probes, so its probes are not put in one window.  They
    are cut into ranges of ``width`` probe numbers, and each range is given the ``n``
    successes before it as context; successes are found by their number, so a long run of
    failures needs nothing special.
    """
    good = F.col("latency_ms") >= 0
    rows, by = probes.select("probe_seq", "table", "latency_ms"), ["table"]
    starts = block_offsets(rows, "probe_seq", by, width, good)
    numbered = number_rows(rows, "probe_seq", by, "__k", width, good, starts)
    own = numbered.withColumns({"__block": block_of("probe_seq", width), "__own": F.lit(True)})
    before = F.col("__offset")
    wanted = starts.where(before > 0).select(
        "table", "__block", F.explode(F.sequence(F.greatest(before - (n - 1), F.lit(1)), before)).alias("__k")
    )
    # Only the last n successes of a range can be context of another: all others stay where they are.
    ends = starts.select("table", "__block", (before + F.col("__rows")).alias("__end"))
    placed = numbered.where(good).withColumn("__block", block_of("probe_seq", width)).join(ends, ["table", "__block"])
    late = placed.where(F.col("__k") > F.col("__end") - n).drop("__block", "__end")
    context = wanted.join(late, ["table", "__k"]).withColumn("__own", F.lit(False))
    # A failure has the number of the success before it, so the frame counts numbers, not rows.
    frame = Window.partitionBy("table", "__block").orderBy("__k").rangeBetween(-(n - 1), 0)
    value = F.when(good, F.col("latency_ms"))
    with_history = (
        own.unionByName(context)
        .withColumns(
            {
                "n": F.count(value).over(frame),
                "__sum": F.sum(value).over(frame),
                "__sorted": F.sort_array(F.collect_list(value).over(frame)),
            }
        )
        .where("__own")
    )
    some = F.col("n") > 0
    return with_history.select(
        "probe_seq",
        "table",
        F.col("latency_ms").alias("last_ms"),
        F.col("n"),
        F.when(some, F.col("__sum").cast("double") / F.col("n").cast("double")).otherwise(F.lit(0.0)).alias("avg_ms"),
        F.when(some, F.try_element_at("__sorted", _rank(F.col("n"), 95).cast("int")))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("p95_ms"),
    )


def probe_success(probes: DataFrame) -> DataFrame:
    """Totals of all probes and the success rate in percent, 0 when there were none."""
    return counted_success(probes.groupBy("latency_ms").agg(F.count(F.lit(1)).alias("n")))


def counted_success(counts: DataFrame) -> DataFrame:
    """The same from a histogram ``latency_ms, n``."""

    def of(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).cast("bigint")

    total, good = of(F.lit(True)), of(F.col("latency_ms") >= 0)
    return counts.agg(
        total.alias("total_probes"),
        good.alias("successful_probes"),
        of(F.col("latency_ms") < 0).alias("failed_probes"),
        F.when(total > 0, good / F.nullif(total, F.lit(0)) * 100).otherwise(F.lit(0.0)).alias("success_rate"),
    )


def labelled(latencies: DataFrame, ms: str = "latency_ms") -> DataFrame:
    """Add every label and band of a latency column."""
    col = F.col(ms)
    return latencies.withColumns(
        {
            "latency_label": latency_label(col),
            "latency_color": latency_color(col),
            "latency_status": latency_status(col),
            "check_status": check_status(col),
        }
    )

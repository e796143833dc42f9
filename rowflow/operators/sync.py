"""Row counts, lag and verdicts of source against target, and load reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import elapsed_ms, lag_label


def table_counts(tables: Mapping[str, DataFrame | None], name: str = "row_count") -> DataFrame:
    """One row per table.  A table that cannot be read (``None``) has a null count."""
    spark = next((df.sparkSession for df in tables.values() if df is not None), None) or SparkSession.active()
    parts = []
    for table, df in tables.items():
        if df is None:
            part = spark.range(1).select(F.lit(None).cast("bigint").alias(name))
        else:
            part = df.agg(F.count(F.lit(1)).alias(name))
        parts.append(part.select(F.lit(table).alias("table"), name))
    return reduce(DataFrame.unionByName, parts)


def sync_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target counts side by side: ``lag``, its label, and a status per table.

    An unknown count makes the status UNKNOWN instead of passing for synced.
    """
    counts = source.select("table", F.col("row_count").alias("source_count")).join(
        target.select("table", F.col("row_count").alias("target_count")), "table", "full_outer"
    )
    lag = F.col("source_count") - F.col("target_count")
    return counts.select(
        "table",
        "source_count",
        "target_count",
        lag.alias("lag"),
        lag_label(lag).alias("lag_label"),
        F.when(lag.isNull(), "UNKNOWN").when(lag == 0, "SYNCED").otherwise("LAGGING").alias("status"),
    )


def sync_verdict(report: DataFrame, mode: str = "exact") -> DataFrame:
    """One row for all tables: ``synced`` and the total of absolute lags.

    ``exact`` wants every lag to be zero, ``at_least`` is content when no target is behind.
    Any unknown count makes ``synced`` null.
    """
    if mode not in ("exact", "at_least"):
        raise ValueError(f"unknown mode {mode!r}")
    fine = F.col("lag") == 0 if mode == "exact" else F.col("lag") <= 0
    total = F.sum(F.abs("lag")).cast("bigint")
    return report.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("lag").isNull()).alias("unknown"),
        F.when(F.count_if(F.col("lag").isNull()) > 0, F.lit(None)).otherwise(F.bool_and(fine)).alias("synced"),
        total.alias("total_lag"),
    ).withColumn(
        "verdict",
        F.when(F.col("synced").isNull(), "UNKNOWN")
        .when(F.col("synced"), "ALL SYNCED")
        .otherwise(F.concat(F.lit("TOTAL LAG: "), F.col("total_lag").cast("string"))),
    )


def load_summary(results: DataFrame) -> DataFrame:
    """Inserts and errors per table of ``table, latency_ms, ok, ts`` rows, and a TOTAL row."""
    counts = (F.count_if("ok").alias("inserts"), F.count_if(~F.col("ok")).alias("errors"))
    per_table = results.groupBy("table").agg(*counts)
    total = per_table.agg(F.sum("inserts").alias("inserts"), F.sum("errors").alias("errors"))
    return per_table.unionByName(
        total.select(F.lit("TOTAL").alias("table"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("inserts", "errors")])
    )


def throughput(results: DataFrame) -> DataFrame:
    """Inserts per second over the time between the first and last row of each table.

    ``per_sec`` is the plain quotient and ``per_sec_cut`` the same cut to two decimals from
    whole milliseconds; both are 0 where no time passed.
    """
    span = results.groupBy("table").agg(
        F.count_if("ok").alias("inserts"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    ms = elapsed_ms(F.col("first_ts"), F.col("last_ts"))
    timed = span.select("table", "inserts", ms.alias("duration_ms"))
    inserts, duration = F.col("inserts"), F.nullif(F.col("duration_ms"), F.lit(0))
    cut = F.call_function("div", inserts * F.lit(100000).cast("bigint"), duration).cast("decimal(18,0)") / 100
    return timed.select(
        "table",
        "inserts",
        "duration_ms",
        F.coalesce(inserts * 1000 / duration, F.lit(0.0)).alias("per_sec"),
        F.coalesce(cut.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("per_sec_cut"),
    )

"""Monitoring reports put together from counts and probes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import check_status, latency_label, latency_status
from ..operators.latency import last_latency, last_n, latency_stats, probe_success
from ..operators.sync import sync_report
from ..schemas import TABLES


def monitor_report(
    source: DataFrame, target: DataFrame, probes: DataFrame, tables: Iterable[str] = tuple(TABLES)
) -> DataFrame:
    """One row per table: counts, lag, newest latency with its label and status, history average and p95.

    A table that was never probed has no status.
    """
    counts = sync_report(source, target)
    stats = latency_stats(last_n(probes), tables, (95,))
    newest = last_latency(probes, tables)
    last = F.col("last_ms")
    return (
        counts.join(newest, "table", "left")
        .join(stats, "table", "left")
        .select(
            "table",
            "source_count",
            "target_count",
            "lag",
            last.alias("last_latency_ms"),
            F.col("avg_ms").alias("avg_latency_ms"),
            F.col("p95_ms").alias("p95_latency_ms"),
            latency_label(last).alias("latency_label"),
            F.when(last != 0, latency_status(last)).alias("status"),
        )
    )


def check_report(source: DataFrame, target: DataFrame, probes: DataFrame) -> DataFrame:
    """One row per probed table: its newest latency, counts, lag and the verdict of the check."""
    newest = probes.groupBy("table").agg(F.max_by("latency_ms", "probe_seq").alias("latency_ms"))
    counts = sync_report(source, target).select("table", "source_count", "target_count", "lag")
    return newest.join(counts, "table").withColumn("status", check_status(F.col("latency_ms")))


def monitor_json(report: DataFrame, probes: DataFrame, as_of: Column) -> DataFrame:
    """The monitor report as a single JSON document with the probe totals; one entry per table."""
    entry = F.struct(
        "source_count", "target_count", "lag", "last_latency_ms", "avg_latency_ms", "p95_latency_ms"
    )
    tables = F.map_from_entries(F.array_sort(F.collect_list(F.struct("table", entry.alias("entry")))))
    totals = probe_success(probes).drop("success_rate")
    document = totals.withColumn("tables", report.agg(tables.alias("tables")).scalar())
    stamp = F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    return document.select(
        F.to_json(F.struct(stamp, "total_probes", "successful_probes", "failed_probes", "tables")).alias("document")
    )

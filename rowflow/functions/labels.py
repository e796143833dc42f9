"""Labels and bands for latencies and lags, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds in milliseconds.
LATENCY_OK = 2000
LATENCY_WARN = 5000
LATENCY_CRITICAL = 10000
PROBE_TIMEOUT = 30000


def latency_label(ms: Column) -> Column:
    """``TIMEOUT`` below zero, whole milliseconds below a second, else seconds with two decimals.

    Halves round up on the exact decimal, for whole and fractional milliseconds alike.
    """
    exact = ms.cast("decimal(24,6)")
    whole = F.concat(F.round(exact, 0).cast("decimal(20,0)").cast("string"), F.lit("ms"))
    seconds = F.concat((exact / 1000).cast("decimal(20,2)").cast("string"), F.lit("s"))
    return F.when(ms < 0, "TIMEOUT").when(ms < 1000, whole).otherwise(seconds)


def latency_color(ms: Column) -> Column:
    """Traffic light of one latency; a failure is red."""
    return (
        F.when(ms < 0, "red").when(ms < LATENCY_OK, "green").when(ms < LATENCY_WARN, "yellow").otherwise("red")
    )


def latency_status(ms: Column) -> Column:
    """Log status: CRIT for failures and slow probes, OK when measured and fast, else WARN."""
    return (
        F.when((ms < 0) | (ms >= LATENCY_CRITICAL), "CRIT")
        .when((ms > 0) & (ms < LATENCY_WARN), "OK")
        .otherwise("WARN")
    )


def check_status(ms: Column) -> Column:
    """Verdict of a one-shot check; zero or negative means nothing was measured."""
    return F.when(ms.isNull() | (ms <= 0), "FAIL").when(ms < LATENCY_WARN, "OK").otherwise("WARN")


def lag_label(lag: Column) -> Column:
    """``0``, or the lag with its sign."""
    return F.when(lag > 0, F.concat(F.lit("+"), lag.cast("string"))).otherwise(lag.cast("string"))

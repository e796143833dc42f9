"""Statistics that follow the probes batch by batch, against the same over all probes at once."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowflow.operators import latency
from rowflow.sources.changes import change_envelopes, read_changes
from rowflow.streaming.probes import ProbeStatistics
from rowflow.streaming.replicate import Upkeep, observed_markers, run_available
from rowflow.streaming.store import KeyedTable

COLUMNS = "table string, marker string, probe_seq long, latency_ms long"
NAMES = ["orders", "customers", "products"]


def rows(df):
    return sorted(map(tuple, df.collect()))


def same(kept, probes):
    assert rows(kept.stats(NAMES)) == rows(latency.latency_stats(probes, NAMES))
    recent = latency.last_n(probes, kept.keep).select("probe_seq", "table", "latency_ms")
    assert rows(kept.recent()) == rows(recent)
    assert rows(kept.last(NAMES)) == rows(latency.last_latency(probes, NAMES))
    assert rows(kept.success()) == rows(latency.probe_success(probes))


def test_statistics_follow_the_batches(spark, root):
    draw = random.Random(5)
    made = [("orders" if k % 3 else "customers", f"m{k}", k, draw.choice([-1, 3, 40, 40, 700, 29_999])) for k in range(90)]
    late = made[40:60]  # arrives last, below what is there
    batches = [made[:40], made[60:], late + made[:5]]
    kept = ProbeStatistics(spark, root, keep=7, buckets=4).create()
    for number, batch in enumerate(batches):
        frame = spark.createDataFrame(batch + batch[:3], COLUMNS)
        kept.take(frame, number)
        if number == 1:
            kept.fold()
            kept.take(frame, number)  # delivered again, after the log was folded
    same(kept, spark.createDataFrame(made, COLUMNS))
    kept.compact()
    again = ProbeStatistics(spark, root, keep=7, buckets=4)
    same(again, spark.createDataFrame(made, COLUMNS))
    assert again.history.current().groupBy("table").count().agg(F.max("count")).first()[0] == 7


def test_a_batch_that_died_counts_once(spark, root, monkeypatch):
    kept = ProbeStatistics(spark, root, keep=3, buckets=4).create()
    first = spark.createDataFrame([("orders", "a", 1, 5), ("orders", "b", 2, 9)], COLUMNS)
    second = spark.createDataFrame([("orders", "b", 3, 1), ("orders", "c", 4, 7), ("orders", None, 5, None)], COLUMNS)
    kept.take(first, 0)
    with monkeypatch.context() as m:
        m.setattr(ProbeStatistics, "_add_history", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.take(second, 1)
    kept.take(second, 1)
    known = [("orders", "a", 1, 5), ("orders", "b", 2, 9), ("orders", "c", 4, 7), ("orders", None, 5, -1)]
    same(kept, spark.createDataFrame(known, COLUMNS))


def test_waits_of_a_running_job(spark, root):
    """From commit to visible: a steady feed, rows that are no probes, updates that show a marker again."""
    row = T.StructType().add("k", "long").add("v", "string")
    table = KeyedTable(spark, f"{root}/target", "orders", row, ["k"])
    for part in range(2):
        changes = [("c", 10 * part + i, 10 * part + i, f"latency_test_{part}_{i}" if i % 2 else "x") for i in range(6)]
        changes += [("u", 10 * part + 9, 1, "latency_test_0_1")]
        commit = F.when(F.col("seq") != 13, F.localtimestamp() - F.make_dt_interval(secs=F.when(F.col("seq") == 15, 7200).otherwise(1)))
        df = spark.createDataFrame(changes, "op string, seq long, k long, v string")
        change_envelopes(df, "orders", ["k"], commit).coalesce(1).write.mode("append").parquet(f"{root}/feed")
    kept = ProbeStatistics(spark, f"{root}/state", timeout_ms=3_600_000, buckets=4)
    probe = {"orders": ("v", F.col("v").like("latency_test_%"))}
    feed = read_changes(spark, f"{root}/feed", max_files=1)
    run_available(feed, {"orders": table}, root, markers=probe, statistics=kept, upkeep=Upkeep(fold_every=2))
    waits = kept.probes.current()
    assert waits.count() == 6 == waits.select("marker").distinct().count()
    failed = waits.where("latency_ms < 0").select("probe_seq")
    assert rows(failed) == [(13,), (15,)]  # no commit time, and later than the timeout
    assert waits.where("latency_ms >= 0").agg(F.min("latency_ms")).first()[0] >= 1000
    same(kept, waits.select("table", "marker", "probe_seq", "latency_ms"))
    assert observed_markers(spark, f"{root}/replicate-all").select("marker").distinct().count() == 6

"""Percentiles, history, running statistics and labels against plain Python."""

import random
from collections import deque
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowflow.functions import check_status, lag_label, latency_color, latency_label, latency_status
from rowflow.operators import latency, sync
from rowflow.operators.numbering import FAN_BITS, LEVELS, block_offsets, number_rows

SCHEMA = "probe_seq long, table string, latency_ms long"


def p(values, share):
    values = sorted(values)
    return values[min(int(len(values) * share), len(values) - 1)]


@pytest.mark.parametrize("n", [1, 2, 19, 20, 99, 100, 101, 777])
def test_floor_rank(spark, n):
    rng = random.Random(n)
    values = [rng.randint(0, 300) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "latency_ms long")
    row = latency.value_stats(df, "latency_ms", (95, 99)).first()
    assert (row.p95_ms, row.p99_ms) == (p(values, 0.95), p(values, 0.99))
    assert (row.n, row.min_ms, row.max_ms, row.avg_ms) == (n, min(values), max(values), sum(values) / n)


def probes(spark, rng, n, tables, fail):
    rows, at = [], 0
    for _ in range(n):
        at += rng.randint(1, 3)
        rows.append((at, rng.choice(tables), -1 if rng.random() < fail else rng.randint(0, 29999)))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def replay(rows):
    """The history kept probe by probe."""
    history, out = {}, {}
    for seq, table, ms in sorted(rows):
        kept = history.setdefault(table, deque(maxlen=100))
        if ms >= 0:
            kept.append(ms)
        out[seq] = (table, ms, len(kept), sum(kept) / len(kept) if kept else 0.0, p(kept, 0.95) if kept else 0)
    return out


@pytest.mark.parametrize("width,fail", [(50, 0.1), (130, 0.5), (40, 0.9), (1 << 14, 0.2)])
def test_running_stats(spark, width, fail):
    rng = random.Random(width)
    # One table has most of the probes, and one run fails for many ranges in a row.
    rows, _ = probes(spark, rng, 900, ["hot"] * 8 + ["cold"], fail)
    rows += [(5000 + i, "hot", -1) for i in range(400)] + [(6000 + i, "hot", i) for i in range(30)]
    got = latency.running_stats(spark.createDataFrame(rows, SCHEMA).repartition(4), width=width).collect()
    assert {r.probe_seq: (r.table, r.last_ms, r.n, r.avg_ms, r.p95_ms) for r in got} == replay(rows)
    assert len(got) == len(rows)


def test_history_stats_and_last(spark):
    rows, df = probes(spark, random.Random(3), 1500, ["orders", "orders", "orders", "customers"], 0.2)
    final = {}
    for seq, (table, ms, n, avg, p95) in sorted(replay(rows).items()):
        final[table] = (n, avg, p95, ms)
    stats = {r.table: r for r in latency.latency_stats(latency.last_n(df)).collect()}
    assert set(stats) == {"orders", "customers", "products", "order_items", "inventory_movements"}
    last = {r.table: r.last_ms for r in latency.last_latency(df).collect()}
    for table, (n, avg, p95, ms) in final.items():
        assert (stats[table].n, stats[table].avg_ms, stats[table].p95_ms, last[table]) == (n, avg, p95, ms)
    assert stats["products"].asDict() == {
        "table": "products", "n": 0, "avg_ms": 0.0, "min_ms": 0, "max_ms": 0, "p95_ms": 0, "p99_ms": 0
    }
    assert last["products"] == 0


def test_nothing_measured(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert latency.latency_overall(empty).first().asDict() == {
        "n": 0, "avg_ms": 0.0, "min_ms": 0, "max_ms": 0, "p95_ms": 0
    }
    assert latency.probe_success(empty).first().success_rate == 0.0
    assert latency.running_stats(empty).count() == 0


def test_probe_join(spark):
    probe = spark.sql(
        """select * from values (1L, 'orders', 'a', timestamp_ntz'2024-03-10 01:59:59.5'),
        (2L, 'orders', 'b', timestamp_ntz'2024-03-10 02:00:00'), (3L, 'orders', 'c', timestamp_ntz'2024-03-10 02:00:00'),
        (4L, 'customers', 'a', timestamp_ntz'2024-03-10 02:00:00') as t(probe_seq, table, marker, insert_ts)"""
    )
    seen = spark.sql(
        """select * from values ('orders', 'a', timestamp_ntz'2024-03-10 03:00:00'),
        ('orders', 'a', timestamp_ntz'2024-03-10 02:00:01'), ('orders', 'b', timestamp_ntz'2024-03-10 02:00:30')
        as t(table, marker, visible_ts)"""
    )
    want = {1: (1500, True), 2: (-1, False), 3: (-1, False), 4: (-1, False)}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):  # the clock change of that night must not matter
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = latency.probe_latency(probe, seen).collect()
            assert {r.probe_seq: (r.latency_ms, r.success) for r in got} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_labels(spark):
    values = [-1, 0, 1, 999, 1000, 1004, 1005, 1999, 2000, 4999, 5000, 9999, 10000, 123456]
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    col = F.col("ms")
    rows = df.select(
        "ms",
        latency_label(col).alias("label"),
        latency_color(col).alias("color"),
        latency_status(col).alias("status"),
        check_status(col).alias("check"),
    ).collect()
    got = {r.ms: tuple(r)[1:] for r in rows}
    assert got[-1] == ("TIMEOUT", "red", "CRIT", "FAIL")
    assert got[0] == ("0ms", "green", "WARN", "FAIL")
    assert got[999] == ("999ms", "green", "OK", "OK")
    assert got[1005] == ("1.01s", "green", "OK", "OK")
    assert got[2000] == ("2.00s", "yellow", "OK", "OK")
    assert got[5000] == ("5.00s", "red", "WARN", "WARN")
    assert got[10000] == ("10.00s", "red", "CRIT", "WARN")
    assert got[123456][0] == "123.46s"
    assert spark.range(1).select(latency_label(F.lit(999.4)), latency_label(F.lit(2.5))).first()[:] == ("999ms", "3ms")
    lags = spark.createDataFrame([(5,), (0,), (-3,)], "lag long").select(lag_label(F.col("lag"))).collect()
    assert [r[0] for r in lags] == ["+5", "0", "-3"]


def test_throughput(spark):
    rows = [("a", 10, True, "2024-01-01 00:00:00"), ("a", 10, True, "2024-01-01 00:00:03"),
            ("a", 10, False, "2024-01-01 00:00:01"), ("b", 10, True, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "table string, latency_ms long, ok boolean, ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r.table: (r.per_sec, r.per_sec_cut) for r in sync.throughput(df).collect()}
    assert got == {"a": (2000 / 3000, Decimal("0.66")), "b": (0.0, Decimal("0.00"))}
    assert {r.table: (r.inserts, r.errors) for r in sync.load_summary(df).collect()} == {
        "a": (2, 1), "b": (1, 0), "TOTAL": (3, 1)
    }


def test_numbering_over_sparse_and_negative_values(spark):
    rng = random.Random(5)
    values = rng.sample(range(-5000, 5000), 700)
    df = spark.createDataFrame([(v, "ab"[v % 2]) for v in values], "o long, g string").repartition(6)
    for width in (1, 37, 1 << 16):
        got = {(r.g, r.o): r.rn for r in number_rows(df, "o", ["g"], width=width).collect()}
        for g in "ab":
            own = sorted(v for v in values if "ab"[v % 2] == g)
            assert [got[g, v] for v in own] == list(range(1, len(own) + 1))


def test_unknown_counts_do_not_pass(spark):
    one = spark.range(3)
    source = sync.table_counts({"a": one, "b": None})
    target = sync.table_counts({"a": one, "b": one})
    report = sync.sync_report(source, target)
    assert {r.table: r.status for r in report.collect()} == {"a": "SYNCED", "b": "UNKNOWN"}
    for mode in ("exact", "at_least"):
        row = sync.sync_verdict(report, mode).first()
        assert row.synced is None and row.verdict == "UNKNOWN"


def test_verdicts_differ_when_the_target_is_ahead(spark):
    report = sync.sync_report(sync.table_counts({"a": spark.range(3)}), sync.table_counts({"a": spark.range(5)}))
    assert report.first().lag_label == "-2"
    assert sync.sync_verdict(report, "at_least").first().synced is True
    exact = sync.sync_verdict(report, "exact").first()
    assert exact.synced is False and exact.verdict == "TOTAL LAG: 2"


def test_sparse_and_negative_keys_are_numbered_by_bounded_windows(spark):
    draw = random.Random(11)
    keys = sorted({draw.randint(-(1 << 63), (1 << 63) - 1) for _ in range(3000)} | set(range(-40, 40)))
    df = spark.createDataFrame([(k,) for k in keys], "o long").repartition(5)
    assert [r.o for r in number_rows(df, "o").orderBy("rn").collect()] == keys
    assert number_rows(df, "o").agg({"rn": "max"}).first()[0] == len(keys)
    # The blocks of a window are a run of 2**16 numbers, those of the top window the leading bits that are left.
    blocks = block_offsets(df, "o").select("__block")
    assert blocks.distinct().count() > 2900
    for level in range(1, LEVELS + 1):
        run = F.shiftright("__block", FAN_BITS * level)
        inside = blocks.select(run.alias("run"), F.shiftright("__block", FAN_BITS * (level - 1)).alias("b")).distinct()
        assert inside.groupBy("run").count().agg(F.max("count")).first()[0] <= 1 << FAN_BITS
    assert blocks.select(F.shiftright("__block", FAN_BITS * LEVELS)).distinct().count() <= 1 << (48 - FAN_BITS * LEVELS)


def test_seen_before_the_insert(spark):
    probes = spark.sql("select 1L as probe_seq, 'orders' as table, 'm' as marker, timestamp_ntz'2024-01-01 00:00:01' as insert_ts")
    seen = spark.sql("select 'orders' as table, 'm' as marker, timestamp_ntz'2024-01-01 00:00:00.5' as visible_ts")
    row = latency.probe_latency(probes, seen).first()
    assert (row.latency_ms, row.success) == (0, True)

"""Replication as a stream: restart, replay, fan-out, contracts, views."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowflow.operators import latency
from rowflow.operators.digests import content_checksums
from rowflow.operators.sync import sync_verdict
from rowflow.plans.catalog import QUERIES
from rowflow.plans.views import CUSTOMER_TIERS, DAILY_ORDERS
from rowflow.schemas import CUSTOMERS, ENVELOPE, ORDERS
from rowflow.sources.changes import change_envelopes, read_changes
from rowflow.streaming.refresh import build_view, covered_until, refresh_view, view_table
from rowflow.streaming.replicate import BatchApplier, Upkeep, await_queries, batch_metrics, run_available, start
from rowflow.streaming.store import KeyedTable
from rowflow.streaming.verify import verify_sync

A = T.StructType().add("k", "long").add("v", "string")


def feed_files(spark, root, table, *batches, fmt="parquet"):
    """Each batch of (op, seq, k, v) becomes one file of envelopes."""
    for rows in batches:
        df = spark.createDataFrame(rows, "op string, seq long, k long, v string")
        commit = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        change_envelopes(df, table, ["k"], commit).coalesce(1).write.mode("append").format(fmt).save(f"{root}/feed")


def table(spark, root, name):
    return KeyedTable(spark, f"{root}/target", name, A, ["k"])


def rows(t):
    return {r.k: r.v for r in t.current().collect()}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_restart_continues_where_it_stopped(spark, root, fmt):
    tables = {"a": table(spark, root, "a")}
    feed_files(spark, root, "a", [("c", 1, 1, "x"), ("c", 2, 2, "y")], fmt=fmt)
    run_available(read_changes(spark, f"{root}/feed", fmt), tables, root)
    assert rows(tables["a"]) == {1: "x", 2: "y"}
    feed_files(spark, root, "a", [("d", 3, 1, None), ("u", 4, 2, "Y")], fmt=fmt)
    again = {"a": table(spark, root, "a")}
    run_available(read_changes(spark, f"{root}/feed", fmt), again, root)
    assert rows(again["a"]) == {2: "Y"}
    metrics = batch_metrics(again, f"{root}/replicate-all").orderBy("batch").collect()
    assert [(m.batch, m.table, m.changes, m.deletes, m.last_seq) for m in metrics] == [(0, "a", 2, 0, 2), (1, "a", 2, 1, 4)]
    assert all(m.min_ms > 0 and m.min_ms <= m.avg_ms <= m.max_ms for m in metrics)


def test_one_job_per_table_and_one_for_all_agree(spark, root):
    names = ["a", "b", "c"]
    for i, name in enumerate(names):
        feed_files(spark, root, name, [("c", n, n % 5, f"{name}{n}") for n in range(10 + i)], [("d", 99, i, None)])
    feed = lambda: read_changes(spark, f"{root}/feed", max_files=2)
    single = {n: table(spark, f"{root}/single", n) for n in names}
    each = {n: table(spark, f"{root}/each", n) for n in names}
    run_available(feed(), single, f"{root}/job1", upkeep=Upkeep(fold_every=1, compact_every=2, keep_versions=2))
    assert len(jobs := start(feed(), each, f"{root}/job2", "per_table", interval=None)) == 3
    await_queries(jobs)
    for i, n in enumerate(names):
        assert rows(single[n]) == rows(each[n]) != {}
        assert i not in rows(each[n])
    with pytest.raises(ValueError):
        start(feed(), each, root, "other")


def test_single_table_job_ignores_the_rest(spark, root):
    feed_files(spark, root, "a", [("c", 1, 1, "x")])
    feed_files(spark, root, "b", [("c", 1, 1, "x")])
    only = {"a": table(spark, root, "a")}
    run_available(read_changes(spark, f"{root}/feed"), only, root)
    assert rows(only["a"]) == {1: "x"}
    assert table(spark, root, "b").version() is None


def test_timed_flush(spark, root):
    tables = {"a": table(spark, root, "a")}
    feed_files(spark, root, "a", [("c", 1, 1, "x")])
    jobs = start(read_changes(spark, f"{root}/feed"), tables, root, interval="1 second", name="timed")
    try:
        assert [q.name for q in jobs] == ["timed-all"]
        jobs[0].processAllAvailable()
        feed_files(spark, root, "a", [("c", 2, 2, "y")])
        jobs[0].processAllAvailable()
        assert rows(tables["a"]) == {1: "x", 2: "y"}
        source = {"a": spark.range(2)}
        outcome = verify_sync(jobs, source, tables, timeout=60)
        assert outcome.synced and not outcome.timed_out and outcome.waited_ms < 30_000
        assert sync_verdict(outcome.report).first().synced
        behind = verify_sync(jobs, {"a": spark.range(5)}, tables, timeout=2)
        assert behind.synced is False and behind.timed_out and 2_000 <= behind.waited_ms < 20_000
    finally:
        jobs[0].stop()


def test_failed_batch_is_repeated_without_effect(spark, root):
    """The job dies after the first table of a batch was written; the restart completes it."""
    feed_files(spark, root, "a", [("c", 1, 1, "x"), ("u", 2, 1, "y")])
    feed_files(spark, root, "b", [("c", 1, 1, "x")])

    class Dies(KeyedTable):
        def append(self, changes, batch):
            raise RuntimeError("lost")

    broken = {"a": table(spark, root, "a"), "b": Dies(spark, f"{root}/target", "b", A, ["k"])}
    with pytest.raises(Exception):
        run_available(read_changes(spark, f"{root}/feed"), broken, root)
    assert rows(table(spark, root, "a")) == {1: "y"}
    tables = {n: table(spark, root, n) for n in "ab"}
    run_available(read_changes(spark, f"{root}/feed"), tables, root)
    assert rows(tables["a"]) == {1: "y"} and rows(tables["b"]) == {1: "x"}
    assert spark.read.parquet(f"{root}/target/a/log").count() == 2


def test_rows_that_break_the_contract_are_set_aside(spark, root):
    good = ("c", 1, 1, 7, "PENDING", "1.00", "here")
    bad = [("c", 2, 2, None, "PENDING", "1.00", "ü" * 251), ("c", 3, 3, 7, "P" * 51, "1.00", None)]
    df = spark.createDataFrame(
        [good, *bad, ("d", 4, 9, None, None, None, None)],
        "op string, seq long, order_id long, customer_id int, order_status string, total_amount string, shipping_address string",
    )
    df = df.withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)"))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    df = df.withColumns({"created_at": now, "updated_at": now})
    change_envelopes(df, "orders", ["order_id"]).write.parquet(f"{root}/feed")
    target = {"orders": KeyedTable(spark, f"{root}/target", "orders", ORDERS.struct, ORDERS.key)}
    run_available(read_changes(spark, f"{root}/feed"), target, root, contracts={"orders": ORDERS})
    assert [r.order_id for r in target["orders"].current().collect()] == [1]
    aside = spark.read.json(f"{root}/replicate-all/quarantine/orders").collect()
    assert {r.order_id: r.reasons for r in aside} == {
        2: "customer_id: null; shipping_address: longer than 500",
        3: "order_status: longer than 50",
    }


def order_changes(spark, rows):
    df = spark.createDataFrame(rows, "op string, seq long, order_id long, customer_id int, total_amount int, day int")
    day = F.to_timestamp_ntz(F.format_string("2024-01-%02d 10:00:00", "day"))
    return df.select(
        "op",
        "seq",
        "order_id",
        "customer_id",
        F.when(F.col("op") != "d", "PENDING").alias("order_status"),
        F.col("total_amount").cast("decimal(12,2)").alias("total_amount"),
        F.lit(None).cast("string").alias("shipping_address"),
        F.when(F.col("op") != "d", day).alias("created_at"),
        F.when(F.col("op") != "d", day).alias("updated_at"),
    )


def random_order_changes(rng, n, keys):
    out = []
    for seq in rng.sample(range(1, 10 * n), n):
        op = rng.choice(["c", "u", "u", "d"])
        gone = op == "d"
        out.append((op, seq, rng.randint(1, keys), None if gone else rng.randint(1, 5), None if gone else rng.randint(1, 900), 1 if gone else rng.randint(1, 6)))
    return out


def test_view_equals_recompute_after_every_batch(spark, root):
    rng = random.Random(17)
    orders = KeyedTable(spark, root, "orders", ORDERS.struct, ORDERS.key)
    orders.create(order_changes(spark, [("r", 0, k, k % 4 + 1, k, k % 6 + 1) for k in range(1, 30)]))
    stored = build_view(orders, view_table(orders, f"{root}/views", DAILY_ORDERS), DAILY_ORDERS)
    key = lambda r: (r.order_date is None, r.order_date)
    for batch in range(4):
        # Late, repeated and losing changes are all in here.
        orders.append(order_changes(spark, random_order_changes(rng, 25, 40)), batch)
        refresh_view(orders, stored, DAILY_ORDERS, None if batch == 2 else batch, batch)
        want = sorted(DAILY_ORDERS.compute(orders.current()).collect(), key=key)
        assert sorted(stored.current().collect(), key=key) == want
        if batch == 1:
            orders.compact(), stored.compact()
    orders.append(order_changes(spark, [("d", 10**6, k, None, None, 1) for k in range(1, 41)]), 9)
    refresh_view(orders, stored, DAILY_ORDERS, 9, 9)
    assert stored.current().count() == 0  # groups without rows are gone


def test_view_is_completed_when_a_batch_is_repeated(spark, root):
    """The batch was stored but the view was not refreshed when the job died."""
    orders = KeyedTable(spark, root, "orders", ORDERS.struct, ORDERS.key)
    orders.create(order_changes(spark, [("r", 0, 1, 1, 10, 1), ("r", 0, 2, 1, 20, 2)]))
    stored = build_view(orders, view_table(orders, f"{root}/views", DAILY_ORDERS), DAILY_ORDERS)
    moved = order_changes(spark, [("u", 5, 1, 1, 10, 3)])
    orders.append(moved, 0)
    applier = BatchApplier({"orders": orders}, f"{root}/job", {"orders": [(DAILY_ORDERS, stored)]})
    applier(change_envelopes(moved, "orders", ["order_id"]), 0)
    assert sorted(r.order_date.day for r in stored.current().collect()) == [2, 3]


def test_refresh_covers_several_batches(spark, root):
    rng = random.Random(23)
    orders = KeyedTable(spark, root, "orders", ORDERS.struct, ORDERS.key)
    orders.create(order_changes(spark, [("r", 0, k, 1, k, k % 6 + 1) for k in range(1, 20)]))
    stored = build_view(orders, view_table(orders, f"{root}/views", DAILY_ORDERS), DAILY_ORDERS)
    applier = BatchApplier(
        {"orders": orders}, f"{root}/job", {"orders": [(DAILY_ORDERS, stored)]}, upkeep=Upkeep(refresh_every=2, fold_every=4)
    )
    for batch in range(4):
        applier(change_envelopes(order_changes(spark, random_order_changes(rng, 6, 25)), "orders", ["order_id"]), batch)
        if batch % 2:
            assert set(stored.current().collect()) == set(DAILY_ORDERS.compute(orders.current()).collect())
    assert orders.version() == (1, 0) and applier.refreshed == {"daily_order_summary": 4}


def test_null_group_of_a_view(spark, root):
    base = dict(first_name="a", last_name="b", email="c", phone=None)
    table_ = KeyedTable(spark, root, "customers", CUSTOMERS.struct, CUSTOMERS.key)

    def change(op, seq, key, tier, spent):
        row = spark.range(1).select(
            F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"), F.lit(key).alias("customer_id"),
            *[F.lit(v).cast("string").alias(k) for k, v in base.items()],
            F.lit("2024-01-01").cast("date").alias("registration_date"), F.lit(tier).cast("string").alias("customer_tier"),
            F.lit(1).alias("total_orders"), F.lit(spent).cast("decimal(14,2)").alias("total_spent"),
            F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        )
        return row

    table_.create(change("r", 0, 1, None, 5).unionByName(change("r", 0, 2, "GOLD", 7)))
    stored = build_view(table_, view_table(table_, f"{root}/views", CUSTOMER_TIERS), CUSTOMER_TIERS)
    assert {r.customer_tier: r.customer_count for r in stored.current().collect()} == {None: 1, "GOLD": 1}
    table_.append(change("u", 1, 2, None, 7), 0)
    refresh_view(table_, stored, CUSTOMER_TIERS, 0, 0)
    assert {r.customer_tier: r.customer_count for r in stored.current().collect()} == {None: 2}


def test_envelope_shape():
    assert ENVELOPE.names == ["table", "op", "seq", "ts_commit", "before_json", "after_json"]


def test_two_settled_jobs_are_verified_long_before_the_timeout(spark, root):
    tables = {n: table(spark, root, n) for n in ("a", "b")}
    for n in tables:
        feed_files(spark, root, n, [("c", 1, 1, "x")])
    jobs = start(read_changes(spark, f"{root}/feed"), tables, root, "per_table", interval="1 second")
    try:
        for job in jobs:
            job.processAllAvailable()
        outcome = verify_sync(jobs, {n: spark.range(1) for n in tables}, tables, timeout=300)
        assert outcome.synced and outcome.waited_ms < 60_000
    finally:
        for job in jobs:
            job.stop()


def test_a_failed_job_raises(spark, root):
    class Dies(KeyedTable):
        def append(self, *args):
            raise RuntimeError("no space left")

    tables = {"a": Dies(spark, f"{root}/target", "a", A, ["k"])}
    feed_files(spark, root, "a", [("c", 1, 1, "x")])
    jobs = start(read_changes(spark, f"{root}/feed"), tables, root, interval=None)
    with pytest.raises(StreamingQueryException, match="no space left"):
        verify_sync(jobs, {"a": spark.range(1)}, tables, timeout=120)


def test_contents_are_compared_and_not_only_counts(spark):
    a, b = spark.range(10).withColumn("v", F.lit("x")), spark.range(10).withColumn("v", F.lit("y"))
    sums = {r.table: r for r in content_checksums({"a": a, "again": a.repartition(7), "b": b}).collect()}
    assert sums["a"].row_count == sums["b"].row_count == 10
    assert sums["a"].checksum == sums["again"].checksum != sums["b"].checksum


def test_broken_messages_are_set_aside(spark, root):
    tables = {"a": table(spark, root, "a")}
    good = [(k, '{"k":%d,"v":"x"}' % k, None) for k in range(3)]
    bad = [(10, "{broken", None), (11, '{"k":"abc","v":"x"}', None), (12, '{"v":"no key"}', None), (13, "[1]", None), (14, None, None)]
    rows_ = [("a", "c", n, None, before, after) for n, after, before in good + bad]
    rows_ += [("a", "d", 20, None, '{"k":0}', None), ("a", "d", 21, None, "{}", None), ("a", "x", 22, None, None, '{"k":9}')]
    df = spark.createDataFrame(rows_, "table string, op string, seq long, ts_commit string, before_json string, after_json string")
    df.withColumn("ts_commit", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{root}/feed")
    run_available(read_changes(spark, f"{root}/feed"), tables, root)
    assert rows(tables["a"]) == {1: "x", 2: "x"}
    aside = spark.read.json(f"{root}/replicate-all/unreadable/a")
    assert sorted(r.seq for r in aside.collect()) == [10, 11, 12, 13, 14, 21, 22]
    reasons = {r.seq: r.reasons for r in aside.collect()}
    assert reasons[10] == reasons[11] == reasons[13] == "after: unreadable; k: null"
    assert reasons[12] == reasons[14] == reasons[21] == "k: null" and reasons[22] == "op: unknown"
    assert {r.after_json for r in aside.collect()} >= {"{broken"}


def quiet_job(spark, root, **upkeep):
    orders = KeyedTable(spark, root, "orders", ORDERS.struct, ["order_id"]).create()
    other = table(spark, root, "a").create()
    stored = build_view(orders, view_table(orders, f"{root}/views", DAILY_ORDERS), DAILY_ORDERS)
    tables = {"orders": orders, "a": other}
    return orders, stored, BatchApplier(tables, f"{root}/job", {"orders": [(DAILY_ORDERS, stored)]}, upkeep=Upkeep(**upkeep))


def other_changes(spark, n):
    df = spark.createDataFrame([("c", n, n, "x")], "op string, seq long, k long, v string")
    return change_envelopes(df, "a", ["k"], F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


@pytest.mark.parametrize("upkeep", [{}, {"fold_every": 2}, {"compact_every": 2}])
def test_quiet_batches_leave_the_view_alone(spark, root, upkeep):
    rng = random.Random(4)
    orders, stored, applier = quiet_job(spark, root, **upkeep)
    for batch in range(7):
        if batch in (2, 5):
            changes = change_envelopes(order_changes(spark, random_order_changes(rng, 6, 12)), "orders", ["order_id"])
        else:
            changes = other_changes(spark, batch)
        applier(changes, batch)
        assert set(stored.current().collect()) == set(DAILY_ORDERS.compute(orders.current()).collect())


def test_a_restart_resumes_the_view_where_it_was(spark, root):
    rng = random.Random(5)
    orders, stored, applier = quiet_job(spark, root)
    make = lambda: change_envelopes(order_changes(spark, random_order_changes(rng, 6, 12)), "orders", ["order_id"])
    applier(make(), 0)
    again = BatchApplier({"orders": orders}, f"{root}/job", {"orders": [(DAILY_ORDERS, stored)]}, upkeep=Upkeep())
    assert covered_until(stored, again.job) == 1
    again(make(), 1)
    assert again.refreshed == {"daily_order_summary": 2}
    assert set(stored.current().collect()) == set(DAILY_ORDERS.compute(orders.current()).collect())


def test_probes_wait_from_the_write_of_the_feed(spark, monkeypatch):
    waits, probe_latency = [], latency.probe_latency

    def kept(sent, seen, timeout_ms):
        waits.extend([probe_latency(sent, seen, timeout_ms), probe_latency(sent, seen, timeout_ms=1)])
        return waits[0]

    monkeypatch.setattr(latency, "probe_latency", kept)
    shown = QUERIES["streamed_visibility"](spark, "/root/testdata/sf0.001").count()
    assert shown and waits[0].where("success and latency_ms > 0").count() == shown
    assert waits[1].where("not success and latency_ms = -1").count() == shown  # the timeout can fail a probe


def test_consumed_files_are_archived(spark, root):
    for k in range(4):
        feed_files(spark, root, "a", [("c", k, k, f"v{k}")])
    only = {"a": table(spark, root, "a")}
    run_available(read_changes(spark, f"{root}/feed", max_files=1, archive=f"{root}/archive"), only, root)
    assert rows(only["a"]) == {k: f"v{k}" for k in range(4)}
    left = spark.read.schema(ENVELOPE).parquet(f"{root}/feed").count()
    kept = spark.read.schema(ENVELOPE).option("recursiveFileLookup", True).parquet(f"{root}/archive").count()
    assert kept >= 1 and left + kept == 4


def test_a_batch_is_written_without_being_kept(spark, root, monkeypatch):
    """Nothing of a batch is cached on its way into the tables, and what cannot be read is still set aside."""
    made = []
    for name in ("a", "b"):
        df = spark.createDataFrame([("c", 1, 1, "x"), ("c", 2, 2, name), ("d", 3, 1, None)], "op string, seq long, k long, v string")
        made.append(change_envelopes(df, name, ["k"]))
    broken = spark.createDataFrame([("b", "c", 4, None, None, "{")], ENVELOPE)
    batch = made[0].unionByName(made[1]).unionByName(broken)

    def refuse(*_):
        raise AssertionError("a batch was cached")

    monkeypatch.setattr(type(batch), "persist", refuse)
    tables = {n: table(spark, root, n).create() for n in ("a", "b")}
    applier = BatchApplier(tables, f"{root}/job")
    applier(batch, 0)
    assert rows(tables["a"]) == {2: "a"} and rows(tables["b"]) == {2: "b"}
    assert [r.seq for r in spark.read.json(f"{root}/job/unreadable/b").collect()] == [4]


def test_probes_arrive_in_files_for_all_cores(spark, root, monkeypatch):
    monkeypatch.setattr("rowflow.plans.catalog.work_dir", lambda *_: root)
    probes = [(i, None, i, kind, float(i), None) for i, kind in enumerate(["click", "view"] * 40)]
    spark.createDataFrame(probes, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{root}/in/events.parquet")
    assert {r.n for r in QUERIES["steady_latency"](spark, f"{root}/in").collect() if r.table in ("orders", "customers")} == {40}
    written = spark.read.parquet(f"{root}/results").inputFiles()
    assert len(written) > 8

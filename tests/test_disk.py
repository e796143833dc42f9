"""What the streamed queries leave on disk while they run: no feed that was worked off, no shuffle that nobody reads."""

import glob
import os
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowflow.operators.digests import collected_checksums, content_checksums
from rowflow.operators.latest import current_rows, latest_by_key
from rowflow.plans.catalog import QUERIES
from rowflow.session import _CLEANUP, shuffles_cleared
from rowflow.sources.changes import change_envelopes, read_changes
from rowflow.streaming import store
from rowflow.streaming.references import References
from rowflow.streaming.replicate import run_available
from rowflow.streaming.store import KeyedTable
from rowflow.streaming.verify import verify_sync

DAY = datetime(1994, 5, 6)


@pytest.fixture
def folder(spark, root, monkeypatch):
    """Small tables of the test schema, and all work of a query below ``root/work``."""
    monkeypatch.setattr("rowflow.plans.catalog.work_dir", lambda _, purpose: f"{root}/work/{purpose}")
    made = {
        "customer": ([(k, f"Customer {k}", k % 5, float(k - 2), "BUILDING") for k in range(1, 9)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(k, f"part {k}", "Brand", "PROMO" if k % 4 == 0 else "LARGE", 10 * k, 9.5 * k) for k in range(1, 7)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k % 8 + 1, "O", 10.25 * k, DAY, "2-HIGH") for k in range(1, 21)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            [(k, k % 6 + 1, k % 3 + 1, n, 2.0, 7.5 * k, 0.0, 0.0, "R" if (k + n) % 5 == 0 else "N", "F", DAY) for k in range(1, 26) for n in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
        "events": ([(k, DAY, k, "click", float(k), None) for k in range(1, 11)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/in/{name}.parquet")
    return f"{root}/in"


def shuffled(spark):
    """The shuffle files there are."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def left_of(spark, before):
    """Shuffle files that are new, once what is being deleted is gone."""
    for _ in range(50):
        new = shuffled(spark) - before
        if not new:
            break
        time.sleep(0.1)
    return new


def files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_checksums_in_parts_are_the_whole_and_leave_no_shuffles(spark, root, parts):
    schema = "op string, seq long, a long, b string, v string"
    rng = random.Random(3)
    draw = lambda n: [(rng.choice("cud"), rng.randrange(50), rng.choice([None, *range(30)]), rng.choice(["x", "y", None]), f"v{rng.randrange(9)}") for _ in range(n)]
    log, base = spark.createDataFrame(draw(300), schema), spark.createDataFrame(draw(60), schema)
    table = KeyedTable(spark, root, "t", log.drop("op", "seq").schema, ["a", "b"], nullable_keys=True).create(base)
    table.append(log, 0)
    setting, before = spark.conf.get(_CLEANUP, None), shuffled(spark)
    changes = base.unionByName(log)
    given = {"stored": lambda only: table.current(only=only), "feed": lambda only: latest_by_key(changes.where(only), ["a", "b"]).where("op != 'd'")}
    found = {r.table: (r.row_count, r.checksum) for r in collected_checksums(given, dict.fromkeys(given, ["a", "b"]), parts).collect()}
    assert not left_of(spark, before)
    assert spark.conf.get(_CLEANUP, None) == setting
    whole = content_checksums({"stored": table.current(), "feed": current_rows(changes, ["a", "b"])}).collect()
    assert found == {r.table: (r.row_count, r.checksum) for r in whole}
    assert found["stored"][0] > 9


def test_clearing_ends_with_the_last_that_asked(spark):
    setting = spark.conf.get(_CLEANUP, None)
    one, other = shuffles_cleared(spark), shuffles_cleared(spark)
    one.__enter__(), other.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(_CLEANUP) == "true"
    other.__exit__(None, None, None)
    assert spark.conf.get(_CLEANUP, None) == setting


def test_consumed_files_go_while_the_job_runs(spark, root):
    changes = spark.createDataFrame([("c", k, k, f"v{k}") for k in range(4)], "op string, seq long, k long, v string")
    change_envelopes(changes.repartition(4, "k"), "a", ["k"]).write.option("maxRecordsPerFile", 1).parquet(f"{root}/feed")
    table = KeyedTable(spark, f"{root}/target", "a", changes.drop("op", "seq").schema, ["k"])
    left = []

    class Watched(KeyedTable):
        def append(self, *args):
            time.sleep(1)  # another thread deletes
            left.append(len(files(f"{root}/feed")))
            super().append(*args)

    watched = Watched(spark, f"{root}/target", "a", changes.drop("op", "seq").schema, ["k"])
    run_available(read_changes(spark, f"{root}/feed", max_files=1, consume=True), {"a": watched}, root)
    assert len(left) >= 4 and left[-1] < left[0]
    assert {r.k: r.v for r in table.current().collect()} == {k: f"v{k}" for k in range(4)}


def test_counts_are_compared_after_the_feed_is_gone_and_leave_no_shuffles(spark, root):
    changes = spark.range(20_000).select(F.lit("c").alias("op"), F.col("id").alias("seq"), F.xxhash64("id").alias("k"))
    table = KeyedTable(spark, root, "a", changes.select("k").schema, ["k"]).create()
    table.append(changes, 0)
    said, before = [], shuffled(spark)
    outcome = verify_sync([], {"a": changes}, {"a": table}, ended=lambda: said.append(not left_of(spark, before)))
    assert said == [True] and outcome.synced
    assert sum(os.path.getsize(f) for f in left_of(spark, before)) < 10_000  # rows of counts at most


def test_the_job_for_all_tables_leaves_no_feed(spark, root, folder):
    found = {r.table: (r.target_count, r.same_content) for r in QUERIES["fanout_apply"](spark, folder).collect()}
    assert not files(f"{root}/work/feed/feed")
    assert found == {"orders": (20, True), "customers": (7, True), "products": (5, True), "order_items": (40, True), "inventory_movements": (10, True)}


def test_jobs_per_table_leave_no_feed(spark, root, folder):
    found = QUERIES["per_table_jobs"](spark, folder)
    assert not files(f"{root}/work/feed/feed")
    logs = files(f"{root}/work/feed/target/*/log")
    assert logs and all(f.endswith(".zstd.parquet") for f in logs)
    assert len(glob.glob(f"{root}/work/feed/target/orders/log/v=0/job=*/batch=*")) > 1  # so the first goes before the last comes
    rows = {r.table: (r.row_count, r.same_content) for r in found.collect()}
    assert rows == {"orders": (20, True), "customers": (7, True), "products": (5, True), "order_items": (40, True), "inventory_movements": (10, True)}


def test_many_changes_move_the_same_rows_without_a_join(spark, root, monkeypatch):
    rng = random.Random(5)
    schema = "op string, seq long, a long, b long, v string"
    draw = lambda n: [(rng.choice("ucd"), rng.randrange(60), rng.choice([None, *range(8)]), rng.randrange(3), f"v{rng.randrange(99)}") for _ in range(n)]
    for nullable in (False, True):
        table = KeyedTable(spark, f"{root}/{nullable}", "t", spark.createDataFrame([], schema).drop("op", "seq").schema, ["a", "b"], nullable_keys=nullable)
        table.create(spark.createDataFrame([r for r in draw(9) if r[2] is not None], schema))
        for batch in range(3):
            table.append(spark.createDataFrame(draw(12), schema), batch)
        found = {}
        for most in (100_000, 0):
            monkeypatch.setattr(store, "JOINED_CHANGES", most)
            moved = table.moved_since(2, columns=("v",))
            assert ("LeftSemi" in moved._jdf.queryExecution().optimizedPlan().toString()) == bool(most)
            found[most] = sorted(map(repr, moved.collect()))
            ends = {(r.a, r.b): (r["__was"], r["__is"]) for r in table.existing_since(2).collect()}
            there = lambda row: row is not None and row.op != "d"
            assert ends == {tuple((r["__after"])[2:4]): (there(r["__before"]), there(r["__after"])) for r in moved.collect()}
        assert found[0] == found[100_000] != []


def test_references_follow_without_leaving_shuffles_or_rows(spark, root):
    schema = "op string, seq long, k long, p long"
    children = KeyedTable(spark, root, "children", spark.createDataFrame([], schema).select("k", "p").schema, ["k"]).create()
    parents = KeyedTable(spark, root, "parents", spark.createDataFrame([], schema).select("p").schema, ["p"]).create()
    kept = References(spark, root, "children", "parents", "p", parents.columns["p"].dataType).build(children, parents)
    change = lambda rows, op, seq: rows.select(F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"), "*")
    rows = spark.range(30_000).select(F.xxhash64("id").alias("k"), F.xxhash64(F.col("id") % 10_000).alias("p"))
    children.append(change(rows, "c", 1), 0)
    parents.append(change(rows.select("p").distinct().where("p > 0"), "c", 1), 0)
    before, held = shuffled(spark), spark.sparkContext._jsc.getPersistentRDDs().size()
    kept.refresh(children, parents, 0)
    assert sum(os.path.getsize(f) for f in left_of(spark, before)) < 10_000
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    assert not glob.glob(f"{root}/**/aside/*", recursive=True)
    counted = rows.where("p <= 0").groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(kept.orphans.current().collect()) == sorted(counted.collect())


def test_orphans_leave_no_feed(spark, root, folder):
    found = {r.order_id: r.n_items for r in QUERIES["orphans_current"](spark, folder).collect()}
    assert found == {k: 1 for k in (3, 8, 13, 18, 23)}  # the other line was returned, and the order with it
    assert not files(f"{root}/work/feed/feed")

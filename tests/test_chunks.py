"""Snapshots in chunks: complete beside a running log, and resumed where they stopped."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowflow.operators.latest import current_rows
from rowflow.plans.catalog import QUERIES
from rowflow.sources.changes import decode_envelopes, sorted_changes, typed_changes, undecodable, unreadable_changes
from rowflow.sources.chunks import ChunkedSnapshot, chunk_limits
from rowflow.streaming.replicate import BatchApplier
from rowflow.streaming.store import KeyedTable

ROW = T.StructType().add("k", "long").add("v", "string")


def test_a_restart_reads_open_chunks_only_and_the_log_wins(spark, root):
    log = [("c", k, k, f"a{k}") for k in range(1, 41)] + [("u", 50, 3, "late"), ("d", 51, 39, None), ("c", 60, 99, "new"), ("d", 61, 5, None)]
    feed = spark.createDataFrame(log, "op string, seq long, k long, v string")
    at, asked = [45], []

    def read(inside):
        asked.append(at[0])
        return current_rows(feed.where((F.col("seq") <= at[0]) & inside), ["k"])

    table = KeyedTable(spark, root, "t", ROW, ["k"]).create()
    snapshot = lambda: ChunkedSnapshot(table, f"{root}/s", read, lambda: at[0])

    def dies(chunk):
        at[0] = 55
        if chunk == 1:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        snapshot().run(4, dies)
    assert len(asked) == 3  # the limits and two chunks
    assert snapshot().run(4) == 2 and len(asked) == 5
    assert snapshot().run(4) == 0 and len(asked) == 5
    marks = sorted(tuple(r) for r in snapshot().finished().select("chunk", "low", "high").collect())
    assert marks == [(0, 45, 45), (1, 55, 55), (2, 55, 55), (3, 55, 55)]
    table.append(feed.where("seq > 45"), 0)
    assert set(table.current().collect()) == set(current_rows(feed, ["k"]).collect())


def test_limits(spark):
    keys = spark.range(1000).withColumnRenamed("id", "k")
    limits = chunk_limits(keys, "k", 4)
    assert len(limits) == 3 and all(abs(x - 250 * (i + 1)) < 40 for i, x in enumerate(limits))
    assert chunk_limits(keys, "k", 1) == [] and chunk_limits(keys.where("k = 7"), "k", 4) == [7]


def test_undecodable_messages_are_set_aside(spark, root):
    good = ['{"table":"a","op":"c","seq":%d,"after_json":"{\\"k\\":%d,\\"v\\":\\"x\\"}"}' % (k, k) for k in range(3)]
    bad = ['{"table":"a","op"', '{"op":"c","seq":9}', '{"table":null,"seq":1}', "", None, '{"table":"a","op":"c","seq":"x"}']
    sent = spark.createDataFrame([(m,) for m in good + bad], "value string")
    envelopes = decode_envelopes(sent)
    assert sorted((r.after_json or "") for r in undecodable(envelopes).collect()) == sorted(m or "" for m in bad)
    table = KeyedTable(spark, f"{root}/target", "a", ROW, ["k"]).create()
    BatchApplier({"a": table}, f"{root}/job")(envelopes, 0)
    assert sorted(r.k for r in table.current().collect()) == [0, 1, 2]
    aside = spark.read.json(f"{root}/job/unreadable/undecodable").collect()
    assert len(aside) == len(bad) and {r.reasons for r in aside} == {"table: null"}


def test_one_pass_sorts_as_three_do(spark):
    good = [("c", 1, None, '{"k":1,"v":"x"}'), ("u", 2, '{"k":1}', '{"k":2,"v":"y"}'), ("u", 3, '{"k":2}', '{"k":2}'), ("d", 4, '{"k":2}', None)]
    bad = [("u", 5, '{"k":1}', '{"k":'), ("u", 6, '{"k":"z"}', '{"k":3}'), ("c", None, None, '{"k":4}'), ("x", 7, None, '{"k":5}'),
           (None, 8, None, '{"k":6}'), ("c", 9, None, '{"v":"x"}'), ("d", 10, None, None), ("c", 11, None, "[1]"), ("u", 12, None, None)]
    df = spark.createDataFrame([("a", *r) for r in good + bad] + [("b", *good[0]), ("b", *bad[0])], "table string, op string, seq long, before_json string, after_json string")
    broken = spark.createDataFrame([(m,) for m in ['{"table":"a","op"', '{"op":"c","seq":9,"after_json":"{\\"k\\":1}"}', "", None]], "value string")
    messages = df.select(F.to_json(F.struct("*")).alias("value")).unionByName(broken)
    received = decode_envelopes(messages)
    got = sorted_changes(received, "a", ROW, ["k"])
    rows = lambda df: sorted(map(str, df.collect()))
    changes = typed_changes(received, "a", ROW, ["k"])
    assert rows(got.where("reasons = ''").select(*changes.columns)) == rows(changes) and changes.count() == len(good) + 1
    set_aside = unreadable_changes(received, "a", ROW, ["k"])
    aside = set_aside.unionByName(undecodable(received))
    assert rows(got.where("reasons != ''").select("envelope.*", "reasons")) == rows(aside)
    assert set_aside.count() == len(bad) and got.count() == len(good) + 1 + len(bad) + 4
    assert got.where("(reasons = '') = (envelope is not null)").count() == 0


def test_quarantined_messages_are_read_and_parsed_once(spark, root):
    orders = [(k, 7, "F", 10.5, "1-URGENT") for k in range(1, 98)]
    items = [(k, 5, 6, 1, 2.5, flag, "O") for k in range(1, 98) for flag in "NR"]
    at = F.lit("1996-01-02 00:00:00").cast("timestamp_ntz")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").withColumn("o_orderdate", at).write.parquet(f"{root}/orders.parquet")
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(items, lines).withColumn("l_shipdate", at).write.parquet(f"{root}/lineitem.parquet")
    found = QUERIES["quarantined_changes"](spark, root)
    assert {r.reasons: r.messages for r in found.collect()} == {
        "": 92 + 92 + 95, "after: unreadable; order_id: null": 4, "order_id: null": 2, "table: null": 6}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("from_json(") == 3  # the message and its two images

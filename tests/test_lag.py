"""Kept row counts and samples of the lag."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowflow.operators.sync import table_counts
from rowflow.sources.changes import UNNAMED, change_envelopes, read_changes, write_routed
from rowflow.streaming.lag import LagSampler, RowCounts, lag_samples
from rowflow.streaming.replicate import Upkeep, await_queries, routed_feed, run_available, start
from rowflow.streaming.store import KeyedTable

ROW = T.StructType().add("k", "long").add("v", "string")


def envelopes(spark, table, changes):
    df = spark.createDataFrame(changes, "op string, seq long, k long, v string")
    return change_envelopes(df, table, ["k"], F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def tables(spark, root, *names):
    return {n: KeyedTable(spark, f"{root}/target", n, ROW, ["k"]) for n in names}


def test_counts_follow_the_batches(spark, root):
    made = tables(spark, root, "a", "b")
    meta = "op string, seq long, k long, v string"
    made["a"].create(spark.createDataFrame([("r", 0, 1, "x"), ("r", 0, 2, "y")], meta))
    made["b"].create()
    counts = RowCounts(spark, root).build(made)
    batches = [[("c", 3, 3, "z"), ("d", 4, 1, None), ("u", 5, 2, "Y")], [("c", 3, 3, "z"), ("d", 9, 7, None)], [("d", 10, 2, None), ("d", 11, 3, None)]]
    for number, batch in enumerate(batches):
        for _ in range(2):
            made["a"].append(spark.createDataFrame(batch, meta), number)
            counts.refresh(made["a"], number)
        kept = {r["table"]: r.row_count for r in counts.current().collect()}
        assert kept.get("a", 0) == made["a"].current().count()
        if number == 0:
            counts.fold()
    assert kept == {"b": 0}  # as it was counted; the other's counter went with its last row


def test_samples_while_a_job_runs_and_while_it_is_idle(spark, root):
    made = tables(spark, root, "a")
    envelopes(spark, "a", [("c", 1, 1, "x"), ("c", 2, 2, "y")]).write.parquet(f"{root}/feed")
    made["a"].create()
    counts = RowCounts(spark, root).build(made)
    ahead = [0]
    now = [1_700_000_000.0]

    def clock():
        now[0] += 1
        return now[0]

    sampler = LagSampler(lambda: table_counts({"a": spark.range(2 + ahead[0]), "c": spark.range(1)}), counts, root, 0.5, "lagged", clock)
    spark.streams.addListener(sampler)
    try:
        jobs = start(read_changes(spark, f"{root}/feed"), made, root, interval="1 second", name="lagged", counts=counts)
        try:
            jobs[0].processAllAvailable()
            ahead[0] = 3  # the source goes on, nothing arrives
            for _ in range(60):
                jobs[0].awaitTermination(0.5)
                samples = lag_samples(spark, root)
                if samples is not None and samples.where("table = 'a' and lag = 3").limit(1).count():
                    break
        finally:
            jobs[0].stop()
    finally:
        spark.streams.removeListener(sampler)
    sampler.sample()
    newest = lag_samples(spark, root).groupBy("table").agg(F.max_by(F.struct("source_count", "target_count", "lag", "status"), "ts").alias("s"))
    assert sorted(map(tuple, newest.select("table", "s.*").collect())) == [("a", 5, 2, 3, "LAGGING"), ("c", 1, 0, 1, "LAGGING")]
    assert lag_samples(spark, root).where("table = 'a' and lag = 3").count() > 1
    assert lag_samples(spark, f"{root}/none") is None


def test_jobs_read_their_own_folders_of_a_routed_feed(spark, root):
    for n, name in enumerate("abc"):
        write_routed(envelopes(spark, name, [("c", 1, k, f"{name}{k}") for k in range(3 + n)]).coalesce(1), f"{root}/feed")
    lost = envelopes(spark, "a", [("c", 1, 9, "?")]).withColumn("table", F.lit(None).cast("string"))
    write_routed(lost.coalesce(1), f"{root}/feed")
    route = routed_feed(spark, f"{root}/feed", stream=False)
    files = [set(route([n], n == "a").inputFiles()) for n in "abc"]
    assert [len(f) for f in files] == [2, 1, 1] and len(set.union(*files)) == 4
    assert any(UNNAMED in f for f in files[0])
    made = tables(spark, root, *"abc")
    await_queries(start(routed_feed(spark, f"{root}/feed", max_files=1), made, root, "per_table", interval=None))
    for n, name in enumerate("abc"):
        assert {r.k: r.v for r in made[name].current().collect()} == {k: f"{name}{k}" for k in range(3 + n)}
    aside = [spark.read.json(f"{root}/replicate-a/unreadable/undecodable").count()]
    assert aside == [1]  # noted once, by the first job
    # A table whose folder comes into being later.
    late = tables(spark, f"{root}/late", "z")
    run_available(routed_feed(spark, f"{root}/feed"), late, f"{root}/late", upkeep=Upkeep(fold_every=None))
    write_routed(envelopes(spark, "z", [("c", 1, 1, "z")]), f"{root}/feed")
    run_available(routed_feed(spark, f"{root}/feed"), late, f"{root}/late", upkeep=Upkeep(fold_every=None))
    assert [tuple(r) for r in late["z"].current().collect()] == [(1, "z")]


def test_one_job_keeps_counts(spark, root):
    with pytest.raises(ValueError):
        start(spark.range(1), {}, root, "per_table", counts=RowCounts(spark, root))

"""The stored table: batches, replays, compaction, tombstones, versions, plans."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowflow.streaming.store import KeyedTable, buckets_for

SCHEMA = T.StructType().add("k", "long").add("v", "string")


def changes(spark, *rows):
    return spark.createDataFrame(rows, "op string, seq long, k long, v string")


def rows(table):
    return {r.k: r.v for r in table.current().collect()}


def new(spark, root, **options):
    return KeyedTable(spark, root, "t", SCHEMA, ["k"], **options)


def test_snapshot_then_changes(spark, root):
    table = new(spark, root).create(changes(spark, ("r", 0, 1, "a"), ("r", 0, 2, "b"), ("r", 0, 3, "c")))
    table.append(changes(spark, ("u", 1, 1, "A"), ("d", 2, 2, None)), 0)
    table.append(changes(spark, ("c", 3, 4, "d"), ("u", 4, 4, "D")), 1)
    assert rows(table) == {1: "A", 3: "c", 4: "D"}
    assert {r.k: r.v for r in table.current(1).collect()} == {1: "A", 3: "c"}
    assert rows(new(spark, root)) == rows(table)  # a reader that only knows the path


def test_repeated_batch_replaces_itself(spark, root):
    table = new(spark, root).create()
    for _ in range(2):
        table.append(changes(spark, ("c", 1, 1, "a"), ("c", 2, 2, "b")), 0)
    assert table.changes_since(0).count() == 2
    table.compact()
    table.append(changes(spark, ("c", 1, 1, "a"), ("c", 2, 2, "b")), 0)  # repeated after the compaction
    assert rows(table) == {1: "a", 2: "b"}


def test_compaction_changes_nothing_and_keeps_tombstones(spark, root):
    table = new(spark, root).create(changes(spark, ("r", 0, 1, "a"), ("r", 0, 2, "b")))
    table.append(changes(spark, ("d", 5, 1, None), ("u", 6, 2, "B")), 0)
    before = rows(table)
    table.compact()
    assert table.version() == (1, 1)
    assert rows(table) == before == {2: "B"}
    table.append(changes(spark, ("u", 4, 1, "late"), ("u", 3, 2, "late")), 1)
    assert rows(table) == {2: "B"}
    table.compact(forget_below=6)
    assert table.state().count() == 1


def test_fold_reduces_the_log_and_leaves_the_snapshot(spark, root):
    table = new(spark, root).create(changes(spark, ("r", 0, 1, "a")))
    for n in range(3):
        table.append(changes(spark, ("u", n + 1, 1, f"v{n}"), ("d", n + 1, 2, None)), n)
    table.fold()
    assert table.version() == new(spark, root).version() == (1, 0)
    assert spark.read.parquet(f"{root}/t/log/v=1").count() == 2
    table.append(changes(spark, ("u", 2, 1, "late"), ("c", 9, 3, "z")), 3)
    assert rows(table) == {1: "v2", 3: "z"}
    assert {r.k: r.v for r in table.current(3).collect()} == {1: "v2"}
    table.vacuum(keep=1)
    assert rows(new(spark, root)) == {1: "v2", 3: "z"}  # the snapshot is still needed


def test_jobs_number_their_batches_on_their_own(spark, root):
    table = new(spark, root).create()
    table.append(changes(spark, ("c", 1, 1, "a")), 0, "x")
    table.append(changes(spark, ("c", 2, 2, "b")), 0, "y")
    assert rows(table) == {1: "a", 2: "b"}
    assert {r.k for r in table.current(0, "y").collect()} == {1}


def test_bucket_count():
    assert buckets_for(0) == 4
    assert buckets_for(100 << 40) == 102400


def test_unpublished_leftover_is_ignored_and_replaced(spark, root):
    table = new(spark, root).create(changes(spark, ("r", 0, 1, "a")))
    # A compaction that died before publishing left files behind.
    spark.range(3).write.parquet(f"{root}/t/snapshot/v=1")
    assert rows(new(spark, root)) == {1: "a"}
    table.append(changes(spark, ("u", 1, 1, "b")), 0)
    table.compact()
    assert rows(new(spark, root)) == {1: "b"}


def test_catalog_entry_is_rebuilt_after_a_restart(spark, root):
    table = new(spark, root).create(changes(spark, ("r", 0, 1, "a")))
    spark.sql(f"drop table {table._snapshot_table(0)}")
    assert rows(new(spark, root)) == {1: "a"}


def test_vacuum_keeps_the_newest(spark, root):
    table = new(spark, root).create(changes(spark, ("r", 0, 1, "a")))
    for n in range(3):
        table.append(changes(spark, ("u", n + 1, 1, f"v{n}")), n)
        table.compact()
    table.vacuum(keep=1)
    assert rows(table) == rows(new(spark, root)) == {1: "v2"}
    assert spark.read.json(f"{root}/t/published").select("v").distinct().count() == 1


def test_stored_rows_are_not_shuffled(spark, root):
    rows_in = spark.range(5000).select(
        F.lit("r").alias("op"), F.lit(0).cast("long").alias("seq"), F.col("id").alias("k"), F.lit("x").alias("v")
    )
    table = new(spark, root).create(rows_in)
    table.append(changes(spark, ("u", 1, 7, "y"), ("d", 1, 8, None)), 0)
    plan = table.state()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert plan.count("Exchange") == 1  # of the changes
    assert table.current().count() == 4999
    only = table.current().select("k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<op:string,seq:bigint,k:bigint>" in only  # other columns are not read


def test_buckets(spark, root):
    table = KeyedTable(spark, root, "b", SCHEMA, ["k"], buckets=4).create(
        spark.range(400).select(F.lit("r").alias("op"), F.lit(0).cast("long").alias("seq"), F.col("id").alias("k"), F.lit("x").alias("v"))
    )
    detail = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {table._snapshot_table(0)}").collect()}
    assert detail["Num Buckets"] == "4" and detail["Bucket Columns"] == "[`k`]"
    files = {p.rsplit("_", 1)[1][:5] for p in spark.read.parquet(f"{root}/b/snapshot/v=0").inputFiles()}
    assert files == {"00000", "00001", "00002", "00003"}
    assert new(spark, root).buckets == 8


def test_a_stored_table_says_itself_how_it_is_stored(spark, root):
    """Written under one setting, read, changed and compacted under others."""
    rows = spark.range(1000).select(F.lit("r").alias("op"), F.lit(0).cast("long").alias("seq"), F.col("id").alias("k"), F.lit("x").alias("v"))
    changes = rows.where("k < 500").select(F.lit("u").alias("op"), F.lit(1).cast("long").alias("seq"), "k", F.lit("y").alias("v"))
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        KeyedTable(spark, root, "s", SCHEMA, ["k"]).create(rows).append(changes, 0)
        for partitions in (16, 3):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            table = KeyedTable(spark, root, "s", SCHEMA, ["k"])
            for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("rowflow_")]:
                spark.sql(f"drop table {name}")
            assert (table.current().count(), table.current().where("v = 'y'").count()) == (1000, 500)
            assert table.buckets == 4
            table.create().compact()
            assert KeyedTable(spark, root, "s", SCHEMA, ["k"]).current().count() == 1000
        with pytest.raises(ValueError, match="4 buckets"):
            KeyedTable(spark, root, "s", SCHEMA, ["k"], buckets=8).current()
        with pytest.raises(ValueError, match="keys"):
            KeyedTable(spark, root, "s", SCHEMA, ["v"]).current()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", setting)


def test_one_file_per_bucket(spark, root):
    rows = spark.range(5000).repartition(8).select(F.lit("r").alias("op"), F.lit(0).cast("long").alias("seq"), F.col("id").alias("k"), F.lit("x").alias("v"))
    KeyedTable(spark, root, "f", SCHEMA, ["k"], buckets=16).create(rows)
    assert len(spark.read.parquet(f"{root}/f/snapshot/v=0").inputFiles()) == 16

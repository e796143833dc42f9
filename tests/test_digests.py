"""Digest trees: what differs is found, whatever it is, and nothing else."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowflow.operators.digests import content_checksums, content_differences, differing_leaves, digest_tree

KEYED = "k long, g string, v string, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, KEYED)


def test_nulls_and_neighbours_are_told_apart(spark):
    rows = [(1, "a", None, 3), (1, "a", "", 3), (1, None, "a", 3), (1, "a", "3", None), (1, "a", None, None), (1, None, "a", None)]
    sums = content_checksums({str(i): frame(spark, [r]) for i, r in enumerate(rows)}).collect()
    assert len({r.checksum for r in sums}) == len(rows) and {r.row_count for r in sums} == {1}


def test_change_columns_are_no_content(spark):
    rows = frame(spark, [(1, "a", None, 3)])
    stored = rows.select(F.lit("r").alias("op"), F.lit(5).alias("seq"), "*")
    one, other = content_checksums({"a": rows, "b": stored}).collect()
    assert one.checksum == other.checksum


@pytest.mark.parametrize("bits", [4, 10, 16])
def test_the_tree_adds_up_and_opens_only_what_differs(spark, bits):
    rows = frame(spark, [(k, str(k % 3), str(k), k) for k in range(500)])
    tree = digest_tree(rows, ["k", "g"], bits).persist()
    for level in {r.level for r in tree.select("level").collect()}:
        total = tree.where(F.col("level") == level).agg(F.sum("row_count"), F.sum("first"), F.sum("second")).first()
        assert tuple(total) == tuple(tree.where("level = 0").select("row_count", "first", "second").first())
    changed = digest_tree(rows.withColumn("v", F.when(F.col("k") == 77, "x").otherwise(F.col("v"))), ["k", "g"], bits)
    assert differing_leaves(tree, tree, bits) == []
    assert len(differing_leaves(tree, changed, bits)) == 1


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10**6))
def test_differences_against_plain_python(spark, seed):
    draw = random.Random(seed)
    source = {(draw.choice([None, *range(60)]), draw.choice([None, "a", "b"])): (draw.choice([None, "", "x"]), draw.choice([None, 1])) for _ in range(80)}
    target = dict(source)
    for key in draw.sample(list(source), 12):
        del target[key]
    for _ in range(12):
        target[(draw.choice([None, *range(90)]), draw.choice([None, "a", "b"]))] = (draw.choice([None, "", "x"]), draw.choice([None, 1]))
    want = {(*k, "missing") for k in source.keys() - target.keys()} | {(*k, "extra") for k in target.keys() - source.keys()}
    want |= {(*k, "changed") for k in source.keys() & target.keys() if source[k] != target[k]}
    ours, theirs = (frame(spark, [(*k, *v) for k, v in t.items()]) for t in (source, target))
    got = [tuple(r) for r in content_differences(ours, theirs, ["k", "g"], bits=6, step=2).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, [(1, "a", "x", 1)])
    assert content_differences(none, none, ["k"]).count() == 0
    assert [tuple(r) for r in content_differences(some, none, ["k"]).collect()] == [(1, "missing")]
    assert [tuple(r) for r in content_differences(none, some, ["k"]).collect()] == [(1, "extra")]


def test_tables_are_read_once(spark, root):
    """Keys and hashes are kept, so the rows themselves are not worked out again for what differs."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = frame(spark, [(k, "g", str(k), k) for k in range(100)])
    ours = rows.mapInArrow(counted, rows.schema)
    theirs = rows.withColumn("v", F.when(F.col("k") != 7, F.col("v")))
    assert [tuple(r) for r in content_differences(ours, theirs, ["k", "g"]).collect()] == [(7, "g", "changed")]
    assert read.value == 100

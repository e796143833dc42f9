"""The pipeline against the stages done one document at a time."""

import os
import sys
from collections import Counter
from itertools import combinations

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
import test_decontam  # noqa: E402
import test_quality  # noqa: E402
import test_sharding  # noqa: E402
import test_simhash  # noqa: E402

from rowflow.llm import mixing  # noqa: E402

SF = "/root/testdata/sf0.001"


def rejected(text):
    n, chars, symbols, lines, duplicates, repeated, capitals = test_quality.brute(text)
    return n < 10 or 100 * repeated > 20 * n or 100 * symbols > 10 * n or 100 * duplicates > 30 * lines or 100 * capitals > 50 * chars


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in docs.collect() if not rejected(r.text)]
    prints = {r.doc_id: test_simhash.brute_print(r.text) for r in rows}
    values = set(prints.values())
    near = [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 2]
    first = {min(i for i, p in prints.items() if p in g) for g in test_simhash.brute_groups(values, near)}
    rows = [r for r in rows if r.doc_id in first]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not test_decontam.brute(r.text, items)[4]]
    # The mix draws; what it must keep are its sums, and whole documents.
    run = corpus_pipeline.run(spark, SF).collect()
    copies = Counter(r.doc_id for r in run)
    assert set(copies) <= {r.doc_id for r in rows} and max(copies.values()) <= 2
    sizes = {}
    for r in rows:
        sizes.setdefault(r.source, Counter())[r.doc_id] = len(r.text.split())
    targets = mixing.source_targets({s: sum(c.values()) for s, c in sizes.items()})
    for s, own in sizes.items():
        taken = sum(n * copies[i] for i, n in own.items())
        assert abs(taken - targets[s]) <= max(own.values())
    mixed = [(r.doc_id, r.text, r.source) for r in run]
    want = test_sharding.brute(mixed, 64 << 20)
    assert all((r.shard, r.shard_docs, r.shard_bytes) == (want[r.doc_id][0], want[r.doc_id][2], want[r.doc_id][3]) for r in run)
    texts = {r.doc_id: r.text for r in rows}
    assert all(r.text == texts[r.doc_id] for r in run)


def test_stages_keep_the_columns_and_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        assert out.columns == docs.columns if name != "shard" else set(out.columns) > set(docs.columns)

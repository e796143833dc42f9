import random

import numpy as np

from rowflow.llm import mixing


def test_targets():
    sizes = {"a": 10, None: 40, "b": 100, "Z": 50}
    targets = mixing.source_targets(sizes)  # Z weighs 5, a 2, b 1, null 5
    assert list(targets) == ["Z", "a", "b", None]
    assert targets["Z"] == 100 and targets["a"] == 20 and targets[None] == 80
    assert targets["b"] == 100 and sum(targets.values()) == 1.5 * 200
    assert mixing.source_targets({}) == {}
    assert mixing.source_targets({"a": 0, "b": 4}) == {"a": 0.0, "b": 6.0}


def test_flight_keeps_the_sums_and_lands_near():
    draw = random.Random(1)
    for k in range(60):
        n = draw.randint(0, 40)
        sizes = np.array(sorted((draw.choice([0, 1, 7, 7, 30, draw.randint(0, 2000)]) for _ in range(n)), reverse=True), float)
        chance = np.full(n, draw.choice([0.1, 0.5, 0.93]))
        flown = mixing.fly(chance, sizes, random.Random(k))
        assert ((flown > 0) & (flown < 1)).sum() <= 2
        assert abs(flown.sum() - chance.sum()) < 1e-6 and abs(flown @ sizes - chance @ sizes) < 1e-4
        landed = mixing.fly(chance, sizes, random.Random(k), land=True)
        assert set(np.unique(landed)) <= {0.0, 1.0}
        left = sizes[(flown > 0) & (flown < 1)]
        assert abs(landed @ sizes - chance @ sizes) <= (left.max() if len(left) else 0) + 1e-4


def test_chances_are_kept_on_average():
    sizes = np.array([90, 50, 20, 9, 8, 3, 2, 1], float)
    runs = np.mean([mixing.fly(np.full(8, 0.4), sizes, random.Random(k)) for k in range(4000)], axis=0)
    assert np.abs(runs - 0.4).max() < 0.04


def table(documents, prose):
    texts = prose(900, 60)
    return documents([(1000 + k, t, random.Random(k).choice(["a", "a", "a", "b", "c", None])) for k, t in enumerate(texts)])


def test_mix(documents, odd, prose):
    docs = table(documents, prose).unionByName(documents(odd))
    small = dict(block=16)  # several rounds
    got = mixing.mix(docs, **small).collect()
    assert len(got) == docs.count()
    again = mixing.mix(docs.repartition(5), **small).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    sources = {r.doc_id: r.source for r in docs.collect()}
    size = {}
    for r in got:
        size.setdefault(sources[r.doc_id], []).append(r)
    targets = mixing.source_targets({s: sum(r.size for r in rs) for s, rs in size.items()})
    for s, rs in size.items():
        assert {r.source_size for r in rs} == {sum(r.size for r in rs)}
        assert {r.target for r in rs} == {targets[s]}
        assert all(r.taken in (0, r.size, 2 * r.size) and r.taken == r.size * r.copies for r in rs)
        longest = max(r.size for r in rs)  # one document of b has more words than all others
        assert abs(sum(r.taken for r in rs) - targets[s]) <= (longest if s == "b" else 60)
        assert abs(sum(r.copies for r in rs) - len(rs) * targets[s] / rs[0].source_size) <= 3


def test_documents_are_repeated(documents, prose):
    docs = table(documents, prose)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    counted = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == copies


def test_empty_and_wordless(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixed_documents(documents([])).count() == 0
    got = mixing.mix(documents([(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_copies_do_not_share_a_block(spark, documents):
    rows = [(None, None, "a")] * 1500 + [(7, "one two three", "a")] * 1500 + [(k, "four words are here", "b") for k in range(300)]
    sizes = []
    got = mixing.mix(documents(rows, parts=4), block=32).collect()
    assert len(got) == len(rows)
    for source in ("a", "b"):
        mine = [r for r in got if (r.doc_id is None or r.doc_id == 7 and r.size == 3) == (source == "a")]
        sizes.append(abs(sum(r.taken for r in mine) - mine[0].target))
        assert abs(sum(r.copies for r in mine) - len(mine) * mine[0].target / mine[0].source_size) <= 3
    assert max(sizes) <= 8
    parted = mixing._parted(spark.createDataFrame([(1, 5)] * 400 + [(k, k) for k in range(2, 50)], "__id long, __hash long").repartition(3), 32)
    assert parted.groupBy("__hash").count().where("count > 1").count() == 0


def test_targets_over_all_tasks_are_the_same(spark):
    draw = random.Random(9)
    for many in (0, 1, 4, 300):
        sizes = {f"s{k}é"[draw.randint(0, 1) :] + str(k): draw.choice([0, 3, draw.randint(1, 50), draw.randint(1, 90_000)]) for k in range(many)}
        sizes |= {None: 40, "": 7} if many else {}
        sums = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "__source string, __source_size long, __units long")
        want = mixing.source_targets(sizes)
        got = mixing.spread_targets(sums).orderBy("__no").collect()
        assert [r["__source"] for r in got] == list(want) and [r["__no"] for r in got] == list(range(len(want)))
        assert all(abs(r["__target"] - want[r["__source"]]) <= 1e-9 * max(1, want[r["__source"]]) for r in got)
    empty = spark.createDataFrame([("a", 0, 2), ("b", 0, 1)], "__source string, __source_size long, __units long")
    assert [(r["__target"], r["__rate"]) for r in mixing.spread_targets(empty).collect()] == [(0.0, 0.0)] * 2


def test_more_sources_than_the_driver_takes(documents, prose, monkeypatch):
    rows = [(k, t, "hot" if k % 3 else None if k % 5 == 0 else f"s{k % 40}") for k, t in enumerate(prose(600, 30))]
    docs = documents(rows, parts=3)
    want = mixing.mix(docs, block=64).collect()
    monkeypatch.setattr(mixing, "MAX_SOURCES", 5)
    got = mixing.mix(docs, block=64).collect()
    facts = lambda rows: sorted((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in rows)
    assert facts(got) == facts(want)
    of = {k: s for k, _, s in rows}
    for s in set(of.values()):
        mine = [r for r in got if of[r.doc_id] == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rowflow.llm import ctw


def brute(train, texts):
    """The tree of counts, weighted recursively; one bit at a time."""
    deep, counts, children = ctw.DEPTH, {}, {}
    for text in train:
        z = bytes(deep) + text + b"\0"
        for i in range(deep, len(z)):
            for bit in range(8):
                prefix, one = 1 << bit | z[i] >> (8 - bit), z[i] >> (7 - bit) & 1
                for d in range(deep + 1):
                    counts.setdefault((z[i - d : i], prefix), [0, 0])[one] += 1
    for context, prefix in counts:
        if context:
            children.setdefault((context[1:], prefix), []).append(context)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    known = {}

    def weighted(context, prefix):
        if (context, prefix) not in known:
            own = kt(*counts.get((context, prefix), (0, 0)))
            if len(context) < deep:
                below = sum(weighted(c, prefix) for c in children.get((context, prefix), []))
                own = np.logaddexp(math.log(0.5) + own, math.log(0.5) + below)
            known[context, prefix] = own
        return known[context, prefix]

    for text in texts:
        z, total = bytes(deep) + text + b"\0", 0.0
        for i in range(deep, len(z)):
            for bit in range(8):
                prefix, one = 1 << bit | z[i] >> (8 - bit), z[i] >> (7 - bit) & 1
                chance = None
                for d in range(deep, -1, -1):
                    context = z[i - d : i]
                    seen = counts.get((context, prefix), (0, 0))
                    here = (seen[one] + 0.5) / (sum(seen) + 1)
                    stop = 1 if d == deep else math.exp(math.log(0.5) + kt(*seen) - weighted(context, prefix))
                    chance = here if chance is None else stop * here + (1 - stop) * chance
                total += math.log10(chance)
        yield total


def held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


def lower(text):
    return (text or "").encode().lower()


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 100.5, 1e6, 1e9 + 0.5])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-7)


def test_bits_of_a_byte_add_up_to_one():
    runs, counts = ctw.counted(ctw.runs_of([b"abracadabra", b"abba"]) >> np.uint64(ctw._DOC_BITS))
    context = int(runs[3]) & ~255
    every = np.arange(256, dtype=np.uint64) + np.uint64(context)
    keys, sums = ctw.merged([(runs, counts), (every, np.zeros(256, np.int64))])
    upper = ctw.Upper(*ctw.upper_sums(keys, sums))
    logs = ctw.log10_probabilities(keys, sums, upper)
    assert abs((10 ** logs[np.searchsorted(keys, every)]).sum() - 1) < 1e-9


def test_scores(documents, odd, prose):
    short = [(i, t if t is None or len(t) < 500 else t[:500], s) for i, t, s in odd]
    rows = short + [(100 + k, t, "s") for k, t in enumerate(prose(40, 25, vocabulary=60))] + [(300, "Ab ab\tAB", "s")]
    texts = {i: lower(t) for i, t, _ in rows}
    train = [lower(t) for i, t, _ in rows if not held_out(i)]
    want = dict(zip(texts, brute(train, texts.values()), strict=True))
    count = Counter()
    for t in train:
        count.update([*t.split(), None])
    tokens, types = sum(count.values()), len(count)
    for size, fan in ((700, 3), (700, ctw.FAN), (ctw.BUCKET_BYTES, 2)):  # many buckets added up in steps, at once, one bucket
        got = ctw.language_scores(documents(rows), bucket_bytes=size, fan=fan).collect()
        assert len(got) == len(rows)
        for r in got:
            t = texts[r.doc_id]
            every = [*t.split(), None]
            base = math.fsum(math.log10((count[w] + 0.5) / (tokens + 0.5 * (types + 1))) for w in every)
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(r.doc_id), len(every), sum(count[w] > 0 for w in every), tokens)
            assert abs(r.base_score - base) < 1e-9 and abs(r.score - want[r.doc_id]) < 1e-4
            assert abs(r.bits_per_byte + r.score * math.log2(10) / (len(t) + 1)) < 1e-9


def test_learns_the_language(documents, prose):
    texts = prose(400, 80, vocabulary=80)
    draw = random.Random(1)
    noise = ["".join(draw.choice("abcdefghiéö ") for _ in t) for t in texts[:60]]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(k, t, "s") for k, t in enumerate(noise, 1000) if held_out(k)]
    got = [r for r in ctw.language_scores(documents(rows)).collect() if r.held_out]
    real = [r.bits_per_byte for r in got if r.doc_id < 1000]
    junk = [r.bits_per_byte for r in got if r.doc_id >= 1000]
    assert np.mean(real) < 2 < 3 < np.mean(junk)


def test_nothing_to_learn_from(documents):
    assert ctw.language_scores(documents([])).count() == 0
    key = next(k for k in range(100) if held_out(k))
    row = ctw.language_scores(documents([(key, "ab", "s")])).collect()[0]
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 2)
    assert abs(row.score - 3 * 8 * math.log10(0.5)) < 1e-9


def test_no_task_adds_up_more_than_a_fan_of_lists(spark, documents, prose, monkeypatch, tmp_path):
    """The same texts in more and more buckets: what one task merges stays, and one list per part is left."""
    rows = [(k, t, "s") for k, t in enumerate(prose(60, 40, vocabulary=30))]
    summed = ctw._sums_of
    seen = []

    def watched(lists, buckets, fan):
        levels = summed(lists, buckets, fan)
        for below, above in zip(levels, levels[1:], strict=False):
            group = F.floor(F.col("bucket") / fan)
            assert below.groupBy("kind", "part", group.alias("g")).count().agg(F.max("count")).first()[0] <= fan
            assert above.count() < below.count()
        assert levels[-1].groupBy("kind", "part").count().agg(F.max("count")).first()[0] == 1
        seen.append((buckets, len(levels)))
        return levels

    monkeypatch.setattr(ctw, "_sums_of", watched)
    ctw.language_scores(documents(rows), bucket_bytes=1000, fan=2).count()
    assert seen[0][0] > 8 and seen[0][1] > 4


def test_ids_that_are_no_numbers(spark):
    df = spark.createDataFrame([("a-1", "to be or not"), ("b", None), (None, "to be")], "doc_id string, text string")
    got = {r.doc_id: r for r in ctw.language_scores(df).collect()}
    assert set(got) == {"a-1", "b", None}
    assert all(r.held_out == held_out(k) for k, r in got.items())

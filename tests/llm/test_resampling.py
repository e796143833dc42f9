import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from rowflow.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text, pairs):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)] * pairs


def brute(rows, target, buckets, pairs=False, percent=10, least=20):
    """id, features, weight, score, rank of every row, in plain Python."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    split = [(i, *features(t, pairs)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in split for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x, pairs)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, n, fs in split:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = [(*r, k + 1) for k, r in enumerate(enough[: len(enough) * percent // 100])]
    rest = Counter(out) - Counter(r[:5] for r in drawn)
    return Counter((r[0], *r[2:]) for r in drawn) + Counter({(r[0], *r[2:], None): n for r, n in rest.items()})


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.fixture
def target(spark, prose):
    texts = prose(30, 40, seed=1) + [None, ""]
    return texts, spark.createDataFrame([(t, "x") for t in texts], "text string, __text string")


@pytest.mark.parametrize("pairs", [False, True])
@pytest.mark.parametrize("head", [3, 1 << 15])
def test_against_plain_python(spark, documents, prose, odd, target, pairs, head, monkeypatch):
    rows = [(k, t, "a") for k, t in enumerate(prose(400, 60, seed=3))] + odd
    got = resampling.importance_resample(documents(rows), target[1], buckets=97, pairs=pairs, head=head)
    assert found(got) == brute([(i, t) for i, t, _ in rows], target[0], 97, pairs)


def test_rare_features_are_added_up_in_between(prose):
    import numpy as np
    import pyarrow as pa

    texts = [(t + " the of the of").encode() for t in prose(300, 10, seed=9, vocabulary=3000)]
    held, resampling.HELD = resampling.HELD, 50
    try:
        (out,) = resampling._counter(89, True, 16)(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])]))
    finally:
        resampling.HELD = held
    totals = np.zeros(89, np.int64)
    for row in out.to_pylist():
        totals[row["bucket"] if row["feature"] is None else zlib.crc32(row["feature"]) % 89] += row["n"]
    wanted = Counter(zlib.crc32(f.encode()) % 89 for t in texts for f in features(t.decode(), True)[1])
    assert totals.tolist() == [wanted[b] for b in range(89)]
    assert 0 < sum(r["feature"] is not None for r in out.to_pylist()) <= 16


def test_copies_share_a_score_and_take_their_ranks(spark, documents, target):
    text = " ".join(["one two three four five"] * 6)
    rows = [(None, text, "a")] * 300 + [(7, text, "a")] * 3
    got = resampling.importance_resample(documents(rows, parts=5), target[1], percent=50)
    assert found(got) == brute([(i, t) for i, t, _ in rows], target[0], 10_000, percent=50)
    assert sorted(r.rank for r in got.where("rank is not null").collect()) == list(range(1, 152))


def test_empty_tables(spark, documents, prose):
    none = spark.createDataFrame([], "text string")
    rows = [(k, t, "a") for k, t in enumerate(prose(50, 60))]
    assert resampling.importance_resample(documents([]), none).count() == 0
    assert found(resampling.importance_resample(documents(rows), none, buckets=31)) == brute([r[:2] for r in rows], [], 31)


def test_drawn_documents_are_whole_rows(spark, documents, prose, target):
    rows = [(k, t, "a") for k, t in enumerate(prose(200, 60, seed=4))]
    docs = documents(rows)
    drawn = resampling.resampled_documents(docs, target[1], buckets=97)
    wanted = {r[0] for r in brute([r[:2] for r in rows], target[0], 97) if r[4]}
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == wanted
    assert {tuple(r) for r in drawn.collect()} == {tuple(r) for r in docs.collect() if r.doc_id in wanted}

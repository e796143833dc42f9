import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowflow.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int, score long, anchor long, vector string, __x int"
FIVE, THREE = negatives.POSITIVES, negatives.NEGATIVES


def brute(rows, every=5, low=50, high=95):
    """The mined rows in plain Python; rows alike are one."""
    known = set()
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        known.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), label))
    out = Counter()
    score = lambda a, b: sum(x * y for x, y in zip(a[1], b[1], strict=True))
    for a in known:
        if a[0] % every:
            continue
        near = sorted((-score(a, r), r[0], r[2]) for r in known if r != a and len(r[1]) == len(a[1]))
        for p, i, _ in [r for r in near if r[2] == a[2]][:FIVE]:
            inside = [r for r in near if r[2] != a[2] and low * -p <= 100 * -r[0] <= high * -p]
            for rank, (n, j, _) in enumerate(inside[:THREE], 1):
                out[(a[0], i, rank, j, -p, -n)] += 1
    return out


def mined(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(*r, 1, 2, "own", 3) for r in rows], COLUMNS).repartition(parts)
    got = negatives.mine_negatives(df, F.col("vec_id") % 5 == 0, **more)
    return Counter(tuple(r) for r in got.select(*negatives._MINED.names).collect())


@pytest.fixture
def rows():
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(300, 12)) + 0.4
    vectors[50:150] = vectors[7]  # copies under many ids and labels
    return [(k, [float(x) for x in v], int(draw.integers(0, 4))) for k, v in enumerate(vectors)]


def test_against_plain_python(spark, rows):
    wanted = brute(rows)
    assert len(wanted) > 500
    assert mined(spark, rows) == wanted


def test_slices_give_the_same(spark, rows):
    assert mined(spark, rows, slice_bytes=800) == brute(rows)


def test_small_blocks_give_the_same(spark, rows, monkeypatch):
    import pyarrow as pa

    ids, labels = pa.array([r[0] for r in rows]), pa.array([r[2] for r in rows], pa.int64())
    whole = np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(float)).astype("<i4")
    batch = pa.RecordBatch.from_arrays([ids, labels, pa.array([v.tobytes() for v in whole], pa.binary())], names=["id", "label", "vector"])
    groups = {d: (at, t) for d, at, t in negatives._tables(*batch.slice(0, 20).columns)}
    primes = negatives.primes_for(int((whole.astype(np.int64) ** 2).sum(1).max()))
    run = lambda: sorted(map(str, next(negatives._positives(groups, 20, primes, 5)(iter([batch.slice(0, 90), batch.slice(90)]))).to_pylist()))
    large = run()
    monkeypatch.setattr(negatives, "ROWS", 7)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    assert run() == large


def test_odd_rows(spark, rows):
    odd = [(None, [1.0, 1.0], 1), (5, None, 1), (10, [1.0, None], 1), (15, [float("nan"), 1.0], 1), (20, [float("inf"), 1.0], 1)]
    odd += [(25, [], 1), (30, [1.0, 2.0], None), (35, [0.5, 2.0], 2), (36, [0.6, 2.0], 2), (37, [0.4, 1.2], 3), (37, [0.4, 1.2], 3)]
    odd += [(40, [0.5, 2.0, 1.0], 2), (35, [0.5, 2.0], 2), (35, [0.4, 1.9], 2), (45, [1e30, 1.0], 2), (-5, [0.5, 1.9], 3)]
    kept = [r for r in odd if r[0] != 45]  # too long for a score
    wanted = brute(kept)
    assert sum(n for k, n in wanted.items()) > 3
    assert mined(spark, odd) == wanted
    assert mined(spark, odd + rows[60:90]) == brute(kept + rows[60:90])


def test_without_rows_or_anchors(spark):
    assert not mined(spark, [], parts=1)
    assert not mined(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)])
    assert not mined(spark, [(0, [1.0, 2.0], 1)])


@pytest.mark.parametrize("size", [3, 300, 1 << 13, 1 << 22])
@pytest.mark.parametrize("columns", [1, 64, 200])
def test_products_are_exact(size, columns):
    draw = np.random.default_rng(columns)
    a, b = (draw.integers(-size, size + 1, (9, columns), np.int64) for _ in range(2))
    a[0], b[0] = size, size
    a[1], b[1] = size, -size
    primes = negatives.primes_for(columns * size * size)
    assert math.prod(primes) > 2 * columns * size * size and len(set(primes)) == len(primes)
    got = negatives.Residues(a.astype(np.int32), primes).scores(negatives.Residues(b.astype(np.int32), primes))
    assert (got == a @ b.T).all()

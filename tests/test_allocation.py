"""Keys out of stored blocks."""

import pytest

from rowflow.operators.allocation import KeyAllocator


def keys(df):
    return [r.id for r in df.select("id").collect()]


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_loads_never_share_a_key(spark, root, block):
    current = spark.createDataFrame([(5,), (17,)], "id long")
    made = KeyAllocator(spark, root, "id", block, tasks=4).create(current)
    seen = set(keys(current))
    top = 17
    for n, parts in ((0, 1), (50, 3), (1, 9), (200, 9)):
        rows = spark.range(n).selectExpr("id as v", "-1L as id").repartition(parts)
        given = made.load(rows, f"load{n}")
        found = keys(given)
        assert len(found) == len(set(found)) == n and not seen & set(found)
        assert all(k > top for k in found)
        assert sorted(r.v for r in given.collect()) == list(range(n))
        seen |= set(found)
        top = max([top, *found])
        assert made.high_water() == top
        assert top - 17 <= 4 * block * (1 + sum(1 for _ in seen))  # gaps stay within the blocks


def test_a_repeated_load_keeps_its_keys_and_a_dead_one_leaves_none(spark, root, monkeypatch):
    made = KeyAllocator(spark, root, "id", 2, tasks=2).create()
    with pytest.raises(ValueError):
        made.load(spark.range(1), "")
    rows = spark.range(9).selectExpr("id as v")
    with monkeypatch.context() as m:
        m.setattr(KeyAllocator, "_mark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            made.load(rows, "one")
    assert made.high_water() == 0
    first = sorted(map(tuple, made.load(rows, "one").collect()))
    again = KeyAllocator(spark, root, "id", 2, tasks=2).create(spark.createDataFrame([(99,)], "id long"))
    assert sorted(map(tuple, again.load(rows, "one").collect())) == first
    assert min(keys(again.load(rows, "two"))) > max(k for k, _ in first)


def test_no_window_no_shuffle_no_scan_of_the_table(spark, root):
    made = KeyAllocator(spark, root, "id", tasks=4).create()
    plan = spark.range(100).coalesce(4).select(made._next(7).alias("id"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    with pytest.raises(ValueError):
        KeyAllocator(spark, f"{root}/other", "id").high_water()

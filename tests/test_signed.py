"""Views and reference counts by signed changes: equal to what a full computation gives, after every batch."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_stream import order_changes, random_order_changes

from rowflow.operators import integrity
from rowflow.operators.latest import latest_by_key
from rowflow.plans.views import CUSTOMER_TIERS, DAILY_ORDERS
from rowflow.schemas import ORDERS
from rowflow.sources.changes import change_envelopes
from rowflow.streaming.references import References
from rowflow.streaming.replicate import BatchApplier, Upkeep
from rowflow.streaming.signed import SIGNED_CUSTOMER_TIERS, SIGNED_DAILY_ORDERS, SignedView, signed_changes
from rowflow.streaming.store import KeyedTable

CUSTOMER = ORDERS.struct["customer_id"].dataType


def made(spark, root, keys=30):
    orders = KeyedTable(spark, root, "orders", ORDERS.struct, ORDERS.key)
    orders.create(order_changes(spark, [("r", 0, k, k % 4 + 1, k, k % 6 + 1) for k in range(1, keys)]))
    return orders, SignedView(spark, f"{root}/views", SIGNED_DAILY_ORDERS, CUSTOMER).build(orders)


def same(orders, stored):
    return set(stored.current().collect()) == set(DAILY_ORDERS.compute(orders.current()).collect())


def test_view_equals_recompute_after_every_batch(spark, root):
    rng = random.Random(17)
    orders, stored = made(spark, root)
    assert same(orders, stored)
    for batch in range(3):
        # Late, repeated and losing changes are all in here.
        orders.append(order_changes(spark, random_order_changes(rng, 25, 40)), batch)
        stored.refresh(orders, batch)
        assert same(orders, stored)
        if batch == 1:
            orders.compact(), stored.compact()
    assert stored.members.current().where("n <= 0").count() == 0
    orders.append(order_changes(spark, [("d", 10**6, k, None, None, 1) for k in range(1, 41)]), 9)
    stored.refresh(orders, 9)
    assert stored.current().count() == stored.members.current().count() == 0


def test_a_job_refreshes_and_folds(spark, root):
    rng = random.Random(23)
    orders, stored = made(spark, root)
    views = {"orders": [(DAILY_ORDERS, stored)]}
    applier = BatchApplier({"orders": orders}, f"{root}/job", views, upkeep=Upkeep(refresh_every=2, fold_every=2))
    for batch in range(4):
        applier(change_envelopes(order_changes(spark, random_order_changes(rng, 6, 25)), "orders", ["order_id"]), batch)
        if batch % 2:
            assert same(orders, stored)


def test_a_repeated_batch_counts_once(spark, root):
    rng = random.Random(7)
    orders, stored = made(spark, root)
    changes = [order_changes(spark, random_order_changes(rng, 12, 40)) for _ in range(3)]
    orders.append(changes[0], 0)
    stored.refresh(orders, 0)
    orders.append(changes[1], 1)
    # The view was written, but the job died before it noted that.
    stored._add(signed_changes(orders, 1, columns=DAILY_ORDERS.reads), 1, 1, "main")
    orders.append(changes[1], 1)
    orders.append(changes[2], 2)
    stored.refresh(orders, 2)  # this time after two batches
    assert same(orders, stored)


def test_losing_and_repeated_changes_count_nothing(spark, root):
    orders, _ = made(spark, root, 5)
    orders.append(order_changes(spark, [("u", 9, 1, 2, 7, 3), ("u", 9, 1, 2, 7, 3)]), 0)
    moved = signed_changes(orders, 0, columns=("customer_id",)).collect()
    assert sorted((r.sign, r.order_id, r.customer_id) for r in moved) == [(-1, 1, 2), (1, 1, 2)]
    orders.append(order_changes(spark, [("u", 8, 1, 4, 1, 1), ("d", 3, 1, None, None, 1)]), 1)
    assert signed_changes(orders, 1).count() == 0
    assert signed_changes(orders, 2).count() == 0


def test_null_groups_members_and_sums(spark, root):
    columns = T.StructType().add("customer_id", "long").add("customer_tier", "string").add("total_orders", "integer").add("total_spent", "decimal(14,2)")
    table = KeyedTable(spark, root, "customers", columns, ["customer_id"])

    def rows(*some):
        return spark.createDataFrame([(*r[:4], r[4], None) for r in some], "op string, seq long, customer_id long, customer_tier string, total_orders int, x string").select(
            "op", "seq", "customer_id", "customer_tier", "total_orders", F.when(F.col("total_orders") > 1, F.col("total_orders") * F.lit("1.10").cast("decimal(3,2)")).alias("total_spent")
        )

    table.create(rows(("r", 0, 1, None, None), ("r", 0, 2, "GOLD", 3), ("r", 0, 3, "GOLD", 1)))
    stored = SignedView(spark, f"{root}/views", SIGNED_CUSTOMER_TIERS).build(table)
    check = lambda: set(stored.current().collect()) == set(CUSTOMER_TIERS.compute(table.current()).collect())
    assert check()
    table.append(rows(("u", 1, 2, None, None), ("u", 1, 3, "GOLD", None), ("c", 1, 4, None, 5)), 0)
    stored.refresh(table, 0)
    assert check() and {r.total_revenue for r in stored.current().collect() if r.customer_tier} == {None}
    table.append(rows(("d", 2, 3, None, None), ("d", 2, 4, None, None)), 1)
    stored.refresh(table, 1)
    assert check() and {r.customer_tier for r in stored.current().collect()} == {None}

    daily = KeyedTable(spark, root, "orders", ORDERS.struct, ORDERS.key)
    daily.create(order_changes(spark, [("r", 0, 1, 1, 5, 1), ("r", 0, 2, 1, 5, 1)]).withColumn("customer_id", F.lit(None).cast(CUSTOMER)))
    view = SignedView(spark, f"{root}/views", SIGNED_DAILY_ORDERS, CUSTOMER).build(daily)
    changes = order_changes(spark, [("u", 3, 2, 1, 5, 1), ("u", 3, 1, 3, 5, 1)]).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    daily.append(changes, 0)
    view.refresh(daily, 0)
    assert same(daily, view) and [r.order_date for r in view.current().collect()] == [None]


def test_a_lookup_does_not_read_the_whole_table(spark, root):
    orders = KeyedTable(spark, root, "orders", ORDERS.struct, ORDERS.key, buckets=16)
    orders.create(order_changes(spark, [("r", 0, k, k % 4 + 1, k, 1) for k in range(1, 3000)]))
    orders.append(order_changes(spark, [("u", 5, k, 1, k, 2) for k in (7, 8, 2999)]), 0)
    few = spark.createDataFrame([(7,), (8,), (5000,)], "order_id long")
    found = orders.state_of(few, columns=["total_amount"])
    assert sorted((r.order_id, r.seq) for r in found.collect()) == [(7, 5), (8, 5)]
    plan = explained(found)
    assert "SelectedBucketsCount: 3 out of 16" in plan or "SelectedBucketsCount: 2 out of 16" in plan
    assert "In(order_id, [5000,7,8])" in plan or "In(order_id, [7,8,5000])" in plan
    many = spark.range(1, 1500).select(F.col("id").alias("order_id"))
    found = orders.state_of(many, before_batch=0)
    assert found.count() == 1499 and found.agg(F.max("seq")).first()[0] == 0
    assert "LessThanOrEqual(order_id,1499)" in explained(found)


def explained(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


ITEM = T.StructType().add("item", "long").add("order_id", "long")


def test_references_equal_the_batch_operators(spark, root):
    rng = random.Random(3)
    items = KeyedTable(spark, root, "items", ITEM, ["item"])
    orders = KeyedTable(spark, root, "orders", T.StructType().add("order_id", "long").add("v", "string"), ["order_id"])

    def changes(n, keys, of):
        rows = [(rng.choice("cuud"), rng.randint(1, 99), rng.randint(1, keys), rng.choice([None, *range(1, 12)])) for _ in range(n)]
        return spark.createDataFrame(rows, f"op string, seq long, {of}, ref long")

    def of_items(n):
        return latest_by_key(changes(n, 30, "item long"), ["item", "seq"]).select("op", "seq", "item", F.col("ref").alias("order_id"))

    def of_orders(n):
        return changes(n, 11, "order_id long").select("op", "seq", "order_id", F.col("ref").cast("string").alias("v"))

    items.create(of_items(25).withColumn("seq", F.lit(0).cast("long")))
    orders.create(of_orders(6).withColumn("seq", F.lit(0).cast("long")))
    kept = References(spark, f"{root}/kept", "items", "orders", "order_id", T.LongType()).build(items, orders)
    candidates = spark.range(14).select(F.col("id").alias("order_id"))

    def check():
        orphans = integrity.fk_orphans(items.current(), orders.current(), "order_id").groupBy("order_id").count()
        assert set(kept.orphans.current().collect()) == {tuple(r) for r in orphans.collect()}
        allowed = integrity.restrict_deletes(candidates, items.current(), "order_id")
        assert set(kept.restrict(candidates).collect()) == {tuple(r) for r in allowed.collect()}

    check()
    for batch in range(4):
        items.append(of_items(9), batch)
        if batch != 3:
            orders.append(of_orders(4), batch)
        if batch != 1:  # the next refresh takes two batches
            kept.refresh(items, orders, batch)
            if batch == 2:  # delivered again after it was taken in
                kept.refresh(items, orders, batch)
            check()
        if batch == 0:
            items.compact(), orders.fold(), kept.fold()
    assert kept.uses.current().where("n <= 0").count() == 0


def test_moves_are_found_in_one_step(spark, root):
    """The row before and after, over the snapshot, earlier batches and late or repeated changes."""
    table = KeyedTable(spark, root, "t", T.StructType().add("k", "long").add("v", "string"), ["k"])
    rows = lambda *r: spark.createDataFrame(r, "op string, seq long, k long, v string")
    table.create(rows(("r", 5, 1, "a"), ("r", 5, 2, "b"), ("r", 5, 3, "c")))
    table.append(rows(("u", 6, 2, "B"), ("c", 6, 4, "d")), 0)
    table.append(rows(("u", 7, 2, "BB"), ("d", 6, 3, None), ("u", 4, 1, "late"), ("u", 6, 4, "a"), ("c", 1, 5, "e"), ("c", 1, 5, "e"), ("c", 9, None, "x")), 1)
    text = lambda x: x and (x.op, x.seq, x.v)
    found = {(r["__after"].k): (text(r["__before"]), text(r["__after"])) for r in table.moved_since(1, columns=("v",)).collect()}
    assert found == {
        1: (("r", 5, "a"), ("r", 5, "a")),
        2: (("u", 6, "B"), ("u", 7, "BB")),
        3: (("r", 5, "c"), ("d", 6, None)),
        4: (("c", 6, "d"), ("u", 6, "a")),
        5: (None, ("c", 1, "e")),
    }

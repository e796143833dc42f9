"""The sample data end to end: inserts, the nine updates, both summaries, item totals."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import seed
from rowflow.functions import line_total
from rowflow.operators import dml, integrity
from rowflow.operators.latest import current_rows
from rowflow.plans.views import CUSTOMER_TIERS, DAILY_ORDERS
from rowflow.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, TABLES, create_table_sql, select_tables
from rowflow.sources.changes import union_all
from rowflow.sources.snapshot import conform, inline_rows


def as_of():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def customers(spark):
    given = inline_rows(
        spark,
        CUSTOMERS,
        [(i, *row) for i, row in enumerate(seed.CUSTOMERS, 1)],
        ["customer_id", *seed.CUSTOMER_COLUMNS],
    )
    return dml.fill_defaults(given, CUSTOMERS, as_of())


def orders(spark):
    given = inline_rows(spark, ORDERS, seed.ORDERS, ["order_id", "customer_id", "order_status", "total_amount"])
    return dml.fill_defaults(given, ORDERS, as_of())


def items(spark):
    rows = [(i, o, p, q, Decimal(u), Decimal(t)) for i, (o, p, q, u, t) in enumerate(seed.ITEMS, 1)]
    given = inline_rows(
        spark, ORDER_ITEMS, rows, ["item_id", "order_id", "product_id", "quantity", "unit_price", "total_price"]
    )
    return dml.fill_defaults(given, ORDER_ITEMS, as_of())


def updated_customers(spark):
    base = customers(spark)
    events = [dml.insert_events(base, 1)]
    for n, (key, count, spent) in enumerate(seed.CUSTOMER_UPDATES, 2):
        assign = {"total_orders": F.lit(count), "total_spent": F.lit(spent)}
        events.append(dml.update_events(base, F.col("customer_id") == key, assign, n, "updated_at", as_of()))
    return current_rows(dml.event_rows(union_all(events), ["customer_id"]), ["customer_id"])


def test_defaults_and_types(spark):
    df = customers(spark)
    assert df.schema == CUSTOMERS.struct or [f.dataType for f in df.schema] == [c.type for c in CUSTOMERS.columns]
    row = df.where("customer_id = 10").first()
    assert (row.customer_tier, row.total_orders, row.total_spent) == ("GOLD", 0, Decimal("0.00"))
    assert row.created_at == seed.AS_OF
    assert orders(spark).where("shipping_address is null").count() == 10


def test_explicit_null_is_not_a_default(spark):
    rows = spark.createDataFrame([(1, 1, None)], "order_id long, customer_id int, order_status string")
    filled = dml.fill_defaults(rows, ORDERS, as_of())
    assert filled.first().order_status is None
    bad = integrity.contract_violations(filled, ORDERS)
    assert bad.first().reasons == "order_status: null"


def test_missing_column_without_default_is_refused(spark):
    with pytest.raises(ValueError):
        dml.fill_defaults(spark.range(1), ORDERS, as_of())


def test_customer_updates_match_orders(spark):
    state = {r.customer_id: (r.total_orders, r.total_spent) for r in updated_customers(spark).collect()}
    want = {i: (0, Decimal("0.00")) for i in range(1, 11)}
    for _, customer, status, amount in seed.ORDERS:
        n, spent = want[customer]
        want[customer] = (n + 1, spent if status == "CANCELLED" else spent + amount)
    assert state == want


def test_update_that_changes_nothing_is_no_event(spark):
    base = customers(spark)
    assign = {"total_orders": F.lit(0)}
    assert dml.update_events(base, F.lit(True), assign, 1, "updated_at", as_of()).count() == 0


def test_daily_summary(spark):
    row = DAILY_ORDERS.compute(orders(spark)).collect()
    assert len(row) == 1
    total = sum(o[3] for o in seed.ORDERS)
    assert row[0].asDict() == {
        "order_date": seed.AS_OF.date(),
        "total_orders": 10,
        "total_revenue": total,
        "avg_order_value": float(total) / 10,
        "unique_customers": 9,
    }


def test_tier_summary(spark):
    got = {r.customer_tier: (r.customer_count, r.total_orders, r.total_revenue) for r in
           CUSTOMER_TIERS.compute(updated_customers(spark)).collect()}
    assert got == {
        "GOLD": (4, 4, Decimal("3529.92")),
        "STANDARD": (4, 4, Decimal("1879.95")),
        "PLATINUM": (2, 2, Decimal("1999.96")),
    }


def test_item_totals(spark):
    df = items(spark)
    assert df.count() == 19
    assert df.where(line_total(F.col("quantity"), F.col("unit_price")) != F.col("total_price")).count() == 0


def test_line_total_is_exact(spark):
    got = spark.sql("select 3 as q, cast(0.335 as decimal(10,3)) as p").select(line_total(F.col("q"), F.col("p"))).first()[0]
    assert got == Decimal("1.02")  # the price is money first: 0.34


def test_items_follow_their_orders(spark):
    deletes = dml.delete_events(orders(spark), F.col("order_status") == "CANCELLED", 5)
    gone = integrity.cascade_events(deletes, items(spark), "order_id").select("op", "seq", "before.order_id").collect()
    assert [tuple(r) for r in gone] == [("d", 5, 6)]


def test_referenced_products_are_kept(spark):
    products = spark.range(1, 11).select(F.col("id").cast("int").alias("product_id"))
    allowed = integrity.restrict_deletes(products, items(spark), "product_id").where("allowed").collect()
    assert [r.product_id for r in allowed] == [6]
    events = integrity.allowed_delete_events(products, items(spark), "product_id", 3)
    assert [r.before.product_id for r in events.collect()] == [6]


def test_declared_tables(spark, root):
    assert list(TABLES) == ["orders", "customers", "products", "order_items", "inventory_movements"]
    assert [f.on_delete for f in ORDER_ITEMS.foreign_keys] == ["cascade", "restrict"]
    spark.sql(create_table_sql("declared_orders", ORDERS.struct, f"{root}/declared", ORDERS.key, 4))
    assert [f.dataType for f in spark.table("declared_orders").schema] == [c.type for c in ORDERS.columns]
    spark.sql("drop table declared_orders")
    assert isinstance(ORDERS.widened().struct["customer_id"].dataType, T.LongType)
    assert conform(orders(spark).select(*reversed(ORDERS.names)), ORDERS).columns == ORDERS.names


def test_table_selection():
    assert select_tables("orders, customers,unknown") == ["orders", "customers"]
    assert select_tables("") == select_tables(None) == select_tables("unknown") == list(TABLES)

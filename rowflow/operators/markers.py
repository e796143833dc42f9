"""Predicates that recognise probe, test and load rows by their marker strings."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dml import delete_events
from .skew import join_to_unique

# Marker patterns and states of removable rows.  ``_`` matches any one character.
TEST_STATUSES = [
    "TEST",
    "BATCH",
    "TO_DELETE",
    "CONTINUOUS",
    "MULTI_TEST",
    "PENDING",
    "PROCESSING",
    "SHIPPED",
    "DELIVERED",
]
TEST_ITEM_ADDRESSES = [
    "latency_test_%",
    "batch_%",
    "delete_test_%",
    "continuous_%",
    "multi_addr_%",
    "load_addr_%",
]
TEST_ORDER_ADDRESSES = TEST_ITEM_ADDRESSES + ["unlimited_addr_%"]
TEST_EMAILS = ["test_%@example.com", "load_%@example.com", "unlimited_%@example.com"]
TEST_SKUS = ["SKU_%", "LOAD_%", "UNLIM_%"]
TEST_NOTES = ["Test movement %", "Load test %", "Unlimited test %"]
BENCH_ADDRESSES = ["bench_addr_%"]
BENCH_NOTES = ["Benchmark movement %"]
BENCH_SKUS = ["BENCH_%"]
BENCH_EMAILS = ["bench_%"]


def like_any(column: Column, patterns: Iterable[str], ignore_case: bool = False) -> Column:
    """True when any pattern matches.  Case counts unless told otherwise."""
    match = column.ilike if ignore_case else column.like
    return reduce(or_, [match(p) for p in patterns])


def marked(column: Column, marker: str) -> Column:
    """Rows whose marker column equals the marker."""
    return column == F.lit(marker)


def removable_orders(addresses: Iterable[str] = tuple(TEST_ORDER_ADDRESSES)) -> Column:
    """Orders in a removable state whose address carries a test marker."""
    return F.col("order_status").isin(TEST_STATUSES) & like_any(F.col("shipping_address"), addresses)


def _not(condition: Column) -> Column:
    """Rows that a delete with this condition leaves."""
    return ~F.coalesce(condition, F.lit(False))


def after_cleanups(tables: dict[str, DataFrame], item_key: Iterable[str]) -> dict[str, DataFrame]:
    """The tables after the test and the load cleanup at the source.

    Deleted orders take their items along; a product that a remaining item refers to stays.  Plain filters decide
    all else, and only the items are joined.
    """
    orders = tables["orders"].where(_not(removable_orders()) & _not(like_any(F.col("shipping_address"), BENCH_ADDRESSES)))
    gone = tables["orders"].where(removable_orders() | like_any(F.col("shipping_address"), BENCH_ADDRESSES))
    items = join_to_unique(tables["order_items"], gone.select("order_id"), "order_id", "left_anti").dropDuplicates(list(item_key))
    doomed = like_any(F.col("sku"), TEST_SKUS + BENCH_SKUS)
    used = items.select("product_id").distinct()
    held = tables["products"].where(F.coalesce(doomed, F.lit(False))).join(used, "product_id", "left_semi").select(*tables["products"].columns)
    return {
        "orders": orders,
        "customers": tables["customers"].where(_not(like_any(F.col("email"), TEST_EMAILS + BENCH_EMAILS))),
        "products": tables["products"].where(_not(doomed)).unionByName(held),
        "order_items": items,
        "inventory_movements": tables["inventory_movements"].where(_not(like_any(F.col("notes"), TEST_NOTES + BENCH_NOTES))),
    }


def cleanup_events(tables: dict[str, DataFrame], kind: str, seq: int) -> dict[str, DataFrame]:
    """Delete events of one cleanup, children first, each later table at a later position.

    ``kind`` is ``test`` or ``bench``.  The test cleanup leaves the items of
    ``unlimited_addr_`` orders to the cascade of their orders; see ``cascade_events``.
    """
    orders = tables["orders"]
    if kind == "test":
        parents, doomed = removable_orders(TEST_ITEM_ADDRESSES), removable_orders()
        emails, skus, notes = TEST_EMAILS, TEST_SKUS, TEST_NOTES
    elif kind == "bench":
        parents = doomed = like_any(F.col("shipping_address"), BENCH_ADDRESSES)
        emails, skus, notes = BENCH_EMAILS, BENCH_SKUS, BENCH_NOTES
    else:
        raise ValueError(f"unknown cleanup {kind!r}")
    return {
        "order_items": delete_events(tables["order_items"], orders.where(parents).select("order_id"), seq, ["order_id"]),
        "orders": delete_events(orders, doomed, seq + 1),
        "customers": delete_events(tables["customers"], like_any(F.col("email"), emails), seq + 2),
        "products": delete_events(tables["products"], like_any(F.col("sku"), skus), seq + 3),
        "inventory_movements": delete_events(
            tables["inventory_movements"], like_any(F.col("notes"), notes), seq + 4
        ),
    }

"""Grouped summaries: one definition serves the full query and the incremental refresh."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class View:
    name: str
    source: str
    group: str
    group_by: Callable[[], Column]
    measures: Callable[[], list[Column]]
    schema: T.StructType
    reads: tuple[str, ...]  # the source columns it needs
    partials: Callable[[], list[Column]] = list  # combined on the way to the measures
    partial_by: tuple[str, ...] = ()

    def compute(self, rows: DataFrame) -> DataFrame:
        """The whole view over current rows."""
        grouped = rows.withColumn(self.group, self.group_by())
        if self.partial_by:
            grouped = grouped.groupBy(self.group, *self.partial_by).agg(*self.partials())
        out = grouped.groupBy(self.group).agg(*self.measures())
        return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def groups(self, rows: DataFrame) -> DataFrame:
        """The groups that some rows belong to."""
        return rows.select(self.group_by().alias(self.group)).distinct()


def _per_day_and_customer() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount")]


def _daily_measures() -> list[Column]:
    # One row per day and customer arrives here, so distinct customers are counted, not expanded.
    orders, revenue = F.sum("n"), F.sum("amount")
    return [
        orders.alias("total_orders"),
        revenue.alias("total_revenue"),
        (revenue.cast("double") / orders.cast("double")).alias("avg_order_value"),
        F.count("customer_id").alias("unique_customers"),
    ]


def _tier_measures() -> list[Column]:
    spent, known = F.sum("total_spent"), F.nullif(F.count("total_spent"), F.lit(0))
    return [
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("total_orders").alias("total_orders"),
        spent.alias("total_revenue"),
        (spent.cast("double") / known.cast("double")).alias("avg_customer_value"),
    ]


DAILY_ORDERS = View(
    "daily_order_summary",
    "orders",
    "order_date",
    lambda: F.col("created_at").cast("date"),
    _daily_measures,
    T.StructType()
    .add("order_date", "date")
    .add("total_orders", "long")
    .add("total_revenue", "decimal(38,2)")
    .add("avg_order_value", "double")
    .add("unique_customers", "long"),
    ("customer_id", "total_amount", "created_at"),
    _per_day_and_customer,
    ("customer_id",),
)

CUSTOMER_TIERS = View(
    "customer_tier_summary",
    "customers",
    "customer_tier",
    lambda: F.col("customer_tier"),
    _tier_measures,
    T.StructType()
    .add("customer_tier", "string")
    .add("customer_count", "long")
    .add("total_orders", "long")
    .add("total_revenue", "decimal(38,2)")
    .add("avg_customer_value", "double"),
    ("customer_tier", "total_orders", "total_spent"),
)

VIEWS = {v.name: v for v in (DAILY_ORDERS, CUSTOMER_TIERS)}

"""The star-schema test tables read as the five replicated tables, their feeds and probes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import line_total, money
from ..functions.labels import PROBE_TIMEOUT
from ..operators.latency import probe_latency
from ..schemas import CUSTOMERS, INVENTORY_MOVEMENTS, ORDERS, PRODUCTS
from ..sources.changes import union_all
from ..sources.snapshot import snapshot_rows

# Fixed values of the mapping.
AS_OF = "2024-01-01 00:00:00"
KEYS = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "order_items": ["order_id", "line_number", "product_id", "supplier_id"],
    "inventory_movements": ["movement_id"],
}
WIDE = {t.name: t.widened() for t in (ORDERS, CUSTOMERS, PRODUCTS, INVENTORY_MOVEMENTS)}


def as_of() -> Column:
    return F.to_timestamp_ntz(F.lit(AS_OF))


def _case(column: str, cases: dict[str, Column | str], otherwise: Column | str | None) -> Column:
    out = None
    for value, result in cases.items():
        hit = F.col(column) == value
        out = F.when(hit, result) if out is None else out.when(hit, result)
    return out.otherwise(otherwise)


def _tag(prefix: str, key: str, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(suffix))


def _day(ts: str) -> Column:
    return F.date_diff(F.col(ts).cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint")


def _position(day: Column, row: Column) -> Column:
    """A log position: the day's part in front of 40 bits for the row."""
    return day.cast("bigint") * F.lit(1 << 40) + row


class Tables:
    """The tables below one folder.  Each is opened once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._open: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._open[name]

    # -- current rows at the source --------------------------------------------------

    def orders(self) -> DataFrame:
        address = {
            "1-URGENT": _tag("latency_test_", "o_orderkey"),
            "2-HIGH": _tag("batch_", "o_orderkey"),
            "3-MEDIUM": _tag("bench_addr_", "o_orderkey"),
            "5-LOW": _tag("unlimited_addr_", "o_orderkey"),
        }
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            _case("o_orderstatus", {"F": "DELIVERED", "O": "PENDING"}, "PROCESSING").alias("order_status"),
            money(F.col("o_totalprice")).alias("total_amount"),
            _case("o_orderpriority", address, None).alias("shipping_address"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def customers(self) -> DataFrame:
        email = {
            "AUTOMOBILE": _tag("test_", "c_custkey", "@example.com"),
            "BUILDING": _tag("load_", "c_custkey", "@example.com"),
            "FURNITURE": _tag("unlimited_", "c_custkey", "@example.com"),
            "HOUSEHOLD": _tag("bench_", "c_custkey", "@example.com"),
        }
        return self.read("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.col("c_name").alias("last_name"),
            _case("c_mktsegment", email, _tag("user", "c_custkey", "@email.com")).alias("email"),
            F.concat(F.lit("555-"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0")).alias("phone"),
            F.date_add(F.lit("2023-01-01").cast("date"), F.col("c_nationkey")).alias("registration_date"),
            F.col("c_mktsegment").alias("customer_tier"),
            F.lit(0).alias("total_orders"),
            money(F.col("c_acctbal"), 14).alias("total_spent"),
            as_of().alias("created_at"),
            as_of().alias("updated_at"),
        )

    def products(self) -> DataFrame:
        sku = {
            "ECONOMY": _tag("SKU_", "p_partkey"),
            "LARGE": _tag("LOAD_", "p_partkey"),
            "MEDIUM": _tag("UNLIM_", "p_partkey"),
            "PROMO": _tag("BENCH_", "p_partkey"),
        }
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            _case("p_type", sku, _tag("ITEM-", "p_partkey")).alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            money(F.col("p_retailprice"), 10).alias("price"),
            F.col("p_size").alias("stock_quantity"),
            F.lit(True).alias("is_active"),
            as_of().alias("created_at"),
            as_of().alias("updated_at"),
        )

    def order_items(self) -> DataFrame:
        quantity, unit_price = F.col("l_quantity").cast("int"), money(F.col("l_extendedprice"), 10)
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            quantity.alias("quantity"),
            unit_price.alias("unit_price"),
            line_total(quantity, unit_price).alias("total_price"),
            F.col("l_shipdate").alias("created_at"),
        )

    def inventory_movements(self) -> DataFrame:
        kind = {"click": "IN", "view": "ADJUSTMENT", "purchase": "OUT", "signup": "RETURN"}
        notes = {
            "click": _tag("Test movement ", "event_id"),
            "view": _tag("Load test ", "event_id"),
            "purchase": _tag("Unlimited test ", "event_id"),
            "signup": _tag("Benchmark movement ", "event_id"),
        }
        return self.read("events").select(
            F.col("event_id").alias("movement_id"),
            F.col("user_id").alias("product_id"),
            _case("event_type", kind, "PROBE").alias("movement_type"),
            F.floor("value").cast("int").alias("quantity"),
            F.lit(None).cast("bigint").alias("reference_id"),
            _case("event_type", notes, None).alias("notes"),
            F.col("ts").alias("created_at"),
        )

    def all(self) -> dict[str, DataFrame]:
        return {
            "orders": self.orders(),
            "customers": self.customers(),
            "products": self.products(),
            "order_items": self.order_items(),
            "inventory_movements": self.inventory_movements(),
        }

    # -- change feeds ----------------------------------------------------------------

    def _typed_like(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        """Changes with all columns of a table, null where they carry none."""
        have = set(rows.columns)
        return rows.select(
            "op",
            F.col("seq").cast("bigint").alias("seq"),
            *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema],
        )

    def order_log(self) -> DataFrame:
        """Every line shipped updates its order; a returned line deletes it."""
        items = self.read("lineitem")
        live = F.col("l_returnflag") != "R"
        position = _position(_day("l_shipdate") * 8 + F.col("l_linenumber"), F.col("l_partkey"))
        image = {
            "customer_id": F.col("l_suppkey"),
            "order_status": _case("l_linestatus", {"O": "SHIPPED"}, "DELIVERED"),
            "total_amount": money(F.col("l_extendedprice")),
            "shipping_address": _tag("load_addr_", "l_partkey"),
            "created_at": F.col("l_shipdate"),
            "updated_at": F.col("l_shipdate"),
        }
        rows = items.select(
            F.when(live, "u").otherwise("d").alias("op"),
            position.alias("seq"),
            F.col("l_orderkey").alias("order_id"),
            *[F.when(live, v).alias(c) for c, v in image.items()],
        )
        return self._typed_like(rows, self.orders())

    def order_feed(self) -> DataFrame:
        return snapshot_rows(self.orders()).unionByName(self.order_log())

    def customer_feed(self) -> DataFrame:
        """Every order updates its customer; a closed account (debt) is deleted in between."""
        tier = {"1-URGENT": "PLATINUM", "2-HIGH": "GOLD", "3-MEDIUM": "SILVER", "5-LOW": "BRONZE"}
        updates = self.read("orders").select(
            F.lit("u").alias("op"),
            _position(_day("o_orderdate"), F.col("o_orderkey")).alias("seq"),
            F.col("o_custkey").alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.col("o_custkey").cast("string").alias("last_name"),
            _tag("user", "o_custkey", "@email.com").alias("email"),
            F.col("o_orderdate").cast("date").alias("registration_date"),
            _case("o_orderpriority", tier, None).alias("customer_tier"),
            F.lit(1).alias("total_orders"),
            money(F.col("o_totalprice"), 14).alias("total_spent"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )
        closed = self.read("customer").where(F.col("c_acctbal") < 0)
        closed = closed.select(F.lit("d").alias("op"), _position(F.lit(3000), F.lit(0)).alias("seq"), F.col("c_custkey").alias("customer_id"))
        base = self.customers()
        return union_all([snapshot_rows(base), self._typed_like(updates, base), self._typed_like(closed, base)])

    def product_feed(self) -> DataFrame:
        """Large parts are retired at a higher price, promotions are dropped."""
        base = self.products()
        retired = base.where(F.col("stock_quantity") > 25).withColumns(
            {
                "op": F.lit("u"),
                "seq": F.lit(1),
                "price": (F.col("price") * F.lit("1.10").cast("decimal(3,2)")).cast("decimal(10,2)"),
                "is_active": F.lit(False),
            }
        )
        dropped = base.where(F.col("category") == "PROMO").select(F.lit("d").alias("op"), F.lit(2).alias("seq"), "product_id")
        return union_all([snapshot_rows(base), self._typed_like(retired, base), self._typed_like(dropped, base)])

    def item_feed(self) -> DataFrame:
        """Every line is inserted; returned lines are deleted."""
        base = self.order_items()
        returned = self.read("lineitem").where(F.col("l_returnflag") == "R")
        returned = returned.select(
            F.lit("d").alias("op"),
            F.lit(2).alias("seq"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
        )
        inserted = base.select(F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq"), *base.columns)
        return inserted.unionByName(self._typed_like(returned, base))

    def movement_feed(self) -> DataFrame:
        """Every movement is inserted, none changes."""
        base = self.inventory_movements()
        return base.select(F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq"), *base.columns)

    def feeds(self, names: Iterable[str] = tuple(KEYS)) -> dict[str, DataFrame]:
        makers = {
            "orders": self.order_feed,
            "customers": self.customer_feed,
            "products": self.product_feed,
            "order_items": self.item_feed,
            "inventory_movements": self.movement_feed,
        }
        return {n: makers[n]() for n in names}

    # -- probes and loads ------------------------------------------------------------

    def _events(self) -> DataFrame:
        """Event types stand for the probed tables, the value for a hundredth of the latency."""
        table = {"click": "orders", "view": "customers", "purchase": "products", "signup": "order_items"}
        return self.read("events").select(
            F.col("event_id").alias("probe_seq"),
            _case("event_type", table, "inventory_movements").alias("table"),
            _tag("probe_", "event_id").alias("marker"),
            F.col("ts").alias("insert_ts"),
            F.round(F.col("value") * 100).cast("bigint").alias("__ms"),
        )

    def probes(self) -> DataFrame:
        return self._events().drop("__ms")

    def observed(self) -> DataFrame:
        """When each marker was seen; the slowest never were."""
        seen = F.col("insert_ts") + F.make_dt_interval(secs=(F.col("__ms") / 1000).cast("decimal(18,6)"))
        return self._events().where(F.col("__ms") < PROBE_TIMEOUT).select("table", "marker", seen.alias("visible_ts"))

    def probe_results(self) -> DataFrame:
        """Probes with their latency, straight from the events."""
        ms = F.col("__ms")
        return self._events().select(
            "probe_seq", "table", F.when(ms >= PROBE_TIMEOUT, F.lit(-1)).otherwise(ms).cast("bigint").alias("latency_ms")
        )

    def joined_probes(self) -> DataFrame:
        return probe_latency(self.probes(), self.observed())

    def load_results(self) -> DataFrame:
        ms = F.col("__ms")
        return self._events().select(
            "table", ms.alias("latency_ms"), (ms < PROBE_TIMEOUT).alias("ok"), F.col("insert_ts").alias("ts")
        )

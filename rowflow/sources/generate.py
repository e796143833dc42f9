"""Rows for load tests, reproducible under any partitioning.

Every generator takes a frame with a whole-number column ``i`` = 1, 2, 3, … (a range or a
numbered table) and derives each row from its number alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import draw, draw_letters, line_total, money, pick
from ..operators.numbering import number_rows

# Words of the deterministic load.
LOAD_TIERS = ["BRONZE", "SILVER", "GOLD"]
LOAD_CATEGORIES = ["Electronics", "Clothing", "Home", "Sports", "Books"]
LOAD_MOVEMENTS = ["IN", "OUT", "ADJUSTMENT"]
STATUSES = ["PENDING", "PROCESSING", "SHIPPED", "DELIVERED"]
# Words of the random load.
BENCH_TIERS = ["BRONZE", "SILVER", "GOLD", "PLATINUM"]
BENCH_CATEGORIES = ["Electronics", "Clothing", "Home", "Sports", "Books", "Toys", "Food"]
BENCH_MOVEMENTS = ["IN", "OUT", "ADJUSTMENT", "RETURN"]
LOAD_POOL = 10
BENCH_POOL = 100


def row_numbers(spark: SparkSession, count: int) -> DataFrame:
    """``i`` = 1 … count."""
    return spark.range(1, count + 1).withColumnRenamed("id", "i")


def id_pool(rows: DataFrame, key: str, limit: int = BENCH_POOL) -> DataFrame:
    """At most ``limit`` existing ids, the lowest ones."""
    return rows.select(key).orderBy(key).limit(limit)


def with_parent(
    rows: DataFrame, parents: DataFrame, key: str, index: Column, limit: int, fallback: int = 1, wrap: bool = False
) -> DataFrame:
    """Add a parent id from the pool of ``limit`` ids, at position ``index`` of the pool.

    A short pool repeats its last id, or begins anew with ``wrap``, which spreads random positions evenly; an
    empty pool gives the fallback.  The pool is bounded by ``limit``, so it may be broadcast whatever the parent table's size.
    """
    pool = id_pool(parents, key, limit)
    placed = pool.select(F.col(key), (F.row_number().over(Window.orderBy(key)) - 1).cast("bigint").alias("__at"))
    last = placed.agg(F.max("__at")).scalar()
    place = F.pmod(index, last + 1) if wrap else F.least(index, last)
    wanted = rows.withColumn("__at", F.coalesce(place, F.lit(0)).cast("bigint"))
    joined = wanted.join(F.broadcast(placed), "__at", "left").drop("__at")
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(fallback)))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _cents(row: Column, salt: str, low: int, high: int, precision: int = 10) -> Column:
    """An amount between two bounds in cents, both included."""
    return ((draw(row, salt, high - low + 1) + low).cast("decimal(18,0)") / 100).cast(f"decimal({precision},2)")


def load_rows(
    numbers: DataFrame, customers: DataFrame, products: DataFrame, marker: str, as_of: Column
) -> dict[str, DataFrame]:
    """The deterministic load: tiers, categories and states rotate with the row number.

    ``customers`` and ``products`` are the existing parents.  Orders are numbered by ``i``;
    the movements go once over the product pool.
    """
    i = F.col("i")
    day = as_of.cast("date")
    out = {
        "customers": numbers.select(
            F.lit("Load").alias("first_name"),
            _text(f"User_{marker}_", i).alias("last_name"),
            _text(f"load_{marker}_", i, "@example.com").alias("email"),
            _text("555-", i, "000").alias("phone"),
            day.alias("registration_date"),
            pick(LOAD_TIERS, i % 3).alias("customer_tier"),
            i.alias("total_orders"),
            money(i.cast("decimal(12,0)") * 100, 14).alias("total_spent"),
        ),
        "products": numbers.select(
            _text(f"LOAD_{marker}_", i).alias("sku"),
            _text(f"Load Product {marker}_", i).alias("product_name"),
            pick(LOAD_CATEGORIES, i % 5).alias("category"),
            _cents(i, f"{marker}:price", 0, 327670).alias("price"),
            (draw(i, f"{marker}:stock", 500) + 100).cast("int").alias("stock_quantity"),
            F.lit(True).alias("is_active"),
        ),
    }
    out["orders"] = with_parent(numbers, customers, "customer_id", i % LOAD_POOL, LOAD_POOL).select(
        i.alias("order_no"),
        "customer_id",
        pick(STATUSES, i % 4).alias("order_status"),
        _cents(i, f"{marker}:amount", 0, 327670, 12).alias("total_amount"),
        _text(f"load_addr_{marker}_", i).alias("shipping_address"),
    )
    quantity = (draw(i, f"{marker}:qty", 5) + 1).cast("int")
    unit_price = _cents(i, f"{marker}:unit", 0, 32767)
    out["order_items"] = with_parent(numbers, products, "product_id", i % LOAD_POOL, LOAD_POOL).select(
        i.alias("order_no"),
        "product_id",
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        line_total(quantity, unit_price).alias("total_price"),
    )
    pool = id_pool(products, "product_id", LOAD_POOL)
    n = F.row_number().over(Window.orderBy("product_id")).cast("bigint")
    out["inventory_movements"] = pool.withColumn("i", n).select(
        "product_id",
        pick(LOAD_MOVEMENTS, i % 3).alias("movement_type"),
        (draw(i, f"{marker}:moved", 100) + 10).cast("int").alias("quantity"),
        F.lit(None).cast("bigint").alias("reference_id"),
        _text(f"Load test {marker}_", i).alias("notes"),
    )
    return out


def batch_orders(numbers: DataFrame, marker: str) -> DataFrame:
    """The batch insert: customers 1 to 10 in turn, one numbered marker per row."""
    i = F.col("i")
    return numbers.select(
        (i % 10 + 1).alias("customer_id"),
        F.lit("BATCH").alias("order_status"),
        _cents(i, f"{marker}:amount", 0, 32767, 12).alias("total_amount"),
        _text(f"{marker}_", i).alias("shipping_address"),
    )


def random_rows(
    numbers: DataFrame, customers: DataFrame, products: DataFrame, marker: str, as_of: Column
) -> dict[str, DataFrame]:
    """The random load: bounded draws per row; children take a random parent of the pool."""
    i = F.col("i")
    at = lambda name: f"{marker}:{name}"
    words = lambda name, values: pick(values, draw(i, at(name), len(values)))
    quantity = (draw(i, at("item_qty"), 10) + 1).cast("int")
    unit_price = _cents(i, at("unit"), 100, 10000)
    buyers = with_parent(numbers, customers, "customer_id", draw(i, at("buyer"), 1 << 32), BENCH_POOL, wrap=True)
    goods = with_parent(numbers, products, "product_id", draw(i, at("good"), 1 << 32), BENCH_POOL, wrap=True)
    return {
        "customers": numbers.select(
            _text("Bench_", draw_letters(i, at("first"), 4)).alias("first_name"),
            F.lit(f"User_{marker}").alias("last_name"),
            _text(f"bench_{marker}_", draw_letters(i, at("email"), 6), i, "@example.com").alias("email"),
            _text("555-", draw(i, at("phone"), 9000) + 1000).alias("phone"),
            as_of.cast("date").alias("registration_date"),
            words("tier", BENCH_TIERS).alias("customer_tier"),
            draw(i, at("orders"), 51).cast("int").alias("total_orders"),
            _cents(i, at("spent"), 100, 500000, 14).alias("total_spent"),
        ),
        "products": numbers.select(
            _text(f"BENCH_{marker}_", F.upper(draw_letters(i, at("sku"), 8)), i).alias("sku"),
            _text("Benchmark Product ", draw_letters(i, at("name"), 6)).alias("product_name"),
            words("category", BENCH_CATEGORIES).alias("category"),
            _cents(i, at("price"), 100, 50000).alias("price"),
            (draw(i, at("stock"), 1000) + 1).cast("int").alias("stock_quantity"),
            F.lit(True).alias("is_active"),
        ),
        "orders": buyers.select(
            i.alias("order_no"),
            "customer_id",
            words("status", STATUSES).alias("order_status"),
            _cents(i, at("amount"), 100, 100000, 12).alias("total_amount"),
            _text(f"bench_addr_{marker}_", draw_letters(i, at("addr"), 8)).alias("shipping_address"),
        ),
        "order_items": goods.select(
            i.alias("order_no"),
            "product_id",
            quantity.alias("quantity"),
            unit_price.alias("unit_price"),
            line_total(quantity, unit_price).alias("total_price"),
        ),
        "inventory_movements": goods.select(
            "product_id",
            words("movement", BENCH_MOVEMENTS).alias("movement_type"),
            (draw(i, at("moved"), 100) + 1).cast("int").alias("quantity"),
            F.lit(None).cast("bigint").alias("reference_id"),
            F.lit(f"Benchmark movement {marker}").alias("notes"),
        ),
    }


def table_numbers(rows: DataFrame, key: str) -> DataFrame:
    """``i`` = 1, 2, 3, … along the key of an existing table: one generated row per row."""
    return number_rows(rows.select(key), key, name="i").select("i")

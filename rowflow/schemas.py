"""The five replicated tables: columns, keys, defaults, lengths, foreign keys.

One declaration per table serves the batch readers, the typed change feed, the
contract check and the stored tables.  Nothing is ever inferred.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import types as T

#: Default of a timestamp column filled with the load time (an explicit ``as_of``).
LOAD_TIME = object()
#: A column without a default.
NO_DEFAULT = object()


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    default: object = NO_DEFAULT
    length: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str
    on_delete: str  # 'cascade' | 'restrict'


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    columns: tuple[Column, ...]
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default=())
    touched: str | None = None  # set to the statement time by every effective update

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    def widened(self) -> Table:
        """The same table with 64-bit ids, for sources whose keys outgrew 32 bits."""
        ids = [replace(c, type=LONG) if c.name.endswith("_id") else c for c in self.columns]
        return replace(self, columns=tuple(ids))


LONG, INT, STR, BOOL, DATE = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DateType()
NTZ = T.TimestampNTZType()


def _money(precision: int) -> T.DecimalType:
    return T.DecimalType(precision, 2)


# The declared columns, lengths and defaults of the replicated tables.
ORDERS = Table(
    "orders",
    ("order_id",),
    (
        Column("order_id", LONG, True),
        Column("customer_id", INT, True),
        Column("order_status", STR, True, "PENDING", 50),
        Column("total_amount", _money(12), True, Decimal("0.00")),
        Column("shipping_address", STR, False, None, 500),
        Column("created_at", NTZ, True, LOAD_TIME),
        Column("updated_at", NTZ, True, LOAD_TIME),
    ),
    touched="updated_at",
)

CUSTOMERS = Table(
    "customers",
    ("customer_id",),
    (
        Column("customer_id", INT, True),
        Column("first_name", STR, True, length=100),
        Column("last_name", STR, True, length=100),
        Column("email", STR, True, length=255),
        Column("phone", STR, False, None, 20),
        Column("registration_date", DATE, True),
        Column("customer_tier", STR, False, "STANDARD", 20),
        Column("total_orders", INT, False, 0),
        Column("total_spent", _money(14), False, Decimal("0.00")),
        Column("created_at", NTZ, True, LOAD_TIME),
        Column("updated_at", NTZ, True, LOAD_TIME),
    ),
    unique=("email",),
    touched="updated_at",
)

PRODUCTS = Table(
    "products",
    ("product_id",),
    (
        Column("product_id", INT, True),
        Column("sku", STR, True, length=50),
        Column("product_name", STR, True, length=255),
        Column("category", STR, True, length=100),
        Column("price", _money(10), True),
        Column("stock_quantity", INT, True, 0),
        Column("is_active", BOOL, False, True),
        Column("created_at", NTZ, True, LOAD_TIME),
        Column("updated_at", NTZ, True, LOAD_TIME),
    ),
    unique=("sku",),
    touched="updated_at",
)

ORDER_ITEMS = Table(
    "order_items",
    ("item_id",),
    (
        Column("item_id", LONG, True),
        Column("order_id", LONG, True),
        Column("product_id", INT, True),
        Column("quantity", INT, True, 1),
        Column("unit_price", _money(10), True),
        Column("total_price", _money(12), True),
        Column("created_at", NTZ, True, LOAD_TIME),
    ),
    foreign_keys=(
        ForeignKey("order_id", "orders", "order_id", "cascade"),
        ForeignKey("product_id", "products", "product_id", "restrict"),
    ),
)

INVENTORY_MOVEMENTS = Table(
    "inventory_movements",
    ("movement_id",),
    (
        Column("movement_id", LONG, True),
        Column("product_id", INT, True),
        Column("movement_type", STR, True, length=20),
        Column("quantity", INT, True),
        Column("reference_id", LONG, False, None),
        Column("notes", STR, False, None, 500),
        Column("created_at", NTZ, True, LOAD_TIME),
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in (ORDERS, CUSTOMERS, PRODUCTS, ORDER_ITEMS, INVENTORY_MOVEMENTS)}

_CHANGE = [
    T.StructField("table", STR),
    T.StructField("op", STR),  # r snapshot row, c insert, u update, d delete
    T.StructField("seq", LONG),  # total order of the changes of one table
    T.StructField("ts_commit", NTZ),  # source commit time: for latency, never for ordering
]

#: Transport form of a change with both images as JSON, so that one feed carries every table.
ENVELOPE = T.StructType([*_CHANGE, T.StructField("before_json", STR), T.StructField("after_json", STR)])


def typed_envelope(row: T.StructType) -> T.StructType:
    """Transport form of the changes of a single table: its columns need no parsing."""
    return T.StructType([*_CHANGE, T.StructField("before", row), T.StructField("after", row)])


def select_tables(names: str | list[str] | None) -> list[str]:
    """Known tables out of a comma list or list; nothing usable selects all of them."""
    wanted = names.split(",") if isinstance(names, str) else list(names or [])
    wanted = [n.strip() for n in wanted]
    return [n for n in wanted if n in TABLES] or list(TABLES)


def create_table_sql(
    name: str, struct: T.StructType, location: str, keys: list[str] | tuple[str, ...] = (), buckets: int = 0
) -> str:
    """DDL of an external Parquet table, hash-bucketed and sorted on its keys when asked."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    clustered = f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS" if buckets else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{clustered} LOCATION '{location}'"

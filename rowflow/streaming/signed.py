"""Views and reference counts kept current by signed changes: what a batch took away and what it put there.

For every key that a batch mentions, the row before the batch counts -1 and the row after it +1; a change that loses
against a newer one, a copy or a replay changes nothing and counts nothing.  Sums follow by addition.  A distinct count
is kept by a helper table with one counter per group and member, and moves when a counter leaves or reaches zero.  So a refresh
looks up the batch's keys, groups and members, and no other row of the table, the view or the helper.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.views import CUSTOMER_TIERS, DAILY_ORDERS, View
from ..session import shuffles_cleared
from .refresh import covered_until, record_covered
from .store import JOB, KeyedTable

COUNTER = T.StructType().add("n", "long")


def signed_changes(table: KeyedTable, since: int, job: str = JOB, columns: tuple[str, ...] = ()) -> DataFrame | None:
    """``sign``, keys and ``columns`` of the rows that the batches from ``since`` on took away (-1) and put there (+1).

    Of columns that are all keys only rows that came or went are listed.  None when no log is stored.  One job writes the
    table: what others append counts on neither side.
    """
    if set(columns) <= set(table.keys):
        found = table.existing_since(since, job)
        sign = (F.col("__is").cast("int") - F.col("__was").cast("int")).alias("sign")
        return None if found is None else found.select(sign, *table.keys).where("sign != 0")
    states = table.moved_since(since, job, columns)
    if states is None:
        return None
    moved = states.where(~F.col("__after").eqNullSafe(F.col("__before")))
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("__before").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("__after").alias("row")))
    rows = moved.select(F.explode(sides).alias("side")).select("side.sign", "side.row.*")
    return rows.where(F.col("op").isNotNull() & (F.col("op") != "d")).drop("op", "seq")


def add_counts(counters: KeyedTable, deltas: DataFrame, since: int, batch: int, job: str = JOB) -> DataFrame:
    """Add ``n`` to the stored counters of the deltas' keys; the written changes with the count before as ``n_before``.

    A counter that reaches zero is deleted.  Counters of batches from ``since`` on are left out, so a repeated
    batch counts once, however the batches are cut the second time.
    """
    moving = deltas.where(F.col("n") != 0).persist()  # looked up and joined: added up once
    changed = _counted(counters, moving, since, batch, job).persist()
    counters.append(changed, batch, job)
    moving.unpersist()
    return changed


def store_counts(counters: KeyedTable, deltas: DataFrame, since: int, batch: int, job: str = JOB) -> None:
    """The same for any number of keys, with nothing kept: what was written is in the counters' log."""
    with counters.set_aside(deltas.where(F.col("n") != 0), job) as moving, shuffles_cleared(counters.spark):
        counters.append(_counted(counters, moving, since, batch, job), batch, job)


def _counted(counters: KeyedTable, moving: DataFrame, since: int, batch: int, job: str) -> DataFrame:
    keys = counters.keys
    old = counters.state_of(moving.select(*keys), since, job)
    before = old.select(*[F.col(k).alias(f"__{k}") for k in keys], F.when(F.col("op") != "d", F.col("n")).alias("__n"), F.col("seq").alias("__seq"))
    joined = moving.join(before, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left")
    had = F.coalesce(F.col("__n"), F.lit(0))
    position = F.greatest(F.coalesce(F.col("__seq"), F.lit(-1)), F.lit(batch).cast("bigint")) + 1
    return joined.select(
        F.when(had + F.col("n") == 0, "d").otherwise("u").alias("op"), position.alias("seq"), *keys, (had + F.col("n")).alias("n"), had.alias("n_before")
    )


@dataclass(frozen=True)
class Signed:
    """How a view is put together from sums over its rows and the number of its distinct members."""

    view: View
    sums: Callable[[], Mapping[str, Column]]  # what a row adds to each sum, never null; n counts rows
    types: T.StructType
    finish: Callable[[], list[Column]]
    member: str | None = None


class SignedView:
    """A stored view: a table of sums per group, and a counter for every group and member."""

    def __init__(self, spark: SparkSession, root: str, signed: Signed, member_type: T.DataType | None = None, buckets: int | None = None):
        self.signed, self.spark, view = signed, spark, signed.view
        self.path = f"{root.rstrip('/')}/{view.name}"
        group = view.schema[view.group]
        columns = T.StructType([group, *signed.types.fields, T.StructField("members", T.LongType())])
        self.sums = KeyedTable(spark, self.path, "sums", columns, [view.group], buckets, nullable_keys=True)
        self.members: KeyedTable | None = None
        if signed.member:
            pair = T.StructType([group, T.StructField(signed.member, member_type), *COUNTER.fields])
            self.members = KeyedTable(spark, self.path, "members", pair, [view.group, signed.member], buckets, nullable_keys=True)

    @property
    def tables(self) -> list[KeyedTable]:
        return [t for t in (self.sums, self.members) if t is not None]

    def current(self) -> DataFrame:
        """The view's rows."""
        schema = self.signed.view.schema
        rows = self.sums.current().select(self.signed.view.group, *self.signed.finish())
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    def fold(self) -> None:
        for table in self.tables:
            table.fold()

    def compact(self) -> None:
        for table in self.tables:
            table.compact()

    def vacuum(self, keep: int = 2) -> None:
        for table in self.tables:
            table.vacuum(keep)

    def _grouped(self, rows: DataFrame, sign: Column) -> tuple[DataFrame, DataFrame | None]:
        """Sums per group, and counts per group and member, of signed rows."""
        view, member = self.signed.view, self.signed.member
        grouped = rows.withColumn(view.group, view.group_by())
        added = [F.sum(F.when(sign < 0, -c).otherwise(c)).cast(self.signed.types[n].dataType).alias(n) for n, c in self.signed.sums().items()]
        counts = None
        if member:
            counts = grouped.where(F.col(member).isNotNull()).groupBy(view.group, member).agg(F.sum(sign).cast("bigint").alias("n"))
        return grouped.groupBy(view.group).agg(*added), counts

    def build(self, table: KeyedTable) -> SignedView:
        """Create the stored view from the table as it is, and note which batches that covers."""
        view, one = self.signed.view, F.lit(1)
        for job, batch in table.stored_batches().items():
            record_covered(self, batch, job)
        sums, counts = self._grouped(table.current(columns=view.reads), one)
        meta = [F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("seq")]
        if self.members is None:
            sums = sums.withColumn("members", F.lit(0).cast("bigint"))
        else:
            self.members.create(counts.select(*meta, *counts.columns))
            found = self.members.current().groupBy(view.group).agg(F.count(F.lit(1)).alias("members"))
            found = found.withColumnRenamed(view.group, "__group")
            sums = sums.join(found, F.col(view.group).eqNullSafe(F.col("__group")), "left").drop("__group")
            sums = sums.fillna(0, ["members"])
        self.sums.create(sums.select(*meta, *sums.columns))
        return self

    def refresh(self, table: KeyedTable, batch: int, job: str = JOB) -> None:
        """Take in the table's batches since the last refresh, up to this one."""
        since = covered_until(self, job) or 0
        if since > batch:
            return
        rows = signed_changes(table, since, job, self.signed.view.reads)
        if rows is not None:
            rows = rows.persist()
            try:
                if not rows.isEmpty():
                    self._add(rows, since, batch, job)
            finally:
                rows.unpersist()
        record_covered(self, batch, job)

    def _add(self, rows: DataFrame, since: int, batch: int, job: str) -> None:
        view, names = self.signed.view, self.signed.types.names
        deltas, counts = self._grouped(rows, F.col("sign"))
        changed = None
        if self.members is None:
            deltas = deltas.withColumn("members", F.lit(0).cast("bigint"))
        else:
            changed = add_counts(self.members, counts, since, batch, job)
            step = F.when(F.col("op") == "d", -1).otherwise(F.when(F.col("n_before") == 0, 1).otherwise(0))
            steps = changed.groupBy(F.col(view.group).alias("__group")).agg(F.sum(step).cast("bigint").alias("members"))
            deltas = deltas.join(steps, F.col(view.group).eqNullSafe(F.col("__group")), "left").drop("__group").fillna(0, ["members"])
        old = self.sums.state_of(deltas.select(view.group), since, job)
        before = old.where(F.col("op") != "d").select(F.col(view.group).alias("__group"), *[F.col(n).alias(f"__{n}") for n in (*names, "members")])
        positions = old.select(F.col(view.group).alias("__at"), F.col("seq").alias("__seq"))
        joined = deltas.join(before, F.col(view.group).eqNullSafe(F.col("__group")), "left")
        joined = joined.join(positions, F.col(view.group).eqNullSafe(F.col("__at")), "left")
        total = {n: F.col(n) + F.coalesce(F.col(f"__{n}"), F.lit(0)) for n in (*names, "members")}
        position = F.greatest(F.coalesce(F.col("__seq"), F.lit(-1)), F.lit(batch).cast("bigint")) + 1
        self.sums.append(
            joined.select(F.when(total["n"] == 0, "d").otherwise("u").alias("op"), position.alias("seq"), view.group, *[c.alias(n) for n, c in total.items()]),
            batch,
            job,
        )
        if changed is not None:
            changed.unpersist()


_MONEY = "decimal(38,2)"


def _money(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast(_MONEY)


def _known(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), 1).otherwise(0)


def _ratio(total: Column, n: Column) -> Column:
    return total.cast("double") / n.cast("double")


def _daily() -> list[Column]:
    revenue = F.when(F.col("known") > 0, F.col("amount"))
    return [
        F.col("n").alias("total_orders"),
        revenue.alias("total_revenue"),
        _ratio(revenue, F.col("n")).alias("avg_order_value"),
        F.col("members").alias("unique_customers"),
    ]


def _tiers() -> list[Column]:
    spent = F.when(F.col("known") > 0, F.col("spent"))
    return [
        F.col("n").alias("customer_count"),
        F.when(F.col("counted") > 0, F.col("orders")).alias("total_orders"),
        spent.alias("total_revenue"),
        _ratio(spent, F.nullif(F.col("known"), F.lit(0))).alias("avg_customer_value"),
    ]


SIGNED_DAILY_ORDERS = Signed(
    DAILY_ORDERS,
    lambda: {"n": F.lit(1), "amount": _money("total_amount"), "known": _known("total_amount")},
    T.StructType().add("n", "long").add("amount", _MONEY).add("known", "long"),
    _daily,
    "customer_id",
)

SIGNED_CUSTOMER_TIERS = Signed(
    CUSTOMER_TIERS,
    lambda: {
        "n": F.lit(1),
        "orders": F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint"),
        "counted": _known("total_orders"),
        "spent": _money("total_spent"),
        "known": _known("total_spent"),
    },
    T.StructType().add("n", "long").add("orders", "long").add("counted", "long").add("spent", _MONEY).add("known", "long"),
    _tiers,
)

"""Foreign keys kept current: how many children refer to each parent, and which references have no parent.

Both tables follow the stream by the batch's own rows.  Children that a batch took away or put there move the
counter of their parent; references whose counter moved, and parents that came or went, are looked up and become or
cease to be orphans.  Neither the children nor the parents are read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_cleared
from .refresh import covered_until, record_covered
from .signed import COUNTER, signed_changes, store_counts
from .store import JOB, KeyedTable


class References:
    """The references of ``child.column`` to the key of ``parent``; a null reference refers to nothing.

    ``uses`` has the number of children of every reference that has some, ``orphans`` those of references without a parent.
    """

    def __init__(self, spark: SparkSession, root: str, child: str, parent: str, column: str, kind: T.DataType, buckets: int | None = None):
        self.spark, self.child, self.parent, self.column = spark, child, parent, column
        self.path = f"{root.rstrip('/')}/{child}_{column}"
        columns = T.StructType([T.StructField(column, kind), *COUNTER.fields])
        self.uses = KeyedTable(spark, self.path, "uses", columns, [column], buckets)
        self.orphans = KeyedTable(spark, self.path, "orphans", columns, [column], buckets)

    @property
    def tables(self) -> list[KeyedTable]:
        return [self.uses, self.orphans]

    def build(self, children: KeyedTable, parents: KeyedTable) -> References:
        """Create both tables from the tables as they are, and note which batches that covers."""
        known, gone = children.stored_batches(), parents.stored_batches()
        for job in known.keys() | gone.keys():
            record_covered(self, max(known.get(job, -1), gone.get(job, -1)), job)
        meta = [F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("seq")]
        rows = children.current(columns=[self.column]).where(F.col(self.column).isNotNull())
        self.uses.create(rows.groupBy(self.column).agg(F.count(F.lit(1)).alias("n")).select(*meta, self.column, "n"))
        keys = parents.current(columns=[]).select(F.col(parents.keys[0]).alias(self.column))
        self.orphans.create(self.uses.current().join(keys, self.column, "left_anti").select(*meta, self.column, "n"))
        return self

    def refresh(self, children: KeyedTable, parents: KeyedTable, batch: int, job: str = JOB) -> None:
        """Take in both tables' batches since the last refresh, up to this one."""
        since = covered_until(self, job) or 0
        if since > batch:  # a batch that is repeated after it was taken in would replace its counts by none
            return
        moved = signed_changes(children, since, job, (self.column,))
        counted = None
        if moved is not None:
            moved = moved.where(F.col(self.column).isNotNull())
            store_counts(self.uses, moved.groupBy(self.column).agg(F.sum("sign").cast("bigint").alias("n")), since, batch, job)
            counted = self.uses.changes_since(batch, job)
        came = signed_changes(parents, since, job)
        touched = [rows for rows in (counted, came and came.select(F.col(parents.keys[0]).alias(self.column))) if rows is not None]
        if touched:
            self._look_up([rows.select(self.column) for rows in touched], parents, batch, job)
        record_covered(self, batch, job)

    def _look_up(self, touched: list[DataFrame], parents: KeyedTable, batch: int, job: str) -> None:
        """Write what the touched references are now: orphans with their count, or deleted."""
        keys = touched[0] if len(touched) == 1 else touched[0].unionByName(touched[1])
        with self.orphans.set_aside(keys.distinct(), job) as keys, shuffles_cleared(self.spark):
            if keys.isEmpty():
                return
            used = self.uses.state_of(keys).where(F.col("op") != "d").select(self.column, "n")
            parent = parents.keys[0]
            asked = keys.select(F.col(self.column).alias(parent))
            found = parents.state_of(asked, columns=()).where(F.col("op") != "d").select(F.col(parent).alias(self.column), F.lit(True).alias("__found"))
            state = keys.join(used, self.column, "left").join(found, self.column, "left")
            orphaned = F.col("n").isNotNull() & F.col("__found").isNull()
            op, seq = F.when(orphaned, "u").otherwise("d").alias("op"), F.lit(batch + 1).cast("bigint").alias("seq")
            self.orphans.append(state.select(op, seq, self.column, F.when(orphaned, F.col("n")).alias("n")), batch, job)

    def restrict(self, candidates: DataFrame, column: str | None = None) -> DataFrame:
        """Candidates for deletion, with their key in ``column``, and ``allowed``: false where a child still refers to the row."""
        column = column or self.column
        asked = candidates.select(F.col(column).alias(self.column)).where(F.col(self.column).isNotNull()).distinct()
        used = self.uses.state_of(asked).where(F.col("op") != "d").select(F.col(self.column).alias("__used"))
        joined = candidates.join(used, F.col(column) == F.col("__used"), "left")
        return joined.select(*candidates.columns, F.col("__used").isNull().alias("allowed"))

    def fold(self) -> None:
        for table in self.tables:
            table.fold()

    def compact(self) -> None:
        for table in self.tables:
            table.compact()

    def vacuum(self, keep: int = 2) -> None:
        for table in self.tables:
            table.vacuum(keep)

"""Foreign keys and column contracts, checked on settled state."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Table
from .dml import delete_events
from .skew import join_to_unique


def fk_orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Child rows whose reference is set but has no parent.

    Parent keys are unique; a single parent may have any share of the children.
    """
    keys = parent.select(F.col(parent_column or column).alias(column))
    return join_to_unique(child.where(F.col(column).isNotNull()), keys, column, "left_anti")


def cascade_events(parent_deletes: DataFrame, children: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Deletes of the children of deleted parents, at the parent's position.

    A row-level log does not show deletes that the source's engine cascades by itself;
    without these events such children would stay in the target for ever.
    """
    gone = parent_deletes.where(F.col("op") == "d").select(
        F.col(f"before.{parent_column or column}").alias(column), F.col("seq").alias("__seq")
    )
    gone = gone.groupBy(column).agg(F.max("__seq").alias("__seq"))
    doomed = join_to_unique(children, gone, column, "inner").select(*children.columns, "__seq")
    image = F.struct(*[F.col(c) for c in children.columns])
    return doomed.select(
        F.lit("d").alias("op"),
        F.col("__seq").alias("seq"),
        image.alias("before"),
        F.lit(None).cast(children.schema).alias("after"),
    )


def restrict_deletes(
    candidates: DataFrame, children: DataFrame, column: str, child_column: str | None = None
) -> DataFrame:
    """Candidates with ``allowed``: false where a child still refers to the row."""
    used = children.select(F.col(child_column or column).alias(column)).distinct().withColumn("__used", F.lit(True))
    return candidates.join(used, column, "left").select(
        *candidates.columns, F.col("__used").isNull().alias("allowed")
    )


def allowed_delete_events(candidates: DataFrame, children: DataFrame, column: str, seq: int) -> DataFrame:
    """Delete events of the candidates that nothing refers to."""
    used = children.select(column).distinct()  # a hot reference is reduced before the shuffle
    free = candidates.join(used, column, "left_anti").select(*candidates.columns)
    return delete_events(free, F.lit(True), seq)


def violations(table: Table, columns: Iterable[str], bytes_count: bool = True) -> Column:
    """Array of broken rules of a row, in column order; empty for a good row.

    The target counts a string's length in bytes; pass ``bytes_count=False`` for characters.
    """
    present = set(columns)
    rules = []
    for c in table.columns:
        if c.name not in present:
            continue
        col = F.col(c.name)
        if c.required:
            rules.append(F.when(col.isNull(), F.lit(f"{c.name}: null")))
        if c.length is not None:
            size = F.octet_length(col) if bytes_count else F.char_length(col)
            rules.append(F.when(size > c.length, F.lit(f"{c.name}: longer than {c.length}")))
    return F.array_compact(F.array(*rules))


def contract_violations(rows: DataFrame, table: Table, bytes_count: bool = True) -> DataFrame:
    """Rows that the target would refuse, with ``reasons``."""
    return split_contract(rows, table, bytes_count)[1]


def split_contract(rows: DataFrame, table: Table, bytes_count: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with ``reasons``.  Deletes need only a key and are good."""
    checked = rows.withColumn("__broken", violations(table, rows.columns, bytes_count))
    bad = F.size("__broken") > 0
    if "op" in rows.columns:
        bad = bad & (F.col("op") != "d")
    good = checked.where(~bad).drop("__broken")
    return good, checked.where(bad).withColumn("reasons", F.concat_ws("; ", "__broken")).drop("__broken")

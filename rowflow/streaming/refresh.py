"""Incremental refresh of grouped views after a batch of changes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.views import View
from .store import JOB, KeyedTable


def view_table(table: KeyedTable, root: str, view: View, buckets: int | None = None) -> KeyedTable:
    """The stored form of a view: one more keyed table, its group as the key (which may be null)."""
    return KeyedTable(table.spark, root, view.name, view.schema, [view.group], buckets, nullable_keys=True)


def build_view(table: KeyedTable, stored: KeyedTable, view: View) -> KeyedTable:
    """Create the stored view from the table as it is."""
    rows = view.compute(table.current(columns=view.reads))
    return stored.create(rows.select(F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("seq"), *rows.columns))


def affected_groups(
    table: KeyedTable, stored: KeyedTable, view: View, since: int | None, job: str = JOB
) -> DataFrame | None:
    """Groups that a changed key was in before batch ``since``, and groups of the changes' own rows.

    A change that loses against a newer one may add a group; recomputing it does no harm.
    Without ``since`` these are all groups, of the table and of the view; None when nothing was stored since.
    """
    if since is None:
        return view.groups(table.current(columns=view.reads)).unionByName(stored.current().select(view.group)).distinct()
    changes = table.changes_since(since, job)
    if changes is None:
        return None
    before = table.current(since, job, view.reads).join(changes.select(*table.keys), table.keys, "left_semi")
    return view.groups(before).unionByName(view.groups(changes.where(F.col("op") != "d"))).distinct()


def refresh_view(
    table: KeyedTable, stored: KeyedTable, view: View, since: int | None, batch: int, job: str = JOB
) -> None:
    """Recompute the groups affected since a batch and upsert them; a group without rows is deleted.

    A running aggregate could not take back the old values of updated and deleted rows.
    ``since=None`` refreshes the whole view, as after a restart, when nobody knows what the
    last refresh had covered.
    """
    affected = affected_groups(table, stored, view, since, job)
    if affected is None:
        return
    groups = affected.withColumnRenamed(view.group, "__group").persist()
    try:
        if groups.isEmpty():  # a batch without changes of this table
            return
        position = stored.state().agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1
        rows = table.current(columns=view.reads)
        if since is not None:
            rows = rows.join(groups, view.group_by().eqNullSafe(F.col("__group")), "left_semi")
        fresh = view.compute(rows).withColumn("__found", F.lit(True))
        rest = [f.name for f in view.schema.fields if f.name != view.group]
        joined = groups.join(fresh, F.col("__group").eqNullSafe(F.col(view.group)), "left")
        changes = joined.select(
            F.when(F.col("__found"), "u").otherwise("d").alias("op"),
            F.lit(position).cast("bigint").alias("seq"),
            F.col("__group").alias(view.group),
            *rest,
        )
        stored.append(changes, batch, job)
    finally:
        groups.unpersist()


def covered_until(stored, job: str = JOB) -> int | None:
    """The first batch of a job that the stored view does not cover yet; None when it never recorded one."""
    try:
        marks = stored.spark.read.schema("next bigint").json(f"{stored.path}/covered/job={job}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return marks.agg(F.max("next")).first()[0]


def record_covered(stored, batch: int, job: str = JOB) -> None:
    """Note that the view covers every batch up to this one, so that a restart goes on from there."""
    row = stored.spark.range(1).select(F.lit(batch + 1).cast("bigint").alias("next"))
    row.write.mode("overwrite").json(f"{stored.path}/covered/job={job}")

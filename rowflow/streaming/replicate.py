"""Continuous replication: a stream of change envelopes into keyed tables."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import elapsed_ms
from ..operators.dml import event_rows
from ..operators.integrity import split_contract
from ..plans.views import View
from ..schemas import Table, select_tables
from ..sources.changes import bad_envelopes, checked_events, good_events, read_changes, undecodable
from .lag import RowCounts
from .probes import ProbeStatistics
from .references import References
from .refresh import covered_until, record_covered, refresh_view
from .signed import SignedView
from .store import KeyedTable

# Fixed value: how often a sink flushes.
FLUSH_INTERVAL = "5 seconds"

_COMMIT = "__commit"

ARRIVED = (
    "table string, changes bigint, deletes bigint, last_seq bigint, "
    "first_commit bigint, avg_commit double, last_commit bigint"
)


@dataclass(frozen=True)
class Upkeep:
    """How many batches lie between two runs of each upkeep task; None leaves it out.

    A fold costs as much as the changes since the last one, a compaction rewrites the table.  A refresh of a
    ``SignedView`` looks up what the batches touched, one of a plain stored view reads the view's columns of the table.
    """

    refresh_every: int | None = 1
    fold_every: int | None = 60
    compact_every: int | None = None
    keep_versions: int | None = None


class BatchApplier:
    """Applies one micro-batch to every table it mentions.

    The writes of a batch are not atomic together.  Each of them replaces itself when the
    batch is repeated, so a restart in the middle completes the batch instead of doubling it.
    """

    def __init__(
        self,
        tables: Mapping[str, KeyedTable],
        root: str,
        views: Mapping[str, list[tuple[View, KeyedTable | SignedView]]] | None = None,
        contracts: Mapping[str, Table] | None = None,
        upkeep: Upkeep | None = None,
        markers: Mapping[str, tuple[str, Column]] | None = None,
        source_zone: str = "UTC",
        references: Iterable[References] = (),
        statistics: ProbeStatistics | None = None,
        counts: RowCounts | None = None,
    ):
        self.tables = dict(tables)
        self.root = root.rstrip("/")
        self.views = {n: v for n, v in (views or {}).items() if n in self.tables}
        self.contracts = dict(contracts or {})
        self.upkeep = upkeep or Upkeep()
        self.markers = dict(markers or {})
        self.source_zone = source_zone
        self.references = [r for r in references if r.child in self.tables and r.parent in self.tables]
        self.statistics = statistics.create() if statistics else None
        self.counts = counts
        self.job = hashlib.md5(self.root.encode()).hexdigest()[:8]
        self.refreshed: dict[str, int | None] = {}  # next batch to refresh from, per view

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Not kept: what arrived is in a few columns, and a table's changes are found by the name that its files have it in.
        mine = batch.where(F.col("table").isin(*self.tables) | F.col("table").isNull())
        found = self._arrived(mine)
        arrived = [r for r in found if r["table"] is not None]
        if len(found) > len(arrived):
            undecodable(mine).write.mode("overwrite").json(f"{self.root}/unreadable/undecodable/batch={batch_id}")
        for name in sorted(r["table"] for r in arrived):
            self._apply(mine, name, batch_id)
        if arrived:
            self._measure(batch.sparkSession, arrived, batch_id)
        self._keep_up(batch_id)

    def _apply(self, batch: DataFrame, name: str, batch_id: int) -> None:
        table = self.tables[name]
        checked = checked_events(batch, name, table.columns, table.keys)
        several = "after" not in batch.columns and (name in self.contracts or name in self.markers)
        if several:
            checked = checked.persist()  # images are parsed once, whatever reads them
        try:
            self._write(checked, batch.columns, name, batch_id)
        finally:
            if several:
                checked.unpersist()

    def _write(self, checked: DataFrame, columns: list[str], name: str, batch_id: int) -> None:
        """Write a table's changes, counting those that cannot be read on the way: only where there are some, they are looked for."""
        table = self.tables[name]
        probed = name in self.markers
        seen = Observation()
        counted = checked.observe(seen, F.count_if(F.col("reasons") != "").alias("unreadable"))
        kept = [_COMMIT] if probed else []
        changes = event_rows(good_events(counted).withColumnRenamed("ts_commit", _COMMIT), table.keys, kept)
        if name in self.contracts:
            changes = split_contract(changes, self.contracts[name])[0]
        table.append(changes, batch_id, self.job)
        if seen.get.get("unreadable", 0):
            bad_envelopes(checked, columns).write.mode("overwrite").json(f"{self.root}/unreadable/{name}/batch={batch_id}")
        if probed or name in self.contracts:
            changes = event_rows(good_events(checked).withColumnRenamed("ts_commit", _COMMIT), table.keys, kept)
        if name in self.contracts:
            changes, bad = split_contract(changes, self.contracts[name])
            bad.drop(_COMMIT).write.mode("overwrite").json(f"{self.root}/quarantine/{name}/batch={batch_id}")
        if probed:
            self._observe(changes, name, batch_id)

    def _observe(self, changes: DataFrame, name: str, batch_id: int) -> None:
        """Note when the marked rows of a batch could be read, on the source's clock face."""
        column, marked = self.markers[name]
        now = F.timestamp_millis(F.lit(int(time.time() * 1000)).cast("bigint"))
        visible = F.convert_timezone(F.lit("UTC"), F.lit(self.source_zone), F.to_utc_timestamp(now, F.current_timezone()).cast("timestamp_ntz"))
        probes = changes.where((F.col("op") != "d") & marked)
        seen = probes.select(F.lit(name).alias("table"), F.col(column).alias("marker"))
        if self.statistics:
            self.statistics.observe(probes, name, column, visible, batch_id, self.job)
        seen.distinct().withColumn("visible_ts", visible).write.mode("overwrite").parquet(
            f"{self.root}/observed/table={name}/batch={batch_id}"
        )

    def _keep_up(self, batch_id: int) -> None:
        """Refresh, fold and compact as often as asked; a refresh always comes before a fold."""
        due = {what: every and (batch_id + 1) % every == 0 for what, every in vars(self.upkeep).items()}
        if due["refresh_every"] or due["fold_every"] or due["compact_every"]:
            for name, views in self.views.items():
                for view, stored in views:
                    if isinstance(stored, SignedView):
                        stored.refresh(self.tables[name], batch_id, self.job)
                        continue
                    if view.name not in self.refreshed:  # after a restart
                        self.refreshed[view.name] = covered_until(stored, self.job)
                    since = self.refreshed[view.name]
                    refresh_view(self.tables[name], stored, view, since, batch_id, self.job)
                    record_covered(stored, batch_id, self.job)
                    self.refreshed[view.name] = batch_id + 1
            for kept in self.references:
                kept.refresh(self.tables[kept.child], self.tables[kept.parent], batch_id, self.job)
            for table in self.tables.values() if self.counts else ():
                self.counts.refresh(table, batch_id, self.job)
        if not (due["fold_every"] or due["compact_every"]):
            return
        for table in [*self.tables.values(), *(s for views in self.views.values() for _, s in views), *self.references, *filter(None, [self.statistics, self.counts])]:
            table.compact() if due["compact_every"] else table.fold()
            if self.upkeep.keep_versions:
                table.vacuum(self.upkeep.keep_versions)

    def _arrived(self, batch: DataFrame) -> list[Row]:
        """What the batch holds, over every row of it: one small row per table."""
        commit = F.convert_timezone(F.lit(self.source_zone), F.lit("UTC"), F.col("ts_commit"))
        commit_ms = elapsed_ms(F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), commit)
        return (
            batch.groupBy("table")
            .agg(
                F.count(F.lit(1)).alias("changes"),
                F.count_if(F.col("op") == "d").alias("deletes"),
                F.max("seq").alias("last_seq"),
                F.min(commit_ms).alias("first_commit"),
                F.avg(commit_ms).alias("avg_commit"),
                F.max(commit_ms).alias("last_commit"),
            )
            .collect()
        )

    def _measure(self, spark: SparkSession, arrived: list[Row], batch_id: int) -> None:
        """Record the latency from commit to visible, now that the batch can be read."""
        now = F.lit(int(time.time() * 1000)).cast("bigint")
        rows = spark.createDataFrame(arrived, ARRIVED).select(
            "table",
            "changes",
            "deletes",
            "last_seq",
            (now - F.col("last_commit")).alias("min_ms"),
            (now - F.col("avg_commit")).alias("avg_ms"),
            (now - F.col("first_commit")).alias("max_ms"),
            now.alias("visible_ms"),
        )
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/metrics/batch={batch_id}")


def batch_metrics(tables: Mapping[str, KeyedTable], root: str) -> DataFrame | None:
    """The measured batches so far, one row per batch and table."""
    spark = next(iter(tables.values())).spark
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/metrics")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def observed_markers(spark: SparkSession, root: str) -> DataFrame | None:
    """``table, marker, visible_ts`` of the marked rows a job has made visible so far."""
    try:
        return spark.read.schema("table string, marker string, visible_ts timestamp_ntz").parquet(f"{root.rstrip('/')}/observed")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def routed_feed(spark: SparkSession, path: str, **options: object) -> Callable[[list[str], bool], DataFrame]:
    """A feed in folders per table, for ``start``: every job lists and reads the folders of its own tables only."""
    return lambda names, unnamed: read_changes(spark, path, tables=names, unnamed=unnamed, **options)


def start(
    feed: DataFrame | Callable[[list[str], bool], DataFrame],
    tables: Mapping[str, KeyedTable],
    root: str,
    mode: str = "single",
    interval: str | None = FLUSH_INTERVAL,
    views: Mapping[str, list[tuple[View, KeyedTable | SignedView]]] | None = None,
    contracts: Mapping[str, Table] | None = None,
    upkeep: Upkeep | None = None,
    name: str = "replicate",
    markers: Mapping[str, tuple[str, Column]] | None = None,
    source_zone: str = "UTC",
    references: Iterable[References] = (),
    statistics: ProbeStatistics | None = None,
    counts: RowCounts | None = None,
    select: str | list[str] | None = None,
) -> list[StreamingQuery]:
    """Start replicating ``feed`` into ``tables``.

    ``markers`` gives, for tables with probe rows, the column of their marker and what tells them from others;
    ``source_zone`` is the zone of the source's commit times, ``references`` are kept current by the job that has both of
    their tables, ``statistics`` of the waits from commit to visible and
    the row ``counts`` by a single job.  ``select`` names the tables to replicate, out of ``tables``.  A ``routed_feed`` is asked for
    the changes of each job's tables, and gives those of no table to the first job.  ``single`` runs one query for all tables, ``per_table`` one query per table with a
    checkpoint of its own.  ``interval=None`` works off what is there and stops.
    """
    if mode not in ("single", "per_table"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode != "single" and not (statistics is None and counts is None):
        raise ValueError("one job keeps statistics and counts: several would fold each other's batches")
    if select is not None:
        tables = {n: tables[n] for n in select_tables(select) if n in tables}
    groups: list[tuple[str, dict[str, KeyedTable]]] = (
        [("all", dict(tables))] if mode == "single" else [(n, {n: t}) for n, t in tables.items()]
    )
    started = []
    for number, (label, group) in enumerate(groups):
        changes = feed(list(group), number == 0) if callable(feed) else feed
        folder = f"{root.rstrip('/')}/{name}-{label}"
        for table in group.values():
            table.create()
        applier = BatchApplier(group, folder, views, contracts, upkeep, markers, source_zone, references, statistics, counts)
        writer = (
            changes.writeStream.queryName(f"{name}-{label}")
            .foreachBatch(applier)
            .option("checkpointLocation", f"{folder}/checkpoint")
        )
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        started.append(writer.trigger(**trigger).start())
    return started


def run_available(feed: DataFrame | Callable[[list[str], bool], DataFrame], tables: Mapping[str, KeyedTable], root: str, **options: object) -> None:
    """Apply everything the feed holds now, then return."""
    await_queries(start(feed, tables, root, interval=None, **options))


def await_queries(queries: Iterable[StreamingQuery], timeout: int | None = None) -> bool:
    """Wait for all queries; false when any still runs after ``timeout`` seconds."""
    done = [q.awaitTermination(timeout) if timeout else q.awaitTermination() or True for q in queries]
    return all(done)

"""Lag of the targets over time: kept row counts, and samples of them beside the source's.

``RowCounts`` follows the tables by what each batch took away and put there, so the count of a target is one stored row and
not a scan.  ``LagSampler`` listens to the running queries and writes one row per table and interval, also while they are
idle and a source may run ahead.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.sync import sync_report, table_counts
from .refresh import covered_until, record_covered
from .signed import COUNTER, add_counts, signed_changes
from .store import JOB, MIN_BUCKETS, KeyedTable

SAMPLE = "table string, ts timestamp_ntz, source_count bigint, target_count bigint, lag bigint, lag_label string, status string"


class RowCounts:
    """How many rows each of some stored tables has."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/row_counts"
        columns = T.StructType([T.StructField("table", T.StringType()), *COUNTER.fields])
        self.counts = KeyedTable(spark, self.path, "counts", columns, ["table"], MIN_BUCKETS)

    def build(self, tables: Mapping[str, KeyedTable]) -> RowCounts:
        """Count the tables as they are, and note which batches that covers."""
        for name, table in tables.items():
            for job, batch in table.stored_batches().items():
                record_covered(self, batch, f"{job}-{name}")
        counted = table_counts({n: t.current(columns=[]) for n, t in tables.items()}, "n")
        self.counts.create(counted.select(F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("seq"), "table", "n"))
        return self

    def refresh(self, table: KeyedTable, batch: int, job: str = JOB) -> None:
        """Take in the table's batches since the last refresh, up to this one; a repeated batch counts once."""
        label = f"{job}-{table.name}"
        since = covered_until(self, label) or 0
        if since > batch:
            return
        rows = signed_changes(table, since, job)
        if rows is not None:
            moved = rows.agg(F.coalesce(F.sum("sign"), F.lit(0)).cast("bigint").alias("n"))
            add_counts(self.counts, moved.select(F.lit(table.name).alias("table"), "n"), since, batch, label).unpersist()
        record_covered(self, batch, label)

    def current(self) -> DataFrame:
        """``table, row_count`` of the tables that have rows."""
        return self.counts.current().select("table", F.col("n").alias("row_count"))

    def fold(self) -> None:
        self.counts.fold()

    def compact(self) -> None:
        self.counts.compact()

    def vacuum(self, keep: int = 2) -> None:
        self.counts.vacuum(keep)


class LagSampler(StreamingQueryListener):
    """Writes ``table, ts, source_count, target_count, lag`` whenever ``interval`` seconds have gone by.

    ``source`` gives the source's ``table, row_count`` as it is at that moment, every table of interest once; a target
    without a stored count is empty.  Only queries whose name begins with ``name`` are listened to.
    """

    def __init__(
        self,
        source: Callable[[], DataFrame],
        target: RowCounts,
        root: str,
        interval: float = 5.0,
        name: str = "replicate",
        clock: Callable[[], float] = time.time,
    ):
        self.source, self.target, self.interval, self.name, self.clock = source, target, interval, name, clock
        self.path = f"{root.rstrip('/')}/lag"
        self.queries: set[str] = set()
        self.last: float | None = None

    def onQueryStarted(self, event) -> None:
        if (event.name or "").startswith(self.name):
            self.queries.add(str(event.id))

    def onQueryProgress(self, event) -> None:
        self._due(str(event.progress.id))

    def onQueryIdle(self, event) -> None:
        self._due(str(event.id))

    def onQueryTerminated(self, event) -> None:
        self.queries.discard(str(event.id))

    def _due(self, query: str) -> None:
        if query in self.queries and (self.last is None or self.clock() - self.last >= self.interval):
            self.sample()

    def sample(self) -> None:
        """Write one row per table now."""
        self.last = self.clock()
        source = self.source()
        counted = source.select("table").join(self.target.current(), "table", "left").fillna(0, ["row_count"])
        now = F.timestamp_millis(F.lit(int(self.last * 1000)).cast("bigint"))
        ts = F.to_utc_timestamp(now, F.current_timezone()).cast("timestamp_ntz")
        rows = sync_report(source, counted).withColumn("ts", ts)
        rows.select("table", "ts", "source_count", "target_count", "lag", "lag_label", "status").coalesce(1).write.mode("append").parquet(self.path)


def lag_samples(spark: SparkSession, root: str) -> DataFrame | None:
    """The samples so far; None before the first."""
    try:
        return spark.read.schema(SAMPLE).parquet(f"{root.rstrip('/')}/lag")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise

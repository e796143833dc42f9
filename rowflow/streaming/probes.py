"""Probe statistics of a running job: waits from commit to visible, added up batch by batch.

Four small tables follow the probes.  ``probes`` knows every marker, so a marker that shows again, late or in a replay,
is counted once; ``histogram`` counts equal waits, which the probe timeout bounds; ``history`` has the newest successes of
each table and ``newest`` the last probe.  A batch looks up its own markers and waits, and old probes are never read again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import elapsed_ms
from ..functions.labels import PROBE_TIMEOUT
from ..operators.latency import HISTORY, counted_success, last_n, last_of, stats_of_counts
from ..schemas import TABLES
from .refresh import covered_until, record_covered
from .signed import COUNTER, add_counts
from .store import JOB, MIN_BUCKETS, KeyedTable

_PROBE = T.StructType().add("probe_seq", "long").add("latency_ms", "long")


def waits(inserted: Column, visible: Column, timeout_ms: int = PROBE_TIMEOUT) -> Column:
    """Milliseconds until a row was visible, 0 where clocks differ; -1 when it took too long or its insert time is unknown."""
    elapsed = F.greatest(elapsed_ms(inserted, visible), F.lit(0))
    return F.when(inserted.isNotNull() & (elapsed < timeout_ms), elapsed).otherwise(F.lit(-1)).cast("bigint")


class ProbeStatistics:
    """Exact statistics over all probes and over the last ``keep`` successes of each table."""

    def __init__(self, spark: SparkSession, root: str, keep: int = HISTORY, timeout_ms: int = PROBE_TIMEOUT, buckets: int | None = None):
        self.spark, self.keep, self.timeout_ms = spark, keep, timeout_ms
        self.path = f"{root.rstrip('/')}/probe_statistics"
        name, key = T.StructField("table", T.StringType()), T.StructField("marker", T.StringType())
        place, wait = T.StructField("place", T.IntegerType()), _PROBE["latency_ms"]

        def small(label: str, columns: list[T.StructField], keys: list[str], n: int | None = MIN_BUCKETS) -> KeyedTable:
            return KeyedTable(spark, self.path, label, T.StructType(columns), keys, n, nullable_keys=True)

        self.probes = small("probes", [name, key, *_PROBE], ["table", "marker"], buckets)
        self.histogram = small("histogram", [name, wait, *COUNTER], ["table", "latency_ms"])
        self.history = small("history", [name, place, *_PROBE], ["table", "place"])
        self.newest = small("newest", [name, *_PROBE], ["table"])

    @property
    def tables(self) -> list[KeyedTable]:
        return [self.probes, self.histogram, self.history, self.newest]

    def create(self) -> ProbeStatistics:
        for table in self.tables:
            table.create()
        return self

    # -- following -------------------------------------------------------------------

    def take(self, probes: DataFrame, batch: int, job: str = JOB) -> None:
        """Take in one batch of ``table, marker, probe_seq, latency_ms``; a batch that was taken in counts once."""
        if (covered_until(self, job) or 0) > batch:
            return
        wait = F.coalesce("latency_ms", F.lit(-1)).cast("bigint").alias("latency_ms")
        sighted = probes.select("table", "marker", F.struct(F.col("probe_seq").cast("bigint").alias("probe_seq"), wait).alias("p"))
        first = sighted.groupBy("table", "marker").agg(F.min("p").alias("p")).select("table", "marker", "p.*").persist()
        new = None
        try:
            known = self.probes.state_of(first.select("table", "marker"), batch, job, ())
            known = known.select(F.col("table").alias("__table"), F.col("marker").alias("__marker"))
            same = F.col("table").eqNullSafe(F.col("__table")) & F.col("marker").eqNullSafe(F.col("__marker"))
            new = first.join(known, same, "left_anti").persist()
            if not new.isEmpty():
                self._add(new, batch, job)
        finally:
            first.unpersist()
            if new is not None:
                new.unpersist()
        record_covered(self, batch, job)

    def _add(self, new: DataFrame, batch: int, job: str) -> None:
        created, at = F.lit("c").alias("op"), F.col("probe_seq").alias("seq")
        self.probes.append(new.select(created, at, "table", "marker", *_PROBE.names), batch, job)
        counts = new.groupBy("table", "latency_ms").agg(F.count(F.lit(1)).alias("n"))
        add_counts(self.histogram, counts, batch, batch, job).unpersist()
        last = new.groupBy("table").agg(F.max(F.struct(*_PROBE.names)).alias("p")).select("table", "p.*")
        self.newest.append(last.select(F.lit("u").alias("op"), at, "table", *_PROBE.names), batch, job)
        self._add_history(new, batch, job)

    def _add_history(self, new: DataFrame, batch: int, job: str) -> None:
        """Write the places that the newest successes have now; each table has at most twice ``keep`` rows here."""
        columns = ["table", *_PROBE.names, "seq"]
        came = last_n(new, self.keep).withColumn("seq", F.lit(batch).cast("bigint")).select(columns)
        touched = came.select(F.col("table").alias("__table")).distinct()
        old = self.history.state(batch, job).where(F.col("op") != "d").join(touched, F.col("table").eqNullSafe(F.col("__table")), "left_semi").select(columns)
        table = Window.partitionBy("table")
        placed = came.unionByName(old).withColumns(
            {
                "place": F.row_number().over(table.orderBy(F.col("probe_seq").desc(), F.col("latency_ms").desc())),
                "seq": F.max("seq").over(table) + 1,
            }
        )
        kept = placed.where(F.col("place") <= self.keep)
        self.history.append(kept.select(F.lit("u").alias("op"), "seq", "table", "place", *_PROBE.names), batch, job)

    def observe(self, rows: DataFrame, name: str, marker: str, visible: Column, batch: int, job: str = JOB) -> None:
        """Take in the marked rows of a batch, ``seq, __commit`` beside their columns, that can be read since ``visible``."""
        wait = waits(F.col("__commit"), visible, self.timeout_ms)
        marker_of = F.col(marker).cast("string").alias("marker")
        self.take(rows.select(F.lit(name).alias("table"), marker_of, F.col("seq").alias("probe_seq"), wait.alias("latency_ms")), batch, f"{job}-{name}")

    # -- reading ---------------------------------------------------------------------

    def stats(self, tables: Iterable[str] = tuple(TABLES), percents: Iterable[int] = (95, 99)) -> DataFrame:
        """Per table over all probes, as ``latency_stats`` has them."""
        return stats_of_counts(self.histogram.current(), tables, percents)

    def recent(self) -> DataFrame:
        """The last successes, as ``last_n`` has them: a bounded number per table."""
        return self.history.current().select("probe_seq", "table", "latency_ms")

    def last(self, tables: Iterable[str] = tuple(TABLES)) -> DataFrame:
        """The wait of the newest probe, as ``last_latency`` has it."""
        return last_of(self.newest.current().select("table", F.col("latency_ms").alias("last_ms")), tables)

    def success(self) -> DataFrame:
        """Totals of all probes, as ``probe_success`` has them."""
        return counted_success(self.histogram.current())

    # -- upkeep ----------------------------------------------------------------------

    def fold(self) -> None:
        for table in self.tables:
            table.fold()

    def compact(self) -> None:
        for table in self.tables:
            table.compact()

    def vacuum(self, keep: int = 2) -> None:
        for table in self.tables:
            table.vacuum(keep)


def follow(feed: DataFrame, statistics: ProbeStatistics, root: str, interval: str | None = None, fold_every: int = 60) -> StreamingQuery:
    """Keep statistics of a stream of probe results ``table, marker, probe_seq, latency_ms``."""
    statistics.create()

    def batch(rows: DataFrame, number: int) -> None:
        statistics.take(rows, number)
        if (number + 1) % fold_every == 0:
            statistics.fold()

    writer = feed.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root.rstrip('/')}/checkpoint")
    return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()

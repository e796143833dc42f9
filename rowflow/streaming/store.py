"""A primary-key table on plain Parquet: a bucketed snapshot and the changes since.

    <root>/<name>/snapshot/v=S           rows with op and seq, tombstones too, bucketed and sorted by key
    <root>/<name>/log/v=K/job=J/batch=N  the changes of one micro-batch, as they came
    <root>/<name>/published/v=K          one small row, written last: version K is snapshot S and log K,
                                         with the keys and the number of buckets

Readers take the highest published version, so they see either all of a compaction or
nothing of it.  A batch that is applied again overwrites its own folder.  Keys and buckets are read
from the marker: the settings of the reader's session say nothing about a stored table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import drop_tombstones, latest_by_key, merge_newest
from ..schemas import create_table_sql
from ..session import COMPRESSED, remove, shuffles_cleared

# Fixed value: least number of hash buckets of a target table.
MIN_BUCKETS = 4

#: Label of the writer whose batches are numbered on their own, and of what a fold wrote.
JOB = "main"
FOLDED = "folded"

META = T.StructType().add("op", "string").add("seq", "long")

#: Up to so many keys are looked up by their values, so that buckets and row groups without them are not read.
LISTED_KEYS = 1000

#: Up to so many changes, earlier ones of their keys are looked up before they are reduced.
JOINED_CHANGES = 100_000


def buckets_for(table_bytes: int, bucket_bytes: int = 1 << 30) -> int:
    """Buckets that keep each one near ``bucket_bytes``, the share of one merging task."""
    return max(MIN_BUCKETS, -(-table_bytes // bucket_bytes))


class KeyedTable:
    """Target of an upsert stream.  One writer, any number of readers.

    The writer calls ``create`` once and from then on knows the version it works on; a
    reader never does, and looks the version up for every query.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        schema: T.StructType,
        keys: Iterable[str],
        buckets: int | None = None,
        nullable_keys: bool = False,
    ):
        self.spark, self.name = spark, name
        self.path = f"{root.rstrip('/')}/{name}"
        self.columns, self.keys = schema, list(keys)
        # Spark merges a bucketed table in place only with at least as many buckets as
        # shuffle partitions, so a session tuned for its data also sizes the buckets of a new table.
        self._wanted = buckets
        self.buckets = buckets or max(MIN_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.nullable_keys = nullable_keys
        self._writing: tuple[int, int] | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType(META.fields + self.columns.fields)

    # -- reading ---------------------------------------------------------------------

    def version(self) -> tuple[int, int] | None:
        """Highest published version and its snapshot, or None before the table exists."""
        if self._writing is not None:
            return self._writing
        try:
            published = self._published()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        newest = published.agg(F.max(F.struct("v", "snapshot", "buckets", "keys")).alias("newest")).first()["newest"]
        if newest is None:
            return None
        if newest["keys"] != self.keys:
            raise ValueError(f"{self.path} has the keys {newest['keys']}, not {self.keys}")
        if self._wanted not in (None, newest["buckets"]):
            raise ValueError(f"{self.path} has {newest['buckets']} buckets, not {self._wanted}")
        self.buckets = newest["buckets"]
        return newest["v"], newest["snapshot"]

    def _published(self) -> DataFrame:
        schema = "v int, snapshot int, buckets int, keys array<string>"
        return self.spark.read.schema(schema).json(f"{self.path}/published")

    def _required(self) -> tuple[int, int]:
        version = self.version()
        if version is None:
            raise ValueError(f"{self.path} has not been created")
        return version

    def _snapshot_table(self, snapshot: int) -> str:
        mark = hashlib.md5(self.path.encode()).hexdigest()[:12]
        return f"rowflow_{mark}_{self.name}_v{snapshot}_b{self.buckets}"

    def _snapshot(self, snapshot: int) -> DataFrame:
        # The catalog entry carries the bucketing; it is registered again after a restart.
        name = self._snapshot_table(snapshot)
        location = f"{self.path}/snapshot/v={snapshot}"
        self.spark.sql(create_table_sql(name, self.schema, location, self.keys, self.buckets))
        return self.spark.table(name)

    def _log(self, version: int, wanted: Column | None = None) -> DataFrame | None:
        fields = T.StructType(self.schema.fields).add("job", "string").add("batch", "long")
        try:
            log = self.spark.read.schema(fields).parquet(f"{self.path}/log/v={version}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return (log if wanted is None else log.where(wanted)).drop("job", "batch")

    def state(
        self, before_batch: int | None = None, job: str = JOB, columns: Iterable[str] | None = None, only: Column | None = None
    ) -> DataFrame:
        """One row per key with ``op`` and ``seq``, deleted keys included.

        ``before_batch`` leaves out that batch of the job and all later ones.  Only the
        keys and the ``columns`` are read, reduced and joined; ``only`` is a condition on the keys, met before that.
        """
        version, snapshot = self._required()
        rest = set(self.schema.names if columns is None else [*META.names, *self.keys, *columns])
        wanted = [c for c in self.schema.names if c in rest]
        later = (F.col("job") == job) & (F.col("batch") >= before_batch) if before_batch is not None else None
        stored, log = self._snapshot(snapshot), self._log(version, None if later is None else ~later)
        stored = stored.select(*wanted) if only is None else stored.select(*wanted).where(only)
        if log is None:
            return stored
        newest = latest_by_key(log.select(*wanted) if only is None else log.select(*wanted).where(only), self.keys)
        return merge_newest(stored, newest, self.keys, self.nullable_keys)

    def state_of(
        self, keys: DataFrame, before_batch: int | None = None, job: str = JOB, columns: Iterable[str] | None = None
    ) -> DataFrame:
        """``state`` of some keys only, which are given once each.

        The scans see the keys' values where they are few and one column, else the range of them; snapshots are
        sorted by key, so both skip row groups, and values skip buckets too.  What is left is joined to the keys
        before anything is reduced, and the snapshot's rows stay where they are.
        """
        version, snapshot = self._required()
        rest = set(self.schema.names if columns is None else [*META.names, *self.keys, *columns])
        wanted = [c for c in self.schema.names if c in rest]
        near = self._near(keys)
        later = (F.col("job") == job) & (F.col("batch") >= before_batch) if before_batch is not None else None
        log = self._log(version, None if later is None else ~later)
        parts = [self._snapshot(snapshot)] + ([log] if log is not None else [])
        asked = keys.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
        found = [rows.select(*wanted).where(near).join(asked, self._same(), "left_semi") for rows in parts]
        if len(found) == 1:
            return found[0]
        return merge_newest(found[0], latest_by_key(found[1], self.keys), self.keys, self.nullable_keys)

    def moved_since(self, batch: int, job: str = JOB, columns: Iterable[str] = ()) -> DataFrame | None:
        """``__before`` and ``__after`` of every key that the job's batches from ``batch`` on mention: ``op, seq``, keys and ``columns``.

        Both are found together: earlier changes of those keys and the batches' own are reduced in one step, and joined to
        the snapshot's rows.  None when no log is stored.
        """
        wanted = [*META.names, *self.keys, *[c for c in columns if c not in self.keys]]
        found = self._around(batch, job, wanted)
        if found is None:
            return None
        both, near = found
        rest = [c for c in wanted if c not in self.keys and c != "seq"]
        row = F.struct("seq", (F.col("op") != "d").alias("__exists"), *rest)  # in the order of ``latest_by_key``
        ends = both.groupBy(*self.keys).agg(
            F.max(F.when(~F.col("__later"), row)).alias("__old"), F.max(row).alias("__new"), F.bool_or("__later").alias("__asked")
        ).where("__asked")
        stored = self._snapshot(self._required()[1]).select(*wanted).where(near)
        stored = stored.select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.struct(*wanted).alias("__stored"))
        joined = ends.join(stored, self._same(), "left")

        def newer(end: str) -> Column:
            found = F.struct(*[F.col(c) if c in self.keys else F.col(f"{end}.{c}").alias(c) for c in wanted])
            return F.when(F.col(end).isNotNull() & (F.col("__stored").isNull() | (F.col(f"{end}.seq") > F.col("__stored.seq"))), found).otherwise(F.col("__stored"))

        return joined.select(newer("__old").alias("__before"), newer("__new").alias("__after"))

    def existing_since(self, batch: int, job: str = JOB) -> DataFrame | None:
        """The keys that the job's batches from ``batch`` on mention, and whether each had a row before (``__was``) and has one now (``__is``).

        What ``moved_since`` tells of rows, by two numbers for each end as in ``live_keys``: nothing is sorted, so hardly anything spills.
        """
        found = self._around(batch, job, [*META.names, *self.keys])
        if found is None:
            return None
        both, near = found
        later, gone = F.col("__later"), F.coalesce(F.col("op") == "d", F.lit(True))
        last = {"__put": ~later & ~gone, "__gone": ~later & gone, "__new_put": later & ~gone, "__new_gone": later & gone}
        ends = both.groupBy(*self.keys).agg(*[F.max(F.when(c, F.col("seq"))).alias(n) for n, c in last.items()])
        ends = ends.where(F.col("__new_put").isNotNull() | F.col("__new_gone").isNotNull())
        stored = self._snapshot(self._required()[1]).where(near)
        kept = F.coalesce(F.col("op") != "d", F.lit(False)).alias("__kept")
        joined = ends.join(stored.select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.col("seq").alias("__seq"), kept), self._same(), "left")

        def exists(put: Column, gone: Column) -> Column:
            at = F.greatest(put, gone)
            decides = at.isNotNull() & (F.col("__kept").isNull() | (at > F.col("__seq")))
            return F.when(decides, put.isNotNull() & (gone.isNull() | (put >= gone))).otherwise(F.coalesce("__kept", F.lit(False)))

        was = exists(F.col("__put"), F.col("__gone"))
        now = exists(F.greatest("__put", "__new_put"), F.greatest("__gone", "__new_gone"))
        return joined.select(*self.keys, was.alias("__was"), now.alias("__is"))

    def _around(self, batch: int, job: str, wanted: list[str]) -> tuple[DataFrame, Column] | None:
        """The changes of the job's batches from ``batch`` on, which are ``__later``, beside earlier ones of their keys, and a condition that holds for those keys.

        Where there are many, a join would shuffle them and all earlier ones before the reduction does: then earlier ones of
        other keys come along, to leave after it.
        """
        version, _ = self._required()
        later = (F.col("job") == job) & (F.col("batch") >= batch)
        changes, earlier = self._log(version, later), self._log(version, ~later)
        if changes is None:
            return None
        changes = changes.select(*wanted)
        if not self.nullable_keys:
            changes = changes.dropna(subset=self.keys)
        near = self._near(changes.select(*self.keys))
        earlier = earlier.select(*wanted).where(near)
        if self._log(version, later).count() <= JOINED_CHANGES:
            earlier = earlier.join(changes.select(*[F.col(k).alias(f"__{k}") for k in self.keys]), self._same(), "left_semi")
        return earlier.withColumn("__later", F.lit(False)).unionByName(changes.withColumn("__later", F.lit(True))), near

    @contextmanager
    def set_aside(self, rows: DataFrame, label: str) -> Iterator[DataFrame]:
        """Rows beside the table's files while they are needed: worked out once, and no memory and no shuffle is held for them."""
        path = f"{self.path}/aside/{label}"
        with shuffles_cleared(self.spark):
            rows.write.mode("overwrite").options(**COMPRESSED).parquet(path)
        try:
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            remove(self.spark, path)

    def _same(self) -> list[Column]:
        """The keys beside those of another frame, which have two underscores before their names."""
        return [F.col(k).eqNullSafe(F.col(f"__{k}")) if self.nullable_keys else F.col(k) == F.col(f"__{k}") for k in self.keys]

    def _near(self, keys: DataFrame) -> Column:
        """A condition on the table's own columns that holds for all of the keys, for the scans."""
        if len(self.keys) == 1:
            key = self.keys[0]
            some = [r[0] for r in keys.select(key).limit(LISTED_KEYS + 1).collect()]
            if len(some) <= LISTED_KEYS:
                listed = F.col(key).isin([v for v in some if v is not None])
                return listed | F.col(key).isNull() if None in some else listed
        ends = keys.agg(
            *[f(k).alias(f"{n}_{i}") for i, k in enumerate(self.keys) for n, f in (("least", F.min), ("most", F.max))],
            *[F.count_if(F.col(k).isNull()).alias(f"nulls_{i}") for i, k in enumerate(self.keys)],
        ).first()
        near = F.lit(True)
        for i, k in enumerate(self.keys):
            if ends[f"least_{i}"] is not None:
                inside = F.col(k).between(ends[f"least_{i}"], ends[f"most_{i}"])
                near = near & (inside | F.col(k).isNull() if ends[f"nulls_{i}"] else inside)
        return near

    def stored_batches(self) -> dict[str, int]:
        """Of each job with unfolded batches, the last one: a row per job."""
        fields = T.StructType().add("job", "string").add("batch", "long")
        try:
            log = self.spark.read.schema(T.StructType(self.schema.fields + fields.fields)).parquet(f"{self.path}/log/v={self._required()[0]}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise
        return {r["job"]: r["last"] for r in log.groupBy("job").agg(F.max("batch").alias("last")).collect() if r["job"] != FOLDED}

    def current(
        self, before_batch: int | None = None, job: str = JOB, columns: Iterable[str] | None = None, only: Column | None = None
    ) -> DataFrame:
        """The rows that exist: all columns, or the keys and some."""
        return drop_tombstones(self.state(before_batch, job, columns, only))

    def changes_since(self, batch: int, job: str = JOB) -> DataFrame | None:
        """The stored changes of a batch and later ones, as far as they were not folded."""
        return self._log(self._required()[0], (F.col("job") == job) & (F.col("batch") >= batch))

    # -- writing ---------------------------------------------------------------------

    def create(self, changes: DataFrame | None = None) -> KeyedTable:
        """Publish version 0 from snapshot changes, or empty; an existing table is left alone."""
        version = self.version()
        if version is None:
            rows = self.spark.createDataFrame([], self.schema) if changes is None else self._typed(changes)
            # Placed by bucket first: one shuffle serves the reduction and the files, one per bucket.
            self._write_snapshot(0, latest_by_key(rows.repartition(self.buckets, *self.keys), self.keys))
            version = self._publish(0, 0)
        self._writing = version
        return self

    def _typed(self, changes: DataFrame) -> DataFrame:
        return changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def append(self, changes: DataFrame, batch: int, job: str = JOB) -> None:
        """Add one batch of changes.  The same batch of the same job replaces itself.

        Nothing is shuffled here: readers and the compaction reduce the log by key, with a
        map-side combine, whatever its size.
        """
        folder = f"{self.path}/log/v={self._required()[0]}/job={job}/batch={batch}"
        self._typed(changes).write.mode("overwrite").options(**COMPRESSED).parquet(folder)

    def fold(self) -> None:
        """Reduce the log to one change per key; the snapshot stays.

        This is the frequent, cheap half of a compaction: its cost follows the changes and
        not the table.
        """
        version, snapshot = self._required()
        log = self._log(version)
        if log is not None:
            newest = latest_by_key(log, self.keys)
            newest.write.mode("overwrite").options(**COMPRESSED).parquet(f"{self.path}/log/v={version + 1}/job={FOLDED}/batch=0")
            self._writing = self._publish(version + 1, snapshot)

    def compact(self, forget_below: int | None = None) -> None:
        """Fold the log into a new snapshot.

        The old snapshot is joined bucket by bucket with the shuffled changes, so its rows
        do not move.  Tombstones stay, or an old row that arrives late would revive a
        deleted key; those below ``forget_below`` can go once the feed cannot go back there.
        """
        version, _ = self._required()
        rows = self.state()
        if forget_below is not None:
            rows = rows.where((F.col("op") != "d") | (F.col("seq") >= forget_below))
        self._write_snapshot(version + 1, rows)
        self._writing = self._publish(version + 1, version + 1)

    def _write_snapshot(self, snapshot: int, rows: DataFrame) -> None:
        name = self._snapshot_table(snapshot)
        # An unpublished leftover of a failed attempt is overwritten.
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (
            rows.select(*self.schema.names)
            .write.format("parquet")
            .mode("overwrite")
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.keys)
            .options(**COMPRESSED)
            .option("path", f"{self.path}/snapshot/v={snapshot}")
            .saveAsTable(name)
        )

    def _publish(self, version: int, snapshot: int) -> tuple[int, int]:
        keys = F.array(*[F.lit(k) for k in self.keys])
        row = self.spark.range(1).select(F.lit(snapshot).alias("snapshot"), F.lit(self.buckets).alias("buckets"), keys.alias("keys"))
        row.write.mode("overwrite").json(f"{self.path}/published/v={version}")
        return version, snapshot

    def vacuum(self, keep: int = 2) -> None:
        """Remove what only versions before the newest ``keep`` need, once no reader uses them."""
        versions = sorted((r["v"], r["snapshot"]) for r in self._published().collect())
        old, kept = versions[:-keep], {s for _, s in versions[-keep:]}
        for version, _ in old:
            self._remove(f"published/v={version}")
            self._remove(f"log/v={version}")
        for snapshot in {s for _, s in old} - kept:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._snapshot_table(snapshot)}")
            self._remove(f"snapshot/v={snapshot}")

    def _remove(self, part: str) -> None:
        remove(self.spark, f"{self.path}/{part}")

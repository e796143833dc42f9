"""A snapshot in chunks of the key, taken while the log goes on, that resumes where it stopped.

A chunk's rows carry the log position that was reached before the chunk was read.  Whatever changes while it is read has
a higher position in the log and wins over what was read, so chunks need no lock and no common point in time,
and the log may be applied before, between and after them.  A chunk that is finished is recorded with its low and
high position; a restart reads the chunks that are not.  A chunk that is read again replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming.store import KeyedTable
from .snapshot import snapshot_rows

#: Label of the batches that hold chunks.
SNAPSHOT = "snapshot"


def chunk_limits(keys: DataFrame, key: str, chunks: int) -> list[int]:
    """Upper limits of all chunks but the last, from approximate quantiles; the summary's size is bounded by the error."""
    if chunks < 2:
        return []
    found = keys.approxQuantile(key, [k / chunks for k in range(1, chunks)], 0.1 / chunks)
    return sorted({int(x) for x in found})


class ChunkedSnapshot:
    """Copies a source into a stored table, chunk by chunk.

    ``read`` gives the source's rows that meet a condition on the key, as they are when it is called; a JDBC reader
    pushes the condition down.  ``position`` gives the log position that the source has reached.
    """

    def __init__(self, table: KeyedTable, root: str, read: Callable[[Column], DataFrame], position: Callable[[], int], key: str | None = None):
        self.table, self.spark, self.root = table, table.spark, root.rstrip("/")
        self.read, self.position, self.key = read, position, key or table.keys[0]

    def _marks(self, folder: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).json(f"{self.root}/{folder}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def plan(self, chunks: int) -> list[int]:
        """The limits of the chunks: chosen once, and the same after a restart."""
        known = self._marks("limits", "limits array<bigint>")
        if known is not None:
            return list(known.first()["limits"])
        limits = chunk_limits(self.read(F.lit(True)).select(self.key), self.key, chunks)
        row = self.spark.createDataFrame([(limits,)], "limits array<bigint>")
        row.coalesce(1).write.mode("overwrite").json(f"{self.root}/limits")
        return limits

    def finished(self) -> DataFrame | None:
        """``chunk, low, high`` of the finished chunks."""
        return self._marks("done", "chunk int, low bigint, high bigint")

    def _condition(self, limits: Sequence[int], chunk: int) -> Column:
        inside = F.lit(True)
        if chunk:
            inside = inside & (F.col(self.key) > limits[chunk - 1])
        if chunk < len(limits):
            inside = inside & (F.col(self.key) <= limits[chunk])
        return inside

    def run(self, chunks: int, between: Callable[[int], None] | None = None) -> int:
        """Read every chunk that is not finished; ``between`` is called after each.  The number of chunks read."""
        limits = self.plan(chunks)
        marks = self.finished()
        done = set() if marks is None else {r["chunk"] for r in marks.select("chunk").collect()}
        still = [k for k in range(len(limits) + 1) if k not in done]
        for chunk in still:
            low = self.position()
            self.table.append(snapshot_rows(self.read(self._condition(limits, chunk)), low), chunk, SNAPSHOT)
            mark = self.spark.range(1).select(F.lit(low).cast("bigint").alias("low"), F.lit(self.position()).cast("bigint").alias("high"))
            mark.write.mode("overwrite").json(f"{self.root}/done/chunk={chunk}")
            if between:
                between(chunk)
        return len(still)

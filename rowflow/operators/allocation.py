"""Keys for new rows from a stored high-water mark, without numbering them.

Every task takes blocks of keys above the mark in turn: its first block by its place among the tasks, the next one a
round further on.  Keys are unique and rise from load to load; what tasks leave of their blocks are gaps.  Nothing is sorted,
shuffled or counted beforehand, and the table that the rows go to is looked at once, when the allocator is made.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a task takes at once: the gaps of a load are at most so many per task and round.
BLOCK = 1024

# Spark's row ids: the task's number above 33 bits for the row in it.
_ROW_BITS = 33


class KeyAllocator:
    """Keys of one table.  One writer at a time; a load is known by its name.

    A load is written with its keys and becomes visible with its mark, so a load that died leaves no keys behind and is
    written anew, and one that is repeated after its mark gives the same rows again.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, block: int = BLOCK, tasks: int | None = None):
        self.spark, self.key, self.block = spark, key, block
        self.path = root.rstrip("/")
        self.tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def create(self, current: DataFrame | None = None) -> KeyAllocator:
        """Set the mark to the greatest key there is; an existing mark is left alone."""
        if self._marks() is None:
            top = 0 if current is None else current.agg(F.coalesce(F.max(self.key), F.lit(0)).cast("bigint")).first()[0]
            self._mark("", top)
        return self

    def _marks(self) -> dict[str, int] | None:
        """The top key of every load: a row per load."""
        try:
            marks = self.spark.read.schema("name string, top bigint").json(f"{self.path}/marks")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return {r["name"]: r["top"] for r in marks.collect()} or None

    def _mark(self, name: str, top: int) -> None:
        row = self.spark.range(1).select(F.lit(name).alias("name"), F.lit(top).cast("bigint").alias("top"))
        row.write.mode("overwrite").json(f"{self.path}/marks/load={len(self._marks() or {})}")

    def high_water(self) -> int:
        marks = self._marks()
        if marks is None:
            raise ValueError(f"{self.path} has not been created")
        return max(marks.values())

    def load(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows with keys above all that were given, stored under the load's name."""
        if not name:
            raise ValueError("a load needs a name")
        folder, base = f"{self.path}/loads/{name}", self.high_water()
        rest = [c for c in rows.columns if c != self.key]
        made = rows.coalesce(self.tasks).select(self._next(base).alias(self.key), *[F.col(f"`{c}`") for c in rest])
        if name not in (self._marks() or {}):
            made.write.mode("overwrite").parquet(folder)
            written = self.spark.read.schema(made.schema).parquet(folder)
            self._mark(name, written.agg(F.coalesce(F.max(self.key), F.lit(base))).first()[0])
        return self.spark.read.schema(made.schema).parquet(folder)

    def _next(self, base: int):
        number = F.monotonically_increasing_id()
        task, row = F.shiftright(number, _ROW_BITS), number.bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("bigint"))
        block = F.lit(self.block).cast("bigint")
        turn = F.call_function("div", row, block) * F.lit(self.tasks).cast("bigint") + task
        return F.lit(base).cast("bigint") + turn * block + row % block + 1

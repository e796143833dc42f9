"""Snapshot rows: the existing rows of a table, read before its changes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Table


def snapshot_rows(rows: DataFrame, position: int = 0) -> DataFrame:
    """Rows as changes ``op='r'`` at the position where the log takes over.

    Log rows have higher positions, so they win wherever snapshot and log overlap.
    """
    return rows.select(F.lit("r").alias("op"), F.lit(position).cast("bigint").alias("seq"), *rows.columns)


def jdbc_options(
    url: str, table: str, key: str, lower: int, upper: int, partitions: int, fetch_size: int = 10000
) -> dict[str, str]:
    """Reader options that split the scan into ranges of the key."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def jdbc_snapshot(spark: SparkSession, table: Table, url: str, partitions: int, **options: str) -> DataFrame:
    """Rows of a source table, read in parallel by ranges of its key.  The driver jar is the cluster's."""
    key = table.key[0]
    bounds = (
        spark.read.format("jdbc")
        .options(url=url, query=f"select min({key}) as lo, max({key}) as hi from {table.name}", **options)
        .load()
        .first()
    )
    lo, hi = (int(bounds[0]), int(bounds[1])) if bounds[0] is not None else (0, 1)
    rows = (
        spark.read.format("jdbc").options(**jdbc_options(url, table.name, key, lo, hi + 1, partitions), **options).load()
    )
    return conform(rows, table)


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """The declared columns by name, in declared order and type."""
    return rows.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in table.columns])


def inline_rows(
    spark: SparkSession, table: Table, rows: Iterable[Sequence[object]], columns: Sequence[str] | None = None
) -> DataFrame:
    """Literal rows of some columns of a table, typed as declared."""
    names = list(columns or table.names)
    schema = table.struct
    return spark.createDataFrame([tuple(r) for r in rows], type(schema)([schema[n] for n in names]))

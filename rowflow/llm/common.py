"""What several operators share: word rules, tables in the shared work folder, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir

#: ASCII white space: what separates plain words.
SPACE = "[\\x20\\x09-\\x0D]+"

#: Lower-cases A-Z and turns what is in no bare word (all ASCII but letters and digits) into a space.
_BARE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def plain_words(text: Column) -> Column:
    """Array of the words of a text, split at ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def bare_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, ASCII digits and all that is not ASCII."""
    return text.translate(_BARE).split() if text else []


def utf8(column: str) -> Column:
    """A string column as its bytes: Arrow then never has to decode them."""
    return F.col(column).cast("binary")


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Whole rows in ``__row``, beside working columns that no column of theirs can clash with."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *[c.alias(n) for n, c in columns.items()])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared work folder and read back: computed once, safe when executors go."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def add_columns(
    df: DataFrame, reads: list[str], new: T.StructType, make: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """Append the columns ``make`` computes of each Arrow batch, and drop the ``reads`` that start with ``__``."""
    drop = [c for c in reads if c.startswith("__")]
    kept = [f for f in df.schema.fields if f.name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays(arrays + make(batch), names=[f.name for f in kept] + new.names)

    return df.mapInArrow(run, T.StructType(kept + new.fields))

"""The change feed: JSON envelopes of many tables, typed per table on demand."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dml import event_rows
from ..schemas import ENVELOPE, NTZ, typed_envelope
from ..session import COMPRESSED


#: Folder of the changes that name no table, as Spark writes it.
UNNAMED = "__HIVE_DEFAULT_PARTITION__"


def read_changes(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    stream: bool = True,
    max_files: int | None = None,
    max_bytes: str | None = None,
    row: T.StructType | None = None,
    tables: Iterable[str] | None = None,
    unnamed: bool = True,
    archive: str | None = None,
    consume: bool = False,
) -> DataFrame:
    """Envelopes below ``path``: a stream that picks up new files, or one batch of all.

    ``row`` is given for a feed of one table whose images are columns and not JSON.
    ``max_files`` or ``max_bytes`` bound a micro-batch, so a long backlog is worked off in
    pieces and not in one giant job.  ``tables`` reads those tables' folders of a routed feed and no others, and
    with ``unnamed`` the changes of no table; files that a stream has worked off go to ``archive``,
    or are deleted with ``consume``, but for those of the newest batch.
    """
    schema = ENVELOPE if row is None else typed_envelope(row)
    if tables is not None:  # the folder's name is the table, which then comes last
        schema = T.StructType([*[f for f in schema if f.name != "table"], schema["table"]])
    reader = (spark.readStream if stream else spark.read).schema(schema).format(fmt)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if stream and max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if stream and archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    elif stream and consume:
        reader = reader.option("cleanSource", "delete")
    if tables is None:
        return reader.load(path)
    folders = ",".join([*tables, *([UNNAMED] if unnamed else [])])
    return reader.option("basePath", path).load(f"{path}/table={{{folders}}}")


def write_routed(envelopes: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add changes to a feed with a folder per table; those of no table have one of their own."""
    envelopes.write.mode("append").format(fmt).options(**COMPRESSED if fmt == "parquet" else {}).partitionBy("table").save(path)


def folder_of(path: str, table: str) -> str:
    """The folder of one table in a routed feed."""
    return f"{path}/table={table}"


IMAGES = ("before", "after")
_BROKEN = "__broken"
_PARSED = "__parsed"
_NO_TABLE = "table: null"


def decode_envelopes(df: DataFrame, column: str = "value") -> DataFrame:
    """Envelopes out of a column of JSON messages, as a message bus delivers them.

    A message that is no envelope, or names no table, becomes one of no table with the message as its after image:
    it cannot be applied, and the job sets it aside as it came.
    """
    text = F.col(column).cast("string")
    marked = T.StructType([*ENVELOPE.fields, T.StructField(_BROKEN, T.StringType())])
    message = F.struct(text.alias("text"), F.from_json(text, marked, {"columnNameOfCorruptRecord": _BROKEN}).alias("e"))
    # Out of an array, or every column below would parse the message again.
    parsed = df.select(F.explode(F.array(message)).alias("m")).select("m.*")
    good = F.col("e.table").isNotNull() & F.col(f"e.{_BROKEN}").isNull()
    fields = [F.when(good, F.col(f"e.{n}")).alias(n) for n in ENVELOPE.names if n != "after_json"]
    return parsed.select(*fields, F.when(good, F.col("e.after_json")).otherwise(F.col("text")).alias("after_json"))


def undecodable(envelopes: DataFrame) -> DataFrame:
    """Envelopes of no table, with ``reasons``; they and the tables' envelopes are all of them."""
    return envelopes.where(F.col("table").isNull()).withColumn("reasons", F.lit(_NO_TABLE))


def checked_events(envelopes: DataFrame, table: str, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    """Every envelope of a table with its typed images and ``reasons``, empty where it can be applied.

    The before image says something in a delete, and in an update that moves a row to another key: then its key
    alone matters.  An image that is no JSON object, or has a value its column cannot hold, is unreadable as a whole.
    """
    return _checked(envelopes.where(F.col("table") == table), schema, keys)


def _checked(mine: DataFrame, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    keys, reasons = list(keys), []
    if "after" not in mine.columns:
        images = {"before": T.StructType([schema[k] for k in keys]), "after": schema}
        parsed = []
        for image, wanted in images.items():
            marked = T.StructType([*wanted.fields, T.StructField(_BROKEN, T.StringType())])
            text = F.when(F.col("table").isNotNull(), F.col(f"{image}_json"))  # what names no table has no images
            parsed.append(F.from_json(text, marked, {"columnNameOfCorruptRecord": _BROKEN}).alias(image))
        # Out of an array, or the filters on what is found here would parse the images again, once for each use.
        mine = mine.select("*", F.explode(F.array(F.struct(*parsed))).alias(_PARSED))
        for image, wanted in images.items():
            text, found = F.col(f"{image}_json"), F.col(f"{_PARSED}.{image}")
            whole = F.struct(*[found[f.name].alias(f.name) if f.name in wanted.names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
            bad = text.isNotNull() & (found.isNull() | found[_BROKEN].isNotNull())
            mine = mine.withColumn(image, F.when(text.isNotNull() & ~bad, whole))
            reasons.append(F.when(bad, f"{image}: unreadable"))
    known = F.coalesce(F.col("op").isin("r", "c", "u", "d"), F.lit(False))
    reasons.append(F.when(~known, "op: unknown"))
    reasons.append(F.when(F.col("seq").isNull(), "seq: null"))
    for k in keys:
        old, new = F.col(f"before.{k}"), F.col(f"after.{k}")
        value = F.when(F.col("op") == "d", F.coalesce(old, new)).otherwise(new)
        reasons.append(F.when(known & value.isNull(), f"{k}: null"))
    return mine.withColumn("reasons", F.concat_ws("; ", *reasons)).drop(_PARSED)


def typed_events(envelopes: DataFrame, table: str, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    """The changes of one table with typed ``before`` and ``after`` images, as far as they can be applied."""
    return good_events(checked_events(envelopes, table, schema, keys))


def good_events(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reasons") == "").select("op", "seq", "ts_commit", *IMAGES)


def bad_envelopes(checked: DataFrame, columns: Iterable[str]) -> DataFrame:
    return checked.where(F.col("reasons") != "").select(*columns, "reasons")


def unreadable_changes(envelopes: DataFrame, table: str, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    """The other envelopes of the table, as they came, with ``reasons``: both together are all of them."""
    return bad_envelopes(checked_events(envelopes, table, schema, keys), envelopes.columns)


def typed_changes(envelopes: DataFrame, table: str, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    """The changes of one table as ``op, seq`` and its columns; deletes carry the key only."""
    return event_rows(typed_events(envelopes, table, schema, keys), keys)


def sorted_changes(envelopes: DataFrame, table: str, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    """``typed_changes``, ``unreadable_changes`` and ``undecodable`` in one pass, which reads and parses every envelope once.

    A change that can be applied is ``op, seq`` and its columns, with empty ``reasons``.  Any other envelope of the table or of
    no table is one row with its ``reasons``, without columns and as it came in ``envelope``.
    """
    nowhere = F.col("table").isNull()
    checked = _checked(envelopes.where((F.col("table") == table) | nowhere), schema, keys)
    checked = checked.withColumn("reasons", F.when(nowhere, F.lit(_NO_TABLE)).otherwise(F.col("reasons")))
    good = F.col("reasons") == ""
    images = [F.when(good, F.col(i)).alias(i) for i in IMAGES]
    came = F.when(~good, F.struct(*envelopes.columns)).alias("envelope")
    return event_rows(checked.select("op", "seq", "reasons", came, *images), keys, ["reasons", "envelope"])


def _as_json(events: DataFrame, image: str) -> Column:
    """An image as JSON with times to the microsecond, where the JSON writer would cut them to milliseconds."""
    fields = events.schema[image].dataType.fields
    text = [T.StructField(f.name, T.StringType() if f.dataType == NTZ else f.dataType) for f in fields]
    return F.to_json(F.col(image).cast(T.StructType(text)))


def change_events(
    changes: DataFrame, table: str, keys: Iterable[str], ts_commit: Column | None = None, keep: Iterable[Column] = ()
) -> DataFrame:
    """A change frame (``op, seq``, columns) as envelopes with column images.

    A delete keeps its key as before image, the other changes their row as after image.  What is in ``keep`` goes
    along beside them.
    """
    keys = list(keys)
    columns = [c for c in changes.columns if c not in ("op", "seq")]
    whole = F.struct(*columns)
    only_key = F.struct(
        *[F.col(c) if c in keys else F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in columns]
    )
    deleted = F.col("op") == "d"
    commit = ts_commit if ts_commit is not None else F.lit(None)
    return changes.select(
        F.lit(table).alias("table"),
        "op",
        "seq",
        commit.cast("timestamp_ntz").alias("ts_commit"),
        F.when(deleted, only_key).alias("before"),
        F.when(~deleted, whole).alias("after"),
        *keep,
    )


def change_envelopes(
    changes: DataFrame, table: str, keys: Iterable[str], ts_commit: Column | None = None, keep: Iterable[Column] = ()
) -> DataFrame:
    """The same with JSON images, for a feed of many tables."""
    events = change_events(changes, table, keys, ts_commit, keep)
    images = [_as_json(events, i).alias(f"{i}_json") for i in IMAGES]
    return events.select("table", "op", "seq", "ts_commit", *images, *events.columns[6:])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Snapshot and log parts of one feed, by column name."""
    return reduce(DataFrame.unionByName, frames)

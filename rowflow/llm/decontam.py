"""Benchmark decontamination with one Aho-Corasick automaton over the benchmark's word windows.

Text and items are normalised alike: A-Z lower-cased, words of ASCII letters, digits and
everything beyond ASCII.  Each item contributes its windows of ten consecutive words (an item
of fewer words is one window); the automaton's letters are word numbers, so a text is
scanned once, word by word, and a match says at which word it ends.  Word places are mapped
back to character offsets of the original text where something was found.

The distinct pairs of window and item are made in Spark and dealt by a hash of the pair to blocks, one
automaton each, whose windows come from about ``BLOCK_BYTES`` of the benchmark; so neither a giant item nor a window of
many items makes a large block.  Words longer than ``LONG`` bytes stand as their digests there.  The documents pass one
block after the other, without a shuffle.  The driver holds one block at a time; after every ``TOGETHER`` blocks what was
found is stored.

Defined results: a null or empty text has no words and is clean; an item without words
has no window; a null item id counts under the name ``null``; an item that is listed twice counts once.
Repeated documents are scanned by themselves.  An empty benchmark finds nothing.  Columns of
the table are carried along whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir
from .common import add_columns, bare_words, packed, stored, utf8

WINDOW = 10
BLOCK_BYTES = 1 << 20
#: Longer words are numbered by their digests.
LONG = 64
#: Blocks whose automata one plan holds.
TOGETHER = 4

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPAN = T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer"))
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
FOUND = (
    T.StructType().add("n_words", "long").add("n_hit", "long").add("n_items", "long").add("items_sha256", "string")
    .add("contaminated", "boolean").add("items", T.ArrayType(T.StringType())).add("spans", _SPAN)
)

_BUILT: dict[str, tuple[dict[bytes, int], ahocorasick.Automaton]] = {}


def windows_of(words: list[bytes], size: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    """The windows of one item."""
    if words:
        for k in range(max(1, len(words) - size + 1)):
            yield tuple(words[k : k + size])


def short(word: bytes) -> bytes:
    """The word, or what stands for a long one; no bare word has a number sign."""
    return word if len(word) <= LONG else b"#" + hashlib.sha256(word).hexdigest().encode()


def build(pairs: Iterable[tuple[bytes, str]]) -> tuple[dict[bytes, int], ahocorasick.Automaton]:
    """Word numbers and the automaton of windows, each with an item it is in; a window's value is its length and its items."""
    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for window, name in pairs:
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in window.split(b" "))
        owners.setdefault(key, set()).add(name)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, names in owners.items():
        automaton.add_word(key, (len(key), tuple(sorted(names))))
    if owners:
        automaton.make_automaton()
    return numbers, automaton


def scan(words: list[bytes], numbers: dict[bytes, int], automaton: ahocorasick.Automaton) -> tuple[set[int], set[str]]:
    """Places of hit words, and the items found."""
    hit: set[int] = set()
    names: set[str] = set()
    if words and len(automaton):
        get = numbers.get
        for last, (length, owners) in automaton.iter(tuple([get(w if len(w) <= LONG else short(w), 0) for w in words])):
            hit.update(range(last - length + 1, last + 1))
            names.update(owners)
    return hit, names


def character_spans(text: bytes, hit: list[int]) -> list[dict[str, int]]:
    """Runs of hit words as character offsets of the original text, end exclusive."""
    places = [m.span() for m in _WORD.finditer(text)]
    # A character begins at every byte that does not continue one.
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    spans, first = [], 0
    for k, word in enumerate(hit):
        if k + 1 == len(hit) or hit[k + 1] != word + 1:
            spans.append({"start": int(before[places[hit[first]][0]]), "stop": int(before[places[word][1]])})
            first = k + 1
    return spans


def _scanner(block: Broadcast, last: bool) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """What one block's automaton adds to what the blocks before found.  A worker builds it once."""
    name = uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = build(block.value)
        numbers, automaton = _BUILT[name]
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in ("__text", "__hit", "__names")}
        hits, names, rows = [], [], []
        for text, old_hit, old_names in zip(*(c.to_pylist() for c in columns.values()), strict=True):
            words = bare_words(text)
            found, who = scan(words, numbers, automaton)
            found.update(old_hit)
            who.update(old_names)
            hits.append(sorted(found))
            names.append(sorted(who))
            rows.append((len(words), text))
        if not last:
            return [columns["__text"], pa.array(hits, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))]
        digests = [hashlib.sha256(",".join(n).encode()).hexdigest() for n in names]
        spans = [character_spans(text, h) if h else [] for h, (_, text) in zip(hits, rows, strict=True)]
        return [
            pa.array([n for n, _ in rows], pa.int64()),
            pa.array([len(h) for h in hits], pa.int64()),
            pa.array([len(n) for n in names], pa.int64()),
            pa.array(digests, pa.string()),
            pa.array([bool(h) for h in hits], pa.bool_()),
            pa.array(names, pa.list_(pa.string())),
            pa.array(spans, _SPAN_ARROW),
        ]

    return run


_PAIR = T.StructType().add("window", "binary").add("id", "string")


def _pairs(items: DataFrame, size: int) -> DataFrame:
    """The distinct pairs of a window, its words with spaces between, and the id of an item it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(*batch.columns, strict=True):
                made = (b" ".join(w) for w in windows_of([short(w) for w in bare_words(text.as_py())], size))
                while part := list(islice(made, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([name.as_py()] * len(part), pa.string())], names=_PAIR.names)

    rows = items.select(F.coalesce(F.col("__id").cast("string"), F.lit("null")).alias("id"), utf8("__text").alias("text"))
    return rows.mapInArrow(run, _PAIR).distinct()


def _blocks(items: DataFrame, size: int, block_bytes: int) -> tuple[int, Iterator[list[tuple[bytes, str]]]]:
    """The number of blocks and, one after the other, their pairs."""
    pairs = _pairs(items, size)
    total = items.agg(F.sum(F.octet_length(utf8("__text")))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    if n > 1:
        dealt = pairs.withColumn("block", F.pmod(F.xxhash64("window", "id"), F.lit(n)).cast("int"))
        pairs = stored(dealt.repartitionByRange("block").sortWithinPartitions("block"), "windows")
        longest = pairs.agg(F.max(F.octet_length("window"))).first()[0] or 0
        if longest > 4 * block_bytes:
            raise ValueError(f"a window of {longest} bytes exceeds the block size {block_bytes}")

    def each() -> Iterator[list[tuple[bytes, str]]]:
        for k in range(n):
            mine = pairs.where(F.col("block") == k) if n > 1 else pairs
            yield [(bytes(r["window"]), r["id"]) for r in mine.select(*_PAIR.names).collect()]

    return n, each()


def scan_documents(
    rows: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Replace the binary column ``__text`` by the columns of ``FOUND``."""
    sc = rows.sparkSession.sparkContext
    n, blocks = _blocks(items.select(F.col(item_id).alias("__id"), F.col(item_text).alias("__text")), size, block_bytes)
    state = T.StructType().add("__text", "binary").add("__hit", T.ArrayType(T.IntegerType())).add("__names", T.ArrayType(T.StringType()))
    found = rows.withColumns({"__hit": F.array().cast("array<int>"), "__names": F.array().cast("array<string>")})
    sent: list[Broadcast] = []
    before: str | None = None
    for k in range(n):
        last = k + 1 == n
        sent.append(sc.broadcast(next(blocks)))
        found = add_columns(found, state.names, FOUND if last else state, _scanner(sent[-1], last))
        if not last and len(sent) == TOGETHER:
            path = work_dir(rows.sparkSession, "scanned")
            found.write.parquet(path)
            found = rows.sparkSession.read.schema(found.schema).parquet(path)
            for block in sent:
                block.destroy()
            if before:
                _forget(rows.sparkSession, before)
            sent, before = [], path
    return found


def _forget(spark: SparkSession, path: str) -> None:
    """Delete what a later state replaces."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """Per document: its key, counts of words, hit words and items, the items, and the hit character spans."""
    return scan_documents(docs.select(F.col(key), utf8(text).alias("__text")), benchmark, **options)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options: object) -> DataFrame:
    """The documents, all columns, in which no window of the benchmark occurs."""
    found = scan_documents(packed(docs, __text=utf8(text)), benchmark, **options)
    return found.where(~F.col("contaminated")).select("__row.*")

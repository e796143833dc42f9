"""Best-fit packing of documents into sequences of a fixed length, with certified numbers of sequences.

A document is its token ids and an end id.  Documents longer than a sequence are cut into pieces of its length, of
which the first may be shorter; pieces that fill a sequence are one by themselves.  The others are packed where they
are, in partitions of at most ``PARTITION`` pieces, by best-fit decreasing.  Of every partition the lengths give a lower
bound on its sequences by dual feasible functions: functions f of a length with f(a) + f(b) + ... <= 1 whenever
a + b + ... fits a sequence, so that no packing needs less than the sum of all f.  Each piece carries the gap of its
partition to that bound.  Even without a gap a partition may leave up to a sequence of room, as bounds are rounded up, so
partitions give away all their sequences that have room, unless the bound of all that would be given away is met already;
what was given is dealt to new partitions of the same size and packed again, until that bound is met or two rounds in
turn save nothing.  A round that saves nothing leaves the packing before it.

Only pieces in open sequences are shuffled, a few per cent of all.  A task holds one partition's pieces without their
ids, whatever the documents: pieces are dealt by their own numbers, so copies and null ids spread.

Defined results: a null or empty text is the end id alone.  Every row is packed, copies and rows without an id too.  An
empty table gives no pieces.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import math
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, utf8
from .tokens import WholeEncoder, as_text, coded, id_bytes, put_together

LENGTH = 1024
END = 2
#: Pieces that one task packs together.
PARTITION = 1 << 16
#: Rounds of exchange at most.
ROUNDS = 8
#: Distinct words a worker remembers before it starts anew.
REMEMBERED = 600_000
#: Longest word remembered, in characters.
_LONGEST = 64

PIECES = (
    T.StructType().add("number", "long").add("id", "string").add("piece", "integer").add("start", "long").add("length", "long")
    .add("ids_crc32", "long").add("sequence_id", "long").add("offset", "long").add("open", "boolean").add("gap", "integer")
)
_ARROW = pa.schema(
    [("number", pa.int64()), ("id", pa.string()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    + [("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_()), ("gap", pa.int32())]
)

# -- encoding ------------------------------------------------------------------------

_AFTER_SPACE = re.compile(r"\s ")
_AT_SPACE = re.compile(r"(?<=\S) ")
#: Signs that begin a token of their own after a letter or number; an apostrophe may begin a contraction.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def is_byte_level(tokenizer_json: str) -> bool:
    """Whether a tokenizer cuts texts by the usual rule of byte-level vocabularies and merges within the cuts only."""
    model = json.loads(tokenizer_json)
    cutter, merges = model.get("pre_tokenizer") or {}, model["model"]
    return (
        cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex", True)
        and not cutter.get("add_prefix_space")
        and not model.get("normalizer")
        and merges["type"] == "BPE"
        and not any(merges.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "unk_token"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in model.get("added_tokens") or [])
    )


class ByteLevelEncoder:
    """Ids of whole texts for byte-level tokenizers, each word encoded once and then remembered.

    No token reaches from a character that is no space into a space, so texts are cut there, and what follows a cut is
    a word, with its space.  Signs at the end of a word after a letter or number below U+0250 are encoded by
    themselves.  New words are encoded in one text and told apart by the bytes of their tokens.
    """

    def __init__(self, tokenizer, dtype: str, end: int):
        self.tokenizer, self.dtype, self.last = tokenizer, np.dtype(dtype), np.array([end], dtype).tobytes()
        self.after: dict[str, bytes] = {}  # ids of words with the space before them, without the signs after them
        self.first: dict[str, bytes] = {}  # ids of words at the start of a text
        self.signs: dict[str, bytes] = {"": b""}
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)  # one character a byte
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words with the space before them, of which none ends in white space or holds an added token."""
        text = " " + " ".join(words) if words else ""
        data = self._ids([text])[0]
        ends = np.cumsum(self.sizes[np.frombuffer(data, self.dtype)])
        sizes = [len(w) for w in words] if text.isascii() else [len(w.encode()) for w in words]
        at = (np.searchsorted(ends, np.cumsum(np.array(sizes, np.int64) + 1)) + 1) * self.dtype.itemsize
        places = [0, *at.tolist()]
        return [data[x:y] for x, y in zip(places, places[1:], strict=False)]

    def _known(self, words: list[str], special: bool) -> list[bytes]:
        """Ids of words with the space before them."""
        after, signs = self.after, self.signs
        cut = [w.rstrip(_SIGNS) for w in words]
        cut = [s if s and s[-1] < "\u0250" and s[-1].isalnum() else w for s, w in zip(cut, words, strict=True)]
        if special:
            cut = [w if any(a in w for a in self.added) else s for s, w in zip(cut, words, strict=True)]
        new = set(cut).difference(after)
        odd = [s for s in new if s[-1:].isspace() or not s or (special and any(a in s for a in self.added))]
        after.update(zip(odd, self._ids([f" {s}" for s in odd]), strict=True))
        rest = list(new.difference(odd))
        after.update(zip(rest, self._together(rest), strict=True))
        ends = [w[len(s) :] for s, w in zip(cut, words, strict=True)]
        alone = list(set(ends).difference(signs))
        signs.update(zip(alone, self._ids(alone), strict=True))
        ids = [after[s] + signs[e] for s, e in zip(cut, ends, strict=True)]
        for memory, learnt in ((after, new), (signs, alone)):
            for w in learnt:
                if len(w) > _LONGEST:
                    del memory[w]
        return ids

    def _encode(self, words: pa.ListArray, special: bool, joined: bool) -> list[bytes]:
        """Ids of texts by the words they were cut into, of which ``joined`` ones hold no space."""
        distinct, places = coded(words.values, joined)
        starts, count = words.offsets.to_numpy(), len(distinct)
        texts = [w.decode("utf-8", "replace") for w in distinct]
        ids, begins = self._known(texts, special), places[starts[:-1]]
        heads = list(dict.fromkeys(begins.tolist()))
        new = [texts[k] for k in heads if texts[k] not in self.first]
        self.first.update(zip(new, self._ids(new), strict=True))
        numbers = np.zeros(count, np.int64)
        numbers[heads] = np.arange(count, count + len(heads))
        places = places.astype(np.int64)
        places[starts[:-1]] = numbers[begins]
        out = put_together(ids + [self.first[texts[k]] for k in heads], places, starts, self.last)
        for w in new:
            if len(w) > _LONGEST:
                del self.first[w]
        return out

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if len(self.after) > REMEMBERED or len(self.first) > REMEMBERED or len(self.signs) > REMEMBERED:
            self.after, self.first, self.signs = {}, {}, {"": b""}
        plain, spaced, special = [], {}, False
        for k, t in enumerate(texts):
            text = t.decode("utf-8", "replace")
            special = special or any(a in text for a in self.added)
            if _AFTER_SPACE.search(text):
                spaced[k] = _AT_SPACE.split(text)
            else:
                plain.append(k)
        out = [b""] * len(texts)
        if plain:
            words = pc.split_pattern(as_text([texts[k] for k in plain]), " ")
            for k, ids in zip(plain, self._encode(words, special, True), strict=True):
                out[k] = ids
        if spaced:
            words = pa.array([[w.encode() for w in ws] for ws in spaced.values()], pa.list_(pa.binary()))
            for k, ids in zip(spaced, self._encode(words, special, False), strict=True):
                out[k] = ids
        return out


# -- packing -------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of every length, its offset there, and the room left in every bin."""
    lists: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by room
    rooms = 0  # a bit for every room that some bin has
    left: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = lists[room].pop()
            if not lists[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(left)
            left.append(room)
        bins[i], offsets[i] = b, capacity - room
        left[b] = room = room - size
        if room:
            rooms |= 1 << room
            lists[room].append(b)
    return bins, offsets, np.array(left, np.int64)


def bins_needed(counts: np.ndarray, capacity: int = LENGTH, family: int = 32) -> int:
    """No packing of ``counts[x]`` pieces of length x takes fewer bins: the best bound of a family of dual feasible functions.

    The functions round lengths to k-ths, for k up to ``family``, after lengths over capacity - e were taken for whole
    bins and lengths below e for nothing, for every e up to half a bin; all in whole numbers.
    """
    x = np.arange(capacity + 1)
    e = np.arange(capacity // 2 + 1)
    before = np.concatenate([[0], np.cumsum(counts)])
    whole = before[capacity + 1] - before[capacity - e + 1]
    best = 0
    for k in range(family + 1):
        scaled = x if k == 0 else np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
        unit = capacity * max(k, 1)
        sums = np.concatenate([[0], np.cumsum(counts * scaled)])
        total = sums[capacity - e + 1] - sums[e] + whole * unit
        best = max(best, int((-(-total // unit)).max()))
    return best


@dataclass(frozen=True)
class Certificate:
    """How many sequences a packing has, and how many any packing of its pieces must have."""

    sequences: int
    bound: int


def certificate(pieces: DataFrame, capacity: int = LENGTH) -> Certificate:
    """The certificate of packed pieces; a row per length, so at most ``capacity``, reaches the driver."""
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("offset") == 0, 1)).alias("first")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows:
        counts[r["length"]] = r["n"]
    return Certificate(sum(r["first"] for r in rows), bins_needed(counts, capacity))


class _Partition:
    """Pieces that one task packs together."""

    def __init__(self, capacity: int):
        self.capacity, self.rows = capacity, []

    def packed(self) -> pa.RecordBatch:
        """All rows with their sequences, named after the piece that begins them."""
        columns = list(zip(*self.rows, strict=True))
        numbers, lengths = np.array(columns[0], np.int64), np.array(columns[4], np.int64)
        bins, offsets, left = best_fit(lengths, self.capacity)
        gap = len(left) - bins_needed(np.bincount(lengths, minlength=self.capacity + 1), self.capacity)
        given = left > 0
        names = np.zeros(len(left), np.int64)
        first = offsets == 0
        names[bins[first]] = numbers[first]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=False)]
        self.rows = []
        return pa.RecordBatch.from_arrays([*arrays, pa.array(names[bins]), pa.array(offsets), pa.array(given[bins]), pa.array(np.full(len(bins), gap, np.int32))], schema=_ARROW)


def _repacker(capacity: int, size: int):
    """Packs the pieces of a task anew, ``size`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Partition(capacity)
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.rows.append(row)
                if len(held.rows) == size:
                    yield held.packed()
        if held.rows:
            yield held.packed()

    return run


_LOADED: dict[str, ByteLevelEncoder | WholeEncoder] = {}
#: Bytes of text encoded at once.
_SLICE = 4 << 20


def _encoder(name: str, source: str, dtype: str, end: int) -> ByteLevelEncoder | WholeEncoder:
    if name not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer

        _LOADED.clear()
        _LOADED[name] = (ByteLevelEncoder if is_byte_level(source) else WholeEncoder)(Tokenizer.from_str(source), dtype, end)
    return _LOADED[name]


def _cutter(model, name: str, dtype: str, end: int, capacity: int, size: int):
    """Encodes the documents of a task, cuts them, and packs the shorter pieces, ``size`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(name, model.value, dtype, end)
        number = TaskContext.get().partitionId() << 33
        held = _Partition(capacity)
        full: list[tuple] = []

        def whole() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*full, strict=True), _ARROW, strict=True)]
            full.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        def cut(key: str | None, ids: bytes) -> None:
            nonlocal number
            data = np.frombuffer(ids, dtype).astype("<u4")
            first = len(data) % capacity or capacity
            for k, end in enumerate(range(first, len(data) + 1, capacity)):
                start = max(0, end - capacity) if k else 0
                row = (number, key, k, start, end - start, zlib.crc32(data[start:end]))
                if end - start == capacity:
                    full.append((*row, number, 0, False, 0))
                else:
                    held.rows.append(row)
                number += 1

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or b"" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                to, weight = at, 0
                while to < len(texts) and weight <= _SLICE:
                    weight += len(texts[to])
                    to += 1
                for key, ids in zip(keys[at:to], encode(texts[at:to]), strict=True):
                    cut(key, ids)
                    if len(held.rows) == size:
                        yield held.packed()
                    if len(full) >= size:
                        yield whole()
                at = to
        if held.rows:
            yield held.packed()
        if full:
            yield whole()

    return run


def exchanged(pieces: DataFrame, capacity: int = LENGTH, size: int = PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """Packed pieces after the open sequences of all partitions were packed together, as long as that saves some."""
    done, pool = [pieces.where(~F.col("open"))], pieces.where("open")
    state, vain = certificate(pool, capacity), False
    for turn in range(rounds):
        if state.sequences <= state.bound:
            break
        parts = math.ceil(pool.count() / size)
        dealt = pool.select(*PIECES.names[:6]).repartition(parts, F.xxhash64("number", F.lit(turn)))
        again = stored(dealt.mapInArrow(_repacker(capacity, size), PIECES), "packed")
        better = certificate(again, capacity)
        if better.sequences >= state.sequences:
            if vain:
                break
            vain = True
            continue
        vain = False
        done.append(again.where(~F.col("open")))
        pool = again.where("open")
        state = certificate(pool, capacity)
    for rows in done:
        pool = pool.unionByName(rows)
    return pool


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = END,
    capacity: int = LENGTH,
    size: int = PARTITION,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per piece: document, number of the piece, its start, length and checksum, sequence and offset there."""
    with open(tokenizer_path, encoding="utf-8") as f:  # a file of the installation, a few MB; executors need not have it
        source = f.read()
    model = docs.sparkSession.sparkContext.broadcast(source)
    run = _cutter(model, uuid.uuid4().hex, f"<u{id_bytes(source, end)}", end, capacity, size)
    rows = docs.select(F.col(key).cast("string").alias("id"), utf8(text).alias("text"))
    packed = exchanged(stored(rows.mapInArrow(run, PIECES), "pieces"), capacity, size, rounds)
    return packed.select(F.col("id").cast(docs.schema[key].dataType).alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

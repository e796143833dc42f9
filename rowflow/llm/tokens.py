"""Token ids as flat binary files with 64-bit document offsets.

One file per range of document ids, in ascending order of the ids:

    ids        unsigned integers, little-endian, two bytes each where the vocabulary allows, else four
    padding    zeros up to a multiple of eight bytes
    documents  int64 document ids, one per document
    ends       int64 offsets, where each document's ids end; they start where the one before ends
    trailer    int64 bytes per id, int64 number of ids, int64 number of documents

All parts are aligned, so ``TokenFile`` maps a file and never reads what is not asked for.  The place of a file in the
whole corpus is the prefix sum of the files before it.

Texts are encoded where they are and dealt to the files by ranges of ids, whose limits are quantiles of the ids.
Spark's text writer puts the files on whatever file system the path names, with its commit protocol; it ends every
row with a separator, so the packer cuts its stream at zero bytes, and a zero byte is the separator.

Defined results: a null or empty text is the end id alone.  Documents with the same id follow each other in
the order of a hash of their ids; those without an id come last.  An empty table gives no ids.  Other columns are ignored.
"""

from __future__ import annotations

import json
import math
import os
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, utf8

END = 1
FILE_BYTES = 32 << 20
#: Distinct words a worker remembers before it starts anew.
REMEMBERED = 400_000

_NO_ID = -(1 << 63)
_LOADED: dict[str, WordEncoder | WholeEncoder] = {}


# -- encoding ------------------------------------------------------------------------


def id_bytes(tokenizer_json: str, end: int = END) -> int:
    """Two bytes per id where every id fits, else four."""
    model = json.loads(tokenizer_json)
    largest = max([end, *model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens") or [])])
    return 2 if largest < 1 << 16 else 4


def is_by_word(tokenizer_json: str) -> bool:
    """Whether a tokenizer lower-cases, drops white space, and cuts what is between it as ``WordEncoder`` takes for granted."""
    model = json.loads(tokenizer_json)
    merges, cutter, cleaner = model["model"], model.get("pre_tokenizer") or {}, model.get("normalizer") or {}
    cuts, cleans = cutter.get("pretokenizers") or [], cleaner.get("normalizers") or []
    return (
        [c["type"] for c in cleans] == ["NFC", "Replace", "Lowercase"]
        and cleans[1]["pattern"] == {"Regex": "\\s+"}
        and cleans[1]["content"] == " "
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": _CUTS}
        and cuts[0]["behavior"] == "Removed"
        and cuts[0]["invert"]
        and not cuts[1].get("add_prefix_space")
        and not cuts[1].get("use_regex", True)
        and merges["type"] == "BPE"
        and merges.get("end_of_word_suffix") == _FINAL
        and not any(merges.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "unk_token"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or _PLAIN.fullmatch(t["content"]) for t in model.get("added_tokens") or [])
    )


def coded(words: pa.Array, joined: bool = True) -> tuple[list[bytes], np.ndarray]:
    """The distinct ones of many words, and every word's place among them; ``joined`` where no word holds a space."""
    found = words.dictionary_encode()
    values, places = found.dictionary, found.indices.to_numpy()
    if not joined or not len(values):
        return values.cast(pa.binary()).to_pylist(), places
    together = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), " ")
    return together[0].as_buffer().to_pybytes().split(b" "), places


def put_together(ids: list[bytes], places: np.ndarray, starts: np.ndarray, last: bytes) -> list[bytes]:
    """The ids of every text, whose words begin at ``starts``, and ``last``."""
    flat = pa.array(ids, pa.large_binary()).take(pa.array(places))
    _, offsets, data = flat.buffers()
    if not len(flat) or data is None:
        return [last] * (len(starts) - 1)
    cuts = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + len(flat) + 1][starts].tolist()
    held = memoryview(data)
    return [b"".join((held[x:y], last)) for x, y in zip(cuts, cuts[1:], strict=False)]


def as_text(texts: list[bytes]) -> pa.Array:
    """Texts as an Arrow column; bytes that are no UTF-8 stay as they are."""
    return pc.cast(pa.array(texts, pa.binary()), options=_AS_TEXT)


class WordEncoder:
    """Ids of whole texts, each word encoded once and then remembered.

    For tokenizers that drop white space and look at letters, single digits and other characters between it by
    themselves, after lower-casing (``is_by_word``).  A word of Latin-1 letters and signs after them is put together of
    the two parts; every other word goes to the tokenizer as it is.
    """

    def __init__(self, tokenizer, dtype: str, end: int):
        self.tokenizer, self.dtype, self.last = tokenizer, dtype, np.array([end], dtype).tobytes()
        self.parts: dict[bytes, bytes] = {b"": b""}
        finals = [i for token, i in tokenizer.get_vocab().items() if token.endswith(_FINAL)]
        self.final = np.zeros(max([0, *tokenizer.get_vocab().values()]) + 1, bool)
        self.final[finals] = True

    def _learn(self, new: list[bytes]) -> None:
        """Encode runs of lower-case letters together: each ends with a token that marks the end of a word."""
        runs, others, made = [], [], {}
        for word in new:
            if word.isalpha():
                runs.append(word.decode())
                continue
            text = word.decode("utf-8", "replace")
            simple = _SIMPLE.fullmatch(text)
            if simple:
                made[word] = stem, signs = simple[1].lower(), simple[2]
                (runs if _LETTERS.fullmatch(stem) else others).append(stem)
                others.append(signs)
            else:
                made[word] = (text,)
                others.append(text)
        found: dict[str, bytes] = {"": b""}
        if runs:
            runs = list(dict.fromkeys(runs))
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids)
            ends = np.nonzero(self.final[ids])[0] + 1
            if len(ends) == len(runs):
                data, width = ids.astype(self.dtype).tobytes(), np.dtype(self.dtype).itemsize
                cuts = [0, *(ends * width).tolist()]
                found.update((r, data[x:y]) for r, x, y in zip(runs, cuts, cuts[1:], strict=False))
            else:
                others += runs
        others = list({p for p in others if p not in found})
        for p, encoding in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            found[p] = np.array(encoding.ids, self.dtype).tobytes()
        self.parts.update((w, b"".join([found[p] for p in made[w]]) if w in made else found[w.decode()]) for w in new)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if len(self.parts) > REMEMBERED:
            self.parts = {b"": b""}
        words = pc.ascii_split_whitespace(as_text(texts))
        distinct, places = coded(words.values)
        stems = [w.rstrip(_SIGNS) for w in distinct]
        stems = [s if s.isalpha() else w for s, w in zip(stems, distinct, strict=True)]
        signs = [w[len(s) :] for s, w in zip(stems, distinct, strict=True)]
        stems = [s.lower() if s.isalpha() else s for s in stems]
        known = self.parts
        new = list(set(stems).union(signs).difference(known))
        if new:
            self._learn(new)
        ids = [known[s] + known[e] for s, e in zip(stems, signs, strict=True)]
        for w in new:
            if len(w) > _LONGEST:
                del known[w]
        return put_together(ids, places, words.offsets.to_numpy(), self.last)


class WholeEncoder:
    """Ids of whole texts, for any tokenizer."""

    def __init__(self, tokenizer, dtype: str, end: int):
        self.tokenizer, self.dtype, self.end = tokenizer, dtype, end

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array([*e.ids, self.end], self.dtype).tobytes() for e in found]


_FINAL = "</w>"
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: Letters that lower-case one by one and have no other form, then signs that no contraction begins with.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: The same signs as bytes: all of ASCII but the apostrophe, which may begin a contraction.
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = re.compile(r"[A-Za-z]*[!-&(-/:-@\[-`{-~]*")
#: How a tokenizer that ``WordEncoder`` can stand for cuts a text (a fixed value of public vocabularies).
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_AS_TEXT = pc.CastOptions(pa.string(), allow_invalid_utf8=True)
#: Longest word remembered, in bytes.
_LONGEST = 200
#: Bytes of text encoded at once.
_SLICE = 4 << 20


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose texts, in the second column, are little more than ``_SLICE`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes, dtype=np.int64) // _SLICE
    cuts = [0, *(np.nonzero(np.diff(parts))[0] + 1).tolist(), len(sizes)]
    for x, y in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(x, y - x)


def encoded(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end: int = END, by_word: bool = True, limits: Sequence[int] = ()
) -> tuple[DataFrame, int]:
    """``id``, the document's token ids as bytes, and the range between ``limits`` that its id is in; and the bytes per token id.

    Words are encoded by themselves ``by_word`` where the tokenizer's file shows that this gives the same ids, else whole texts.
    """
    with open(tokenizer_path, encoding="utf-8") as f:  # a file of the installation, a few MB; executors need not have it
        source = f.read()
    width = id_bytes(source, end)
    model, name = docs.sparkSession.sparkContext.broadcast(source), uuid.uuid4().hex
    dtype, kind = f"<u{width}", WordEncoder if by_word and is_by_word(source) else WholeEncoder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _LOADED:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
            from tokenizers import Tokenizer

            _LOADED.clear()
            _LOADED[name] = kind(Tokenizer.from_str(model.value), dtype, end)
        for some in (s for batch in batches for s in _slices(batch)):
            keys = some.column(0)
            ids = _LOADED[name]([t or b"" for t in some.column(1).to_pylist()])
            ranges = np.searchsorted(np.array(limits, np.int64), keys.fill_null(0).to_numpy(zero_copy_only=False), "left")
            ranges[keys.is_null().to_numpy(zero_copy_only=False)] = len(limits)
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary()), pa.array(ranges.astype(np.int32))], names=["id", "ids", "range"])

    rows = docs.select(F.col(key).cast("bigint").alias("id"), utf8(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, ids binary, range int"), width


# -- files ---------------------------------------------------------------------------


def _packer(width: int):
    """One task's documents, in order, as the bytes of one file, in rows that end before a zero byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        sizes: list[int] = []
        rest = b""

        def rows(data: bytes) -> Iterator[pa.RecordBatch]:
            nonlocal rest
            data = rest + data
            cut = data.rfind(b"\0")
            if cut >= 0:
                yield pa.RecordBatch.from_arrays([pa.array([data[:cut]], pa.binary())], names=["value"])
            rest = data[cut + 1 :]

        _LOADED.clear()  # a worker that encoded before needs its words no more
        for batch in (s for whole in batches for s in _slices(whole)):
            ids += [_NO_ID if i is None else i for i in batch.column(0).to_pylist()]
            texts = batch.column(1).to_pylist()
            sizes += map(len, texts)
            yield from rows(b"".join(texts))
            del texts
        if ids:
            total = sum(sizes)
            ends = np.cumsum(np.array(sizes, "<i8")) // width
            trailer = np.array([width, total // width, len(ids)], "<i8")
            yield from rows(bytes(-total % 8) + np.array(ids, "<i8").tobytes() + ends.astype("<i8").tobytes() + trailer.tobytes())

    return run


def _limits(ids: DataFrame, files: int) -> list[int]:
    """Upper limits of all ranges but the last, one per file, from approximate quantiles."""
    if files == 1:
        return []
    found = ids.approxQuantile("id", [k / files for k in range(1, files)], 0.1 / files)
    return sorted(int(x) for x in found)


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", end: int = END, by_word: bool = True, file_bytes: int = FILE_BYTES
) -> None:
    """Encode the documents and write their ids below ``path``."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    files = max(1, math.ceil(total / file_bytes))  # ids take about as many bytes as their text
    limits = _limits(docs.select(F.col(key).cast("bigint").alias("id")), files)
    rows, width = encoded(docs, tokenizer_path, key, text, end, by_word, limits)
    order = [F.col("id").asc_nulls_last(), F.xxhash64("ids").asc(), F.col("ids").asc()]
    ranged = rows.repartitionById(files, "range").sortWithinPartitions(*order)
    packed = ranged.select("id", "ids").mapInArrow(_packer(width), "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


class TokenFile:
    """A token file over its bytes, or mapped from a local path."""

    def __init__(self, source: str | bytes):
        data = np.frombuffer(source, np.uint8) if isinstance(source, bytes) else np.memmap(source, np.uint8, "r")
        width, n_ids, n_docs = data[-24:].view("<i8").tolist()
        index = -(-n_ids * width // 8) * 8
        if len(data) != index + 16 * n_docs + 24:
            raise ValueError("the trailer does not fit the file")
        self.ids = data[: n_ids * width].view(f"<u{width}")
        self.documents = data[index : index + 8 * n_docs].view("<i8")
        self.ends = data[index + 8 * n_docs : index + 16 * n_docs].view("<i8")

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, k: int) -> np.ndarray:
        return self.ids[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])]


FILE_ROWS = (
    T.StructType().add("path", "string").add("place", "integer").add("id", "long").add("at", "long").add("n_tokens", "long").add("ids_crc32", "long")
)


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            data = content.as_py()
            if not data:
                continue
            file = TokenFile(data)
            ends = file.ends.astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            crcs = [zlib.crc32(file[k].astype("<u4").tobytes()) for k in range(len(file))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path.as_py()] * len(file), pa.string()),
                    pa.array(np.arange(len(file), dtype=np.int32)),
                    pa.array([None if i == _NO_ID else i for i in file.documents.tolist()], pa.int64()),
                    pa.array(starts),
                    pa.array(ends - starts),
                    pa.array(crcs, pa.int64()),
                ],
                names=FILE_ROWS.names,
            )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files below ``path``: id, file, place, ``start`` among all ids, and a checksum of its ids."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = stored(files.mapInArrow(_read_files, FILE_ROWS), "index")
    rows = rows.withColumn("file", F.regexp_extract("path", r"part-(\d+)", 1).cast("int"))
    # One row per file.
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "file").select("id", "path", "place", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

"""Near duplicates by SimHash, found through Golay-code fuzzy hashing.

A fingerprint has 64 bits.  The perfect Golay code of 23 bits has a codeword within three
bits of every value; a value's keys are its nearest codeword and, where that is three
bits away, the five codewords at four bits.  Two values at most two bits apart then share a key.

The fingerprint is cut into three segments.  Two differing bits leave at least one segment
untouched, so a candidate key is one segment as it is together with a Golay key of the
next segment: three choices of the untouched segment, one or six keys each.  Fingerprints that
share a candidate key are joined and verified by counting differing bits.

Only distinct fingerprints are linked, so exact copies cost nothing.  A key shared by more than
``GROUP`` fingerprints is not joined pairwise: each of its fingerprints meets the others, just
as exactly, at the fingerprints one bit away from it, where at most 65 can meet.

Defined results: a text without words (null, empty, white space) has fingerprint zero and is linked
like any other; the smallest id ignores null ids and is null where there is no other; repeated
rows share a component.  Columns of the table are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, stored, utf8
from .components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one candidate key that are still compared pairwise.
GROUP = 32

# Fixed value: generator polynomial of the binary Golay code of length 23.
_GENERATOR = 0b101011100011

# -- fingerprints --------------------------------------------------------------------

_BYTE_PLACE = np.arange(8, dtype=np.int64) * 256
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> list[int]:
    """XXH64 of every run of ``size`` words, or of all of them where there are fewer."""
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[size - 1 :], strict=False)]


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: a bit is set where over half of the hashes have it."""
    hashes = shingle_hashes((text or b"").lower().split(), size)
    if not hashes:
        return 0
    values = np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    seen = np.bincount((values + _BYTE_PLACE).ravel(), minlength=2048).reshape(8, 256)
    counts = (seen @ _BITS_OF_BYTE).ravel()
    return int(_POWERS[2 * counts > len(hashes)].sum(dtype=np.uint64).astype(np.int64))


def add_fingerprint(rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Replace the binary column ``__text`` by ``fingerprint``."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.schema.get_field_index("__text"))
        return [pa.array([fingerprint(t.as_py(), size) for t in texts], pa.int64())]

    return add_columns(rows, ["__text"], T.StructType().add("fingerprint", "long"), run)


# -- Golay keys ----------------------------------------------------------------------


def _remainder(values: np.ndarray) -> np.ndarray:
    """Syndrome: the remainder of 23-bit polynomials modulo the generator."""
    rest = values.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (_GENERATOR << (bit - 11)), rest)
    return rest


def _patterns() -> np.ndarray:
    """Six error patterns per syndrome: weights up to three, and of weight four where the lightest has three.

    Unused places repeat the first pattern.
    """
    table: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], dtype=np.int64)
        for error, syndrome in zip(errors.tolist(), _remainder(errors).tolist(), strict=True):
            if weight < 4 or table[syndrome][0].bit_count() == 3:
                table[syndrome].append(error)
    return np.array([(row * 6)[:6] if len(row) == 1 else row for row in table], dtype=np.int64)


_TABLES: list[np.ndarray] = []


def golay_keys(values: np.ndarray) -> np.ndarray:
    """The codewords near each 23-bit value, six columns; a value with a single one repeats it."""
    if not _TABLES:
        _TABLES.append(_patterns())
    return values[:, None] ^ _TABLES[0][_remainder(values)]


def candidate_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places into ``fingerprints`` and the candidate keys, without repeats."""
    bits = fingerprints.view(np.uint64)
    parts = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    places, keys = [], []
    for k, same in enumerate(parts):
        near = golay_keys(parts[(k + 1) % 3])
        whole = (np.int64(k) << 45) | (same[:, None] << 23) | near
        new = np.ones(near.shape, dtype=bool)
        new[:, 1:] = near[:, 1:] != near[:, :1]
        places.append(np.nonzero(new)[0])
        keys.append(whole[new])
    return np.concatenate(places), np.concatenate(keys)


def _map_longs(fps: DataFrame, name: str, make) -> DataFrame:
    """Rows ``fingerprint, name`` that ``make`` derives from batches of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            places, derived = make(values)
            yield pa.RecordBatch.from_arrays([pa.array(values[places]), pa.array(derived)], names=["fingerprint", name])

    return fps.select("fingerprint").mapInArrow(run, T.StructType().add("fingerprint", "long").add(name, "long"))


def _one_bit_away(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flips = np.concatenate([[np.uint64(0)], _POWERS])
    around = values.view(np.uint64)[:, None] ^ flips
    return np.repeat(np.arange(len(values)), 65), around.ravel().view(np.int64)


def links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect all at most ``MAX_BITS`` = 2 apart."""
    keys = stored(_map_longs(fps, "key", candidate_keys), "keys")
    shared = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    sized = stored(keys.join(shared, "key"), "sized")
    few = sized.where(F.col("n") <= group)
    a, b = few.select("key", F.col("fingerprint").alias("a")), few.select("key", F.col("fingerprint").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = a.join(b, "key").where((F.col("a") < F.col("b")) & (apart <= MAX_BITS)).select("a", "b")
    hot = stored(sized.where(F.col("n") > group).select("fingerprint").distinct(), "hot")
    meeting = _map_longs(hot, "at", _one_bit_away).groupBy("at").agg(F.collect_set("fingerprint").alias("all"))
    met = meeting.where(F.size("all") > 1).select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    return pairs.unionByName(met.where(F.col("a") != F.col("b"))).distinct()


# -- the operator --------------------------------------------------------------------


def _with_component(prints: DataFrame, key: str) -> DataFrame:
    """``fingerprint, component_id`` of a stored table of keys and fingerprints."""
    first = stored(prints.groupBy("fingerprint").agg(F.min(key).alias("first")), "first")
    roots = components(links(first))
    rooted = first.join(roots, first["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = stored(rooted, "rooted")
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    return stored(rooted.join(smallest, "root").select("fingerprint", "root", "component_id"), "members")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Per document: key, ``fingerprint`` as 16 hex digits, and the smallest key of its component."""
    prints = stored(add_fingerprint(docs.select(F.col(key), utf8(text).alias("__text")), size), "fingerprints")
    return prints.join(_with_component(prints, key), "fingerprint").select(
        key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _whole(docs: DataFrame) -> Column:
    """A hash of all columns that tells nulls apart, also inside nested values, and takes maps."""
    parts: list[Column] = []
    for f in docs.schema.fields:
        c = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        # An alias gives the value a plain name inside the object.
        parts += [c.isNull(), F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}) if nested else c]
    return F.xxhash64(*parts)


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """The documents, all columns, of which one is left per component: that with the smallest key.

    Among rows with the same key the one with the smallest hash of all its columns stays, null keys come last;
    rows that agree in everything, nulls and nested values included, are one document.
    """
    whole = _whole(docs)
    rows = docs.select(F.col(key).alias("__key"), whole.alias("__hash"), utf8(text).alias("__text"))
    prints = stored(add_fingerprint(rows, size), "fingerprints")
    alike = prints.groupBy("fingerprint", "__key", "__hash").agg(F.count(F.lit(1)).alias("__copies"))
    member = _with_component(prints, "__key").select("fingerprint", "root")
    order = F.struct(F.col("__key").isNull().alias("last"), "__key", "__hash", "__copies")
    winners = stored(alike, "alike").join(member, "fingerprint").groupBy("root").agg(F.min(order).alias("w")).select("w.__key", "w.__hash", "w.__copies")
    winners = stored(winners, "winners")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(key).alias("__own"), whole.alias("__h"))
    same = marked["__own"].eqNullSafe(winners["__key"]) & (marked["__h"] == winners["__hash"])
    if winners.where("__copies > 1").isEmpty():
        return marked.join(winners, same, "left_semi").select("__row.*")
    single = marked.join(winners.where("__copies = 1"), same, "left_semi")
    several = marked.join(winners.where("__copies > 1"), same, "left_semi").dropDuplicates(["__own", "__h"])
    return single.unionByName(several).select("__row.*")

import json
import random
import zlib

import numpy as np
import pytest

from rowflow.llm import packing
from rowflow.llm.tokens import WholeEncoder

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, capacity):
    """Every document whole and in order, every sequence without gaps; the number of sequences."""
    wanted = []
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        cuts = list(range(len(ids) % capacity or capacity, len(ids) + 1, capacity))
        for k, end in enumerate(cuts):
            start = max(0, end - capacity) if k else 0
            wanted.append((k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
    assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(wanted)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_words_are_encoded_as_whole_texts(tokenizer):
    draw = random.Random(5)
    bits = [" ", "  ", "\n", " \n", "\t", "\xa0", "\x85", "\x1c", " ", "a", "B", "don't", "'s", "'ll", "é", "ß", "Ⅳ", "²", "½"]
    bits += ["日本", "٣", "ʰ", "ɏ", "ɐ", "́", "!", "...", "<|endoftext|>", "foo", "12", "_", "\0", "😀", "x" * 90]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 30))).encode() for _ in range(3000)]
    fast, plain = packing.ByteLevelEncoder(tokenizer, "<u2", 2), WholeEncoder(tokenizer, "<u2", 2)
    assert fast(texts) == plain(texts)
    assert fast(texts[::-1]) == plain(texts[::-1])
    assert all(len(w) <= 64 for w in fast.after)


def test_tokenizers_are_told_apart():
    assert packing.is_byte_level(open(PATH, encoding="utf-8").read())
    assert not packing.is_byte_level(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    spaced = json.loads(open(PATH, encoding="utf-8").read())
    spaced["pre_tokenizer"]["add_prefix_space"] = True
    assert not packing.is_byte_level(json.dumps(spaced))


def fewest(sizes, capacity):
    """The least number of bins, by trying all."""
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for b in {r: b for b, r in enumerate(rooms) if r >= sizes[k]}.values():
            place(k + 1, [r - sizes[k] * (i == b) for i, r in enumerate(rooms)])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


def test_bound_and_best_fit_enclose_the_least_number():
    draw = random.Random(2)
    met = 0
    for _ in range(120):
        capacity = draw.choice([10, 24, 30])
        sizes = sorted((draw.randint(1, capacity) for _ in range(draw.randint(1, 9))), reverse=True)
        bins, offsets, left = packing.best_fit(np.array(sizes), capacity)
        assert all(left[b] >= 0 for b in bins) and len(left) == len(set(bins.tolist()))
        bound = packing.bins_needed(np.bincount(sizes, minlength=capacity + 1), capacity)
        least = fewest(sizes, capacity)
        assert bound <= least <= len(left)
        met += bound == least
    assert met > 100


def test_bound_sees_more_than_the_sum():
    # Three of 400 fill 1,200 of 1,024; only two fit a bin, so five need three bins though their sum needs two.
    assert packing.bins_needed(np.bincount([400] * 5, minlength=1025)) == 3
    assert packing.bins_needed(np.bincount([600] * 7, minlength=1025)) == 7
    assert packing.bins_needed(np.zeros(1025, np.int64)) == 0


def test_documents(spark, documents, odd, tokenizer):
    rows = packing.pack_documents(documents(odd), PATH, capacity=256).collect()
    check(rows, [t for _, t, _ in odd], tokenizer, 256)
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, None}


def test_empty_table(spark, documents):
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_a_text_that_fills_a_sequence(spark, documents, tokenizer):
    text = " a" * 63
    rows = packing.pack_documents(documents([(1, text, "a"), (2, text + " a", "a")]), PATH, capacity=64).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.offset) for r in rows) == [(1, 0, 64, 0), (2, 0, 1, 0), (2, 1, 64, 0)]


def test_exchange_saves_sequences_and_stays_near_the_bound(spark, documents, prose, tokenizer):
    texts = prose(900, 60, seed=8)
    docs = documents([(k, t, "a") for k, t in enumerate(texts)], parts=6)
    alone = packing.pack_documents(docs, PATH, capacity=128, size=100, rounds=0)
    together = packing.pack_documents(docs, PATH, capacity=128, size=100)
    before, after = (check(d.collect(), texts, tokenizer, 128) for d in (alone, together))
    found = packing.certificate(together, 128)
    assert found.sequences == after < before
    assert found.bound <= after <= found.bound + 3


def test_copies_without_ids_spread(spark, documents, tokenizer):
    docs = documents([(None, "the same text", "a")] * 3000, parts=4)
    rows = packing.pack_documents(docs, PATH, capacity=64, size=100)
    assert check(rows.collect(), ["the same text"] * 3000, tokenizer, 64) == packing.certificate(rows, 64).bound

import glob
import json
import os
import random
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from rowflow.llm import tokens  # noqa: E402

PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(PATH)


def test_words_encode_like_whole_texts(tokenizer):
    draw = random.Random(1)
    alphabet = [chr(c) for c in range(256)] + list("   \n\n\tabcABC's'tΣσİǅ가각ﬁ") + ["́", " ", "　", " ", "ͅ", "😀", "<|endoftext|>", "<|startoftext|>"]
    encode = tokens.WordEncoder(tokenizer, "<u2", 1)
    for _ in range(1500):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40)))
        want = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u2").tobytes()
        assert encode([text.encode()]) == [want], text


def test_many_texts_at_once_and_little_memory(tokenizer, monkeypatch):
    draw = random.Random(4)
    bits = [" ", "\n", "\t", "\x1c", "\xa0", "Word", "WORD,", "it's", "H\u0331", "h\u0331", "Ünder", "ẞ", "12ab", "...", "<|", "|>", "<|endoftext|>", "x" * 300]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 25))).encode() for _ in range(800)] + [b"", b"  ", b"\xff\xfe a"]
    encode, plain = tokens.WordEncoder(tokenizer, "<u2", 1), tokens.WholeEncoder(tokenizer, "<u2", 1)
    want = plain(texts)
    assert encode(texts) == want and encode([]) == [] and all(len(w) <= 200 for w in encode.parts)
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    assert [encode([t])[0] for t in texts] == want


def test_other_tokenizers_are_not_taken_word_by_word(spark, documents):
    source = open(PATH, encoding="utf-8").read()
    assert tokens.is_by_word(source)
    assert not tokens.is_by_word(open(public.path("byte_bpe_50k.json"), encoding="utf-8").read())
    for change in (
        lambda m: m["normalizer"]["normalizers"].pop(),
        lambda m: m["pre_tokenizer"]["pretokenizers"][0].update(behavior="Isolated"),
        lambda m: m["model"].update(end_of_word_suffix=None),
        lambda m: m["added_tokens"].append(dict(m["added_tokens"][0], content="word", id=49408)),
    ):
        model = json.loads(source)
        change(model)
        assert not tokens.is_by_word(json.dumps(model))
    spaced = " two  spaces\nand a line "
    rows, _ = tokens.encoded(documents([(1, spaced, "s")]), public.path("byte_bpe_50k.json"))
    ids = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json")).encode(spaced, add_special_tokens=False).ids
    assert bytes(rows.first()["ids"]) == np.array([*ids, 1], "<u2").tobytes()


def expected(tokenizer, rows):
    ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, _ in rows]
    return sorted(ids, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


@pytest.mark.parametrize("file_bytes,by_word", [(1 << 20, True), (3000, False)])
def test_files(spark, root, documents, odd, prose, tokenizer, file_bytes, by_word):
    rows = odd + [(100 + k, t, "s") for k, t in enumerate(prose(80, 60))] + [(-5, "negative id", "s")]
    tokens.write_tokens(documents(rows), f"{root}/t", PATH, file_bytes=file_bytes, by_word=by_word)
    want = expected(tokenizer, rows)
    got = tokens.read_index(spark, f"{root}/t").orderBy("start").collect()
    at = 0
    same = {}
    for r in got:
        same.setdefault(r.id, []).append((r.n_tokens, r.ids_crc32))
        assert r.start == at
        at += r.n_tokens
    assert [r.id for r in got] == [i for i, _ in want]
    for i in same:
        ids = [x for k, x in want if k == i]
        assert sorted(same[i]) == sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids)
    files = [f for f in sorted(glob.glob(f"{root}/t/part-*")) if os.path.getsize(f)]
    assert (len(files) > 1) == (file_bytes < 5000)
    mapped = [tokens.TokenFile(f) for f in files]
    whole = [f[k].tolist() for f in mapped for k in range(len(f))]
    assert sorted(whole) == sorted(x for _, x in want) and all(f.ids.dtype == np.dtype("<u2") for f in mapped)
    assert isinstance(mapped[0].ids.base, np.memmap) or isinstance(mapped[0].ids, np.memmap)


def test_wide_ids(spark, root, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "id_bytes", lambda *a: 4)
    tokens.write_tokens(documents([(1, "abc", "s"), (2, None, "s")]), f"{root}/t", PATH, end=70_000)
    file = next(tokens.TokenFile(f) for f in glob.glob(f"{root}/t/part-*") if os.path.getsize(f))
    assert file.ids.dtype == np.dtype("<u4") and file[1].tolist() == [70_000]


def test_no_documents_and_torn_file(spark, root, documents):
    tokens.write_tokens(documents([]), f"{root}/t", PATH)
    assert tokens.read_index(spark, f"{root}/t").count() == 0
    with pytest.raises(ValueError, match="trailer"):
        tokens.TokenFile(np.array([1, 2, 3, 2, 9, 1], "<i8").tobytes())


def test_the_packer_hands_on_a_few_megabytes_at_a_time():
    import pyarrow as pa

    from rowflow.llm import tokens

    texts = [b"\x01\x00" * 100_000] * 100
    batch = pa.RecordBatch.from_arrays([pa.array(range(100), pa.int64()), pa.array(texts, pa.binary())], names=["id", "ids"])
    made = [v.as_py() for part in tokens._packer(2)(iter([batch])) for v in part.column(0)]
    assert max(map(len, made)) < 2 * tokens._SLICE
    file = tokens.TokenFile(b"".join(v + b"\0" for v in made))
    assert len(file) == 100 and file[99].tolist() == [1] * 100_000

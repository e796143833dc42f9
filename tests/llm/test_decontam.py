import hashlib
import re

import pytest

from rowflow.llm import decontam

BARE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return BARE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    own = words(text)
    hit, names = set(), set()
    for name, item in items:
        w = words(item)
        for window in [tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))] if w else []:
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    names.add("null" if name is None else str(name))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(own), len(hit), len(names), digest, bool(hit)


@pytest.fixture
def bench(spark, prose):
    texts = prose(12, 40, seed=9)
    items = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (20, None), (21, "..."), (22, "Short Item"), (None, "nameless item x")]
    return items, spark.createDataFrame(items, "item_id long, text string")


def planted(odd, prose, items):
    texts = prose(60, 40, seed=12)
    rows = list(odd)
    for k, t in enumerate(texts):
        source = (items[k % 12][1] or "").split()
        if k % 3 == 0:
            t = f"{t} ... {', '.join(source[2:15]).upper()}!! {t}"
        if k % 7 == 0:
            t = f"short-ITEM {t} nameless  item\tx short item item"
        rows.append((100 + k, t, "s"))
    return rows


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 400])
def test_contamination(documents, odd, prose, bench, block_bytes):
    items, benchmark = bench
    rows = planted(odd, prose, items)
    got = decontam.contamination(documents(rows), benchmark, block_bytes=block_bytes).collect()
    texts = {i: t for i, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(text, items)
        inside = [w for s in r.spans for w in words(text[s.start : s.stop])]
        assert len(inside) == r.n_hit and bool(r.spans) == r.contaminated


def test_clean_documents_stay_whole(documents, odd, prose, bench):
    items, benchmark = bench
    rows = planted(odd, prose, items)
    docs = documents(rows)
    clean = decontam.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t, _ in rows if not brute(t, items)[4])


def test_empty_tables_and_giant_items(spark, documents, bench):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontam.contamination(documents([(1, "a b", "s")]), empty).collect()] == [0]
    assert decontam.contamination(documents([]), bench[1]).count() == 0
    with pytest.raises(ValueError, match="exceeds the block size"):
        decontam.contamination(documents([]), bench[1], block_bytes=10)


def test_giant_items_are_cut(spark, documents, odd, prose, monkeypatch):
    monkeypatch.setattr(decontam, "TOGETHER", 2)
    texts = prose(60, 60, seed=21)
    long = "w" * 5000
    # One item and the null ids are each far larger than four blocks; one window belongs to many items.
    items = [(1, " ".join(texts))] + [(None, t) for t in prose(40, 60, seed=22)] + [(1000 + k, "a window of many items") for k in range(300)] + [(2, f"{long} after")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = planted(odd, prose, [(k, texts[k]) for k in range(12)]) + [(900, f"here is a window of many items and {long.upper()} after it", "s"), (901, "w" * 5001 + " after", "s")]
    got = {r.doc_id: r for r in decontam.contamination(documents(rows), benchmark, block_bytes=2000).collect()}
    for i, t, _ in rows:
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == brute(t, items), i
    assert got[900].n_items == 301 and not got[901].contaminated

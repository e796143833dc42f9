import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from rowflow.llm import simhash
from rowflow.llm.components import components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), set()).add(n)
    return {frozenset(g) for g in groups.values()}


def test_golay_keys_are_shared_within_two_bits():
    # The code is linear, so values around one codeword stand for all.
    values = simhash._patterns()[:, 0]
    errors = [0] + [1 << a for a in range(23)] + [1 << a | 1 << b for a, b in combinations(range(23), 2)]
    keys = simhash.golay_keys(values)
    for e in errors:
        assert (keys[:, :, None] == simhash.golay_keys(values ^ e)[:, None, :]).any(axis=(1, 2)).all()
    assert (np.bitwise_count(keys ^ values[:, None]) <= 4).all()


def test_candidate_keys_are_shared_within_two_bits():
    draw = random.Random(2)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, 2)):
            b ^= 1 << bit
        both = np.array([a, b], np.uint64).view(np.int64)
        places, keys = simhash.candidate_keys(both)
        assert set(keys[places == 0]) & set(keys[places == 1])


def flipped(value, draw, most=2):
    for bit in draw.sample(range(64), draw.randint(0, most)):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("group", [2, 32])
def test_links_connect_what_is_two_bits_apart(spark, group):
    draw = random.Random(4)
    seeds = [0] + [draw.getrandbits(64) for _ in range(6)]
    prints = {flipped(draw.choice(seeds), draw, 3) for _ in range(260)} | {draw.getrandbits(64) for _ in range(40)}
    cloud = draw.getrandbits(64)  # many on the same candidate keys
    prints |= {cloud ^ (1 << a) ^ (1 << b) for a, b in combinations(range(44, 64), 2)}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), group).collect()
    near = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in links)
    assert brute_groups(signed, [(r.a, r.b) for r in links]) == brute_groups(signed, near)


def test_components(spark):
    draw = random.Random(6)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 580)]
    some = [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(70)]
    links = [(a, b) if draw.random() < 0.5 else (b, a) for a, b in chain + star + some + chain[:9]]
    got = {}
    for r in components(spark.createDataFrame(links, "a long, b long")).collect():
        got.setdefault(r.root, set()).add(r.node)
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {frozenset(g) for g in got.values()} == brute_groups(nodes, [(a, b) for a, b in links if a != b])
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def near_copies(texts):
    out = []
    for k, t in enumerate(texts):
        words = t.split()
        out += [t, " ".join([*words[:-1], "changed"]), t.upper(), t]
    return out


def test_documents(documents, odd, prose):
    rows = odd + [(100 + k, t, "s") for k, t in enumerate(near_copies(prose(25, 300)) + prose(20, 3))]
    got = simhash.near_duplicates(documents(rows)).collect()
    prints = {(i, t): brute_print(t) for i, t, _ in rows}
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{brute_print(t):016x}") for i, t, _ in rows)
    values = set(prints.values())
    groups = brute_groups(values, [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 2])
    for g in groups:
        ids = [i for (i, t), p in prints.items() if p in g and i is not None]
        assert {r.component_id for r in got if int(r.fingerprint, 16) in g} == {min(ids, default=None)}


def test_one_document_of_each_group_stays(documents, odd, prose):
    rows = odd + [(100 + k, t, "s") for k, t in enumerate(near_copies(prose(15, 200)))]
    rows += [(100, near_copies(prose(15, 200))[0], "s")] * 3  # the whole row again
    docs = documents(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    members = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, members))


def test_empty(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.drop_near_duplicates(documents([])).count() == 0


def test_nulls_maps_and_nested_values_tell_rows_apart(spark):
    columns = "doc_id long, text string, a string, b string, m map<string,int>, s struct<x:string,y:string>, v array<string>"
    plain = (1, "the same text", None, "x", {"k": 1}, ("p", None), ["q", None])
    rows = [plain, plain, (1, "the same text", "x", None, {"k": 1}, ("p", None), ["q", None])]
    rows += [(1, "the same text", None, "x", {"k": None}, ("p", None), ["q", None]), (1, "the same text", None, "x", {"k": 1}, (None, "p"), ["q", None])]
    rows += [(1, "the same text", None, "x", {"k": 1}, ("p", None), [None, "q"])]
    docs = spark.createDataFrame(rows, columns)
    hashed = docs.select(simhash._whole(docs).alias("h"))
    assert hashed.distinct().count() == len(rows) - 1
    kept = simhash.drop_near_duplicates(docs)
    assert kept.count() == 1 and kept.columns == docs.columns
    assert {str(r) for r in kept.collect()} <= {str(r) for r in docs.collect()}

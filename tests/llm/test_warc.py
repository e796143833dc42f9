import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowflow.llm import warc


def archive(plain):
    draw = random.Random(3)
    records = []
    for k in range(30):
        body = draw.randbytes(200) + b"WARC/1.1\r\nnot a record\x1f\x8b\x08 nor a member" if k % 3 else b"<p>same</p>"
        records.append(warc.record_bytes(str(k), f"http://x/{k}", body, "0" if k == 9 else None))
    return [r if plain else warc.member(r) for r in records]


def ids(found):
    return [f.headers["warc-record-id"].split(":")[-1][:-1] for *_, f in found if f]


@pytest.mark.parametrize("plain", [False, True])
def test_later_records_survive_damage(plain):
    parts = archive(plain)
    whole = b"".join(parts)
    assert ids(warc.salvage(whole)) == [str(k) for k in range(30)]
    start = [sum(map(len, parts[:k])) for k in range(31)]
    flip = bytearray(whole)
    flip[start[6] - 30] ^= 0xFF
    cut = whole[: start[7] + 20] + whole[start[9] :]
    noise = whole[: start[4]] + b"junk WARC/1.0\r\n\x1f\x8b\x08" + whole[start[4] :]
    torn = whole[:-15]
    for data, lost in ((bytes(flip), [5]), (cut, [7, 8]), (noise, []), (torn, [29])):
        found = list(warc.salvage(data))
        assert ids(found) == [str(k) for k in range(30) if k not in lost]
        gaps = [(o, n) for o, n, problem, _ in found if problem]
        assert len(gaps) == 1
        # Nothing is left out: records and gaps follow each other.
        assert sum(n for _, n, _, _ in found) == len(data)
        assert all(a[0] + a[1] == b[0] for a, b in zip(found, found[1:], strict=False))
    assert list(warc.salvage(b"")) == []
    assert [p for *_, p, f in warc.salvage(b"nothing here")][0]


def test_long_record_ends_in_a_zero_byte():
    record = warc.record_bytes("1", None, os.urandom((16 << 20) + 5))
    packed = warc.member(record)
    assert packed[-1] == 0
    found = list(warc.salvage(packed + warc.member(warc.record_bytes("2", None, b"x"))))
    assert ids(found) == ["1", "2"]


def pages(spark):
    rows = [(k, f"http://h/{k}", f"<p>page {k} é</p>" * (k % 5)) for k in range(40)]
    rows += [(100 + k, f"http://m/{k}", "<b>mirror</b>") for k in range(200)]
    rows += [(None, None, "<b>mirror</b>"), (None, "x\r\ny", "alone"), (50, "u", None), (100, "http://m/0", "<b>mirror</b>"), (300, "l", "z" * 200_000)]
    return rows, spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, payload long, id string").repartition(4)


@pytest.mark.parametrize("least", [0, 14])
def test_pages_come_back(spark, root, least):
    rows, df = pages(spark)
    warc.write_warc(df, f"{root}/w", least=least)
    everything = warc.read_warc(spark, f"{root}/w")
    assert warc.gaps(everything).count() == 0
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if i is not None and len(body) >= least:
            first[body] = min(i, first.get(body, i))
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        target = first.get(body)
        again = target is not None and target != i
        want[(str(i) if i is not None else "null", len(body), warc.digest_of(body), "revisit" if again else "response", str(target) if again else None)] += 1
    got = warc.records(everything).collect()
    assert Counter((r.record_id, r.payload_length, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(warc.digest_of(bytes(r.payload)) == r.payload_digest for r in got if r.record_type == "response")
    assert {r.target_uri for r in got if r.record_id == "null"} == {None, "x%0D%0Ay"}


def test_damaged_archive_on_disk(spark, root):
    _, df = pages(spark)
    warc.write_warc(df.coalesce(1), f"{root}/w")
    path = max((os.path.join(d, f) for d, _, fs in os.walk(f"{root}/w") for f in fs if f.startswith("part-")), key=os.path.getsize)
    with open(path, "r+b") as f:
        f.seek(os.path.getsize(path) // 3)
        f.write(b"\0" * 10)
    os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    everything = warc.read_warc(spark, f"{root}/w").cache()
    assert warc.gaps(everything).count() == 1
    assert warc.records(everything).count() == df.count() - 1


def test_no_pages(spark, root):
    warc.write_warc(pages(spark)[1].where("false"), f"{root}/w")
    assert warc.read_warc(spark, f"{root}/w").count() == 0


def test_shared_payload_is_joined_by_its_list_only(spark):
    _, df = pages(spark)
    rows = df.select(F.col("page_id").alias("id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    assert "Window" not in warc.with_first(rows)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("plain", [False, True])
def test_headers_of_any_length(plain):
    long = "data:text/html," + "x" * 100_000
    records = [warc.record_bytes("1", long, b"a"), warc.record_bytes("2", "\x01" * 30_000, b"a", "1"), warc.record_bytes("3", "u", b"b")]
    parts = records if plain else [warc.member(r) for r in records]
    found = list(warc.salvage(b"".join(parts)))
    assert ids(found) == ["1", "2", "3"] and not [p for *_, p, _ in found if p]
    assert [f.headers["warc-target-uri"] for *_, f in found] == [long, "%01" * 30_000, "u"]
    if plain:  # torn off within its long headers
        assert ids(warc.salvage(records[0][:90_000] + b"\r\n" + records[2])) == ["3"]


def test_long_urls_come_back(spark, root):
    rows = [(1, "data:," + "y" * 100_000, "<b>same</b>"), (2, "http://h/2", "<b>same</b>"), (3, "\x01" * 30_000, "other"), (4, "http://h/4", None)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{root}/w")
    everything = warc.read_warc(spark, f"{root}/w")
    assert warc.gaps(everything).count() == 0
    got = {r.record_id: (r.target_uri, r.refers_to) for r in warc.records(everything).collect()}
    assert got == {"1": (rows[0][1], None), "2": ("http://h/2", "1"), "3": ("%01" * 30_000, None), "4": ("http://h/4", None)}

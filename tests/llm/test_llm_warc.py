"""WARC archives: round trips, chains through any range size, magic inside payloads, damage."""

import glob
import hashlib
import os
import random

import pytest

from graphloom.llm import queries, warc
from graphloom.llm.common import Scratch

SCHEMA = "page_id bigint, url string, html string, kind string"
TRAP = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:666>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")


def pages(seed=1, n=60):
    rng = random.Random(seed)
    bodies = ["x" * 99, "y" * 100, "z" * 100, "é" * 50, TRAP, "\r\n\r\n" + TRAP * 3, "WARC/1.1\r\n", "WARC/1.1\r\nContent-Length: 9\r\n\r\n",
              "", None, "a\r\n\r\n", "long " * 3000, TRAP * 40]
    rows = [(i, f"http://h/{i}\r\nX: y" if i % 7 else None, rng.choice(bodies), "c") for i in range(n)]
    rng.shuffle(rows)
    return rows


def told(rows, min_bytes=100):
    by = {}
    for key, _, body, _ in rows:
        by.setdefault((body or "").encode(), []).append(key)
    out = []
    for key, _, body, _ in rows:
        data = (body or "").encode()
        known = [k for k in by[data] if k is not None]
        first = min(known) if known and len(data) >= min_bytes else key
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), "response" if first == key else "revisit",
                    None if first == key else first))
    return sorted(out, key=str)


def read_back(spark, folder, **kw):
    got = warc.resolved(warc.read_archives(spark, folder, **kw)).collect()
    number = lambda x: int(x) if x else None
    return sorted(((number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["kind"], number(r["refers_to"])) for r in got), key=str)


@pytest.mark.parametrize("range_bytes", [1, 37, 500, 1 << 20])
def test_round_trip_at_any_range_size(spark, scratch, range_bytes):
    rows = pages(n=25 if range_bytes < 100 else 60)
    if range_bytes == 1:
        rows = [r for r in rows if len(r[2] or "") < 1000][:8]
    warc.write_archives(warc.page_records(spark.createDataFrame(rows, SCHEMA).repartition(3)), f"{scratch}/w")
    assert read_back(spark, f"{scratch}/w", range_bytes=range_bytes) == told(rows)


def test_payloads_come_back_and_only_the_chain_is_read(spark, scratch):
    rows = pages(2)
    warc.write_archives(warc.page_records(spark.createDataFrame(rows, SCHEMA).coalesce(2)), f"{scratch}/w")
    got = warc.read_archives(spark, f"{scratch}/w", range_bytes=700)
    bodies = {key: (body or "").encode() for key, _, body, _ in rows}
    for r in got.collect():
        key = int(r["record_id"])
        assert key != 666 and (bytes(r["payload"]) == bodies[key] if r["kind"] == "response" else not r["payload"])
        if key % 7:
            assert r["url"] == f"http://h/{key}%0D%0AX: y"
    ranges = warc.archive_ranges(spark, f"{scratch}/w", 700)
    assert warc.candidates(ranges).count() > got.count()  # the traps were there


def test_pointer_jumping_reaches_the_chain_and_nothing_else(spark):
    # file a: 0 -> 1 -> ... -> 40, and a chain of its own from 100 on; file b: 0 alone
    jumps = [("a", i, i + 1) for i in range(40)] + [("a", 100 + i, 101 + i) for i in range(9)] + [("a", 200, 7), ("b", 5, 6)]
    starts = spark.createDataFrame([("a", 0), ("b", 0)], "path string, at bigint")
    got = warc.reached(starts, spark.createDataFrame(jumps, "path string, at bigint, exit bigint"), Scratch(spark, "t"))
    assert {tuple(r) for r in got.collect()} == {("a", i) for i in range(41)} | {("b", 0)}


@pytest.mark.parametrize("damage", ["cut", "inserted", "lost"])
def test_damage_is_an_error(spark, scratch, damage):
    warc.write_archives(warc.page_records(spark.createDataFrame(pages(3), SCHEMA).coalesce(1)), f"{scratch}/w")
    [path] = [p for p in glob.glob(f"{scratch}/w/part*") if os.path.getsize(p)]
    data = open(path, "rb").read()
    middle = len(data) // 2
    data = {"cut": data[:-10], "inserted": data[:middle] + b"!" + data[middle:], "lost": data[:middle] + data[middle + 1:]}[damage]
    os.mkdir(f"{scratch}/d")
    open(f"{scratch}/d/x.warc", "wb").write(data)
    with pytest.raises(Exception, match="do not lead to the end|no record|wrong payload digest"):
        warc.resolved(warc.read_archives(spark, f"{scratch}/d", range_bytes=900)).collect()


def test_odd_rows(spark, scratch):
    same = "s" * 120
    rows = [(3, "u", same, "c"), (3, "u", same, "c"), (None, None, same, "c"), (5, None, same, "c"), (9, "u", None, "c"), (9, "u", "", "c"),
            (9, "u", "w" * 200, "c"), (None, "u", "v" * 200, "c"), (None, "u", "v" * 200, "c"), (12, "u", "l" * 3_000_000, "c"), (13, "u", "l" * 3_000_000, "c")]
    warc.write_archives(warc.page_records(spark.createDataFrame(rows, SCHEMA)), f"{scratch}/w")
    got = read_back(spark, f"{scratch}/w")
    assert got == told(rows)
    empty = spark.createDataFrame([], SCHEMA)
    warc.write_archives(warc.page_records(empty), f"{scratch}/e")
    assert read_back(spark, f"{scratch}/e") == []


def test_binary_payloads_are_written_as_they_are(spark, scratch):
    rows = [(1, bytearray(range(256)) * 2), (2, bytearray(b"\xff\xfe\r\n\r\nWARC/1.1\r\n")), (4, bytearray(range(256)) * 2)]
    frame = spark.createDataFrame(rows, "id int, data binary").withColumn("url", warc.F.lit("u"))
    warc.write_archives(warc.page_records(frame, key="id", body="data"), f"{scratch}/w")
    got = {r["record_id"]: bytes(r["payload"]) for r in warc.read_archives(spark, f"{scratch}/w").collect() if r["kind"] == "response"}
    assert got == {"1": bytes(rows[0][1]), "2": bytes(rows[1][1])}


def test_a_payload_that_many_pages_share(spark, tmp_path):
    rows = [(i, "u", "shared " * 30 if i % 3 == 0 else f"own {i} " * 30, "c") for i in range(600)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op12_warc(spark, str(tmp_path))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == told(rows)

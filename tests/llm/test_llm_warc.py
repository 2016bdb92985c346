"""WARC archives: round trips, members by offset, damaged and foreign files."""

import gzip
import hashlib
import random
import uuid
import zlib

import pytest

from dialogue_engine.llm import warc
from dialogue_engine.scratch import scratch_dir

SCHEMA = "page_id long, url string, html string, `key` string, `Response` int, `a.b` int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", 1, 2) for i, u, h in rows], SCHEMA)


def expected(rows):
    """The contract, row by row."""
    largest = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and i is not None:
            largest[body] = max(largest.get(body, i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        first = largest.get(body)
        again = first is not None and (i is None or i < first)
        out.append(
            (i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", first if again else None)
        )
    return sorted(out, key=str)


def edge_rows():
    long = "<p>" + "é" * 700
    return [
        (1, "http://a/1", None),
        (2, "http://a/2", ""),
        (3, None, "ends\r\n"),
        (4, "http://a/4\r\nWARC-Type: fake", "a\r\n\r\nb\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
        (5, "http://a/5", "\r\n\r\n"),
        (6, "http://a/6", "\r"),
        (7, "http://a/7", long),
        (-8, "http://a/8", long),
        (9, "http://a/9", long),
        (9, "http://a/9", long),
        (None, "http://a/10", long),
        (10, "http://a/10", "x" * 999),
        (11, "http://a/11", "x" * 999),
        (12, "http://a/12", "x" * 1000),
        (13, "http://a/13", "x" * 1000),
        (13, "http://b/13", "another page of the same id"),
        (14, "http://a/14", "﻿z\0\n" + "long " * 200_000),
    ]


def test_edges(spark):
    rows = edge_rows()
    got = warc.page_records(pages(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_empty_table(spark):
    assert warc.page_records(pages(spark, [])).collect() == []


def test_payloads_come_back(spark):
    rows = edge_rows()
    index, folder = warc.archive_pages(pages(spark, rows))
    found = warc.read_members(index, folder)
    assert found.where("not intact").count() == 0
    assert {r.payload for r in found.where("record_type = 'revisit'").collect()} == {None}
    texts = warc.with_payloads(found).collect()
    assert sorted(bytes(r.payload) for r in texts) == sorted((h or "").encode() for _, _, h in rows)
    urls = {r.target_uri for r in texts}
    assert None in urls and "http://a/4%0D%0AWARC-Type: fake" in urls


def test_random_round_trip(spark):
    """Many separators and parts of separators, also across the reader's buffers."""
    rng = random.Random(4)
    bits = ["\r", "\n", "\r\n", "\r\n\r\n", "a", "WARC/1.1", "é", "x" * 1000]
    rows = [(i, f"u{i}", "".join(rng.choices(bits, k=rng.choice([0, 3, 60, 400])))) for i in range(400)]
    index, folder = warc.archive_pages(pages(spark, rows).repartition(3))
    got = warc.read_members(index, folder)
    assert got.where("not intact").count() == 0
    named = warc.with_payloads(got).select(warc.page_id_of(got.record_id).alias("i"), "payload")
    assert {r.i: bytes(r.payload).decode() for r in named.collect()} == {i: h for i, _, h in rows}


def folder_of(spark):
    folder = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    store, path = warc._opened(folder)
    store.create_dir(f"{path}/in", recursive=True)
    return store, path, folder


def put(store, path, data):
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)


def record(body, kind="resource", i=1):
    head = f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <urn:x:{i}>\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_each_member_stands_alone(spark):
    store, path, folder = folder_of(spark)
    bodies = [bytes([i]) * i + b"\xff\xfe\r\n\r\n" for i in range(50)]
    put(store, f"{path}/in/a.warc.gz", gzip.compress(b"".join(record(b, i=i) for i, b in enumerate(bodies))))
    # a file that has a member per record already, and one that is not compressed at all
    put(store, f"{path}/in/b.warc.gz", b"".join(gzip.compress(record(b)) for b in bodies[:7]))
    put(store, f"{path}/in/c.warc", record(b"plain"))
    index = warc.normalise(spark, f"{folder}/in", folder)
    rows = index.collect()
    assert len(rows) == 50 + 7 + 1 and all(r.problem is None for r in rows)
    seen = {}
    for r in rows:
        with store.open_input_file(f"{path}/archives/{r.archive}") as file:
            inflater = zlib.decompressobj(31)
            inflated = inflater.decompress(file.read_at(r.length, r.offset))
            assert inflater.eof and not inflater.unused_data
            seen.setdefault(r.archive[0], []).append((r.offset, warc.header_of(inflated)[1]))
    assert [b for _, b in sorted(seen["a"])] == bodies
    assert [b for _, b in sorted(seen["b"])] == bodies[:7]
    # gzip reads the whole archive as the concatenation of its members
    name = next(r.archive for r in rows if r.archive.startswith("a"))
    with store.open_input_file(f"{path}/archives/{name}") as file:
        assert gzip.decompress(file.read()) == b"".join(record(b, i=i) for i, b in enumerate(bodies))
    read = warc.read_members(index, folder).where("record_type = 'resource'").collect()
    assert sorted(bytes(r.payload) for r in read) == sorted([*bodies, *bodies[:7], b"plain"])


@pytest.mark.parametrize("tail, whole", [(record(b"y" * 100)[:-60], 2), (b"no record at all", 2)])
def test_damaged_files_are_named(spark, tail, whole):
    store, path, folder = folder_of(spark)
    good = record(b"one") + record(b"two")
    put(store, f"{path}/in/bad.warc.gz", gzip.compress(good + tail))
    put(store, f"{path}/in/good.warc.gz", gzip.compress(good))
    rows = warc.normalise(spark, f"{folder}/in", folder).collect()
    assert sum(r.problem is None for r in rows) == whole + 2
    (problem,) = [r for r in rows if r.problem]
    assert problem.archive.startswith("bad-") and str(len(good)) in problem.problem
    index = spark.read.schema(warc.INDEX).parquet(f"{folder}/index")
    assert warc.read_members(index, folder).count() == whole + 2


def test_a_changed_payload_is_seen(spark):
    index, folder = warc.archive_pages(pages(spark, [(1, "u", "some text")]))
    store, path = warc._opened(f"{folder}/archives")
    (row,) = index.collect()
    with store.open_input_file(f"{path}/{row.archive}") as file:
        inflated = zlib.decompress(file.read(), 31)
    packed = gzip.compress(inflated.replace(b"some", b"same"))
    put(store, f"{path}/{row.archive}", packed)
    changed = index.selectExpr("archive", "offset", f"{len(packed)}L as length", "problem")
    assert [r.intact for r in warc.read_members(changed, folder).collect()] == [False]


def test_cutter_takes_any_pieces():
    rng = random.Random(1)
    wanted = [record(bytes(rng.choices(b"\r\nab", k=rng.randrange(30)))) for _ in range(200)]
    stream = b"".join(wanted)
    for size in (1, 3, 50, 10_000):
        cutter, got = warc.Cutter(), []
        for at in range(0, len(stream), size):
            got += cutter.feed(stream[at : at + size])
        assert got == wanted and cutter.finish() is None

import hashlib
import io
import random

import pyarrow as pa
import pytest
import zstandard
from helpers import folder, rows

from rollkeeper.llm import warc as w
from rollkeeper.llm.files import located, new_folder

PAGE = {"page_id": pa.int64(), "url": pa.string(), "html": pa.string()}


def brute(pages):
    last = {}
    for i, _, html in pages:
        if i is not None and len((html or "").encode()) >= 1000:
            last[html] = max(last.get(html, i), i)
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        to = last.get(html) if len(raw) >= 1000 else None
        to = None if to is None or to == i else to
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to, None))
    return sorted(out, key=repr)


def test_against_brute_force(spark, tmp_path):
    r = random.Random(1)
    long = ["<p>é" * 400, "x" * 1000, "x" * 999, "y" * 3_000_000]
    pages = [(i, r.choice([None, "", "http://a b/\r\nX: y", "http://é/?a=1"]), r.choice([*long[:3], None, "", "short", f"z{i}" * 300])) for i in range(400)]
    pages += [(None, None, long[0]), (None, "u", "only null" * 200), (None, "u", "only null" * 200), (7, "u", long[3]), (7, "v", long[3]), (-3, "v", long[3])]
    path = folder(tmp_path, pages=({k: list(v) for k, v in zip(PAGE, zip(*pages, strict=True), strict=True)}, PAGE))
    got = sorted((tuple(x) for x in w.op10_warc(spark, path).collect()), key=repr)
    assert got == brute(pages)


def test_small_archives_payloads_and_damage(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<html>{i % 5}</html>" * 40) for i in range(50)], "page_id long, url string, html string")
    archives = w.write_archives(w.plan_records(pages), new_folder(spark, "warc-test"), archive_bytes=3000)
    assert archives.count() > 5
    got = rows(w.read_archives(archives))
    assert {x["page_id"]: x["payload"].decode() for x in got} == {i: f"<html>{i % 5}</html>" * 40 for i in range(50)}
    path = archives.first().path
    store, place = located(path)
    raw = store.open_input_stream(place, compression=None).read()
    with store.open_output_stream(place, compression=None) as out:
        out.write(raw[:-20])
    again = rows(w.read_archives(archives))
    assert sum(x["error"] is not None for x in again) == 1 and len(again) == 50


def test_frames_and_records():
    records = [w.record(i, f"u{i}", b"z" * i, hashlib.sha1(b"z" * i).hexdigest(), None, "2024-01-01T00:00:00Z") for i in range(300)]
    raw = w.archive(records)
    assert raw[:4] == b"\x5d\x2a\x4d\x18"
    assert list(w.frames(io.BytesIO(raw))) == records
    size = int.from_bytes(raw[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(raw[8 : 8 + size])
    assert list(w.frames(io.BytesIO(raw[:4] + len(packed).to_bytes(4, "little") + packed + raw[8 + size :]))) == records
    assert [w.parse(x)["payload"] for x in records] == [b"z" * i for i in range(300)]
    ok = records[20]
    for bad in (ok[:-1], ok + b"x", ok.replace(b"WARC/1.1", b"WARC/9"), ok.replace(b"WARC-Date", b"X-Date"), ok.replace(b"z" * 20, b"y" * 20), ok.replace(b"Content-Length: 20", b"Content-Length: 21")):
        with pytest.raises(w.Damaged):
            w.parse(bad)
    for bad in (b"", raw[:6], raw[: 8 + size // 2], b"\0" * 20):
        with pytest.raises(w.Damaged):
            list(w.frames(io.BytesIO(bad)))


def test_empty(spark, tmp_path):
    path = folder(tmp_path, pages=({k: [] for k in PAGE}, PAGE))
    assert w.op10_warc(spark, path).collect() == []

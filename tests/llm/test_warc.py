import gzip
import hashlib
from pathlib import Path

import pytest

from yearwheel.llm import files, warc
from yearwheel.operators.staging import Staging


def test_round_trip(spark, stage):
    big = "<p>é</p>" * 200
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y %41", big), (3, None, None), (4, "u", "small"), (5, "v", "small"),
            (2, "again", big), (None, "n", big), (None, "m", "y" * 2000), (None, "o", "y" * 2000), (9, "long", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    index = warc.write_archives(pages, stage.folder, file_bytes=2000)
    got = warc.read_records(index).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    found = sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key)
    want = []
    for page, url, html in rows:
        data = (html or "").encode()
        revisit = html == big and page != 2
        want.append((page, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert found == sorted(want, key=key)
    assert all(bytes(r.payload) == dict((u, h) for _, u, h in rows)[r.url].encode() for r in got if r.payload is not None and r.url)
    # a lookup reads only what it names, and archives are plain gzip members
    assert [r.page_id for r in warc.read_records(index.where("page_id = 4")).collect()] == [4]
    archive = next(Path(stage.folder).glob("warc/*.warc.gz"))
    assert gzip.decompress(archive.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert warc.read_records(warc.write_archives(pages.limit(0), Staging(spark).folder)).count() == 0


def test_damage_is_noticed():
    record = warc.record_bytes(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, False, "1970-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="length"):
        warc.parse_record(record[:-1])


def test_neighbouring_ranges_are_read_together(tmp_path, monkeypatch):
    path = str(tmp_path / "f")
    sink = files.Sink(str(tmp_path), ".bin")
    for k in range(10):
        sink.write(bytes([k]) * 10)
    sink.close()
    path = sink.path
    ranges = [(path, 0, 10), (path, 20, 10), (path, 90, 10)]
    assert [d for _, d in files.coalesced(ranges, gap=15)] == [b"\0" * 10, b"\2" * 10, b"\x09" * 10]

from __future__ import annotations

import gzip
import hashlib
import io
import zlib

import pytest

from zonewright.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload string, payload_digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "d") for r in rows], SCHEMA)


ROWS = [
    (5, "http://a.org/", "x" * 200),
    (3, "http://b.org/", "x" * 200),
    (9, None, "x" * 200),
    (4, "http://c.org/\r\nx", "short"),
    (6, "http://d.org/", "short"),
    (7, "http://e.org/", None),
    (8, "http://f.org/", ""),
    (10, "http://g.org/", "ß" * 60 + "\r\n\r\n" + "日" * 50_000),
]


def test_round_trip(spark):
    read = warc.read_warc(warc.write_warc(pages(spark, ROWS)), with_payload=True)
    got = {r.page_id: r for r in read.collect()}
    assert len(got) == len(ROWS)
    for name, _, html in ROWS:
        raw = (html or "").encode()
        row = got[name]
        assert row.payload_bytes == len(raw)
        assert row.payload_digest == hashlib.sha256(raw).hexdigest()
        revisit = name in (5, 9)
        assert row.record_type == ("revisit" if revisit else "response")
        assert row.refers_to == (3 if revisit else None)
        assert row.payload == (None if revisit else raw)


def test_empty_and_repeated(spark):
    assert warc.read_warc(warc.write_warc(pages(spark, []))).count() == 0
    twice = warc.read_warc(warc.write_warc(pages(spark, [ROWS[0], ROWS[0]]))).collect()
    assert [r.record_type for r in twice] == ["response", "response"]


def record(**change):
    row = {"page_id": 1, "url": "u", "payload": b"abc" * 50, "refers_to": None}
    row["payload_digest"] = hashlib.sha256(row["payload"]).hexdigest()
    return warc._record(row | change, "2020-01-01T00:00:00Z")


def test_members_and_errors():
    good = gzip.compress(record()) + gzip.compress(record(page_id=2))
    assert [r["page_id"] for r in warc.read_records(io.BytesIO(good))] == [1, 2]
    with pytest.raises(ValueError, match="payload"):
        list(warc.read_records(io.BytesIO(gzip.compress(record(payload_digest="0" * 64)))))
    changed = record().replace(b"abcabc", b"abdabc", 1)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(gzip.compress(changed))))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_records(io.BytesIO(good[:-30])))
    longer = record().replace(b"\r\n\r\n" + b"HTTP", b"\r\n\r\nX" + b"HTTP", 1)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(longer))))

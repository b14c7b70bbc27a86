from __future__ import annotations

import io
import struct

import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from zonewright.llm import token_frames as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def build(docs, frame_ids):
    sink = io.BytesIO()
    writer = tf.FrameWriter(sink, frame_ids)
    for name, ids in docs:
        writer.add(name, struct.pack(f"<{len(ids)}I", *ids))
    writer.close()
    return sink.getvalue()


DOCS = [(n, list(range(n * 3, n * 3 + n % 7))) for n in range(200)] + [(None, [5] * 500)]


def test_reader_fetches_only_what_it_needs():
    raw = build(DOCS, 64)
    reader = tf.FrameReader(Source(raw), 64)
    for k in (0, 3, 199, 200):
        ids = DOCS[k][1]
        assert reader.ids(k) == struct.pack(f"<{len(ids)}I", *ids)
    frames = len(reader.sizes)
    assert frames > 10
    lone = tf.FrameReader(Source(raw), 64)
    lone.ids(3)
    assert lone.fetched == 1
    assert not reader.valid[200]


def test_any_reader_of_the_format_can_read_it():
    raw = build(DOCS, 64)
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert plain == b"".join(struct.pack(f"<{len(i)}I", *i) for _, i in DOCS)


def test_damage_is_an_error():
    raw = bytearray(build(DOCS, 64))
    reader = tf.FrameReader(Source(bytes(raw)), 64)
    reader.sums = reader.sums + 1
    with pytest.raises(ValueError, match="checksum"):
        reader.ids(3)
    with pytest.raises(ValueError, match="seek table"):
        tf.FrameReader(Source(bytes(raw[:-1])), 64)


def test_odd_rows(odd, none):
    library = Tokenizer.from_file(PATH)
    listing = tf.write_token_files(odd, PATH, end_id=0)
    rows = tf.read_token_files(listing).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    by_id = {r.doc_id: r.text or "" for r in odd.collect()}
    at = 0
    for row in rows:
        ids = library.encode(by_id[row.doc_id], add_special_tokens=False).ids + [0]
        assert (row.start, row.n_tokens) == (at, len(ids))
        assert bytes(row.token_bytes) == struct.pack(f"<{len(ids)}I", *ids)
        at += len(ids)
    some = tf.read_token_files(listing, wanted=[7, 2]).collect()
    assert sorted(r.doc_id for r in some) == [2, 7]
    assert tf.read_token_files(tf.write_token_files(none, PATH)).count() == 0

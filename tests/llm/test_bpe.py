from __future__ import annotations

import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonewright.llm import bpe, pieces
from zonewright.llm import token_frames as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    parts = ["the", "ing", " ", "  ", "\n", "é", "ß", "9", "!!", "'s", "'re", "\t", "日本", "\x1c"]
    parts += ["<|endoftext|>", "😀", "aaaa", "word.", "end,", " ", "\r\n"]
    for k in range(120):
        yield "".join(rng.choice(parts) for _ in range(rng.choice([1, 5, 60, 300])))
    for letters in ("aeiotn", "abcdefghe", "=-", "    x", "0123"):
        yield "".join(rng.choice(letters) for _ in range(6000))
    yield " " * 3000 + "x" + "\n" * 2000
    yield ""


def test_pieces_and_streams_equal_the_library(library):
    table, encoder = bpe.merge_table(PATH), bpe.piece_encoder(PATH)
    rng = random.Random(5)
    assert 0 < table.reach < 1000
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode_column(pa.array([text]))[0].tolist() == want
        stream, got, at = bpe.StreamEncoder(table), [], 0
        while at < len(text):
            step = rng.choice([1, 3, 50, 900])
            got += stream.feed(text[at : at + step])
            assert len(stream.text) <= 8 * stream.BUFFER
            at += step
        assert got + list(stream.finish()) == want
        decoder = bpe.StreamDecoder(table)
        out = "".join(decoder.feed(want[i : i + 5]) for i in range(0, len(want), 5))
        assert out + decoder.finish() == text == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("window,longest,limit", [(1 << 20, 256, 32 << 20), (97, 12, 900)])
def test_columns_in_parts_equal_the_library(library, monkeypatch, window, longest, limit):
    monkeypatch.setattr(pieces, "WINDOW", window)
    monkeypatch.setattr(pieces, "LONGEST", longest)
    rows = [*texts(), None, "", "a\u00a0 b", "x\u3000 y", "one two\nthree\n\nfour ", " \n lead", "a \x85b"]
    for encoder in (bpe.piece_encoder(PATH), tf.library_encoder(PATH)):
        encoder.limit = limit
        ids, offsets = encoder.encode_column(pa.array(rows))
        for text, begin, end in zip(rows, offsets, offsets[1:]):
            assert ids[begin:end].tolist() == library.encode(text or "", add_special_tokens=False).ids


def counted(limit):
    """An encoder by code points, and the pieces it was asked for."""
    asked = []

    def compute(found):
        asked.extend(found)
        return [struct.pack(f"<{len(p)}I", *map(ord, p)) for p in found]

    return pieces.PieceEncoder(compute, limit=limit), asked


def points(texts):
    return [ord(c) for t in texts for c in t]


def test_a_piece_met_once_is_not_computed_again():
    encoder, asked = counted(1 << 20)
    for _ in range(2):
        assert encoder.encode_column(pa.array(["one two three"]))[0].tolist() == points(["one two three"])
    assert asked == ["one", " two", " three"]


def test_pieces_met_again_outlast_the_limit():
    encoder, asked = counted(1 << 16)
    for k in range(300):
        rows = ["often met", " ".join(f"{k}x{n}" for n in range(40))]
        assert encoder.encode_column(pa.array(rows))[0].tolist() == points(rows)
        assert encoder.memory.held() <= encoder.limit
    assert asked.count("often") == asked.count(" met") == 1
    assert encoder.memory.pieces < 300 * 40


def test_pieces_with_equal_hashes_keep_their_own_ids(monkeypatch):
    real = pieces.piece_hashes
    monkeypatch.setattr(pieces, "piece_hashes", lambda *a: real(*a) & np.uint64(3))
    encoder, _ = counted(1 << 20)
    rows = ["a b c d e f", "a longer word, and a longer ward", "a\0 a b\0\0 b", ""]
    for _ in range(2):
        ids, offsets = encoder.encode_column(pa.array(rows))
        assert ids.tolist() == points(rows)
        assert np.diff(offsets).tolist() == list(map(len, rows))


def test_transducer_holds_a_window_only():
    table = bpe.merge_table(PATH)
    machine, got = bpe.Transducer(table), []
    data = ("thinonerst" * 4000).encode()
    for at in range(0, len(data), 777):
        got += machine.feed(data[at : at + 777])
        assert len(machine.held) <= 2 * machine.window
    got += machine.finish()
    assert got == table.merge(data)


def test_broken_bytes_decode_like_the_library(library):
    table = bpe.merge_table(PATH)
    rng = random.Random(1)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        decoder = bpe.StreamDecoder(table)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(
            ids, skip_special_tokens=False
        )


def test_odd_rows(odd, none, library):
    coded = bpe.decode_ids(bpe.encode_texts(odd, PATH), PATH)
    rows = coded.collect()
    assert len(rows) == 10 and coded.columns[-2:] == ["ids", "decoded"]
    for row in rows:
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == (row.text or "") and row.key == "k"
    assert bpe.round_trip(odd, PATH).columns == coded.columns
    assert sorted(map(str, bpe.round_trip(odd, PATH).collect())) == sorted(map(str, rows))
    assert bpe.decode_ids(bpe.encode_texts(none, PATH), PATH).count() == 0
    assert bpe.round_trip(none, PATH).count() == 0
    skipped = odd.limit(1).select(F.array(F.lit(464), F.lit(None).cast("int")).alias("ids"))
    assert bpe.decode_ids(skipped, PATH).first().decoded == "The"

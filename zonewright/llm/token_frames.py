"""Token ids in files of independent zstandard frames with a trailing seek table.

One file per range of document ids, in ascending order. The ids of all documents of a file
form one stream of unsigned 32-bit little-endian numbers, cut every ``FRAME_IDS`` ids; each cut
is a zstandard frame of its own. Two skippable frames follow: the documents of the file (id and
length), and the seek table with the compressed size, size and checksum of every frame. A
reader fetches the tail, then only the frames that hold the documents it wants.

Defined results: a null or empty text has only the end id; null ids come first; documents
with equal ids stand next to each other, ordered by their text's hash; an empty table
writes no file and reads back as an empty table; a frame whose checksum differs is an error.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, slices
from zonewright.llm.files import one_task_each, open_folder, output_folder, task_file
from zonewright.llm.pieces import PieceEncoder

# Fixed values of the seekable zstandard format.
SKIPPABLE_DOCS = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_IDS = 1 << 18
MANIFEST = "number int, path string, documents bigint, ids bigint"


class FrameWriter:
    """Writes one file; holds one frame of ids and the document list."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS, level: int = 1):
        self.sink, self.frame_bytes = sink, 4 * frame_ids
        self.codec = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held = bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.names, self.counts = array("q"), array("q")
        self.valid = bytearray()

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.names.append(0 if doc_id is None else doc_id)
        self.valid.append(doc_id is not None)
        self.counts.append(len(ids) // 4)
        self.held += ids
        while len(self.held) >= self.frame_bytes:
            self._frame(bytes(self.held[: self.frame_bytes]))
            del self.held[: self.frame_bytes]

    def _frame(self, data: bytes) -> None:
        packed = self.codec.compress(data)
        self.sink.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> tuple[int, int]:
        """Documents and ids of the file."""
        if self.held:
            self._frame(bytes(self.held))
        docs = self.codec.compress(
            np.array(self.names, dtype="<i8").tobytes()
            + np.array(self.counts, dtype="<i8").tobytes()
            + bytes(self.valid)
        )
        self.sink.write(struct.pack("<II", SKIPPABLE_DOCS, len(docs)) + docs)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_FOOTER)
        # the length of the document frame, for a reader that starts at the end
        tail = struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table
        self.sink.write(struct.pack("<IIQ", SKIPPABLE_DOCS, 8, len(docs)) + tail)
        return len(self.counts), sum(self.counts)


class FrameReader:
    """Reads the documents of one file, fetching only the frames asked for."""

    def __init__(self, source, frame_ids: int = FRAME_IDS):
        self.source, self.frame_bytes = source, 4 * frame_ids
        self.codec = zstandard.ZstdDecompressor()
        size = source.size()
        count, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_FOOTER or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = size - 9 - 12 * count
        table = np.frombuffer(self._at(table_at, 12 * count), dtype="<u4").reshape(-1, 3)
        self.sizes, self.plain, self.sums = (table[:, k].astype(np.int64) for k in range(3))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        (docs_bytes,) = struct.unpack("<Q", self._at(table_at - 16, 8))
        docs = self.codec.decompress(self._at(table_at - 24 - docs_bytes, docs_bytes))
        n = len(docs) // 17
        self.names = np.frombuffer(docs, dtype="<i8", count=n)
        self.counts = np.frombuffer(docs, dtype="<i8", count=n, offset=8 * n)
        self.valid = np.frombuffer(docs, dtype=np.uint8, offset=16 * n).astype(bool)
        self.offsets = np.concatenate([[0], np.cumsum(self.counts)])
        self.frame, self.data = -1, b""
        self.fetched = 0

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def _load(self, k: int) -> bytes:
        if k != self.frame:
            packed = self._at(int(self.starts[k]), int(self.sizes[k]))
            self.data = self.codec.decompress(packed, max_output_size=int(self.plain[k]))
            if xxhash.xxh64_intdigest(self.data) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"checksum of frame {k} differs")
            self.frame = k
            self.fetched += 1
        return self.data

    def ids(self, document: int) -> bytes:
        """Ids of the n-th document of the file."""
        begin, end = 4 * int(self.offsets[document]), 4 * int(self.offsets[document + 1])
        out = []
        while begin < end:
            k, at = divmod(begin, self.frame_bytes)
            part = self._load(k)[at : at + end - begin]
            out.append(part)
            begin += len(part)
        return b"".join(out)


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The library's tokenizer; one per Python worker, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=1)
def library_encoder(path: str, run: str = "") -> PieceEncoder:
    """Ids by the tokenizers library; one per Python worker, which remembers a bounded number of bytes.

    The tasks of one ``run`` share what a worker remembers; another run starts with nothing.
    """
    tokenizer = _tokenizer(path)

    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    (feed,) = tokenizer.encode("\n", add_special_tokens=False).ids
    plain = re.compile(r" ?\S+").fullmatch

    def ids(found: list[str]) -> list[bytes]:
        """Pieces without inner white space stand one a line: a line feed is a token of its own."""
        out = [b""] * len(found)
        lines = [k for k, p in enumerate(found) if plain(p)]
        if any(s in "\n".join(found) for s in special):
            lines = [k for k in lines if not any(s in found[k] for s in special)]
        for start in range(0, len(lines), 4096):
            chosen = lines[start : start + 4096]
            (whole,) = tokenizer.encode_batch_fast(
                ["\n".join([found[k] for k in chosen])], add_special_tokens=False
            )
            flat = np.array(whole.ids, dtype="<u4")
            ends = np.append(np.flatnonzero(flat == feed), len(flat)).tolist()
            raw, begin = flat.tobytes(), 0
            for k, end in zip(chosen, ends, strict=True):
                out[k] = raw[4 * begin : 4 * end]
                begin = end + 1
        rest = [k for k, tokens in enumerate(out) if not tokens]
        encoded = tokenizer.encode_batch_fast([found[k] for k in rest], add_special_tokens=False)
        for k, e in zip(rest, encoded):
            out[k] = struct.pack(f"<{len(e)}I", *e.ids)
        return out

    return PieceEncoder(ids)


def _write_files(
    folder: str, id_col: str, text_col: str, vocabulary: str, end_id: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (p for b in batches for p in slices(b, text_col))
        first = next(rows, None)
        if first is None:
            return
        encoder = library_encoder(vocabulary, folder)
        files, path, address, number = task_file(folder, "tokens", ".zst")
        with files.open_output_stream(path, compression=None) as sink:
            writer = FrameWriter(sink)
            for part in itertools.chain([first], rows):
                names = part.column(id_col).to_pylist()
                ids, offsets = encoder.encode_column(part.column(text_col))
                places = offsets.tolist()
                for name, begin, stop in zip(names, places, places[1:]):
                    writer.add(name, ids[begin:stop].tobytes() + end)
            documents, ids = writer.close()
        yield pa.RecordBatch.from_pylist(
            [{"number": number, "path": address, "documents": documents, "ids": ids}],
            schema=pa.schema(
                [
                    ("number", pa.int32()),
                    ("path", pa.string()),
                    ("documents", pa.int64()),
                    ("ids", pa.int64()),
                ]
            ),
        )

    return run


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Writes the files and returns their list: number, path, documents, ids.

    The texts are dealt out by sampled ranges of (id, hash of text), so one id with very
    many rows still splits.
    """
    spark = docs.sparkSession
    folder = folder or output_folder(spark, "tokens")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(
            F.col(id_col).cast("long").alias("_id"),
            F.col(text_col).cast("string").alias("_text"),
            F.xxhash64(text_col).alias("_hash"),
        )
        .repartitionByRange(parts, "_id", "_hash")
        .sortWithinPartitions("_id", "_hash")
    )
    listing = ordered.mapInArrow(_write_files(folder, "_id", "_text", vocabulary, end_id), MANIFEST)
    return materialize(listing, "token-files")


def read_token_files(listing: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``token_bytes``.

    ``wanted`` limits the result to some document ids; then only their frames are read. The
    list of files, one row each, is summed on the driver.
    """
    spark = listing.sparkSession
    files, base = [], 0
    for row in listing.orderBy("number").collect():
        files.append((row.number, row.path, base))
        base += row.ids
    placed = spark.createDataFrame(files, "number int, path string, base bigint")
    asked = None if wanted is None else np.array(sorted(wanted), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = open_folder(row["path"])
                with system.open_input_file(path) as source:
                    reader = FrameReader(source)
                    chosen = np.arange(len(reader.names))
                    if asked is not None:
                        chosen = chosen[np.isin(reader.names, asked) & reader.valid]
                    for group in np.array_split(chosen, max(1, len(chosen) // 256)):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.names[group], mask=~reader.valid[group]),
                                pa.array(reader.offsets[group] + row["base"]),
                                pa.array(reader.counts[group]),
                                pa.array([reader.ids(int(k)) for k in group], pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "token_bytes"],
                        )

    return one_task_each(placed, "number", len(files)).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, token_bytes binary"
    )

"""WARC archives: writing pages as records, and reading them back sequentially.

Each record is one gzip member. Of pages with equal payloads of at least ``min_bytes``, the
smallest id is a response and the others are revisits that refer to it. The reader inflates a
file in small parts, frames each record by its content length, and computes digests as the
bytes pass, so its memory doesn't grow with a record (unless the payload is asked for).

Defined results: a null payload is empty; payloads below ``min_bytes`` are always responses; a
null url gives a record without a target (line ends in a url are escaped); repeated rows with
one id are all responses; a digest that differs, a broken length or a torn file is an error;
an empty table writes no archive and reads back as an empty table.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, measured, slices
from zonewright.llm.files import one_task_each, open_folder, output_folder, task_file

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

LISTING = "number int, path string, records bigint"
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, payload binary"
)
CHUNK = 1 << 16


def with_revisits(
    pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 100
) -> DataFrame:
    """``pages`` with ``payload``, ``payload_digest`` and ``refers_to``.

    First ids are found by an aggregate over digests that is combined on the map side. Only
    digests that occur more than once are joined back, so payloads move at most once, and
    not at all while that list is small.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    keyed = pages.withColumns({"payload": payload, "payload_digest": F.sha2(payload, 256)})
    repeated = (
        pages.select(F.col(id_col).alias("_id"), payload.alias("_payload"))
        .filter(F.octet_length("_payload") >= min_bytes)
        .select("_id", F.sha2("_payload", 256).alias("_digest"))
        .groupBy("_digest")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("_digest", "_first")
    )
    joined = keyed.join(
        measured(repeated, "repeated-payloads"), F.col("payload_digest") == F.col("_digest"), "left"
    )
    return joined.withColumn(
        "refers_to", F.when(~F.col("_first").eqNullSafe(F.col(id_col)), F.col("_first"))
    ).drop("_digest", "_first")


def _record(row: dict, date: str) -> bytes:
    """One record, uncompressed."""
    payload, revisit = row["payload"], row["refers_to"] is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{row['page_id']}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Type: {HTTP_TYPE}",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        clean = row["url"].replace("\r", "%0D").replace("\n", "%0A")
        head.append(f"WARC-Target-URI: {clean}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{row['refers_to']}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 100,
    date: str = "2020-01-01T00:00:00Z",
    level: int = 6,
    folder: str | None = None,
) -> DataFrame:
    """Writes one archive per task and returns their list: number, path, records."""
    spark = pages.sparkSession
    folder = folder or output_folder(spark, "warc")
    rows = with_revisits(
        pages.select(
            F.col(id_col).cast("long").alias("page_id"),
            F.col(url_col).cast("string").alias("url"),
            F.col(payload_col).cast("string").alias("html"),
        ),
        min_bytes=min_bytes,
    ).select("page_id", "url", "payload", "payload_digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (p for b in batches for p in slices(b, "payload"))
        first = next(parts, None)
        if first is None:
            return
        files, path, address, number = task_file(folder, "pages", ".warc.gz")
        count = 0
        with files.open_output_stream(path, compression=None) as sink:
            for part in itertools.chain([first], parts):
                for row in part.to_pylist():
                    member = zlib.compressobj(level, zlib.DEFLATED, 31)
                    sink.write(member.compress(_record(row, date)) + member.flush())
                    count += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([address]), pa.array([count])],
            names=["number", "path", "records"],
        )

    return materialize(rows.mapInArrow(run, LISTING), "warc-files")


class _Member:
    """Bytes of one gzip member, inflated part by part."""

    def __init__(self, source, pending: bytes):
        self.source, self.pending, self.buffer = source, pending, bytearray()
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.pending or self.source.read(CHUNK)
        if not data:
            raise ValueError("the archive ends inside a record")
        if not self.inflate.unconsumed_tail:
            self.pending = b""
        self.buffer += self.inflate.decompress(data, CHUNK)
        return True

    def line(self) -> bytes:
        """The next line without its line end."""
        seen = 0
        while (at := self.buffer.find(b"\r\n", seen)) < 0:
            seen = max(0, len(self.buffer) - 1)
            if not self._more():
                raise ValueError("the record ends inside its header")
        out = bytes(self.buffer[:at])
        del self.buffer[: at + 2]
        return out

    def take(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes in parts."""
        while length:
            if not self.buffer and not self._more():
                raise ValueError("the record is shorter than its content length")
            part = bytes(self.buffer[:length])
            del self.buffer[: len(part)]
            length -= len(part)
            if part:
                yield part

    def finish(self) -> bytes:
        """Checks the end of the record; returns what was read of the next member."""
        while self._more():
            pass
        if bytes(self.buffer) != b"\r\n\r\n":
            raise ValueError("bytes after the content length")
        return self.inflate.unused_data


def _headers(member: _Member) -> dict[str, str]:
    out = {}
    while line := member.line():
        name, _, value = line.decode().partition(":")
        out[name.lower()] = value.strip()
    return out


def _page(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "None" else int(value)


def read_records(source, with_payload: bool = False) -> Iterator[dict]:
    """Records of one open archive, in order; digests are verified."""
    pending = b""
    while pending or (pending := source.read(CHUNK)):
        member = _Member(source, pending)
        if member.line().decode() != VERSION:
            raise ValueError("no record header")
        head = _headers(member)
        length, revisit = int(head["content-length"]), head["warc-type"] == "revisit"
        block, payload, kept, http = hashlib.sha256(), hashlib.sha256(), [], bytearray()
        in_payload, size = False, 0
        for part in member.take(length):
            block.update(part)
            if not in_payload:
                http += part
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                in_payload, part = True, bytes(http[at + 4 :])
                del http[at:]
            payload.update(part)
            size += len(part)
            if with_payload:
                kept.append(part)
        pending = member.finish()
        stated = next(
            int(x.partition(b":")[2])
            for x in bytes(http).split(b"\r\n")
            if x.lower().startswith(b"content-length:")
        )
        digest = head["warc-payload-digest"].removeprefix("sha256:")
        if block.hexdigest() != head["warc-block-digest"].removeprefix("sha256:"):
            raise ValueError(f"block digest of {head['warc-record-id']} differs")
        if not revisit and (payload.hexdigest() != digest or size != stated):
            raise ValueError(f"payload of {head['warc-record-id']} differs")
        yield {
            "page_id": _page(head["warc-record-id"]),
            "url": head.get("warc-target-uri"),
            "payload_bytes": stated,
            "payload_digest": digest,
            "record_type": head["warc-type"],
            "refers_to": _page(head["warc-refers-to"]) if revisit else None,
            "payload": b"".join(kept) if with_payload and not revisit else None,
        }


def read_warc(listing: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of all archives of a listing; one task reads one archive front to back."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    per_batch = 16 if with_payload else 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, local = open_folder(path)
                with system.open_input_stream(local, compression=None) as source:
                    records = read_records(source, with_payload)
                    while group := list(itertools.islice(records, per_batch)):
                        yield pa.RecordBatch.from_pylist(group, schema=schema)

    count = listing.count()
    return one_task_each(listing, "number", count).mapInArrow(run, RECORDS)

"""Well-known binary <-> polygon columns, Arrow batches in and out.

Spark has no built-in that unpacks WKB into coordinates. Each batch is decoded
into flat coordinate arrays with list offsets; ring coordinates are read in one
step, Python only walks the part and ring headers.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from zonewright.functions.geometry import GEOMETRY

# Fixed values of the format: geometry kinds and the extended flags.
POLYGON, MULTIPOLYGON = 3, 6
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000


def _polygons(blob: bytes) -> list[list[np.ndarray]] | None:
    """Rings (n x 2 arrays) per polygon; None for other kinds."""

    def header(at: int) -> tuple[str, int, int, int]:
        order = "<" if blob[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", blob, at + 1)
        at += 9 if code & HAS_SRID else 5
        plain = code & 0x0FFFFFFF
        extra = bool(code & HAS_Z) + bool(code & HAS_M) + (0, 1, 1, 2)[plain // 1000 % 4]
        return order, plain % 1000, 2 + extra, at

    def polygon(order: str, width: int, at: int) -> tuple[list[np.ndarray], int]:
        (n_rings,) = struct.unpack_from(order + "I", blob, at)
        at += 4
        rings = []
        for _ in range(n_rings):
            (n,) = struct.unpack_from(order + "I", blob, at)
            flat = np.frombuffer(blob, order + "f8", n * width, at + 4)
            rings.append(flat.reshape(n, width)[:, :2])
            at += 4 + 8 * n * width
        return rings, at

    order, kind, width, at = header(0)
    if kind == POLYGON:
        return [polygon(order, width, at)[0]]
    if kind != MULTIPOLYGON:
        raise ValueError(f"geometry of kind {kind}; only polygons and multipolygons are zones")
    (n_parts,) = struct.unpack_from(order + "I", blob, at)
    at += 4
    parts = []
    for _ in range(n_parts):
        part_order, _, part_width, at = header(at)
        rings, at = polygon(part_order, part_width, at)
        parts.append(rings)
    return parts


def _offsets(sizes: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32"))


def _decode(blobs: pa.Array) -> pa.Array:
    shapes = [None if b is None else _polygons(b) for b in blobs.to_pylist()]
    parts = [p for s in shapes if s is not None for p in s]
    rings = [r for p in parts for r in p]
    points = np.concatenate(rings).astype("f8") if rings else np.empty((0, 2))
    vertices = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(points[:, 0])), pa.array(np.ascontiguousarray(points[:, 1]))], ["x", "y"]
    )
    nested = pa.ListArray.from_arrays(_offsets([len(r) for r in rings]), vertices)
    nested = pa.ListArray.from_arrays(_offsets([len(p) for p in parts]), nested)
    return pa.ListArray.from_arrays(
        _offsets([0 if s is None else len(s) for s in shapes]),
        nested,
        mask=pa.array([s is None for s in shapes], pa.bool_()),
    )


def _encode(geometry: pa.Array, srid: int) -> pa.Array:
    """Each level is flattened once; a ring is a slice of one coordinate buffer."""
    part_counts = pc.list_value_length(geometry).to_pylist()
    parts = geometry.flatten()
    rings = parts.flatten()
    vertices = rings.flatten()
    lengths = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
    axes = dict(zip((f.name for f in vertices.type), vertices.flatten(), strict=True))
    pairs = np.stack([axes[c].to_numpy(zero_copy_only=False).astype("<f8") for c in "xy"], axis=1)
    buffer = memoryview(pairs.tobytes())
    ends = np.cumsum(lengths, dtype="int64") * 16
    pieces = [
        struct.pack("<I", n) + buffer[end - 16 * n : end]
        for n, end in zip(lengths.tolist(), ends.tolist(), strict=True)
    ]
    ring_counts = pc.fill_null(pc.list_value_length(parts), 0).to_pylist()
    polygons, at = [], 0
    for n in ring_counts:
        polygons.append(struct.pack("<I", n) + b"".join(pieces[at : at + n]))
        at += n
    whole, at = [], 0
    for n in part_counts:
        if n is None:
            whole.append(None)
            continue
        own = polygons[at : at + n]
        at += n
        if n == 1:
            whole.append(struct.pack("<BII", 1, POLYGON | HAS_SRID, srid) + own[0])
        else:
            head = struct.pack("<BIII", 1, MULTIPOLYGON | HAS_SRID, srid, n)
            whole.append(head + b"".join(struct.pack("<BI", 1, POLYGON) + p for p in own))
    return pa.array(whole, pa.binary())


def srid_of(blob: str) -> str:
    """Number of the coordinate system in extended WKB, as SQL text over a binary; null without one."""
    head = f"hex(substring({blob}, 1, 9))"

    def word(at: int) -> str:
        octets = [f"substr({head}, {at + 2 * i}, 2)" for i in range(4)]
        swapped = ", ".join(reversed(octets))
        text = f"CASE WHEN substr({head}, 1, 2) = '01' THEN concat({swapped}) ELSE concat({', '.join(octets)}) END"
        return f"CAST(conv({text}, 16, 10) AS BIGINT)"

    return f"CASE WHEN {word(3)} & {HAS_SRID}L != 0 THEN {word(11)} END"


def from_wkb(column: Column) -> Column:
    """Polygon or MultiPolygon WKB (plain, extended or ISO) -> geometry; other kinds fail the job."""

    @F.arrow_udf(GEOMETRY)
    def decode(blobs: pa.Array) -> pa.Array:
        return _decode(blobs)

    return decode(column)


def to_wkb(column: Column, srid: int = 4326) -> Column:
    """Geometry -> extended WKB, little-endian, with the coordinate system's number."""

    @F.arrow_udf("binary")
    def encode(geometry: pa.Array) -> pa.Array:
        return _encode(geometry, srid)

    return encode(column)

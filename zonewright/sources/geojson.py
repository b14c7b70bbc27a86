"""One large FeatureCollection read by many tasks.

The file is split at closing braces wherever the reader's byte ranges happen to fall. Whether a brace
belongs to a string, and how deep it is nested, depends on all text before it. So a first pass
sums up each range for both cases, that it begins inside a string or not: how far the depth moves,
how low it gets, and whether the range ends in a string. From these few rows, one per range, the
true state at each border follows, and the second pass cuts out the objects at the depth of features.
A feature that lies across borders comes as fragments, joined by the range it begins in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.session import written
from zonewright.sources.tables import polygons_from_geojson

#: Depth inside a feature of a collection: the document, its list of features, the feature.
FEATURE_DEPTH = 3
# A string to its end, or to the end of the text; or a bracket.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?$)|[{}\[\]]', re.S)
_STRING_REST = re.compile(r'(?:[^"\\]|\\.)*("|\\?$)', re.S)
_STEP = {"{": 1, "[": 1, "}": -1, "]": -1}
_SUMMARY = "file string, block bigint, " + ", ".join(
    f"delta{k} bigint, low{k} bigint, inside{k} boolean" for k in (0, 1)
)


def _brackets(text: str, inside: bool) -> tuple[list[tuple[int, str]], bool]:
    """Brackets outside strings with their places, and whether the text ends in a string."""
    start = 0
    if inside:
        rest = _STRING_REST.match(text)
        if rest[1] != '"':
            return [], True
        start = rest.end()
    found, ends_inside = [], False
    for token in _TOKEN.finditer(text, start):
        part = token[0]
        if part[0] == '"':
            ends_inside = token.end() == len(text) and not re.fullmatch(r'"(?:[^"\\]|\\.)*"', part, re.S)
        else:
            found.append((token.start(), part))
    return found, ends_inside


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    """(file, range, text up to and with a closing brace), in the order of the file."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], list[list]] = {}
    for file, block, value in _rows(batches):
        for state in held.setdefault((file, block), [[0, 0, False], [0, 0, True]]):
            found, state[2] = _brackets(value + "}", state[2])
            for _, bracket in found:
                state[0] += _STEP[bracket]
                state[1] = min(state[1], state[0])
    rows = [
        {"file": f, "block": b} | {f"{n}{k}": v for k in (0, 1) for n, v in zip(("delta", "low", "inside"), s[k])}
        for (f, b), s in held.items()
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


def _starts(summaries: list) -> dict[tuple[str, int], tuple[int, bool, int]]:
    """Depth, string state and the range that an open feature began in, at the start of each range."""
    out: dict[tuple[str, int], tuple[int, bool, int]] = {}
    file, depth, inside, owner = None, 0, False, -1
    for row in sorted(summaries, key=lambda r: (r["file"], r["block"])):
        if row["file"] != file:
            file, depth, inside, owner = row["file"], 0, False, -1
        out[file, row["block"]] = (depth, inside, owner)
        k = int(inside)
        if depth < FEATURE_DEPTH or depth + row[f"low{k}"] < FEATURE_DEPTH:
            owner = row["block"]
        depth, inside = depth + row[f"delta{k}"], row[f"inside{k}"]
    return out


def _features(starts: dict[tuple[str, int], tuple[int, bool, int]]):
    """Whole features, with no owner, and fragments, by the range that the feature begins in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, depth, inside, owner, part = None, 0, False, -1, []
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out)] or [[], [], [], []]
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "owner", "block", "text"]
            )

        def close_range() -> None:
            if part:
                out.append((at[0], at[1] if owner < 0 else owner, at[1], "".join(part)))
                part.clear()

        for file, block, value in _rows(batches):
            if (file, block) != at:
                close_range()
                at = (file, block)
                depth, inside, owner = starts[at]
                if depth < FEATURE_DEPTH:
                    owner = -1
            text = value + "}"
            found, inside = _brackets(text, inside)
            begin = 0 if depth >= FEATURE_DEPTH else None
            for place, bracket in found:
                depth += _STEP[bracket]
                if bracket == "{" and depth == FEATURE_DEPTH:
                    begin = place
                elif bracket == "}" and depth == FEATURE_DEPTH - 1 and begin is not None:
                    part.append(text[begin : place + 1])
                    whole = "".join(part)
                    part.clear()
                    out.append((file, None if owner < 0 else owner, block, whole))
                    owner, begin = -1, None
            if begin is not None and depth >= FEATURE_DEPTH:
                part.append(text[begin:])
            if len(out) >= 10_000:
                yield batch()
        close_range()
        if out:
            yield batch()

    return run


def read_geojson_split(
    spark: SparkSession, path: str, properties: str | None = None, split_bytes: int | None = None
) -> DataFrame:
    """FeatureCollection files of any size -> one row per feature: properties and geometry.

    As ``read_geojson``, but the byte ranges of one file go to many tasks, whatever its line breaks.
    ``split_bytes`` sets the size of a range; else the session's setting holds.
    """
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    if split_bytes:
        spark.conf.set(setting, str(split_bytes))
    try:
        pieces = (
            spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
        )
        starts = _starts(pieces.mapInArrow(_summaries, _SUMMARY).collect())
        cut = pieces.mapInArrow(_features(starts), "file string, owner bigint, block bigint, text string")
        found = written(cut, "features")
    finally:
        spark.conf.set(setting, before)
    # at most one feature begins in a range and ends beyond it
    stitched = (
        found.filter("owner IS NOT NULL")
        .groupBy("file", "owner")
        .agg(F.array_join(F.expr("transform(sort_array(collect_list(struct(block, text))), p -> p.text)"), "").alias("text"))
    )
    texts = found.filter("owner IS NULL").select("text").unionByName(stitched.select("text"))
    schema = "type string, properties string, geometry struct<type string, coordinates string>"
    features = texts.select(F.from_json("text", schema).alias("f")).filter("f.type = 'Feature'")
    geometry = polygons_from_geojson(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    if properties is None:
        return features.select(F.col("f.properties").alias("properties"), geometry.alias("geometry"))
    return features.select(
        F.from_json("f.properties", properties).alias("p"), geometry.alias("geometry")
    ).select("p.*", "geometry")

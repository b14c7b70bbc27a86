"""Removal of repeated byte strings with a distributed sparse suffix array.

A string of ``LENGTH`` bytes that occurs twice has, in both places, the same *anchor*: the
24-byte piece inside it with the smallest hash. So only the suffixes that start at anchors are
sorted. The work has two passes over the texts:

1. Every anchored suffix is a short row: its leading token (hash of the anchor), a hash of
   the bytes that its windows span, and its place. The rows are dealt out by sampled
   splitters over (token, span, place), so that even one very frequent token splits over many
   buckets. A span that stands earlier in the same bucket is removed at once. Suffixes with an
   unrepeated token are dropped. What is left (tokens with several different spans, and the
   first and last token of each bucket, which may go on in the next one) is a candidate.
2. Candidates get their bytes and are dealt out again by sampled splitters over the leading
   token. Each bucket sorts them by multikey quicksort, once by what follows the anchor and
   once by what precedes it, backwards; the common prefixes of neighbours then number all
   windows exactly, and the earliest holder of each window stays. A token with more than
   ``SPLIT_ROWS`` candidates is split over buckets and compared across their boundaries: each
   part sends the first holder of each of its windows, a 128-bit digest and a place.

The removed runs of a document are gathered, merged and cut out of its bytes.

Defined results: a null text is empty and has nothing to remove; texts shorter than the length
stay whole; equal texts keep the smallest id only; a null id comes first; rows that share an id
and a text are one document and are judged alike, rows that share an id only are told apart by
their text's hash; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewright.llm.common import carries, materialize, measured, slices
from zonewright.llm.textkernel import mix, text_buffer, weights

_U = np.uint64
LENGTH = 100
ANCHOR = 24
#: Anchor positions inside a window of LENGTH bytes.
PLACES = LENGTH - ANCHOR + 1
#: Rows that a bucket sorts at a time, in whole tokens.
BLOCK_ROWS = 40_000
#: Candidates of one token above which it is split over buckets.
SPLIT_ROWS = 20_000

_GRAM = weights(3, 7)
_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < count:
        grown = np.full(max(count, 1 << 20), base, _U)
        grown[0] = 1
        held = _POWERS[base] = np.multiply.accumulate(grown)
    return held


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each position."""
    n = len(data) - ANCHOR + 1
    if n <= 0:
        return np.zeros(0, _U)
    buffer = np.ascontiguousarray(data)
    total = np.zeros(n, _U)
    for k in range(3):
        view = np.ndarray((n,), "<u8", buffer, offset=8 * k, strides=(1,))
        total += view * _GRAM[k]
    return mix(total)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchored suffixes: token, span hash, text, first and last window start, anchor."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (_U, _U, *[np.int64] * 4))
    grams = gram_hashes(data)
    bits = max(1, int(len(grams)).bit_length())
    keyed = (grams >> _U(bits) << _U(bits)) | np.arange(len(grams), dtype=_U)
    # smallest of PLACES neighbours, by running minima of blocks from both sides
    blocks = -(-len(keyed) // PLACES)
    padded = np.full(blocks * PLACES, np.iinfo(_U).max, _U)
    padded[: len(keyed)] = keyed
    table = padded.reshape(blocks, PLACES)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:n], ahead[PLACES - 1 : PLACES - 1 + n])
    at = (low & _U((1 << bits) - 1)).astype(np.int64)
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    valid = owner[:n] == owner[LENGTH - 1 :]
    changed = np.ones(n, bool)
    changed[1:] = (at[1:] != at[:-1]) | ~valid[:-1] | (owner[1:n] != owner[: n - 1])
    first = np.flatnonzero(changed & valid)
    if not len(first):
        return tuple(np.zeros(0, t) for t in (_U, _U, *[np.int64] * 4))
    ends = np.ones(n, bool)
    ends[:-1] = changed[1:] | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    where = at[first]
    power, inverse = _powers(_STEP, len(grams)), _powers(_STEP_INVERSE, len(grams))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(grams * power[: len(grams)], dtype=_U)])
    span = (sums[last + PLACES] - sums[first]) * inverse[first]
    shape = ((last - first) * PLACES + (where - first)).astype(_U)
    return grams[where], mix(span + shape * _U(0xD6E8FEB86659FD93)), owner[first], first, last, where


# A place in one number: 15 bits of the text's hash, the start in the text, window count, anchor.
def pack(tag: np.ndarray, start: np.ndarray, more: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (tag << 48) | (start << 14) | (more << 7) | anchor


def unpack(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return place >> 48, (place >> 14) & ((1 << 34) - 1), (place >> 7) & 127, place & 127


def _columns(batches: Iterator[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    """Whole columns of a bucket as arrays; a bucket's size is bounded by the range exchange."""
    held = [b for b in batches if b.num_rows]
    return [
        np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in held])
        if held
        else np.zeros(0, np.int64)
        for n in names
    ]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchored suffixes of the texts ``_bytes``."""
    for batch in batches:
        for part in slices(batch, "_bytes", 1 << 20):
            data, offsets = text_buffer(part.column("_bytes"))
            token, span, owner, first, last, where = anchors(data, offsets)
            ids = part.column("_id").to_numpy(zero_copy_only=False)
            tags = part.column("_tag").to_numpy(zero_copy_only=False).astype(np.int64)
            place = pack(tags[owner], first - offsets[owner], last - first, where - first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token.view(np.int64)),
                    pa.array(span.view(np.int64)),
                    pa.array(ids[owner]),
                    pa.array(place),
                ],
                names=["token", "span", "id", "place"],
            )


def _changes(*keys: np.ndarray) -> np.ndarray:
    """True where a sorted row differs from the one before it."""
    out = np.ones(len(keys[0]), bool)
    if len(out) > 1:
        out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats found by span, and candidates, of one bucket."""
    token, span, ids, place = _columns(batches, ["token", "span", "id", "place"])
    if not len(token):
        return
    order = np.lexsort((place, ids, span, token))
    token, span, ids, place = token[order], span[order], ids[order], place[order]
    new_token, new_span = _changes(token), _changes(token, span)
    # rows that share an id and a text are one document: the same place is no earlier place
    group = np.cumsum(new_span) - 1
    head = np.flatnonzero(new_span)[group]
    repeat = (ids != ids[head]) | (place != place[head])
    number = np.cumsum(new_token) - 1
    kinds = np.bincount(number, weights=new_span)[number]
    edge = (number == 0) | (number == number[-1])
    candidate = new_span & ((kinds > 1) | edge)
    for kind, rows in ((0, np.flatnonzero(repeat)), (1, np.flatnonzero(candidate))):
        for start in range(0, len(rows), 100_000):
            some = rows[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), kind, np.int32)),
                    pa.array(token[some]),
                    pa.array(ids[some]),
                    pa.array(place[some]),
                ],
                names=["kind", "token", "id", "place"],
            )


def multikey_sort(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows by multikey quicksort over 8-byte keys.

    Only rows that are still tied are looked at with the next key.
    """
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    keys = padded.view(">u8")
    order = np.argsort(keys[:, 0], kind="stable")
    tied = np.zeros(n, bool)
    same = keys[order[1:], 0] == keys[order[:-1], 0]
    tied[1:] |= same
    tied[:-1] |= same
    group = np.cumsum(np.concatenate([[True], ~same])) if n else np.zeros(0, int)
    for k in range(1, keys.shape[1]):
        at = np.flatnonzero(tied)
        if not len(at):
            break
        part, number, column = order[at], group[at], keys[order[at], k]
        inner = np.lexsort((column, number))
        order[at] = part[inner]
        column = column[inner]
        same = (number[1:] == number[:-1]) & (column[1:] == column[:-1])
        follows = np.concatenate([[False], same])
        tied[at] = follows
        tied[at[:-1]] |= same
        group[at] = np.cumsum(~follows)
    return order


def prefix_lengths(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it in ``order``."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        found = differ.any(axis=1)
        out[1:] = np.where(found, differ.argmax(axis=1), rows.shape[1])
    return out


def _resolve(
    token: np.ndarray, ids: np.ndarray, place: np.ndarray, spans: list[bytes], edge: np.ndarray
) -> tuple[list[tuple], list[tuple]]:
    """Removed runs of window starts, and undecided windows of edge tokens.

    Rows are in order of (token, id, place). ``edge`` marks rows whose token may go on in
    another bucket.
    """
    n = len(token)
    _, start, more, anchor = unpack(place)
    right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, PLACES), np.uint8)
    for i, raw in enumerate(spans):
        row, a = np.frombuffer(raw, np.uint8), int(anchor[i])
        after = row[a : a + LENGTH]
        right[i, : len(after)] = after
        left[i, :a] = row[:a][::-1]
    tokens = np.cumsum(_changes(token)) - 1
    orders, commons = [], []
    for rows in (right, left):
        order = multikey_sort(rows)
        orders.append(order)
        commons.append(prefix_lengths(rows, order))
    removed = np.zeros((n, PLACES), bool)
    undecided: list[tuple] = []
    rank = np.zeros(n, np.int64)
    for before in range(PLACES):
        valid = np.flatnonzero((before >= anchor - more) & (before <= anchor))
        if not len(valid):
            continue
        key = tokens[valid]
        for order, common, length in zip(orders, commons, (LENGTH - before, before)):
            rank[order] = np.cumsum(common < length)
            key = key * (n + 1) + rank[valid]
            _, key = np.unique(key, return_inverse=True)
        _, first = np.unique(key, return_index=True)
        head = valid[first[key]]
        at = start + anchor - before
        again = (ids[valid] != ids[head]) | (at[valid] != at[head]) | (
            place[valid] >> 48 != place[head] >> 48
        )
        removed[valid[again], before] = True
        for i in valid[first][edge[valid[first]]].tolist():
            offset = int(anchor[i]) - before
            digest = xxhash.xxh3_128_digest(spans[i][offset : offset + LENGTH])
            undecided.append((digest, int(ids[i]), int(place[i]), int(at[i])))
    runs = []
    for i in np.flatnonzero(removed.any(axis=1)).tolist():
        hits = int(anchor[i]) - np.flatnonzero(removed[i])[::-1]
        cuts = np.flatnonzero(np.diff(hits) > 1)
        for a, b in zip(
            hits[np.concatenate([[0], cuts + 1])].tolist(),
            hits[np.concatenate([cuts, [len(hits) - 1]])].tolist(),
        ):
            runs.append((int(ids[i]), int(place[i]) >> 48, int(start[i]) + a, int(start[i]) + b))
    return runs, undecided


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of one bucket of candidates, resolved in blocks of whole tokens."""
    names = ["digest", "id", "tag", "first", "last"]

    def block(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, ids, place, part = (
            table[c].to_numpy() for c in ("token", "id", "place", "part")
        )
        order = np.lexsort((place, ids, token))
        token, ids, place, part = token[order], ids[order], place[order], part[order]
        raw = table["bytes"].take(pa.array(order)).to_pylist()
        runs, undecided = _resolve(token, ids, place, raw, part > 0)
        for start in range(0, len(runs), 50_000):
            a = np.array(runs[start : start + 50_000], dtype=np.int64)
            columns = [pa.array(a[:, k].copy()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.binary()), *columns], names)
        for start in range(0, len(undecided), 50_000):
            some = undecided[start : start + 50_000]
            at = pa.array([p[3] for p in some], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0] for p in some], pa.binary()),
                    pa.array([p[1] for p in some], pa.int64()),
                    pa.array([p[2] >> 48 for p in some], pa.int64()),
                    at,
                    at,
                ],
                names,
            )

    held: pa.Table | None = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        if held.num_rows > BLOCK_ROWS:
            # cut where a new token, or a new part of a split token, begins
            held = held.combine_chunks()
            cut = np.flatnonzero(_changes(held["token"].to_numpy(), held["part"].to_numpy()))[-1]
            if cut:
                yield from block(held.slice(0, cut))
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from block(held.combine_chunks())


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the candidates of each text."""
    for batch in batches:
        for part in slices(batch, "_bytes", 2 << 20):
            token, part_of, ids, place, raw = [], [], [], [], []
            for row in part.to_pylist():
                data = row["_bytes"]
                for found in row["_wanted"]:
                    start, more = (found["place"] >> 14) & ((1 << 34) - 1), found["place"] >> 7 & 127
                    token.append(found["token"])
                    part_of.append(found["part"])
                    ids.append(row["_id"])
                    place.append(found["place"])
                    raw.append(data[start : start + more + LENGTH])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token, pa.int64()),
                    pa.array(part_of, pa.int32()),
                    pa.array(ids, pa.int64()),
                    pa.array(place, pa.int64()),
                    pa.array(raw, pa.binary()),
                ],
                names=["token", "part", "id", "place", "bytes"],
            )


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(runs):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def repeated_runs(docs: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Byte ranges to remove: ``id``, ``tag``, ``begin``, ``length``; ranges may overlap.

    ``docs`` has ``_id`` (null as the smallest long), ``_tag`` and ``_bytes``.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    suffixes = docs.mapInArrow(_extract, "token bigint, span bigint, id bigint, place bigint")
    first = materialize(
        suffixes.repartitionByRange(parts, "token", "span", "id", "place").mapInArrow(
            _first_pass, "kind int, token bigint, id bigint, place bigint"
        ),
        "suffix-first",
    )
    tag = F.shiftright("place", 48)
    start = F.shiftright("place", 14).bitwiseAND((1 << 34) - 1)
    by_span = first.filter("kind = 0").select(
        "id",
        tag.alias("tag"),
        start.alias("begin"),
        (F.shiftright("place", 7).bitwiseAND(127) + LENGTH).alias("length"),
    )
    candidate = first.filter("kind = 1")
    frequent = measured(
        candidate.groupBy(F.col("token").alias("_frequent"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > split_rows),
        "suffix-frequent",
    )
    spread = F.pmod(F.xxhash64("id", "place"), F.ceil(F.col("_n") / split_rows)) + 1
    wanted = (
        candidate.join(frequent, F.col("token") == F.col("_frequent"), "left")
        .select("token", F.coalesce(spread, F.lit(0)).cast("int").alias("part"), "id", "place")
        .groupBy(F.col("id").alias("_of"), tag.cast("int").alias("_of_tag"))
        .agg(F.collect_list(F.struct("token", "part", "place")).alias("_wanted"))
    )
    spans = (
        docs.join(wanted, (F.col("_id") == F.col("_of")) & (F.col("_tag") == F.col("_of_tag")))
        .select("_id", "_bytes", "_wanted")
        .mapInArrow(_spans, "token bigint, part int, id bigint, place bigint, bytes binary")
    )
    resolved = materialize(
        spans.repartitionByRange(parts, "token", "part")
        .sortWithinPartitions("token", "part")
        .mapInArrow(
            _second_pass, "digest binary, id bigint, tag bigint, first bigint, last bigint"
        ),
        "suffix-second",
    )
    place = ["id", "tag", F.col("first").alias("begin")]
    length = (F.col("last") - F.col("first") + LENGTH).alias("length")
    earliest = Window.partitionBy("digest").orderBy("id", "tag", "first")
    across = (
        resolved.filter("digest IS NOT NULL")
        .withColumn("_rank", F.dense_rank().over(earliest))
        .filter("_rank > 1")
    )
    return (
        by_span.unionByName(resolved.filter("digest IS NULL").select(*place, length))
        .unionByName(across.select(*place, length))
    )


@carries("id_col", "text_col")
def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_bytes``.

    The ranges of one document are gathered in one row, bounded by its own length.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumns(
        {
            "_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))),
            "_tag": F.xxhash64(text).bitwiseAND(32767).cast("int"),
            "_bytes": text.cast("binary"),
        }
    )
    packed = F.shiftleft("begin", 8).bitwiseOR(F.col("length"))
    runs = (
        repeated_runs(keyed.select("_id", "_tag", "_bytes"), split_rows)
        .groupBy(F.col("id").alias("_of"), F.col("tag").cast("int").alias("_of_tag"))
        .agg(F.collect_list(packed).alias("_runs"))
    )
    joined = keyed.join(
        runs, (F.col("_id") == F.col("_of")) & (F.col("_tag") == F.col("_of_tag")), "left"
    ).drop("_of", "_of_tag", "_id", "_tag")
    made = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_bytes", T.BinaryType()),
    ]
    kept = [f for f in docs.schema.fields if f.name not in {m.name for m in made}]
    names = [f.name for f in kept]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_bytes"):
                sizes, removed, spans, rest = [], [], [], []
                runs_of = part.column("_runs").to_pylist()
                for raw, found in zip(part.column("_bytes").to_pylist(), runs_of):
                    merged = merge_runs([(r >> 8, (r >> 8) + (r & 255)) for r in found or []])
                    out, at = [], 0
                    for begin, end in merged:
                        out.append(raw[at:begin])
                        at = end
                    out.append(raw[at:])
                    sizes.append(len(raw))
                    removed.append(sum(e - b for b, e in merged))
                    spans.append(len(merged))
                    rest.append(b"".join(out))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in names),
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.int64()),
                        pa.array(rest, pa.binary()),
                    ],
                    names=[*names, *(m.name for m in made)],
                )

    return joined.select(*names, "_bytes", "_runs").mapInArrow(cut, T.StructType([*kept, *made]))


def brute_force(texts: list[tuple[int, bytes]], length: int = LENGTH) -> dict[int, list]:
    """Removed runs of each document by looking at every string; for tests."""
    seen: dict[bytes, bool] = {}
    out = {}
    for name, raw in sorted(texts):
        runs = []
        for q in range(len(raw) - length + 1):
            key = hashlib.sha256(raw[q : q + length]).digest()
            if key in seen:
                runs.append((q, q + length))
            seen[key] = True
        out[name] = merge_runs(runs)
    return out

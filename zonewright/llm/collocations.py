"""Phrases whose words come together more often than their parts predict.

Every word position starts a suffix of up to ``longest`` words of its piece. The suffixes are
routed over all tasks by ranges of their leading words; each task sorts pointers to its
suffixes by multikey three-way quicksort. The size of an equal partition is the count of the
phrase its suffixes share, and a partition that weighs less than ``least`` is abandoned, as no
phrase in it can be frequent. Only phrases that begin the first or last suffix of a range can go on
in the next one; their partial counts are added up afterwards.

Words travel as numbers: the ``known_words`` most frequent words of all languages by rank, in
three bytes, all others by a 63-bit hash, in eight. When every word of ``least`` occurrences has a
rank, other words end a suffix, since no frequent phrase can hold them. The limit decides
bytes moved, never a result.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows count
as often as they stand; ties in score and count go by the phrase's bytes; an empty table gives
an empty table; other columns are ignored; texts are read whole, in batches of bounded bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, slices
from zonewright.llm.textkernel import LOWER, mix, text_buffer, weights, word_hashes, words

_U = np.uint64
#: Rows of suffixes that one task sorts at most (equal suffixes of a task count as one).
TASK_ROWS = 1_000_000
_HASHED = _U(1 << 63)

#: Ends of a piece: . , ; : ! ? and the ASCII line and form breaks.
BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
#: Separators of words: the ends of a piece, space and tab.
SEPARATORS = BREAKS.copy()
SEPARATORS[[32, 9]] = True


def _language_salt(langs: pa.Array) -> np.ndarray:
    """A number for the language of each row, by its content."""
    salts = {
        name: int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
        for name in set(langs.to_pylist())
    }
    return np.array([salts[name] for name in langs.to_pylist()], dtype=_U)


class Words:
    """Words of the texts of a batch: number of (language, word), place and piece."""

    def __init__(self, part: pa.RecordBatch):
        data, offsets = text_buffer(part.column("_text"))
        self.data = LOWER[data]
        self.starts, self.ends, self.owner = words(self.data, offsets, SEPARATORS)
        salt = _language_salt(part.column("_lang"))
        hashes = word_hashes(self.data, self.starts, self.ends)
        self.numbers = mix(hashes ^ salt[self.owner]) | _HASHED if len(hashes) else hashes
        before = np.cumsum(BREAKS[self.data], dtype=np.int64)
        piece = before[self.starts] if len(self.starts) else before[:0]
        #: whether the next word follows in the same piece
        self.follows = np.zeros(len(self.starts), bool)
        self.follows[:-1] = (piece[1:] == piece[:-1]) & (self.owner[1:] == self.owner[:-1])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text", 4 << 20):
            found = Words(part)
            numbers, first, counts = np.unique(found.numbers, return_index=True, return_counts=True)
            raw = found.data.tobytes()
            spans = zip(found.starts[first].tolist(), found.ends[first].tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_lang").take(pa.array(found.owner[first])),
                    pa.array(numbers.view(np.int64)),
                    pa.array([raw[a:b].decode("utf-8", "replace") for a, b in spans], pa.string()),
                    pa.array(counts.astype(np.int64)),
                ],
                names=["lang", "number", "word", "n"],
            )


class Ranks:
    """Ranks of the most frequent words by their number; 0 or the number itself for others."""

    def __init__(self, numbers: np.ndarray, complete: bool):
        order = np.argsort(numbers)
        self.numbers, self.ranks = numbers[order], (order + 1).astype(_U)
        self.complete = complete

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.numbers):
            return np.zeros(len(numbers), _U) if self.complete else numbers
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        other = _U(0) if self.complete else numbers
        return np.where(self.numbers[at] == numbers, self.ranks[at], other)


def pack(rows: np.ndarray) -> pa.Array:
    """Binary keys of suffixes (one row each, 0 after the last word) that sort as the words do."""
    short = rows < _HASHED
    sizes = np.where(rows == 0, 0, np.where(short, 3, 8))
    offsets = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
    out = np.zeros(int(offsets[-1]), np.uint8)
    place = offsets[:-1].copy()
    for k in range(rows.shape[1]):
        for size, chosen in ((3, short[:, k] & (rows[:, k] > 0)), (8, ~short[:, k])):
            at, value = place[chosen], rows[chosen, k]
            for b in range(size if len(at) else 0):
                out[at + b] = (value >> _U(8 * (size - 1 - b))).astype(np.uint8)
        place += sizes[:, k]
    wide = offsets.astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(wide), pa.py_buffer(out)]
    )


def unpack(keys: pa.Array, longest: int) -> np.ndarray:
    """The suffixes of packed keys."""
    data, offsets = text_buffer(keys)
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    place, end = offsets[:-1].copy(), offsets[1:]
    rows = np.zeros((len(keys), longest), _U)
    for k in range(longest):
        there = place < end
        short = there & (data[np.where(there, place, 0)] < 128)
        for size, chosen in ((3, short), (8, there & ~short)):
            at = place[chosen]
            value = np.zeros(len(at), _U)
            for b in range(size):
                value = (value << _U(8)) | data[at + b].astype(_U)
            rows[chosen, k] = value
            place[chosen] += size
    return rows


def merge_equal(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal suffixes as one row with their common weight."""
    mixed = (mix(rows ^ weights(rows.shape[1], 3)) * weights(rows.shape[1], 7)).sum(
        axis=1, dtype=_U
    )
    order = np.argsort(mixed, kind="stable")
    rows, weight, mixed = rows[order], weight[order], mixed[order]
    fresh = np.ones(len(rows), bool)
    # rows are compared, so a collision leaves two rows and never adds up unlike ones
    fresh[1:] = (mixed[1:] != mixed[:-1]) | (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(fresh)
    return rows[first], np.add.reduceat(weight, first) if len(first) else weight[:0]


def _suffixes(ranks, longest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        for batch in batches:
            for part in slices(batch, "_text", 4 << 20):
                found = Words(part)
                codes = table.codes(found.numbers)
                # a suffix of one word tells nothing that the word counts do not
                alive = codes > 0
                alive[:-1] &= found.follows[:-1] & (codes[1:] > 0)
                alive[-1:] = False
                at = np.flatnonzero(alive)
                rows = np.zeros((len(at), longest), _U)
                rows[:, 0] = codes[at]
                for k in range(1, longest):
                    here = at + k - 1
                    inside = here < len(codes) - 1
                    here = np.where(inside, here, 0)
                    on = inside & found.follows[here] & (rows[:, k - 1] > 0)
                    rows[on, k] = codes[here[on] + 1]
                rows, weight = merge_equal(rows, np.ones(len(rows), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pack(rows), pa.array(weight)], names=["suffix", "weight"]
                )

    return run


def equal_partitions(
    rows: np.ndarray, weight: np.ndarray, least: int
) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers: (words, a pointer, weight) of frequent phrases.

    The pointers are split by the word at one depth into those below, at and above a pivot. The
    equal part shares one word more; parts that weigh less than ``least`` are abandoned.
    """
    waiting = [(np.arange(len(rows)), 0)]
    while waiting:
        at, depth = waiting.pop()
        column, heavy = rows[at, depth], weight[at]
        sample = np.sort(column[:: max(1, len(column) // 9)])
        pivot = sample[len(sample) // 2]
        for below in (True, False):
            side = column < pivot if below else column > pivot
            if heavy[side].sum() >= least:
                waiting.append((at[side], depth))
        if pivot == 0:
            continue
        same = column == pivot
        total = int(heavy[same].sum())
        if total >= least:
            equal = at[same]
            yield depth + 1, int(equal[0]), total
            if depth + 1 < rows.shape[1]:
                waiting.append((equal, depth + 1))


def _border(rows: np.ndarray) -> list[np.ndarray]:
    """First and last suffix of a range."""
    if not len(rows):
        return []
    order = np.lexsort(rows.T[::-1])
    return [rows[order[0]], rows[order[-1]]]


def _count_phrases(longest: int, least: int, held_rows: int = TASK_ROWS) -> Callable:
    schema = pa.schema([("words", pa.list_(pa.int64())), ("n", pa.int64()), ("border", pa.bool_())])

    def batch(found: list[tuple[list[int], int, bool]]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        fresh = 0
        for b in batches:
            parts.append((unpack(b.column("suffix"), longest), b.column("weight").to_numpy()))
            fresh += b.num_rows
            if fresh > held_rows:
                parts = [merge_equal(*(np.concatenate(c) for c in zip(*parts)))]
                fresh = 0
        if not parts:
            return
        rows, weight = merge_equal(*(np.concatenate(c) for c in zip(*parts)))
        parts.clear()
        partial: dict[tuple[int, ...], int] = {}
        for edge in _border(rows):
            same = np.ones(len(rows), bool)
            for k in range(longest):
                if edge[k] == 0:
                    break
                same &= rows[:, k] == edge[k]
                if k:
                    partial[tuple(edge[: k + 1].view(np.int64).tolist())] = int(weight[same].sum())
        found = [(list(phrase), n, True) for phrase, n in partial.items()]
        for size, at, total in equal_partitions(rows, weight, least):
            phrase = rows[at, :size].view(np.int64).tolist()
            if size > 1 and tuple(phrase) not in partial:
                found.append((phrase, total, False))
            if len(found) >= 50_000:
                yield batch(found)
                found = []
        yield batch(found)

    return run


def phrase_counts(
    docs: DataFrame, least: int, longest: int, known_words: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (id, lang, word, n), frequent phrases (words, n) and words per language."""
    spark = docs.sparkSession
    counted = materialize(
        docs.mapInArrow(_count_words, "lang string, number bigint, word string, n bigint")
        .groupBy("lang", "number", "word")
        .agg(F.sum("n").alias("n")),
        "word-counts",
    )
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counted.filter(F.col("n") >= least)
    chosen = frequent.orderBy(F.desc("n"), "number").limit(known_words).select("number").toArrow()
    numbers = chosen["number"].to_numpy().view(_U)
    complete = len(numbers) < known_words
    ranks = spark.sparkContext.broadcast(Ranks(numbers, complete))
    ranked = spark.createDataFrame(
        pa.table({"id": np.arange(1, len(numbers) + 1), "number": numbers.view(np.int64)})
    )
    vocabulary = materialize(
        frequent.join(ranked, "number", "left").select(
            F.coalesce("id", "number").alias("id"), "lang", "word", "n"
        ),
        "frequent-words",
    )
    suffixes = materialize(
        docs.mapInArrow(_suffixes(ranks, longest), "suffix binary, weight bigint"), "suffixes"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, -(-suffixes.count() // TASK_ROWS))
    pieces = suffixes.repartitionByRange(parts, "suffix").mapInArrow(
        _count_phrases(longest, least), "words array<bigint>, n bigint, border boolean"
    )
    pieces = materialize(pieces, "phrase-counts")
    over = pieces.filter("border").groupBy("words").agg(F.sum("n").alias("n"))
    phrases = pieces.filter("NOT border").select("words", "n").unionByName(
        over.filter(F.col("n") >= least)
    )
    return vocabulary, phrases, totals


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    known_words: int = 1 << 20,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words with ``a >= least`` occurrences is cut after its first k
    words into parts of ``l`` and ``r`` occurrences; its score is the least of
    ``floor(1000 * a * n / (l * r))`` over its cuts, ``n`` being the words of the language. A
    phrase that a longer frequent one holds as often is dropped.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"),
        F.col(text_col).cast("string").alias("_text"),
    )
    vocabulary, phrases, totals = phrase_counts(texts, least, longest, known_words)
    counts = phrases.unionByName(vocabulary.select(F.array("id").alias("words"), "n"))
    # a longer phrase that holds a shorter one as often also has one of the sizes between
    inner = phrases.select(
        F.explode(
            F.array(
                F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)")
            )
        ).alias("words"),
        F.col("n").alias("held"),
    ).groupBy("words").agg(F.max("held").alias("held"))
    kept = (
        phrases.join(inner, "words", "left")
        .filter(F.col("held").isNull() | (F.col("held") < F.col("n")))
        .select("words", F.col("n").alias("a"))
    )
    cuts = kept.select(
        "words", "a", F.expr("explode(sequence(1, size(words) - 1))").alias("k")
    ).withColumns(
        {
            "_left": F.expr("slice(words, 1, k)"),
            "_right": F.expr("slice(words, k + 1, size(words) - k)"),
        }
    )
    left = counts.select(F.col("words").alias("_left"), F.col("n").alias("l"))
    right = counts.select(F.col("words").alias("_right"), F.col("n").alias("r"))
    langs = vocabulary.join(totals, "lang").select(
        F.col("id").alias("_first"), "lang", F.col("total").alias("n")
    )
    wide = "decimal(18,0)"
    above = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(16,0)") * F.col("n").cast("decimal(17,0)")
    below = F.col("l").cast(wide) * F.col("r").cast(wide)
    scored = (
        cuts.join(left, "_left")
        .join(right, "_right")
        .withColumn("_first", F.get("words", F.lit(0)))
        .join(langs, "_first")
        .withColumns({"_above": above, "_below": below})
        .withColumn("score", F.expr("_above div _below"))
        .groupBy("lang", "words", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "words", "a", "n", "cut.score", "cut.l", "cut.r")
    )
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = scored.withColumn("_place", F.rank().over(by)).filter(F.col("_place") <= top)
    spelled = (
        near.select("*", F.posexplode("words").alias("_at", "id"))
        .join(vocabulary.select("id", "word"), "id")
        .groupBy("lang", "words", "a", "l", "r", "n", "score")
        .agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_spelled"))
        .withColumn("phrase", F.array_join(F.col("_spelled.word"), " "))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        spelled.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )

"""Benchmark decontamination: BM25 over the test items, block-max WAND, overlap check.

The test items are the indexed documents; every passage of every training text is a query.
Items are indexed by length class, the next power of two of their words; a passage is two
neighbouring blocks of words, each as long as the class, so each item copied into a text lies
wholly inside one passage, and no other item changes how far a passage reaches. Scores are divided by the item's score
against itself, so one threshold holds for all items: 1 means that all terms of the item occur.

For each batch of passages three bounds are applied, all exact: the sum of each term's best
score anywhere; the sum of its best score inside groups of items; then block-max WAND finds all
items at or above the threshold. A hit counts if enough of the question's and of the answer's
word n-grams stand in the passage.

The index is broadcast in shards of at most ``shard_bytes`` of item text, one pass over the texts
for each shard; term statistics are those of all items.

Defined results: a null or empty text has no passage; an item without words is never found; an
item with fewer words than the n-gram counts as one gram; equal items are found each; several
hits of one item in one text give its best; rows that share an id are one document; an empty
table on either side gives no hits; other columns are ignored by the search and kept by the
filter.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import carries, materialize, measured, slices
from zonewright.llm.textkernel import LOWER, NOT_ALNUM, mix, text_buffer, weights, word_hashes, words

_U = np.uint64
K1, B = 1.2, 0.75
#: Postings in a block of a term's list, and groups of items with a bound for each term.
POSTINGS, GROUPS = 8, 64
GRAM = 3
#: Words of the smallest length class of items.
SHORTEST_WINDOW = 32
HITS = (
    "doc_id bigint, item_id bigint, score double, question_overlap double, "
    "answer_overlap double, passage_start bigint"
)


def word_sequence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the offsets of the texts in them."""
    data, offsets = text_buffer(texts)
    data = LOWER[data]
    starts, ends, owner = words(data, offsets, NOT_ALNUM)
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
    return word_hashes(data, starts, ends), np.concatenate([[0], np.cumsum(counts)])


def grams(hashes: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Distinct n-grams of a word sequence; a shorter sequence is one gram."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    factors = weights(size, 211)
    total = np.zeros(len(hashes) - size + 1, _U)
    for k in range(size):
        total += hashes[k : len(total) + k] * factors[k]
    return np.unique(mix(total))


class ItemIndex:
    """Inverted index of test items with block maxima."""

    def __init__(
        self,
        names: list[int],
        questions: list[np.ndarray],
        answers: list[np.ndarray],
        terms: np.ndarray,
        documents: np.ndarray,
        total: int,
        mean_length: float,
        window: int,
    ):
        """``terms`` and ``documents``: every term of any item and how many items have it.

        ``window`` bounds the words of an item; a passage is two windows, and starts at each.
        """
        self.names = names
        #: n-gram size and distinct n-grams of each side of each item
        self.sides = [
            [(min(GRAM, len(words)), grams(words)) for words in side]
            for side in (questions, answers)
        ]
        self.window = window
        found: list[tuple[int, int, float]] = []
        for item, (question, answer) in enumerate(zip(questions, answers)):
            whole = np.concatenate([question, answer])
            if not len(whole):
                continue
            values, counts = np.unique(whole, return_counts=True)
            n = documents[np.searchsorted(terms, values)]
            idf = np.log(1 + (total - n + 0.5) / (n + 0.5))
            norm = K1 * (1 - B + B * len(whole) / mean_length)
            scores = idf * counts * (K1 + 1) / (counts + norm)
            found += zip(values.tolist(), [item] * len(values), (scores / scores.sum()).tolist())
        found.sort()
        term = np.array([f[0] for f in found], _U)
        self.terms, first = np.unique(term, return_index=True)
        ends = np.append(first[1:], len(found))
        self.items = [[f[1] for f in found[a:b]] for a, b in zip(first, ends)]
        self.scores = [[f[2] for f in found[a:b]] for a, b in zip(first, ends)]
        self.best = np.array([max(s) for s in self.scores])
        self.block_best = [
            [max(s[k : k + POSTINGS]) for k in range(0, len(s), POSTINGS)] for s in self.scores
        ]
        width = max(1, math.ceil(len(names) / GROUPS))
        self.group_best = np.zeros((len(self.terms), max(1, math.ceil(len(names) / width))), "f4")
        for t, (items, scores) in enumerate(zip(self.items, self.scores)):
            for item, score in zip(items, scores):
                g = item // width
                self.group_best[t, g] = max(self.group_best[t, g], score)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the terms, -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def search(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items that score ``threshold`` or more, by block-max WAND."""
        bar = threshold - 1e-9
        lists = [[self.items[t][0], 0, t] for t in query]
        hits = []
        while lists:
            lists.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(lists):
                bound += self.best[t]
                if bound >= bar:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            # bound of the blocks in which the pivot item would lie
            bound, block_end = 0.0, math.inf
            for current, at, t in lists[: pivot + 1]:
                items = self.items[t]
                place = at if current == item else bisect_left(items, item, at)
                if place < len(items):
                    block = place // POSTINGS
                    bound += self.block_best[t][block]
                    block_end = min(block_end, items[min(len(items), (block + 1) * POSTINGS) - 1])
            if bound >= bar:
                if lists[0][0] == item:
                    score = sum(self.scores[t][at] for c, at, t in lists if c == item)
                    if score >= bar:
                        hits.append((item, score))
                    goal = item + 1
                else:
                    goal = item
            else:
                later = lists[pivot + 1][0] if pivot + 1 < len(lists) else math.inf
                goal = max(item + 1, min(block_end + 1, later))
            rest = []
            for entry in lists[: pivot + 1]:
                items = self.items[entry[2]]
                at = bisect_left(items, goal, entry[1]) if goal < math.inf else len(items)
                if at < len(items):
                    rest.append([items[at], at, entry[2]])
            lists = rest + lists[pivot + 1 :]
        return hits


def split_items(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Question and answer of items with one text: the last quarter of its words answers."""
    parts = F.filter(F.split(F.coalesce(text_col, F.lit("")), r"\s+"), lambda w: w != "")
    tail = F.ceil(F.size("_words") / 4).cast("int")
    return (
        benchmark.select(F.col(id_col).cast("long").alias("item_id"), parts.alias("_words"))
        .withColumn("_tail", tail)
        .select(
            "item_id",
            F.expr("array_join(slice(_words, 1, size(_words) - _tail), ' ')").alias("question"),
            F.expr("array_join(slice(_words, size(_words) - _tail + 1, _tail), ' ')").alias(
                "answer"
            ),
        )
    )


def length_class(words: int) -> int:
    """Words of a window for an item: the next power of two, ``SHORTEST_WINDOW`` at least.

    It depends on the item alone, so other items never decide whether a document holds it.
    """
    return max(SHORTEST_WINDOW, 1 << max(0, words - 1).bit_length())


def build_shards(items: DataFrame, shard_bytes: int = 32 << 20) -> Iterator[list[ItemIndex]]:
    """Indexes of at most about ``shard_bytes`` of item text, one for each length class."""
    kept = materialize(items.select("item_id", "question", "answer"), "test-items")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, of_q = word_sequence(batch.column("question"))
            a, of_a = word_sequence(batch.column("answer"))
            for i in range(batch.num_rows):
                own = np.concatenate([q[of_q[i] : of_q[i + 1]], a[of_a[i] : of_a[i + 1]]])
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.unique(own).view(np.int64)),
                            pa.array(np.full(len(np.unique(own)), len(own))),
                            pa.array(np.arange(len(np.unique(own))) == 0),
                        ],
                        names=["term", "length", "head"],
                    )

    spread_terms = kept.mapInArrow(spread, "term bigint, length bigint, head boolean")
    found = spread_terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).toArrow()
    total, length = spread_terms.filter("head").agg(F.count(F.lit(1)), F.sum("length")).first()
    if not total:
        return
    terms = found["term"].to_numpy().view(_U)
    order = np.argsort(terms)
    terms, documents = terms[order], found["n"].to_numpy()[order]
    size = kept.agg(F.sum(F.length("question") + F.length("answer"))).first()[0]
    shards = max(1, math.ceil(4 * size / shard_bytes))
    for k in range(shards):
        rows = (
            kept.filter(F.pmod(F.xxhash64("item_id", "question"), F.lit(shards)) == k)
            .orderBy("item_id", "question", "answer")
            .toArrow()
            .combine_chunks()
        )
        if not rows.num_rows:
            continue
        sides = []
        for name in ("question", "answer"):
            h, of = word_sequence(pa.array(rows[name].to_pylist(), pa.string()))
            sides.append([h[of[i] : of[i + 1]] for i in range(rows.num_rows)])
        names = rows["item_id"].to_pylist()
        classes = [length_class(len(q) + len(a)) for q, a in zip(*sides)]
        yield [
            ItemIndex(
                [names[i] for i in chosen],
                *([side[i] for i in chosen] for side in sides),
                terms,
                documents,
                total,
                length / total,
                window,
            )
            for window in sorted(set(classes))
            for chosen in [[i for i, c in enumerate(classes) if c == window]]
        ]


def scan_batch(
    index: ItemIndex, hashes: np.ndarray, offsets: np.ndarray, threshold: float, overlap: float
) -> list[tuple]:
    """Hits in the texts of a batch of words: text number, item, score, overlaps, first word."""
    counts = np.diff(offsets)
    known = index.lookup(hashes)
    at = np.flatnonzero(known >= 0)
    if not len(at):
        return []
    owner = np.searchsorted(offsets, at, "right") - 1
    blocks = -(-counts // index.window)
    base = np.concatenate([[0], np.cumsum(blocks)])
    block = base[owner] + (at - offsets[owner]) // index.window
    term = known[at]
    # a passage has the block of its number and the next one of the same text
    earlier = block > base[owner]
    width = len(index.terms)
    pairs = np.unique(
        np.concatenate([block * width + term, (block[earlier] - 1) * width + term[earlier]])
    )
    passage, term = pairs // width, pairs % width
    starts = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    bar = threshold - 1e-6
    alive = np.add.reduceat(index.best[term], starts) >= bar
    ends = np.append(starts[1:], len(term))
    out = []
    for start, end in zip(starts[alive].tolist(), ends[alive].tolist()):
        if index.group_best[term[start:end]].sum(axis=0).max() < bar:
            continue
        number = int(passage[start])
        text = int(np.searchsorted(base, number, "right")) - 1
        first = int((number - base[text]) * index.window)
        for item, score in index.search(term[start:end].tolist(), threshold):
            here = hashes[offsets[text] + first : offsets[text + 1]][: 2 * index.window]
            shares = []
            for size, asked in (side[item] for side in index.sides):
                present = np.isin(asked, grams(here, size)) if size else np.ones(1)
                shares.append(float(present.mean()))
            if min(shares) >= overlap:
                out.append((text, item, score, *shares, first))
    return out


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.6,
    overlap: float = 0.6,
) -> DataFrame:
    """Hits, the best for each document and item: see :data:`HITS`.

    ``items`` has ``item_id``, ``question`` and ``answer``.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")
    )
    found = None
    for indexes in build_shards(items):
        shared = spark.sparkContext.broadcast(indexes)

        def run(
            batches: Iterator[pa.RecordBatch], shared=shared
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "_text", 2 << 20):
                    sequence = word_sequence(part.column("_text"))
                    hits = [
                        (text, index.names[item], *rest)
                        for index in shared.value
                        for text, item, *rest in scan_batch(index, *sequence, threshold, overlap)
                    ]
                    ids = part.column("_id")
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([h[0] for h in hits], pa.int64())),
                            pa.array([h[1] for h in hits], pa.int64()),
                            *(pa.array([h[k] for h in hits], pa.float64()) for k in (2, 3, 4)),
                            pa.array([h[5] for h in hits], pa.int64()),
                        ],
                        names=[c.split()[0] for c in HITS.split(", ")],
                    )

        hits = texts.mapInArrow(run, HITS)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], HITS)
    best = F.max_by(
        F.struct("score", "question_overlap", "answer_overlap", "passage_start"),
        F.struct("score", (-F.col("passage_start")).alias("p")),
    ).alias("_best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "_best.*")


@carries("id_col", "text_col")
def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    hits = contaminated(docs, items, id_col, text_col, **options)
    listed = measured(hits.select(F.col("doc_id").alias("_hit")).distinct(), "contaminated")
    return docs.join(listed, F.col(id_col).eqNullSafe(F.col("_hit")), "left_anti")

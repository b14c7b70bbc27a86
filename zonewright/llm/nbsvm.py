"""Quality classifier: naive Bayes support vectors.

Features are indicators of byte 3-grams, words, and a few bins of length and repetition, hashed
to ``1 << BITS`` places. Each is scaled by its log-count ratio between the classes, counted over
all labelled rows. A linear hinge-loss model is fitted by dual coordinate descent on at most
about ``fit_rows`` labelled rows of each class, chosen by a hash of their id. Scoring runs over
all texts; what is broadcast has a fixed size.

Defined results: a null or empty text has only its bins and gets a score; labels that are null
or name no document are ignored; several labels of one id vote; without both classes every
score is 0.5; repeated rows are scored each; an empty table gives an empty table; ``score_texts``
passes other columns through, ``quality_scores`` drops them; texts of any length are read whole.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewright.llm.common import materialize, measured, slices
from zonewright.llm.textkernel import mix, text_buffer, word_hashes, words

_U = np.uint64
BITS = 20
PLACES = 1 << BITS
#: Of a dual variable, which lies between 0 and c.
TOLERANCE = 1e-3


def _place(values: np.ndarray, kind: int) -> np.ndarray:
    salt = _U(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(values + salt) >> _U(64 - BITS)).astype(np.int64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature places of each text, ascending, and the offsets of the texts."""
    data, offsets = text_buffer(texts)
    count, lengths = len(texts), np.diff(offsets)
    every = np.arange(count)
    found, of = [], []
    if len(data) >= 3:
        wide = data.astype(_U)
        gram = (wide[:-2] << _U(16)) | (wide[1:-1] << _U(8)) | wide[2:]
        owner = np.repeat(every, lengths)
        inside = owner[:-2] == owner[2:]
        found.append(_place(gram[inside], 1))
        of.append(owner[:-2][inside])
    starts, ends, owner = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    found.append(_place(hashes, 2))
    of.append(owner)
    total = np.bincount(owner, minlength=count)
    same = np.zeros(count, np.int64)
    if len(hashes) > 1:
        again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        same = np.bincount(owner[1:][again], minlength=count)
    distinct = np.zeros(count, np.int64)
    if len(hashes):
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        fresh = np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1]))
        distinct = np.bincount(o[fresh], minlength=count)
    at_least_one = np.maximum(total, 1)
    bins = (
        np.ceil(np.log2(total + 1)),
        10 * same // at_least_one,
        10 * distinct // at_least_one + 16 * np.ceil(np.log2(total + 1)),
    )
    for kind, values in enumerate(bins):
        found.append(_place(values.astype(_U), 3 + kind))
        of.append(every)
    key = np.unique(np.concatenate(of) * PLACES + np.concatenate(found))
    owner, place = key // PLACES, key % PLACES
    return place, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))])


@dataclass
class Model:
    """Weight of each feature, intercept, and the two numbers of the logistic scale."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def scores(self, place: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        sizes = np.diff(offsets)
        total = np.zeros(len(sizes))
        full = np.flatnonzero(sizes)
        if len(full):
            total[full] = np.add.reduceat(self.weights[place], offsets[:-1][full])
        margin = total / np.sqrt(np.maximum(sizes, 1)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, c: float = 1.0, epochs: int = 400
) -> tuple[np.ndarray, float]:
    """Weights and intercept of the hinge-loss model over ratio-scaled indicators.

    One dual variable at a time is set to its best value in [0, c]; the weights follow, until no
    variable moves by ``TOLERANCE`` in an epoch. Running out of epochs before that is told.
    """
    weights, intercept = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    square = np.array([v @ v + 1 for v in values])
    chooser = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in chooser.permutation(len(rows)).tolist():
            y = labels[i]
            gradient = y * (weights[rows[i]] @ values[i] + intercept) - 1
            best = min(max(alpha[i] - gradient / square[i], 0.0), c)
            step = (best - alpha[i]) * y
            if step:
                weights[rows[i]] += step * values[i]
                intercept += step
                alpha[i] = best
                moved = max(moved, abs(step))
        if moved < TOLERANCE:
            break
    else:
        warnings.warn(f"a dual variable still moves by {moved:.2g} after {epochs} epochs", stacklevel=2)
    return weights, intercept


def logistic_scale(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift that map margins to probabilities, by Newton's method."""
    target = np.where(positive, (positive.sum() + 1) / (positive.sum() + 2), 1 / ((~positive).sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * margin**2).sum(), (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(slope, 1e-6), shift


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "label",
    id_col: str = "doc_id",
    fit_rows: int = 3_000,
    smoothing: float = 1.0,
) -> Model:
    """Model from labelled texts; ``label_col`` is 1 or 0."""
    rows = labelled.select(
        F.col(text_col).cast("string").alias("_text"),
        F.col(label_col).cast("int").alias("_label"),
        F.col(id_col).alias("_id"),
    )
    count = {r._label: r.n for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count.get(0) or not count.get(1):
        return Model(np.zeros(PLACES, "f4"), 0.0, 1.0, 0.0)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, PLACES), np.int64)
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                place, offsets = features(part.column("_text"))
                positive = part.column("_label").to_numpy() == 1
                of = np.repeat(positive, np.diff(offsets))
                for k in (0, 1):
                    held[k] += np.bincount(place[of == bool(k)], minlength=PLACES)
        some = np.flatnonzero(held.any(axis=0))
        for start in range(0, len(some), 100_000):
            part = some[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(held[1][part]), pa.array(held[0][part])],
                names=["place", "positive", "negative"],
            )

    sums = (
        rows.mapInArrow(counted, "place bigint, positive bigint, negative bigint")
        .groupBy("place")
        .agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
        .toArrow()
    )
    counts = np.full((2, PLACES), smoothing)
    at = sums["place"].to_numpy()
    counts[1, at] += sums["positive"].to_numpy()
    counts[0, at] += sums["negative"].to_numpy()
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    limit = 1_000_000
    share = F.when(F.col("_label") == 1, int(min(1.0, fit_rows / count[1]) * limit)).otherwise(
        int(min(1.0, fit_rows / count[0]) * limit)
    )
    chosen = rows.filter(F.pmod(F.xxhash64("_id", F.lit("fit")), F.lit(limit)) < share)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                place, offsets = features(part.column("_text"))
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(place.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_label"), lists],
                    names=["id", "label", "places"],
                )

    sample = materialize(
        chosen.mapInArrow(
            listed,
            T.StructType(
                [
                    T.StructField("id", chosen.schema["_id"].dataType),
                    T.StructField("label", T.IntegerType()),
                    T.StructField("places", T.ArrayType(T.IntegerType())),
                ]
            ),
        ),
        "fit-rows",
    )
    taken = sample.orderBy("id").select("label", "places").toArrow().combine_chunks()
    positive = taken["label"].to_numpy() == 1
    if not taken.num_rows or positive.all() or not positive.any():
        return Model(np.zeros(PLACES, "f4"), 0.0, 1.0, 0.0)
    vectors = [x.values.to_numpy() for x in taken["places"].combine_chunks()]
    weights, intercept = dual_coordinate_descent(vectors, np.where(positive, 1, -1), ratio)
    scaled = weights * ratio
    margin = np.array([scaled[v].sum() / np.sqrt(max(1, len(v))) for v in vectors]) + intercept
    slope, shift = logistic_scale(margin, positive)
    return Model(scaled.astype("f4"), intercept, slope, shift)


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                score = shared.value.scores(*features(part.column(text_col)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in names),
                        pa.array(score),
                        pa.array((score >= 0.5).astype(np.int32)),
                    ],
                    names=[*names, "score", "predicted"],
                )

    return docs.mapInArrow(run, T.StructType([*kept, *made]))


def held_out(id_col: str) -> Column:
    """The fold that no label is learned from: crc32 of the id's text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    **options,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    votes = (
        labels.select(F.col(id_col).alias("_of"), F.col(label_col).alias("_vote"))
        .filter("_of IS NOT NULL AND _vote IS NOT NULL")
        .filter(~held_out("_of"))
        .groupBy("_of")
        .agg((F.avg("_vote") >= 0.5).cast("int").alias("label"))
    )
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labelled = plain.join(measured(votes, "labels"), F.col("doc_id") == F.col("_of"))
    model = fit(labelled.select("doc_id", "text", "label"), **options)
    return score_texts(plain, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted"
    )

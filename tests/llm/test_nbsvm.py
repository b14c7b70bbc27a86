from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from zonewright.llm import nbsvm


def test_held_out_accuracy(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for n in range(600):
        good = n % 5 != 0
        words = ["".join(rng.choice("etaoins") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
        docs.append((n, " ".join(words if good else [w + rng.choice(["$$$", "***"]) for w in words])))
        labels.append((n, int(good)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    rows = nbsvm.quality_scores(frame, marks).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 600 and 100 < len(held) < 300
    truth = dict(labels)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    import zlib

    docs = [(n, f"text {'$$$ ' * (n % 2)} {n}") for n in range(90)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    def scores(flip):
        marks = [
            (n, (n % 2) ^ (flip and zlib.crc32(str(n).encode()) % 3 == 1)) for n in range(90)
        ]
        found = nbsvm.quality_scores(frame, spark.createDataFrame(marks, "doc_id bigint, quality int"))
        return {r.doc_id: r.score for r in found.collect()}
    assert scores(False) == scores(True)


def test_features_do_not_depend_on_the_batch():
    texts = pa.array(["abc abc def", None, "", "a", "zzz"])
    place, offsets = nbsvm.features(texts)
    for i in range(len(texts)):
        alone, _ = nbsvm.features(texts.slice(i, 1))
        assert (place[offsets[i] : offsets[i + 1]] == alone).all()


def test_odd_rows(spark, odd, none):
    marks = spark.createDataFrame(
        [(1, 1), (3, 0), (None, 1), (8, None), (99, 0), (4, 0), (6, 1)], "doc_id bigint, quality int"
    )
    rows = nbsvm.quality_scores(odd, marks).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert nbsvm.quality_scores(none, marks).count() == 0
    blank = nbsvm.quality_scores(odd, marks.filter("false")).collect()
    assert {r.score for r in blank} == {0.5}


def test_coordinate_descent_reaches_the_best_value():
    """Against the dual and the primal value: their gap bounds the distance from the optimum."""
    rng = np.random.default_rng(4)
    ratio = rng.normal(size=60)
    rows = [np.sort(rng.choice(60, rng.integers(1, 25), replace=False)) for _ in range(120)]
    labels = np.where([ratio[r].sum() + rng.normal() > 0 for r in rows], 1, -1)
    weights, intercept = nbsvm.dual_coordinate_descent(rows, labels, ratio)
    x = np.zeros((120, 61))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt(len(r))
    x[:, 60] = 1

    def primal(w):
        return w @ w / 2 + np.maximum(0, 1 - labels * (x @ w)).sum()

    # a plain projected gradient on the dual, run until it stands still
    q = (x * labels[:, None]) @ (x * labels[:, None]).T
    alpha = np.zeros(120)
    for _ in range(60_000):
        alpha = np.clip(alpha - (q @ alpha - 1) / np.linalg.norm(q, 2), 0, 1)
    best = (x * labels[:, None]).T @ alpha
    dual = alpha.sum() - alpha @ q @ alpha / 2
    assert primal(best) - dual < 1e-4
    got = np.append(weights, intercept)
    assert primal(got) - dual < 0.05 and np.abs(x @ got - x @ best).max() < 0.05


def test_equal_scores_as_a_plain_model(spark):
    """Counts, ratios and scores of a small set against a version without batches."""
    rng = random.Random(8)
    docs = [(n, " ".join(rng.choice("ab cd ef $$ gh ij".split()) for _ in range(rng.randrange(30)))) for n in range(200)]
    marks = [(n, int("$" not in (docs[n][1] or "")) if rng.random() < 0.9 else 1) for n in range(0, 200, 2)]
    import zlib

    learned = {n: y for n, y in marks if zlib.crc32(str(n).encode()) % 3 != 1}
    place, offsets = nbsvm.features(pa.array([t for _, t in docs]))
    of = [place[a:b] for a, b in zip(offsets, offsets[1:])]
    counts = np.ones((2, nbsvm.PLACES))
    for n, y in learned.items():
        np.add.at(counts[y], of[n], 1)
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ids = sorted(learned)
    weights, intercept = nbsvm.dual_coordinate_descent(
        [of[n] for n in ids], np.array([1 if learned[n] else -1 for n in ids]), ratio
    )
    margin = [(weights * ratio)[of[n]].sum() / np.sqrt(max(1, len(of[n]))) + intercept for n, _ in docs]
    slope, shift = nbsvm.logistic_scale(np.array([margin[n] for n in ids]), np.array([learned[n] == 1 for n in ids]))
    rows = nbsvm.quality_scores(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(marks, "doc_id bigint, quality int"),
    ).collect()
    want = {n: 1 / (1 + np.exp(-(slope * margin[n] + shift))) for n, _ in docs}
    assert all(abs(r.score - want[r.doc_id]) < 1e-3 for r in rows)

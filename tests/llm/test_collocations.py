from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from zonewright.llm import collocations as cl


def brute_force(rows, least, top=2000):
    totals, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        f[lang, tuple(words[i : i + k])] += 1
    f = {p: n for p, n in f.items() if n >= least}
    held = {
        (lang, p[i : i + m], n)
        for (lang, p), n in f.items()
        for m in range(2, len(p))
        for i in range(len(p) - m + 1)
    }
    best = []
    for (lang, p), a in f.items():
        if len(p) < 2 or any((lang, p, n) in held for n in range(a, a + 1)):
            continue
        n = totals[lang]
        cuts = [
            (1000 * a * n // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        ]
        score, _, left, right = min(cuts)
        best.append((lang, -score, -a, " ".join(p).encode(), left, right, n))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(best):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n, -score))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["a", "B", "c", "dd", "ée", "日本", "f" * 300, "x y", "#", "g"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", ";", "\r\n", "\x0b", "! "]
    rows = []
    for _ in range(300):
        n = rng.choice([0, 1, 4, 30, 200])
        text = "".join(rng.choice(words[: rng.choice([2, 4, 10])]) + rng.choice(ends) for _ in range(n))
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), text))
    rows += [("en", "is onhe is onhe")] * 500 + [(None, None), ("en", None), ("en", " \t")]
    return rows


@pytest.mark.parametrize("known,parts", [(1 << 20, 4), (7, 13), (0, 3)])
def test_equals_brute_force(spark, known, parts):
    rows = corpus(known + parts)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = cl.collocations(docs, least=6, top=40, known_words=known).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, got)) == sorted(brute_force(rows, 6, 40))


def test_odd_rows_and_empty_tables(spark, odd, none):
    docs = odd.withColumnRenamed("source", "lang")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(map(tuple, cl.collocations(docs, least=2).collect())) == sorted(brute_force(rows, 2))
    assert cl.collocations(none.withColumnRenamed("source", "lang")).collect() == []


def test_quicksort_counts_equal_partitions():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 5, (4000, 5)).astype(np.uint64)
    for k in range(1, 5):
        rows[rows[:, k - 1] == 0, k] = 0
    weight = rng.integers(1, 4, len(rows))
    want = Counter()
    for row, n in zip(rows.tolist(), weight.tolist()):
        for k in range(1, 6):
            if row[k - 1]:
                want[tuple(row[:k])] += n
    got = {tuple(rows[at, :k].tolist()): n for k, at, n in cl.equal_partitions(rows, weight, 30)}
    assert got == {p: n for p, n in want.items() if n >= 30}


def test_packed_keys_come_back_and_sort_like_words():
    top = np.uint64(1 << 63)
    rows = np.array([[1, 2, 0], [top + np.uint64(5), 3, top], [1 << 20, 0, 0], [1, 1, 9]], np.uint64)
    keys = cl.pack(rows)
    assert (cl.unpack(keys, 3) == rows).all()
    by_key = sorted(range(4), key=lambda i: keys[i].as_py())
    assert by_key == sorted(range(4), key=lambda i: rows[i].tolist())

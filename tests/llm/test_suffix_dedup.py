from __future__ import annotations

import random

import numpy as np
import pytest

from zonewright.llm import suffix_dedup as sd


def corpus():
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage, other = noise(260), noise(130)
    docs = []
    for n in range(60):
        parts = [noise(rng.choice([0, 40, 150]))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(0, 120)
            parts += [passage[at : at + rng.choice([99, 100, 101, 140])], noise(rng.choice([0, 1, 80]))]
        if rng.random() < 0.4:
            parts.append(other)
        docs.append((n, "".join(parts)))
    docs += [(100, "ab" * 400), (101, "a" * 300), (102, docs[3][1]), (103, docs[3][1])]
    return docs


@pytest.mark.parametrize("split_rows", [1, 3, 20_000])
def test_equals_brute_force(spark, split_rows):
    docs = corpus()
    want = sd.brute_force([(n, t.encode()) for n, t in docs])
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = sd.remove_repeats(frame, split_rows=split_rows).collect()
    assert len(got) == len(docs)
    for row in got:
        raw, runs = row.text.encode(), want[row.doc_id]
        kept, at = b"", 0
        for begin, end in runs:
            kept += raw[at:begin]
            at = end
        assert bytes(row.kept_bytes) == kept + raw[at:]
        assert (row.n_bytes, row.n_spans) == (len(raw), len(runs))
        assert row.n_removed == sum(e - b for b, e in runs)


def test_multikey_sort():
    rows = np.random.default_rng(1).integers(0, 2, (500, 21)).astype(np.uint8)
    order = sd.multikey_sort(rows)
    assert [bytes(r) for r in rows[order]] == sorted(bytes(r) for r in rows)
    common = sd.prefix_lengths(rows, order)
    for k in range(1, 500):
        a, b = rows[order[k - 1]], rows[order[k]]
        n = next((i for i in range(21) if a[i] != b[i]), 21)
        assert common[k] == n


def test_odd_rows(odd, none):
    rows = sd.remove_repeats(odd).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert all(r.key == "k" for r in rows)
    # repeated rows are one document and keep their text; runs inside one text are removed
    assert all(r.n_removed == 0 for r in rows if r.doc_id in (1, 2, 3, 4, 5, 8, None))
    assert by_id[6].n_removed == 4999 and bytes(by_id[6].kept_bytes) == b"x"
    assert sd.remove_repeats(none).count() == 0

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonewright.llm import decontamination as dc


def make_index(items):
    sides = []
    for k in (1, 2):
        h, of = dc.word_sequence(pa.array([i[k] for i in items]))
        sides.append([h[of[i] : of[i + 1]] for i in range(len(items))])
    whole = [np.unique(np.concatenate(p)) for p in zip(*sides)]
    terms, counts = np.unique(np.concatenate(whole), return_counts=True)
    mean = np.mean([len(a) + len(b) for a, b in zip(*sides)])
    return dc.ItemIndex([i[0] for i in items], *sides, terms, counts, len(items), mean, 64)


def test_wand_finds_all_at_or_above_the_threshold():
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(80)]
    items = [
        (n, " ".join(rng.choices(vocabulary, k=8)), " ".join(rng.choices(vocabulary, k=3)))
        for n in range(150)
    ]
    index = make_index(items)
    for threshold in (0.2, 0.4, 0.6):
        for _ in range(60):
            query = sorted(set(rng.sample(range(len(index.terms)), 25)))
            want = {}
            for t in query:
                for item, score in zip(index.items[t], index.scores[t]):
                    want[item] = want.get(item, 0) + score
            want = {i: s for i, s in want.items() if s >= threshold - 1e-9}
            got = dict(index.search(query, threshold))
            assert got == pytest.approx(want)


def corpus(spark):
    rng = random.Random(9)
    words = [f"k{k}" for k in range(3000)]
    items = [(n, " ".join(rng.choices(words, k=rng.choice([6, 20, 40])))) for n in range(30)]
    docs = []
    for n in range(80):
        body = rng.choices(words, k=rng.choice([5, 100, 500]))
        if n % 4 == 0:
            item = items[n % 30][1].split()
            at = rng.randrange(len(body) + 1)
            body = body[:at] + item + body[at:]
        if n % 9 == 1:
            body += items[n % 30][1].split()[: 4]
        docs.append((n, " ".join(body).upper() if n % 8 == 0 else " ".join(body)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(
        items, "item_id bigint, text string"
    ), docs, items


def test_copied_items_are_found_and_nothing_else(spark):
    frame, bench, docs, items = corpus(spark)
    hits = dc.contaminated(frame, dc.split_items(bench)).collect()
    want = {(n, i) for n, t in docs for i, x in items if f" {x} " in f" {t.lower()} "}
    assert {(h.doc_id, h.item_id) for h in hits} == want and want
    kept = dc.decontaminate(frame, dc.split_items(bench))
    assert {r.doc_id for r in kept.collect()} == {n for n, _ in docs} - {n for n, _ in want}


def test_shards_give_the_same_hits(spark):
    frame, bench, *_ = corpus(spark)
    items = dc.split_items(bench)
    many = list(dc.build_shards(items, shard_bytes=2000))
    assert len(many) > 2
    texts = pa.array([r.text for r in frame.orderBy("doc_id").collect()])
    one = next(iter(dc.build_shards(items)))

    def found(indexes):
        sequence = dc.word_sequence(texts)
        return {
            (hit[0], index.names[hit[1]])
            for index in indexes
            for hit in dc.scan_batch(index, *sequence, 0.6, 0.6)
        }

    whole = found(one)
    assert found([index for shard in many for index in shard]) == whole and whole
    assert len({index.window for index in one}) > 1


def test_an_unrelated_long_item_changes_no_hit(spark):
    rng = random.Random(3)
    item = [f"i{k}" for k in range(20)]
    filler = [f"f{k}" for k in range(150)]
    docs = spark.createDataFrame(
        [(1, " ".join(item[:10] + filler + item[10:])), (2, " ".join(filler + item))],
        "doc_id bigint, text string",
    )
    long = " ".join(f"z{rng.randrange(900)}" for _ in range(400))
    for rows in ([(1, " ".join(item))], [(1, " ".join(item)), (2, long)]):
        split = dc.split_items(spark.createDataFrame(rows, "item_id bigint, text string"))
        assert {(h.doc_id, h.item_id) for h in dc.contaminated(docs, split).collect()} == {(2, 1)}


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "one two three four five six seven"), (2, None), (3, ""), (4, "null id here")],
        "item_id bigint, text string",
    )
    split = dc.split_items(items)
    hits = {(h.doc_id, h.item_id) for h in dc.contaminated(odd, split).collect()}
    assert hits == {(1, 1), (2, 1), (None, 4)}
    left = dc.decontaminate(odd, split)
    assert left.count() == 6 and left.columns == odd.columns
    assert dc.contaminated(none, split).count() == 0
    assert dc.contaminated(odd, split.filter(F.lit(False))).count() == 0

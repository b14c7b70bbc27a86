from __future__ import annotations

import random
from collections import defaultdict

import pytest

from zonewright.llm import components as cc
from zonewright.llm.jaccard_join import jaccard_components


def brute_force(docs):
    sets = {}
    for name, text in docs:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        sets[name] = grams or ({tuple(words)} if words else set())
    parent = {n: n for n in sets}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: (len(sets[n]), root(n)) for n in names}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    docs, name = [], 0
    for _ in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 12, 80, 200]))]
        if rng.random() < 0.5:
            base = passage + base
        for _ in range(rng.choice([1, 2, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append((name, " ".join(words)))
            name += 1
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,sample", [(1, 10_000), (2, 20)])
def test_equals_brute_force(spark, seed, sample):
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = jaccard_components(frame, sample_docs=sample).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(docs)


def test_odd_rows(odd, none):
    rows = jaccard_components(odd).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.n_shingles, r.component_id))
    assert got[1] == [(3, 1)] * 2 and got[2] == [(3, 1)]
    assert got[3] == [(0, 3)] and got[4] == [(0, 4)] and got[5] == [(0, 5)]
    assert got[None] == [(1, None)] and got[6] == [(1, 6)]
    assert jaccard_components(none).count() == 0


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a bigint, b bigint")
    labels = {r.node: r.label for r in cc.components(links).collect()}
    assert labels == {k: 0 for k in range(61)} | {100: 100, 101: 100}

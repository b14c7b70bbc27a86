from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonewright.llm import prefix_trie as pt


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, hashlib.md5(f"{len((role or '').encode())}:{role or ''}:{text or ''}".encode()).hexdigest())
            own.setdefault(conv, []).append((key, (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    nodes = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        whole = own.get(conv - int(np.fmod(conv, 100)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            node = nodes.setdefault(tuple(whole[:d]), [[], [], set()])
            node[0].append(conv)
            if d == len(whole):
                node[1].append(conv)
            else:
                node[2].add(whole[d])
    out = []
    for path, (members, ends, children) in nodes.items():
        below = {p: v for p, v in nodes.items() if p[: len(path)] == path}
        saved = sum((len(v[0]) - 1) * (len(p[-1][1]) if p else 0) for p, v in below.items())
        leaves = sum(not v[2] for v in below.values())
        digest = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()
        parent = min(nodes[path[:-1]][0]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), leaves, saved, digest))
    return sorted(out, key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    texts = ["", None, "hello", "ünï 😀", "x" * 3000, "bye", " "]
    rows = []
    for conv in rng.sample(range(-300, 3000), n):
        size = rng.choice([1, 2, 3, 6, 9])
        for turn in range(size):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(texts[: rng.choice([2, 7])])))
    rows += [(5001, None, "a", "first"), (5001, 0, "b", "second"), (5001, 0, "a", "tie"), (5001, 0, "a", "tie")]
    rows += [(None, 0, "user", "no id")]
    rows += [(c, 0, "system", "copy") for c in range(20_000, 20_400)]
    rows += [(c, t, "user", "long") for c in (30_000, 30_001) for t in range(300)]
    return rows


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("parts,spines", [(1, 4000), (4, 4000), (37, 6)])
def test_equals_brute_force(spark, monkeypatch, parts, spines):
    monkeypatch.setattr(pt, "ID_RANGE", 64)
    rows = corpus(parts)
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    turns = turns.withColumns({"path": F.lit("p"), "turns": F.lit(1), "_base": F.lit(2), "_h": F.lit(3)})
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = found(pt.prefix_trie(pt.rebuilt(turns), shard_spines=spines))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute_force(rows)


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert pt.prefix_trie(pt.rebuilt(turns)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_findclose_equals_a_stack(seed):
    rng = random.Random(seed)
    bits, depth = [], 0
    for _ in range(rng.choice([1, 70, 5000])):
        if depth and rng.random() < 0.48:
            bits.append(False)
            depth -= 1
        else:
            bits.append(True)
            depth += 1
    bits += [False] * depth
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    at = np.flatnonzero(np.array(bits))
    assert pt.Parentheses(np.array(bits)).findclose(at).tolist() == [want[i] for i in at.tolist()]

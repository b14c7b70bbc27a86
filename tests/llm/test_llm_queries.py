"""Queries with SQL against their SQL; the pipeline against a brute-force version."""

from __future__ import annotations

import re

import compare
import public_tokenizers
import pytest
from test_jaccard import brute_force as groups_of
from test_quality import counts
from tokenizers import Tokenizer

from zonewright.llm.catalog import CHECKS, QUERIES
from zonewright.llm.suffix_dedup import brute_force as runs_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_sql(spark, name):
    got = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    assert compare.difference(got, compare.duck_rows(compare.connect(SF_DIR), CHECKS[name])) is None


def test_every_operator_has_a_query():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES if n.startswith("op")} == {
        str(n) for n in range(1, 14)
    }
    assert "pipeline" in QUERIES


def test_pipeline_equals_brute_force(spark):
    con = compare.connect(SF_DIR)
    docs = con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()
    items = [r[0] for r in con.execute("SELECT text FROM benchmark").fetchall()]
    # no line of these tables is above a host's limit of more than ten documents
    lines = {}
    for _, text, source in docs:
        for line in {x.strip().lower() for x in (text or "").split("\n")} - {""}:
            lines.setdefault((source, line), set()).add(text)
    assert max(map(len, lines.values())) <= 10
    kept = []
    for name, text, _ in docs:
        n, _, _, _, repeated = counts(text)
        if n >= 50 and 100 * repeated <= 50 * n:
            kept.append((name, text))
    first = groups_of(kept)
    kept = [(n, t) for n, t in kept if first[n][1] == n]
    runs = runs_of([(n, t.encode()) for n, t in kept])
    cut = []
    for name, text in kept:
        raw, out, at = text.encode(), b"", 0
        for begin, end in runs[name]:
            out += raw[at:begin]
            at = end
        cut.append((name, (out + raw[at:]).decode("utf-8", "ignore")))
    cut = [(n, t) for n, t in cut if not any(i in t for i in items)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {n: library.encode(t, add_special_tokens=False).ids for n, t in cut}
    rows = QUERIES["pipeline"](spark, SF_DIR).collect()
    assert {r.doc_id: r.ids for r in rows} == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from zonewright.llm.quality_rules import quality_rules


def counts(text):
    words = (text or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
    words = [w for w in words if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.translate({c: None for c in (9, 11, 12, 13, 32)})]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(hit),
    )


def test_odd_rows(odd, none):
    rows = quality_rules(odd).collect()
    assert len(rows) == 10
    for r in rows:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert found == counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert quality_rules(none).count() == 0


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    menu, line = "Home | Shop 12 | Login", "w{} " * 30
    docs = []
    letters = "abcdefghijklmnopqrstuvwxyzABCD"
    for n in range(60):
        name = letters[n // 10] + letters[n % 10]
        own = "\n".join(line.format(*[name + letters[k] + letters[j].lower() + name * (j > 25) for j in range(30)]) for k in range(3))
        docs.append((n, f"{menu.replace('12', str(n + 10))}\n{own}\n", "h1" if n < 40 else None))
    noise = "\n".join(f"common line {k} " + "z " * 10 for k in range(9))
    docs += [(100 + n, noise + f"\nown words {letters[n]}q{letters[n]}", "h1") for n in range(30)]
    docs += [(200 + n, docs[0][1], "h2") for n in range(30)]  # copies are one text
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    rows = {r.doc_id: r for r in quality_rules(frame).collect()}
    assert "Login" not in rows[0].clean_text and rows[0].kept and rows[0].n_lines_removed == 1
    assert "Login" not in rows[50].clean_text and rows[50].kept
    assert rows[100].base_failed is False or rows[100].n_repeat_words
    assert not rows[100].kept and rows[100].words_left == 3
    assert rows[200].clean_text == rows[200].text and rows[200].kept


def test_no_python_on_the_path(odd):
    plan = quality_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality_rules(odd).select(F.sum("n_words")).first()[0] > 0

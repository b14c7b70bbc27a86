from __future__ import annotations

import itertools
import random
import re

from pyspark.sql import functions as F

from zonewright.llm import url_rules as ur

FIXED = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def fixed(host, path):
    fits = []
    for action, text in FIXED:
        h, _, tail = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + tail):
            fits.append((len(text), text, action))
    return max(fits)[1:] if fits else (None, None)


ODD = [
    None,
    "",
    "no scheme",
    "http://",
    "HTTP://WWW.Example.NET/en/1",
    "http://example.net/en",
    "http://example.net",
    "http://net/",
    "http://xnet/",
    "https://a.org/fr/?q=1",
    "https://a.ORG/fr",
    "x://b.example.com/de/5#f",
    "http://h?://x/y",
    "a://b://c/d",
    "http://ÄB.net/É",
    "http://h/p\nq?x",
]


def test_hosts_paths_and_fixed_rules(spark):
    frame = spark.createDataFrame(list(enumerate(ODD)) + [(4, ODD[4])], "page_id bigint, url string")
    none = spark.createDataFrame([], "_labelled bigint, bad boolean")
    rows = ur.filter_urls(frame.withColumn("host", F.lit(1)), none, FIXED).collect()
    assert len(rows) == len(ODD) + 1
    for row in rows:
        host, path = parsed(row.url)
        rule, verdict = fixed(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule), row.url
        assert row.verdict == (verdict or "allow")
    assert ur.filter_urls(frame.filter("false"), none, FIXED).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(8)
    pages, marks = [], []
    for n in range(400):
        host = rng.choice(["a.x.com", "b.x.com", "c.y.org"])
        part, query = rng.choice(["en", "de"]), rng.choice(["", "?ad=1", "?ref=2"])
        pages.append((n, f"http://{host}/{part}/{n}{query}"))
        bad = (host == "a.x.com" and query == "?ad=1") or (part == "de" and rng.random() < 0.3)
        if n % 4:
            marks.append((n, bad))
    frame = spark.createDataFrame(pages, "page_id bigint, url string")
    labels = spark.createDataFrame(marks, "_labelled bigint, bad boolean")
    rows = ur.filter_urls(frame, labels, [], min_support=0.02, min_confidence=0.6).collect()
    sets = {
        r.page_id: frozenset(r.tokens)
        for r in frame.withColumns(ur.host_and_path(F.col("url")))
        .withColumn("tokens", ur.tokens())
        .collect()
    }
    seen, hits = {}, {}
    for n, bad in marks:
        for size in range(1, len(sets[n]) + 1):
            for rule in itertools.combinations(sorted(sets[n]), size):
                seen[rule] = seen.get(rule, 0) + 1
                hits[rule] = hits.get(rule, 0) + bad
    rules = [
        set(r) for r, n in seen.items() if hits[r] >= 0.02 * len(marks) and hits[r] >= 0.6 * n
    ]
    assert rules
    for row in rows:
        want = any(rule <= sets[row.page_id] for rule in rules)
        assert row.verdict == ("block" if want else "allow")
    assert {r.verdict for r in rows} == {"block", "allow"}

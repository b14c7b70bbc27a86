"""URL filters: fixed host and path rules, then association rules mined from labelled urls.

The tokens of a url are the suffixes of its host, its path segments (numbers as one token) and
its query and fragment parts. Spark's FP-growth mines token combinations of labelled urls
together with the label; combinations whose share of bad urls reaches ``min_confidence``, at
``min_support`` of the labelled urls, block. Of two rules of which one contains the other, only
the shorter is kept if its confidence is no less. A rule is filed under its rarest token; only
urls that hold that token are compared with it.

Defined results: a null url, or one without ``://``, has an empty host and path, no tokens, and
is allowed; rows without a label are not learned from; repeated rows are judged each; an
empty table gives an empty table; without labelled rows nothing is mined; other columns pass
through, and columns with the names of the result are replaced.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import carries, materialize, measured

BAD, GOOD = "label:bad", "label:good"


def host_and_path(url: Column) -> dict[str, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return {"host": lower, "path": path}


def fixed_rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest fitting fixed rule; null where none fits.

    ``rules`` is a short list of (verdict, host followed by path).
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, tail = text.partition("/")
        fits = (
            (F.col("host") == host) | F.col("host").endswith("." + host)
        ) & F.col("path").startswith(slash + tail)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def tokens(url: str = "url") -> Column:
    """Distinct tokens of a url with its ``host`` and ``path``, in order."""
    labels = "split(host, '[.]')"
    hosts = (
        f"transform(sequence(1, size({labels})), "
        f"i -> concat('host:', array_join(slice({labels}, i, size({labels}) - i + 1), '.')))"
    )
    segments = (
        "transform(filter(split(path, '/'), s -> s <> ''), "
        "s -> concat('path:', CASE WHEN s rlike '^[0-9]+$' THEN '#' ELSE s END))"
    )
    tail = f"regexp_extract(coalesce(`{url}`, ''), '[?#].*$', 0)"
    parts = f"transform(filter(split({tail}, '[?&#]'), s -> s <> ''), s -> concat('part:', s))"
    every = f"array_sort(array_distinct(concat({hosts}, {segments}, {parts})))"
    return F.expr(f"CASE WHEN host = '' THEN array() ELSE {every} END").cast("array<string>")


def mine_rules(
    labelled: DataFrame, min_support: float, min_confidence: float, partitions: int
) -> DataFrame:
    """Kept rules: ``rule_tokens``, ``confidence``, ``support``; from ``tokens`` and ``bad``."""
    items = labelled.select(
        F.array_append("tokens", F.when(F.col("bad"), BAD).otherwise(GOOD)).alias("items")
    )
    model = FPGrowth(
        itemsCol="items",
        minSupport=min_support,
        minConfidence=min_confidence,
        numPartitions=partitions,
    ).fit(items)
    mined = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.array_sort("antecedent").alias("rule_tokens"), "confidence", "support"
    )
    mined = materialize(mined.filter(~F.array_contains("rule_tokens", GOOD)), "url-rules")
    # a rule filed under each of its tokens meets the rules that it contains
    narrow = mined.select(
        F.col("rule_tokens").alias("part"),
        F.col("confidence").alias("part_confidence"),
        F.col("rule_tokens")[0].alias("token"),
    )
    covered = (
        mined.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("token"))
        .join(narrow, "token")
        .filter(F.size("part") < F.size("rule_tokens"))
        .filter(F.size(F.array_except("part", "rule_tokens")) == 0)
        .filter("part_confidence >= confidence")
        .select("rule_tokens")
        .distinct()
    )
    return mined.join(covered, "rule_tokens", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame, frequency: DataFrame) -> DataFrame:
    """Token sets that a rule matches: ``tokens``, ``matched_rule``.

    ``frequency``: ``token``, ``n``. Distinct token sets are looked up, not single urls.
    """
    numbered = rules.withColumn("rule_id", F.xxhash64(F.array_join("rule_tokens", "\n")))
    rarest = (
        numbered.select("rule_id", "rule_tokens", "confidence", F.explode("rule_tokens").alias("token"))
        .join(frequency, "token", "left")
        .groupBy("rule_id")
        .agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).alias("_rare"),
            F.first("rule_tokens").alias("rule_tokens"),
            F.first("confidence").alias("confidence"),
        )
        .select(F.col("_rare.token").alias("token"), "rule_tokens", "confidence")
    )
    sets = urls.select("tokens").distinct()
    return (
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(measured(rarest, "url-rule-index"), "token")
        .filter(F.size(F.array_except("rule_tokens", "tokens")) == 0)
        .groupBy("tokens")
        .agg(F.max(F.struct("confidence", "rule_tokens")).alias("_best"))
        .select("tokens", F.col("_best.rule_tokens").alias("matched_rule"))
    )


@carries("id_col", "url_col")
def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    min_support: float = 0.002,
    min_confidence: float = 0.5,
    min_rows: int = 10,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``matched_rule``.

    ``labels``: ``_labelled`` (a page id) and ``bad``. A rule needs ``min_support`` of the labelled
    urls and ``min_rows`` of them, so that few labels make no rule of a single url.
    """
    partitions = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = pages.drop("host", "path", "rule", "verdict", "matched_rule", "tokens")
    urls = plain.withColumns(host_and_path(F.col(url_col))).withColumn("tokens", tokens(url_col))
    votes = (
        labels.filter("_labelled IS NOT NULL AND bad IS NOT NULL")
        .groupBy("_labelled")
        .agg((F.avg(F.col("bad").cast("int")) >= 0.5).alias("bad"))
    )
    labelled = materialize(
        urls.join(votes, F.col(id_col) == F.col("_labelled"))
        .filter("size(tokens) > 0")
        .select("tokens", "bad"),
        "labelled-urls",
    )
    frequency = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")
    )
    support = max(min_support, min(1.0, min_rows / max(1, labelled.count())))
    mined = mine_rules(labelled, support, min_confidence, partitions)
    matched = measured(match_rules(urls, mined, frequency), "matched-urls")
    rule, verdict = fixed_rule(rules)
    found = matched.withColumnRenamed("tokens", "_tokens")
    return (
        urls.join(found, F.col("tokens") == F.col("_tokens"), "left")
        .withColumns({"rule": rule, "verdict": verdict})
        .withColumn(
            "verdict",
            F.coalesce(
                "verdict", F.when(F.col("matched_rule").isNotNull(), "block").otherwise("allow")
            ),
        )
        .drop("_tokens", "tokens")
    )

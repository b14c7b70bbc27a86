"""Quality rules: per-document counts and lines that recur over the documents of a host.

Only DataFrame functions. A line is normalised (lower case, digits as 0, single spaces) and
hashed together with its host. Documents are counted once per distinct text, so exact copies
do not make their own lines look like boilerplate. A line is removed from a host's documents
if more than ``max(min_docs, share * documents of the host)`` of them hold it. A document is
depleted, and rejected, if fewer than ``min_words`` words or less than ``min_rest`` of its
words are left.

Defined results: a null text has no words (rejected); a null host is a host of its own; lines
without a word are never counted or removed; repeated rows are judged each by its own text;
an empty table gives an empty table; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import carries, measured

SPACE = r"[\\x20\\x09-\\x0D]"
#: Counts of the base rules, in the order of the result.
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once per row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def words_sql(text: str) -> str:
    """Words of a text as an array."""
    return f"filter(split({text}, '{SPACE}+'), w -> w <> '')"


def repeat_words_sql(words: str) -> str:
    """Number of words that lie in a 3-word window found twice or more.

    Windows are compared by a 64-bit hash. They are sorted by (hash, position), equal
    neighbours give the positions of repeated windows, and each position adds the words that
    the position before does not cover yet.
    """
    windows = "transform(sequence(0, size(ws) - 3), i -> xxhash64(ws[i], ws[i + 1], ws[i + 2]))"
    ordered = "sort_array(transform(hs, (h, i) -> struct(h AS h, i AS i)))"
    hits = (
        "sort_array(filter(transform(so, (s, k) -> CASE WHEN "
        "(k > 0 AND so[k - 1].h = s.h) OR (k + 1 < size(so) AND so[k + 1].h = s.h) "
        "THEN s.i END), p -> p IS NOT NULL))"
    )
    covered = (
        f"aggregate({hits}, named_struct('n', 0L, 'last', -3), "
        "(a, p) -> named_struct('n', a.n + least(3, p - a.last), 'last', p), a -> a.n)"
    )
    found = _let(ordered, "so", covered)
    counted = _let(windows, "hs", f"IF(size(array_distinct(hs)) = size(hs), 0L, {found})")
    return _let(words, "ws", f"IF(size(ws) < 4, 0L, {counted})")


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of :data:`BASE`."""
    text = f"coalesce(`{text_col}`, '')"
    lines = f"filter(split({text}, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    counted = docs.withColumns(
        {
            "n_words": F.expr(f"CAST(size({words_sql(text)}) AS BIGINT)"),
            "word_chars": F.expr(f"CAST(length(regexp_replace({text}, '{SPACE}+', '')) AS BIGINT)"),
            "n_symbols": F.expr(f"CAST(regexp_count({text}, '[#*$%&|<>]') AS BIGINT)"),
            "n_dup_lines": F.expr(
                "CAST(" + _let(lines, "ls", "size(ls) - size(array_distinct(ls))") + " AS BIGINT)"
            ),
            "n_repeat_words": F.expr(f"CAST({repeat_words_sql(words_sql(text))} AS BIGINT)"),
        }
    )
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    )


def line_key_sql(line: str, host: str) -> str:
    """64-bit hash of a normalised line and its host; null for a line without a word."""
    plain = f"regexp_replace(regexp_replace(lower({line}), '[0-9]', '0'), '{SPACE}+', ' ')"
    return _let(
        f"btrim({plain})",
        "l",
        f"CASE WHEN l = '' THEN NULL ELSE xxhash64(coalesce(`{host}`, ''), `{host}` IS NULL, l) END",
    )


def frequent_lines(
    docs: DataFrame, text_col: str, host_col: str, min_docs: int, share: float
) -> DataFrame:
    """Keys of the lines above their host's limit.

    The distinct (host, line, text) triples spread a frequent line over all partitions
    before it is counted; the counts are summed on the map side first.
    """
    text = f"coalesce(`{text_col}`, '')"
    keys = f"transform(split({text}, '\\n'), x -> {line_key_sql('x', host_col)})"
    held = docs.select(
        F.col(host_col).alias("_host"),
        F.expr(f"xxhash64({text})").alias("_text"),
        F.explode(F.expr(f"array_distinct({keys})")).alias("_line"),
    ).filter("_line IS NOT NULL")
    lines = (
        held.distinct()
        .groupBy("_host", "_line")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > min_docs)
    )
    hosts = (
        docs.select(F.col(host_col).alias("_of"), F.expr(f"xxhash64({text})").alias("_text"))
        .distinct()
        .groupBy("_of")
        .agg(F.count(F.lit(1)).alias("_docs"))
    )
    return (
        lines.join(hosts, F.col("_host").eqNullSafe(F.col("_of")))
        .filter(F.col("_n") > F.col("_docs") * F.lit(share))
        .select("_line")
    )


@carries("id_col", "text_col", "host_col")
def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = 10,
    share: float = 0.05,
    min_words: int = 50,
    min_rest: float = 0.5,
) -> DataFrame:
    """``docs`` with base counts, ``clean_text``, ``n_lines_removed``, ``words_left``, ``kept``.

    ``clean_text`` is the text without its removed lines, the text itself where none goes.
    The lines to remove are gathered per document id, at most the lines of one document.
    """
    spark_text = f"coalesce(`{text_col}`, '')"
    limits = measured(
        frequent_lines(docs, text_col, host_col, min_docs, share), "frequent-lines"
    )
    exploded = docs.select(
        F.col(id_col).alias("_id"),
        F.explode(
            F.expr(
                f"array_distinct(transform(split({spark_text}, '\\n'), "
                f"x -> {line_key_sql('x', host_col)}))"
            )
        ).alias("_line"),
    ).filter("_line IS NOT NULL")
    cut = (
        exploded.join(limits, "_line", "left_semi")
        .groupBy("_id")
        .agg(F.collect_set("_line").alias("_cut"))
    )
    cut = measured(cut, "cut-lines")
    joined = base_counts(docs, text_col).join(cut, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    left = (
        f"array_join(filter(split({spark_text}, '\\n'), x -> NOT coalesce("
        f"array_contains(_cut, {line_key_sql('x', host_col)}), false)), '\\n')"
    )
    return (
        joined.withColumn(
            "clean_text", F.expr(f"CASE WHEN _cut IS NULL THEN `{text_col}` ELSE {left} END")
        )
        .withColumns(
            {
                "n_lines_removed": F.expr(
                    f"CASE WHEN _cut IS NULL THEN 0 ELSE size(split({spark_text}, '\\n')) "
                    f"- size(split(clean_text, '\\n')) END"
                ),
                "words_left": F.expr(
                    "CASE WHEN _cut IS NULL THEN n_words ELSE "
                    f"CAST(size({words_sql('clean_text')}) AS BIGINT) END"
                ),
            }
        )
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.col("words_left") >= min_words)
            & (F.col("words_left") >= F.lit(min_rest) * F.col("n_words")),
        )
        .drop("_id", "_cut")
    )

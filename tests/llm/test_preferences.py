from __future__ import annotations

from zonewright.llm import preferences as pf

SCHEMA = "pair_id bigint, turn bigint, role string, text string"


def turn(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_prompt_and_masks(spark):
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b")]
    rejected = [(1, 0, "user", "q"), (1, 1, "assistant", "zz"), (1, 2, "user", "s")]
    chosen += [(2, 0, "user", "same"), (3, 0, "user", "alone"), (4, 0, None, None), (4, 1, "assistant", "x")]
    rejected += [(2, 0, "user", "same"), (4, 0, None, None), (5, 0, "user", "alone")]
    frames = [spark.createDataFrame(r, SCHEMA) for r in (chosen, rejected)]
    rows = {r.pair_id: r for r in pf.format_preferences(*frames).collect()}
    assert set(rows) == {1, 2, 4}
    one = rows[1]
    assert one.prompt == turn("user", "q") and one.prompt_turns == 1
    assert one.chosen == turn("assistant", "a") + turn("user", "r") + turn("assistant", "b")
    assert [one.chosen[s.start : s.end] for s in one.chosen_mask] == [
        turn("assistant", "a"),
        turn("assistant", "b"),
    ]
    assert [one.rejected[s.start : s.end] for s in one.rejected_mask] == [turn("assistant", "zz")]
    assert (rows[2].chosen, rows[2].rejected, rows[2].chosen_mask) == ("", "", [])
    assert rows[4].prompt == turn("", "") and rows[4].rejected == ""
    assert pf.format_preferences(*(f.filter("false") for f in frames)).count() == 0


def test_echo_negatives(spark):
    talk = spark.createDataFrame(
        [
            (1, 0, "user", "hi"),
            (1, 1, "assistant", "hello"),
            (1, 2, "user", "bye"),
            (2, 0, "user", "only"),
            (3, 0, "assistant", "first"),
            (None, 0, "user", "n"),
            (None, 1, "assistant", None),
            (4, 0, "user", "twice"),
            (4, 0, "user", "twice"),
            (4, 1, "assistant", "twice"),
        ],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = {r.pair_id: r for r in pf.format_preferences(*pf.echo_negatives(talk)).collect()}
    assert set(rows) == {1, 3, None, 4}
    assert rows[1].prompt == turn("user", "hi")
    assert (rows[1].chosen, rows[1].rejected) == (turn("assistant", "hello"), turn("assistant", "hi"))
    assert rows[3].prompt == "" and rows[3].rejected == turn("assistant", "")
    assert rows[None].rejected == turn("assistant", "n")
    assert rows[4].prompt_turns == 3 and rows[4].chosen == ""

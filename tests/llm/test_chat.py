"""Formatting of conversations, read back exactly."""

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plain import sha
from tidemark.llm.chat import END, PROBE, SEAM, START, format_chats, masked_text, turns_of
from tidemark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def back(spark, rows):
    df = format_chats(spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit(0)).withColumn("pieces", F.lit(1)))
    read = df.select(
        "conv_id", "formatted", turns_of(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    return {r.conv_id: r for r in read.collect()}


def test_template(spark):
    rows = [(1, 2, "assistant", "hi"), (1, 0, "system", "be brief"), (1, 1, "user", "a"), (1, 3, "assistant", "there")]
    got = back(spark, rows)[1]
    assert got.formatted == (
        f"{START}system\nbe brief{END}\n{START}user\na{END}\n{START}assistant\nhi{SEAM}there{END}\n"
    )
    assert got.loss == "hithere"


TRICKY = [
    None, "", PROBE, START, END, SEAM, "<|nl|>", "<\\|im_end|>", "<\\\\|", "<", "|", "<<||>", "\\", "a\nb", "<|", "é😀", "x" * 50_000,
]


@pytest.mark.parametrize("role", ["user", "assistant", None, "<|im_end|>", "a\nb", "<\\|nl|>"])
def test_every_text_comes_back(spark, role):
    rows = [(n, 0, "user", "q") for n in range(len(TRICKY))]
    rows += [(n, 1, role, t) for n, t in enumerate(TRICKY)] + [(n, 2, role, t) for n, t in enumerate(TRICKY)]
    got = back(spark, rows)
    for n, t in enumerate(TRICKY):
        turn = (role or "", t or "")
        assert [tuple(x) for x in got[n].turns] == [("user", "q"), turn, turn]
        assert got[n].loss == ((t or "") * 2 if role == "assistant" else "")
        assert got[n].formatted.count(END) == (2 if role != "user" else 1)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "tool\n"]), st.text("<|\\>im_endstar\n", max_size=12)), min_size=1, max_size=12))
def test_any_conversation_comes_back(spark, turns):
    got = back(spark, [(1, n, role, text) for n, (role, text) in enumerate(turns)])[1]
    assert [tuple(x) for x in got.turns] == turns
    assert got.loss == "".join(text for role, text in turns if role == "assistant")


def test_defined_results(spark):
    rows = [(None, 1, "user", "b"), (None, None, "user", "a"), (2, 1, "user", "y"), (2, 1, "user", "x"), (2, 1, "user", "x")]
    got = back(spark, rows)
    assert [x.text for x in got[None].turns] == ["a", "b"]
    assert [x.text for x in got[2].turns] == ["x", "x", "y"]
    assert back(spark, [(1, 0, "user", "x")])[1].loss == ""
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_conversation(spark):
    rows = [(1, n, "assistant" if n % 3 else "user", f"t{n}") for n in range(3000)]
    got = back(spark, rows)[1]
    assert [x.text for x in got.turns] == [f"t{n}" for n in range(3000)]


@pytest.mark.parametrize("roles", [["user", "assistant"], ["assistant"]])
def test_a_very_long_conversation(spark, tmp_path, roles):
    """50,000 turns, by turns and by one role, take seconds."""
    turns = [(1, n, roles[n % len(roles)], f"says {n} <|x|> é") for n in range(50_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    begun = time.time()
    row = next(r for r in QUERIES["op10_chat"](spark, str(tmp_path)).collect() if r.conv_id == 1)
    assert time.time() - begun < 20
    loss = "".join(text for _, _, role, text in turns if role == "assistant")
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (50_000, len(loss), sha(loss))
    assert row.turns_sha256 == sha("".join(f"{role}\n{text}\n" for _, _, role, text in turns))

"""Chat formatting: control strings in texts, the loss mask, and the operator against its SQL."""

import random
import re

import duckdb
import pytest

from revlens.llm import chat
from revlens.llm.common import importable
from tests.oracle_check import compare

SCHEMA = "conv_id long, turn int, role string, text string"
BITS = ["[INST]", "[/INST]", "<s>", "</s>", "\\", "[\\INST]", "[", "<", "/", "INST]", "s>", "\n", "ok ", "é", "$1", "😀"]


def conversations(n, seed=4, roles=("user", "assistant", "system", "tool")):
    r = random.Random(seed)
    return [
        (c, t, r.choice(roles), "".join(r.choice(BITS) for _ in range(r.randrange(12))) if r.random() < 0.9 else None)
        for c in range(n) for t in range(r.randrange(1, 6))
    ]


def formatted(spark, rows):
    return {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize("text, shown", [
    ("see [INST] here", "<s>see [\\INST] here</s>"), ("a </s> b", "<s>a <\\/s> b</s>"), ("<s>", "<s><\\s></s>"),
    ("[\\INST]", "<s>[\\\\INST]</s>"), ("nothing", "<s>nothing</s>"), ("[INST", "<s>[INST</s>"), ("", "<s></s>"),
])
def test_control_strings_are_always_escaped(spark, text, shown):
    r = formatted(spark, [(1, 0, "assistant", text)])[1]
    assert r.formatted == shown and [(t.role, t.text) for t in r.turns] == [("assistant", text)]


def test_only_the_template_has_control_strings(spark):
    control = re.compile(r"\[/?INST\]|</?s>")
    for r in formatted(spark, conversations(200)).values():
        marks = control.findall(r.formatted)
        assert len(marks) == 2 * len(r.turns)


def test_query_equals_its_sql(spark):
    """On conversations full of control strings, with nulls and ties in turn."""
    importable(spark)
    rows = conversations(300) + [(None, None, "user", None), (7, 0, "user", "again"), (7, 0, "user", "again"), (8, None, None, "x")]
    df = chat.op5_chat_formatting(spark, spark.createDataFrame(rows, SCHEMA))
    con = duckdb.connect()
    con.execute("create table conversations(conv_id bigint, turn integer, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = con.sql(chat.ORACLE)
    assert not compare(df.columns, df.collect(), want.columns, want.fetchall())


def test_loss_spans_are_the_assistant_texts(spark):
    for r in formatted(spark, conversations(200, seed=9)).values():
        texts = [r.formatted[s.start : s.end] for s in r.loss_spans]
        assert [re.sub(r"([\[<])\\(\\*)(/?INST\]|/?s>)", r"\1\2\3", t) for t in texts] == [t.text for t in r.turns if t.role == "assistant"]
        for s in r.loss_spans:
            assert r.formatted[s.start - 3 : s.start] == "<s>" and r.formatted[s.end : s.end + 4] == "</s>"


def test_a_very_long_conversation_and_a_long_text(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(2000)] + [(2, 0, "assistant", "word [INST] " * 50_000)]
    got = formatted(spark, rows)
    assert len(got[1].turns) == 2000 and len(got[1].loss_spans) == 1000 and got[1].n_escaped == 2000
    assert got[2].turns[0].text == "word [INST] " * 50_000


def test_extra_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", "x", "y")], SCHEMA + ", source string, formatted string")
    assert chat.format_conversations(df).columns == ["conv_id", "formatted", "turns", "loss_spans", "n_escaped"]

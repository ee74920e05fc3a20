import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecensus.llm import chat
from lakecensus.llm.queries import FORGED

TURN = "conv_id long, turn long, role string, text string"


def back(spark, rows, schema=TURN, key="conv_id"):
    return {r["conversation"]: r for r in chat.read_back(chat.format_chats(spark.createDataFrame(rows, schema), key)).collect()}


def test_forged_markers_stay_text(spark):
    got = back(spark, [(1, 0, "user", FORGED), (1, 1, "assistant", FORGED)])[1]
    assert [tuple(t) for t in got["turns"]] == [("user", FORGED), ("assistant", FORGED)] and got["loss_text"] == FORGED
    assert got["formatted"].count("<|im_start|>") == got["formatted"].count("<|im_end|>") == 2
    assert sum(m["before"] + m["loss"] + m["after"] for m in got["mask"]) == len(got["formatted"])


ODD = st.text(alphabet=st.sampled_from(list("<|\\>im_startend%0A25\n\r é😀")), max_size=30)


def test_escapes_are_reversible(spark):
    found = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(ODD, ODD)
    def collect(role, text):
        found.append((role, text))

    collect()
    rows = [(i, 0, r, t) for i, (r, t) in enumerate(found)] + [(i, 1, "assistant", t) for i, (_, t) in enumerate(found)]
    got = back(spark, rows)
    for i, (role, text) in enumerate(found):
        assert [tuple(t) for t in got[i]["turns"]] == [(role, text), ("assistant", text)]
        assert got[i]["loss_text"] == (text if role == "assistant" else "") + text


def test_nulls_ties_repeats_and_order(spark):
    got = back(spark, [(1, 1, "assistant", None), (1, 0, None, "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
                       (None, 0, "assistant", "x"), (2, 0, "assistant", ""), (2, None, "user", "first"), (3, 0, "assistant", "long " * 50000)])
    assert [tuple(t) for t in got[None]["turns"]] == [("assistant", "x")]
    assert got[2]["loss_text"] == "" and got[3]["loss_text"] == "long " * 50000
    assert [tuple(t) for t in got[2]["turns"]] == [("user", "first"), ("assistant", "")]
    assert [tuple(t) for t in got[1]["turns"]] == [("", "b"), ("user", "a"), ("user", "a"), ("assistant", "")]


def test_layouts_become_canonical_turns(spark):
    schema = ("id long, messages array<struct<role:string,content:string,weight:int>>, "
              "conversations array<struct<`from`:string,value:string>>, prompt string, completion string, response string, "
              "instruction string, input string, output string, system string, question string, answer string, layout string")

    def record(i, **fields):
        names = [c.split(" ")[0] for c in ("id messages conversations prompt completion response instruction input output "
                                           "system question answer layout").split()]
        return tuple(i if n == "id" else fields.get(n, "noise" if n == "layout" else None) for n in names)

    rows = [
        record(1, messages=[("user", "q", 1), ("assistant", "a", 2)]),
        record(2, conversations=[("human", "q"), ("gpt", "a")]),
        record(3, prompt="q", completion="a"), record(4, prompt="q", response="a"),
        record(5, instruction="q", output="a"), record(6, instruction="q", input="more", output="a", system="s"),
        record(7, question="q", answer="a"), record(8, prompt="only"), record(9, messages=[]),
    ]
    df = spark.createDataFrame(rows, schema)
    layouts = {r["conversation"]: r["layout"] for r in chat.to_turns(df, "id").collect()}
    assert layouts == {1: "messages", 2: "sharegpt", 3: "prompt_completion", 4: "prompt_response", 5: "instruction",
                       6: "instruction", 7: "question_answer", 8: None, 9: "messages"}
    got = {r["conversation"]: [tuple(t) for t in r["turns"]] for r in chat.read_back(chat.format_chats(df, "id")).collect()}
    plain = [("user", "q"), ("assistant", "a")]
    assert all(got[i] == plain for i in (1, 2, 3, 4, 5, 7))
    assert got[6] == [("system", "s"), ("user", "q\n\nmore"), ("assistant", "a")] and got[8] == [] and got[9] == []


def test_fingerprints_ignore_other_columns(spark):
    rows = [(1, 0, "user", "a")]
    plain = spark.createDataFrame(rows, TURN)
    more = plain.select("*", *[F.lit(1).alias(n) for n in ("formatted", "mask", "pos", "p", "_fp", "conversation")])
    a, b = (df.select(chat.fingerprint(df.schema).alias("f")).first()["f"] for df in (plain, more))
    assert a == b == hashlib.md5(b"role\ntext\nturn").hexdigest()
    every = [f for n in chat.LAYOUTS for f in chat.fingerprints(n)]
    assert len(every) == len(set(every))
    assert chat.read_back(chat.format_chats(more.drop("_fp"), "conv_id")).first()["n_turns"] == 1


def test_empty_table(spark):
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], TURN), "conv_id")).count() == 0


@pytest.mark.parametrize("n", [2000])
def test_a_long_conversation_is_linear(spark, n):
    rows = spark.range(n).selectExpr("0L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('x<|', 30) as text")
    got = chat.read_back(chat.format_chats(rows, "conv_id")).first()
    assert got["n_turns"] == n and got["loss_text"] == "x<|" * 30 * (n // 2)

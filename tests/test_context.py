import random

import pytest

from dialogue_engine import constants as C
from dialogue_engine.operators import context

TURNS = "conv_id long, turn long, role string, text string"


def conversations():
    """Short ones, one of 90 turns with gaps, one empty text, a role that is not chat."""
    rng = random.Random(5)
    rows = []
    for conv, length in [(0, 1), (1, 2), (2, 3), (3, 90), (4, 7), (5, 12), (None, 30)]:
        turn = -6 if conv == 5 else 0
        for i in range(length):
            turn += 1 if conv != 3 else rng.choice([1, 1, 2, 40])
            role = rng.choice(["user", "user", "assistant", "system", "tool"])
            rows.append((conv, turn, role, f"{conv}.{i}" if i % 5 else ""))
    return rows


def expected(rows, last_k):
    out = {}
    for conv in {r[0] for r in rows}:
        history = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1]):
            if role not in ("user", "assistant"):
                continue
            if role == "user":
                earlier = history if last_k is None else history[len(history) - min(last_k, len(history)):]
                out[conv, turn] = [("system", C.SYSTEM_PROMPT), *earlier, (role, text)]
            history.append((role, text))
    return out


@pytest.mark.parametrize("span", [1, 3, 16, 256])
@pytest.mark.parametrize("last_k", [None, 0, 1, 4, 50])
def test_chat_context(spark, span, last_k):
    rows = conversations()
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    got = context.chat_context(turns, last_k=last_k, span=span).collect()
    assert {(r.conv_id, r.turn): [tuple(m) for m in r.messages] for r in got} == expected(rows, last_k)


def test_append_reply(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 4, "user", "c")], TURNS)
    replies = spark.createDataFrame(
        [(1, "q", "r"), (3, "x", "y"), (1, "second", "s")], "conv_id long, message string, reply string"
    )
    rows = {tuple(r) for r in context.append_reply(turns, replies).collect()}
    assert rows == {
        (1, 4, "user", "second"), (1, 5, "assistant", "s"),
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "q"), (1, 3, "assistant", "r"),
        (2, 4, "user", "c"), (3, 0, "user", "x"), (3, 1, "assistant", "y"),
    }


@pytest.mark.parametrize("last_k", [None, 1, 0])
def test_request_context(spark, last_k):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (2, 1, "user", "z")], TURNS
    )
    requests = spark.createDataFrame([(1, "q"), (9, "new")], "conv_id long, message string")
    got = {r.conv_id: [tuple(m) for m in r.messages] for r in context.request_context(turns, requests, last_k=last_k).collect()}
    history = [("user", "a"), ("assistant", "b")]
    history = history if last_k is None else history[2 - last_k:]
    system = ("system", C.SYSTEM_PROMPT)
    assert got == {1: [system, *history, ("user", "q")], 9: [system, ("user", "new")]}


def test_request_gate(spark):
    rows = [("hi", 64), ("hi", 0), ("hi", None), (" \t　", 5), (None, 5), ("", 5)]
    gated = context.request_gate(spark.createDataFrame(rows, "message string, max_tokens long"))
    assert sorted(r.max_tokens for r in gated.collect()) == [64, 192, 192]


@pytest.mark.parametrize("last_k", [3, 40])
def test_a_conversation_with_a_third_of_all_turns_is_spread(spark, last_k):
    """No task holds more than a few runs of it, however its turns are numbered."""
    span = 16
    rows = [(0, 7 * i if i % 2 else 7 * i + 3, "user" if i % 3 else "assistant", f"t{i}") for i in range(2000)]
    rows += [(c, t, "user", "x") for c in range(1, 1001) for t in range(4)]
    turns = spark.createDataFrame(rows, TURNS)
    got = context.chat_context(turns, last_k=last_k, span=span)
    assert {(r.conv_id, r.turn): [tuple(m) for m in r.messages] for r in got.collect()} == expected(rows, last_k)

    plans = context._recent(
        turns.selectExpr("*", f"floor(turn / {span}) as block", "struct(role, text) as message"), span, last_k
    )._jdf.queryExecution().executedPlan().toString()
    texts = [line for line in plans.splitlines() if "Window [" in line and "message" in line]
    assert texts and not any("[conv_id#" in line.split("],", 1)[-1] for line in texts)


def test_recent_messages_against_a_list(spark):
    """Blocks with one turn, with many, and empty ones between them."""
    rng = random.Random(8)
    turn, rows = 0, []
    for i in range(400):
        turn += rng.choice([1, 1, 1, 30, 500])
        rows.append((0, turn, "user", str(i)))
    turns = spark.createDataFrame(rows, TURNS).selectExpr(
        "*", "floor(turn / 8) as block", "struct(role, text as content) as message"
    )
    for k in (1, 5, 20):
        got = {r.block: [m.content for m in r.inherited] for r in context._recent(turns, 8, k).collect()}
        first = {}
        for i, (_, t, _, _) in enumerate(rows):
            first.setdefault(t // 8, i)
        assert got == {b: [str(j) for j in range(max(0, i - k), i)] for b, i in first.items() if i}

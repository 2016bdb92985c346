import math
import random
import struct

import pytest
from helpers import apply, column
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.functions import text
from dialogue_engine.functions.rounding import py_round

EDGES = [None, "", " \t\n", "　", "\x1c", "a" * 19, "a" * 20, " " + "a" * 19 + "\n", "\U0001f600 ok"]


def test_there_are_29_blanks():
    assert len(C.BLANK_CHARS) == 29
    assert all(c.isspace() for c in C.BLANK_CHARS)


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_py_round(spark, digits):
    rng = random.Random(digits)
    values = [0.25, 0.35, 2.675, 0.125, 0.75, 0.065, 0.055, 0.045, -0.25, -0.35, 0.0, 1.0, 1e-9, 0.5, 1.5]
    values += [rng.randrange(1, 400) / rng.randrange(1, 400) for _ in range(2000)]
    values += [rng.randrange(0, 10**6) / 10 ** (digits + 1) for _ in range(2000)]
    values += [struct.unpack("d", struct.pack("q", struct.unpack("q", struct.pack("d", v))[0] + s))[0]
               for v in (0.05, 0.15, 0.125, 2.675, 12.345) for s in (-1, 0, 1)]
    assert apply(spark, values, lambda c: py_round(c, digits), "double") == [
        round(v, digits) for v in values
    ]


def test_py_round_without_a_number(spark):
    values = [None, math.inf, -math.inf, math.nan, 1e300]
    got = apply(spark, values, lambda c: py_round(c, 1), "double")
    assert got[:3] == values[:3] and math.isnan(got[3]) and got[4] == 1e300


def test_strip_like_python(spark):
    blanks = C.BLANK_CHARS
    values = [a + "x" + blanks + "y" + b for a in blanks for b in blanks]
    assert apply(spark, values, text.strip_unicode) == [v.strip() for v in values]


def test_lengths_and_classes(spark):
    assert apply(spark, EDGES, text.char_length) == [len(v or "") for v in EDGES]

    def kind(v):
        inner = (v or "").strip()
        return "empty" if not inner else "short" if len(inner) < 20 else "ok"

    assert apply(spark, EDGES, text.reply_class) == [kind(v) for v in EDGES]


def test_words_and_normal_form(spark):
    values = [*EDGES, "a　b\x1cc  d", "  Mixed CASE\n\n text ", " " + C.BLANK_CHARS + "z" + C.BLANK_CHARS]
    assert apply(spark, values, text.word_count) == [len((v or "").split()) for v in values]
    assert apply(spark, values, text.normalised) == [" ".join((v or "").lower().split()) for v in values]


def test_keywords(spark):
    values = [None, "", "Shipment of ORDER order", "nothing here", "assistance with accounting policy"]

    def count(v):
        return sum(k in (v or "").lower() for k in C.SUPPORT_KEYWORDS)

    assert apply(spark, values, text.keyword_count) == [count(v) for v in values]
    assert apply(spark, values, text.any_keyword) == [count(v) > 0 for v in values]


def test_excerpt(spark):
    values = [None, "", "a" * 50, "a" * 51, "\U0001f600" * 60]
    assert apply(spark, values, lambda c: text.excerpt(c, 50)) == [(v or "")[:50] for v in values]
    assert apply(spark, values, lambda c: text.excerpt(c, 50, mark=True)) == [
        (v or "")[:50] + ("..." if len(v or "") > 50 else "") for v in values
    ]


def test_commentary(spark):
    df = spark.createDataFrame([("abc", "de"), (None, "x")], "b string, f string")
    rows = [r[0] for r in df.select(text.length_commentary(F.col("b"), F.col("f"))).collect()]
    assert rows[0].startswith("Base: 3 chars. Fine-tuned: 2 chars. ")
    assert rows[1].startswith("Base: 0 chars. Fine-tuned: 1 chars. ")


def test_extract_reply(spark):
    cases = {
        "x assistant hi": "hi",
        "a assistant b assistant c <|end|> d": "c",
        "Assistant no ": "Assistant no ",
        " no word ": " no word ",
        "assistant": "",
        "user q assistant\n\n　reply \x1c<|eot_id|>": "reply",
    }
    assert apply(spark, list(cases), text.extract_reply) == list(cases.values())


def test_extract_reply_by_template(spark):
    mark = "<|start_header_id|>assistant<|end_header_id|>\n\n"
    cases = {
        f"q<|eot_id|>{mark}ask my assistant now<|eot_id|>": "ask my assistant now",
        " no assistant header ": " no assistant header ",
    }
    assert apply(spark, list(cases), lambda c: text.extract_reply(c, "template")) == list(cases.values())


def test_parse_reply_json(spark):
    bodies = {
        '{"message": {"role": "assistant", "content": "hi"}}': ("hi", False),
        '{"message": {}}': ("", False),
        "{}": ("", False),
        '{"message": {"content": "cut': ("", True),
        "not json": ("", True),
        None: ("", True),
    }
    assert [tuple(v) for v in apply(spark, list(bodies), text.parse_reply_json)] == list(bodies.values())


def test_empty_frame(spark):
    assert column(spark, []).select(text.word_count(F.col("v"))).collect() == []

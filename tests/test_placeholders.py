import random
import re

import pytest
from helpers import apply
from pyspark.sql import functions as F

from dialogue_engine.functions import placeholders as P
from dialogue_engine.operators.fill import fill_placeholders, placeholder_inventory

TOKEN = re.compile(r"\{\{([^{}]+)\}\}")
TEXTS = [
    None,
    "",
    "none",
    "Order {{Order Number}} of {{Company}}.",
    "{{Company}}{{Company}}",
    "open {{Company",
    "{{Open {{Company}} x}}",
    "{{{Company}}}",
    "{{}} {{a}b}} }}{{",
    "{{{{Company}}X}}",
    "mark ﷐ {{Company}}",
]


def random_texts(n):
    rng = random.Random(7)
    bits = ["{{", "}}", "{", "}", "Company", "Order Number", "X", " ", "﷐", "é"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(n)]


def fill(text, values):
    if text is None:
        return None
    return TOKEN.sub(lambda m: values.get(m[1]) if values.get(m[1]) is not None else m[0], text)


@pytest.mark.parametrize("company", ["ACME", "", "a {{Order Number}} b", "{", "}}", None, "x﷐y"])
def test_fill(spark, company):
    values = {"Company": company, "Order Number": "77"}
    columns = {k: F.lit(v).cast("string") for k, v in values.items()}
    texts = TEXTS + random_texts(400)
    assert apply(spark, texts, lambda c: P.fill_tokens(c, columns)) == [fill(t, values) for t in texts]


def test_fill_with_nothing(spark):
    assert apply(spark, TEXTS, lambda c: P.fill_tokens(c, {})) == TEXTS


def test_generic(spark):
    def words(m):
        return "your order number" if m[1] == "Order Number" else m[1].lower()

    texts = TEXTS + random_texts(400)
    assert apply(spark, texts, P.generic_placeholders) == [
        None if t is None else TOKEN.sub(words, t) for t in texts
    ]


def test_strip_leaves_no_token_of_the_text(spark):
    texts = [t for t in TEXTS + random_texts(400) if t is not None]
    assert apply(spark, texts, P.strip_placeholders) == [TOKEN.sub("", t) for t in texts]


def test_handle(spark):
    texts = ["a {{Order Number}} b"]
    got = [apply(spark, texts, lambda c, how=how: P.handle_placeholders(c, how))[0] for how in ("keep", "generic", "strip")]
    assert got == ["a {{Order Number}} b", "a your order number b", "a  b"]


def test_fill_from_table(spark):
    texts = spark.createDataFrame(
        [(1, 10, "{{Name}}/{{No}}"), (2, 99, "{{Name}}"), (3, None, "{{Name}}")], "id long, k long, text string"
    )
    values = spark.createDataFrame([(10, "Ann", 5)], "k long, name string, no long")
    rows = fill_placeholders(texts, values, "k", {"Name": "name", "No": "no"}).orderBy("id").collect()
    assert [r.text for r in rows] == ["Ann/5", "{{Name}}", "{{Name}}"]


def test_inventory(spark):
    texts = spark.createDataFrame([("{{A}} {{A}} {{B}}",), ("{{A}} {{Open",), (None,)], "text string")
    rows = {r.placeholder: (r.occurrences, r.texts) for r in placeholder_inventory(texts).collect()}
    assert rows == {"A": (3, 2), "B": (1, 1)}

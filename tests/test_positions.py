import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dialogue_engine.operators.positions import null_safe_join, positions, span_of, top_per_key
from dialogue_engine.operators.prepare import number_turns, pair_turns


def rows_with_a_hot_key(n=3000):
    """A third of the rows has one key, some have none; order values have gaps."""
    rng = random.Random(1)
    order = rng.sample(range(-50, 20 * n), n)
    return [(rng.choice([7, 7, 7, None, 1, 2, 3, 4, 5]), v, float(v % 13)) for v in order]


def test_positions(spark):
    rows = rows_with_a_hot_key()
    df = spark.createDataFrame(rows, "k long, s long, x double")
    totals = {"n": (F.lit(1), "sum"), "low": (F.col("x"), "min"), "high": (F.col("x"), "max")}
    got = positions(df, ["k"], ["s"], span_of("s", 100), totals=totals).collect()

    groups = defaultdict(list)
    for k, s, x in rows:
        groups[k].append((s, x))
    expected = set()
    for k, members in groups.items():
        xs = [x for _, x in members]
        for i, (s, x) in enumerate(sorted(members)):
            expected.add((k, s, x, i, len(members), min(xs), max(xs)))
    assert len(got) == len(rows)
    assert {(r.k, r.s, r.x, r.position, r.n, r.low, r.high) for r in got} == expected


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k long, v string")
    right = spark.createDataFrame([(None, "n"), (1, "o")], "k long, w string")
    got = null_safe_join(left, right, ["k"], "left").select("k", "v", "w").collect()
    assert {tuple(r) for r in got} == {(1, "a", "o"), (None, "b", "n"), (3, "c", None)}


def test_number_turns(spark):
    turns = spark.createDataFrame(
        [(1, 5, "user", "a"), (1, 900_000, "assistant", "b"), (1, 70_000, "user", "c"), (2, 3, "user", "d")],
        "conv_id long, turn long, role string, text string",
    )
    got = {(r.conv_id, r.text): r.turn for r in number_turns(turns).collect()}
    assert got == {(1, "a"): 0, (1, "c"): 1, (1, "b"): 2, (2, "d"): 0}


def test_pair_turns(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (2, 0, "user", "d")],
        "conv_id long, turn long, role string, text string",
    )
    assert [tuple(r) for r in pair_turns(turns).collect()] == [(1, 2, "b", "c")]


def test_sparse_order_is_spread(spark):
    """Numbers so far apart that every bucket has one row."""
    rows = [("k", i * 10**9) for i in range(-400, 400)] + [(None, i * 7**20) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = positions(df, ["k"], ["o"], span_of("o"), totals={"n": (F.lit(1), "sum")}).collect()
    wanted = {}
    for key in ("k", None):
        own = sorted(o for k, o in rows if k == key)
        wanted |= {(key, o): (i, len(own)) for i, o in enumerate(own)}
    assert {(r.k, r.o): (r.position, r.n) for r in got} == wanted


@pytest.mark.parametrize("k", [1, 5, 2000])
def test_top_per_key(spark, k):
    rows = [("hot", (i * 7919) % 5003) for i in range(5003)] + [("cold", i) for i in range(3)] + [(None, 4)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = top_per_key(df, ["k"], [F.col("o").desc()], k, "o").collect()
    wanted = set()
    for key in ("hot", "cold", None):
        own = sorted((o for key_, o in rows if key_ == key), reverse=True)
        wanted |= {(key, o, i) for i, o in enumerate(own[:k], 1)}
    assert {(r.k, r.o, r["__rank"]) for r in got} == wanted

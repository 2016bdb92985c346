import functools
import random
import re
import statistics

import pytest
from helpers import plan
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.operators import heldout, prepare, profile
from dialogue_engine.sources.cases import prompt_catalog

CASES = "case_id long, instruction string, response string, category string, intent string, flags string"
ROWS = [
    (0, "cancel it", "sure", "ORDER", "cancel", "B"),
    (1, "cancel it", "done " * 20, "ORDER", "cancel", "BQ"),
    (2, "track", "sure", "ORDER", "track", "B"),
    (3, "pay", "ok", "PAYMENT", "pay", None),
    (4, "pay now", "ok", "PAYMENT", "pay", None),
]


def cases(spark):
    return spark.createDataFrame(ROWS, CASES)


def test_distribution(spark):
    got = {(r.category, r.intent): tuple(r)[2:] for r in profile.distribution(cases(spark)).collect()}
    assert got == {("ORDER", "cancel"): (2, 1, 2, 2, 0.4), ("ORDER", "track"): (1, 1, 1, 1, 0.2),
                   ("PAYMENT", "pay"): (2, 2, 1, 0, 0.4)}


def test_length_profile(spark):
    rows = {r.column: r for r in profile.length_profile(cases(spark)).collect()}
    lengths = [len(r[2]) for r in ROWS]
    assert (rows["response"].length_min, rows["response"].length_max) == (2, 100)
    assert rows["response"].p50 == statistics.median(lengths)
    assert rows["response"].p95 == round(4 + 0.8 * 96, 1)


def test_table_profile(spark):
    rows = [tuple(r) for r in profile.table_profile(cases(spark)).orderBy("position").collect()]
    assert rows[0] == (0, "case_id", "bigint", 5, 5) and rows[5] == (5, "flags", "string", 5, 3)


def test_preview_and_longest(spark):
    assert [r.case_id for r in profile.preview(cases(spark), 2, ["case_id"], 1).collect()] == [1, 2]
    assert [r.case_id for r in profile.longest_cases(cases(spark), 2).collect()] == [1, 0]


def test_filters(spark):
    assert prepare.length_band(cases(spark), "response", 3, 99).count() == 2
    assert prepare.in_scope(cases(spark), "category", ["PAYMENT"]).count() == 2
    assert {r.case_id for r in prepare.dedupe(cases(spark), ["flags"]).collect()} == {0, 1, 3}
    assert {r.case_id for r in prepare.dedupe(cases(spark).repartition(5), ["intent", "response"]).collect()} == {0, 1, 2, 3}


def test_fallback(spark):
    extra = spark.createDataFrame([(9, "tell me a joke")], "case_id long, instruction string")
    row = prepare.add_fallback_examples(cases(spark), extra).where("case_id = 9").first()
    assert (row.intent, row.response, row.category) == ("out_of_scope", C.FALLBACK_REPLY, None)


def test_held_out(spark):
    prompts = prompt_catalog(spark)
    assert prompts.count() == 15 and {r.test_type for r in prompts.collect()} >= {"typo", "edge", "paraphrase"}
    data = spark.createDataFrame(
        [("  CANCEL\teverything\n",), ("Cancel everything now",), ("cancel　everything",)], "instruction string"
    )
    kept = heldout.held_out(prompts, data)
    assert kept.columns == prompts.columns
    assert {r.prompt for r in prompts.collect()} - {r.prompt for r in kept.collect()} == {"Cancel everything"}


def test_held_out_overlap(spark):
    prompts = spark.createDataFrame(
        [(1, "A b  c d"), (2, "x y z"), (3, "one"), (4, " "), (5, None), (6, "a b c q")], "prompt_id long, prompt string"
    )
    data = spark.createDataFrame([("so a B c",), ("b c d",), ("ONE",), (None,)], "instruction string")
    rows = {r.prompt_id: (r.ngrams, r.found, r.share) for r in heldout.held_out_overlap(prompts, data, n=3).collect()}
    assert rows == {1: (2, 2, 1.0), 2: (1, 0, 0.0), 3: (1, 1, 1.0), 4: (0, 0, 0.0), 5: (0, 0, 0.0), 6: (2, 1, 0.5)}


def test_held_out_keeps_repeats(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "prompt_id long, prompt string")
    data = spark.createDataFrame([("B",), ("b ",)], "instruction string")
    assert sorted(r.prompt_id for r in heldout.held_out(prompts, data).collect()) == [1, 2, 4]


def test_held_out_overlap_against_sets(spark):
    """Any n, blanks of all kinds, texts shorter than n, repeats; with and without the pre-filter."""
    rng = random.Random(4)
    blanks = [" ", "\t", "\n ", "\u3000", "\x1c", "  "]

    def text():
        return "".join(rng.choice("abC") + rng.choice(blanks) for _ in range(rng.randrange(12)))

    asked = [(i, text()) for i in range(60)] + [(60, None), (61, ""), (62, " \n")]
    known = [(text(),) for _ in range(80)] + [(None,), ("",)] + [("a b c a b c",)] * 40
    prompts = spark.createDataFrame(asked, "prompt_id long, prompt string")
    data = spark.createDataFrame(known, "instruction string").repartition(3)

    def grams(value, n):
        words = (value or "").lower().split()
        if not words:
            return set()
        return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}

    for n in (1, 2, 3, 5, 6, 7, 8):
        have = set().union(*(grams(v, n) for (v,) in known))
        wanted = {i: (len(grams(v, n)), len(grams(v, n) & have)) for i, v in asked}
        for limit in (heldout.BLOOM_TEXT, -1):
            keep, heldout.BLOOM_TEXT = heldout.BLOOM_TEXT, limit
            try:
                rows = heldout.held_out_overlap(prompts, data, n=n).collect()
            finally:
                heldout.BLOOM_TEXT = keep
            assert {r.prompt_id: (r.ngrams, r.found) for r in rows} == wanted
            assert all(r.share == (round(r.found / r.ngrams, 4) if r.ngrams else 0.0) for r in rows)


def test_large_prompts_are_dealt_out_by_their_text(spark, monkeypatch):
    """As many tasks as the text asks for, and no task that keeps the n-grams of its input."""
    monkeypatch.setattr(heldout, "BLOOM_TEXT", -1)
    monkeypatch.setattr(heldout, "TASK_TEXT", 100)
    prompts = spark.createDataFrame([(i, f"p{i} q r s") for i in range(40)], "prompt_id long, prompt string")
    for rows in (150, 300):
        data = spark.createDataFrame([(f"p{i} q r s t",) for i in range(rows)], "instruction string")
        size = sum(len(f"p{i} q r s t") for i in range(rows))
        found = heldout.held_out_overlap(prompts, data, n=3)
        dealt = re.findall(r"Exchange hashpartitioning\(__gram#\d+L, (\d+)\), REPARTITION_BY_NUM", plan(found))
        assert dealt == [str(-(-size // 100))] * 2
        assert {(r.ngrams, r.found) for r in found.collect()} == {(2, 2)}


@pytest.mark.parametrize("kind", ["long", "string", "two", "ties", "nulls"])
def test_preview_far_from_the_start(spark, monkeypatch, kind):
    monkeypatch.setattr(profile, "PREVIEW_ROWS", 20)
    monkeypatch.setattr(profile, "PREVIEW_BOUNDS", 5)
    rng = random.Random(2)
    rows = [(rng.randrange(400), f"k{rng.randrange(60):02d}", i) for i in range(1500)]
    if kind == "ties":
        rows = [(7 if i % 3 == 0 else a, b, i) for i, (a, b, _) in enumerate(rows)]
    if kind == "nulls":
        rows = [(None if i % 4 == 0 else a, b, i) for i, (a, b, _) in enumerate(rows)]
    order = {"long": ["a", "i"], "string": ["b", "i"], "two": ["b", "a"], "ties": ["a"], "nulls": ["a", "b"]}[kind]
    df = spark.createDataFrame(rows, "a long, b string, i long").repartition(4)
    at = [["a", "b", "i"].index(c) for c in order]
    ordered = sorted(([r[j] for j in at] for r in rows), key=lambda k: [(v is not None, v) for v in k])
    for offset, n in ((21, 3), (400, 50), (700, 300), (1490, 30), (1499, 1), (1500, 4), (9000, 1)):
        got = [[r[c] for c in order] for r in profile.preview(df, n, order, offset).collect()]
        assert got == ordered[offset : offset + n]


def test_preview_far_gathers_no_earlier_rows(spark):
    df = spark.range(200_000).withColumn("text", F.repeat(F.lit("x"), 20))
    found = profile.preview(df, 5, ["id"], offset=150_000)
    assert [r.id for r in found.collect()] == [*range(150_000, 150_005)]
    text = plan(found)
    offset = re.search(r"offset=(\d+)", text)
    assert offset is None or int(offset[1]) <= profile.PREVIEW_ROWS
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def cases_for(spark, n=30_000):
    return spark.range(n).select(
        F.concat(F.lit("i"), F.col("id") % 7000).alias("instruction"),
        F.repeat(F.lit("r"), (F.col("id") % 997).cast("int")).alias("response"),
        F.concat(F.lit("c"), F.col("id") % 2).alias("category"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("n"), F.col("id") % 3)).alias("intent"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("string")).alias("flags"),
    )


def test_totals_of_a_distribution(spark):
    rows = {(r.level, r.category, r.intent): r for r in profile.distribution(cases_for(spark), totals=True).collect()}
    assert len(rows) == 1 + 2 + 6
    whole = rows[0, None, None]
    assert (whole.cases, whole.instructions, whole.templates, whole.flags, whole.share) == (30_000, 7000, 997, 11, 1.0)
    # a missing intent is a group, not a total
    assert rows[2, "c0", None].cases == 5000 and rows[1, "c0", None].cases == 15_000


@pytest.mark.parametrize("totals", [False, True])
def test_sketched_counts_add_up_over_loads(spark, totals):
    cases = cases_for(spark)
    exact = {(r.category, r.intent, r.cases): r for r in profile.distribution(cases, totals=totals).collect()}
    loads = [profile.distribution_sketches(cases.where(F.xxhash64("response") % 3 == i)) for i in (-2, -1, 0, 1, 2)]
    merged = functools.reduce(lambda a, b: a.unionByName(b), loads)
    for found in (profile.estimated_distribution(merged, totals=totals), profile.distribution(cases, approx=True, totals=totals)):
        rows = found.collect()
        assert {(r.category, r.intent, r.cases) for r in rows} == set(exact)
        for r in rows:
            e = exact[r.category, r.intent, r.cases]
            assert r.share == e.share
            for name in ("instructions", "templates", "flags"):
                assert abs(r[name] - e[name]) <= max(1, 0.03 * e[name])


def test_sketched_lengths_add_up_over_loads(spark):
    rng = random.Random(6)
    lengths = [int(rng.lognormvariate(5, 1)) for _ in range(20_000)]
    cases = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, n int").select(
        "id", F.repeat(F.lit("x"), F.col("n")).alias("instruction"), F.lit(None).cast("string").alias("response")
    )
    loads = [profile.length_sketches(cases.where(F.col("id") % 4 == i)) for i in range(4)]
    merged = functools.reduce(lambda a, b: a.unionByName(b), loads)
    ordered = sorted(lengths)
    for found in (profile.estimated_lengths(merged), profile.length_profile(cases, approx=True)):
        rows = {r.column: r for r in found.collect()}
        assert tuple(rows["response"])[1:] == (0, 0, 0.0, 0.0, 0.0)
        row = rows["instruction"]
        assert (row.length_min, row.length_max) == (ordered[0], ordered[-1])
        for share, value in ((0.5, row.p50), (0.95, row.p95), (0.99, row.p99)):
            low = sum(n < value for n in lengths) / len(lengths)
            high = sum(n <= value for n in lengths) / len(lengths)
            assert low - 0.01 <= share <= high + 0.01

import random
import statistics

import pytest
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.operators import evaluate as E

RESULTS = "run_id string, prompt_id long, prompt string, base_output string, fine_tuned_output string, ollama_output string"


def scores(texts):
    """The scores by their definition, in plain Python."""
    n = len(texts)
    texts = [t or "" for t in texts]
    lengths = [len(t) for t in texts]
    hits = [sum(k in t.lower() for k in C.SUPPORT_KEYWORDS) for t in texts]
    inner = [len(t.strip()) for t in texts]
    return {
        "num_prompts": n,
        "length_min": min(lengths),
        "length_max": max(lengths),
        "length_avg": round(sum(lengths) / n, 1),
        "length_std": round(statistics.stdev(lengths), 1) if n > 1 else 0.0,
        "relevance_score": round(sum(h > 0 for h in hits) / n, 2),
        "keyword_count_avg": round(sum(hits) / n, 1),
        "empty_responses": sum(i == 0 for i in inner),
        "short_responses": sum(0 < i < 20 for i in inner),
    }


def random_texts(n, seed):
    rng = random.Random(seed)
    words = [*C.SUPPORT_KEYWORDS, "weather", "\U0001f600", "x" * 30, "　", "\x1c", "Orders"]
    return [rng.choice([None, "", " \n", " ".join(rng.choices(words, k=rng.randrange(1, 8)))]) if rng.random() < 0.3
            else " ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(n)]


def test_metrics(spark):
    runs = {("a", "base"): random_texts(40, 1), ("a", "fine_tuned"): random_texts(40, 2),
            ("b", "single"): random_texts(1, 3), ("c", "single"): [None, None], (None, "base"): random_texts(7, 4)}
    rows = [(r, i, m, t) for (r, m), texts in runs.items() for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "run_id string, prompt_id long, model string, output string")
    got = {(r.run_id, r.model): r.asDict() for r in E.evaluation_metrics(df).collect()}
    assert set(got) == set(runs)
    for key, texts in runs.items():
        assert {k: v for k, v in got[key].items() if k not in ("run_id", "model")} == scores(texts)


def test_metrics_of_a_union_are_the_union_of_the_metrics(spark):
    schema = "run_id string, prompt_id long, model string, output string"
    parts = [spark.createDataFrame([(r, i, "single", t) for i, t in enumerate(random_texts(9, s))], schema)
             for r, s in (("a", 1), ("b", 2))]
    whole = E.evaluation_metrics(parts[0].union(parts[1])).collect()
    apart = [r for p in parts for r in E.evaluation_metrics(p).collect()]
    assert sorted(whole) == sorted(apart)


# Lengths and keyword numbers of two recorded evaluations of 15 prompts would need their texts;
# these texts have the recorded extremes and the sums behind the recorded averages.
def test_one_model_record(spark):
    lengths = [347, 6379] + [1193] * 12 + [1205]
    assert round(sum(lengths) / 15, 1) == 1483.1
    texts = ["order help " + "x" * (n - 11) for n in lengths]
    texts[0] = "x" * 347
    rows = [("r", i, "p", None, None, t) for i, t in enumerate(texts)]
    record = E.metrics_record(E.evaluate_results(spark.createDataFrame(rows, RESULTS))).first()
    assert record.avg_length_ollama == 1483.1
    assert record.relevance_score_ollama == 0.93
    assert record.length_stats_ollama.asDict() == {"min": 347, "max": 6379, "avg": 1483.1,
                                                   "std": round(statistics.stdev(lengths), 1)}
    assert record.avg_length_base is None and record.length_stats_base is None
    assert record.keyword_count_avg == round(28 / 15, 1) and record.keyword_count_avg_base is None


@pytest.fixture
def results(spark):
    rows = [("two", 0, "p0", "an order", "refund " * 5, None), ("two", 1, "p1", None, None, None),
            ("one", 0, "p0", None, None, "hello"), ("blank", 0, "p0", None, None, None)]
    return spark.createDataFrame(rows, RESULTS)


def test_mode(results):
    assert {tuple(r) for r in E.result_mode(results).collect()} == {("two", "two"), ("one", "single"), ("blank", "single")}


def test_mixed_runs(spark, results):
    runs = spark.createDataFrame([("two",), ("one",), ("none_at_all",)], "run_id string")
    rows = {r.run_id: r for r in E.metrics_record(E.evaluate_results(results), runs).collect()}
    two, one, nothing = rows["two"], rows["one"], rows["none_at_all"]
    assert (two.num_prompts, two.avg_length_base, two.avg_length_fine_tuned) == (2, 4.0, 17.5)
    assert (two.relevance_score_base, two.keyword_count_avg, two.keyword_count_avg_base) == (0.5, 0.5, 0.5)
    assert (two.empty_responses, two.short_responses, two.avg_length_ollama) == (1, 0, None)
    assert (one.num_prompts, one.avg_length_ollama, one.short_responses, one.avg_length_base) == (1, 5.0, 1, None)
    assert nothing.asDict() == {c: (0 if c == "num_prompts" else "none_at_all" if c == "run_id" else None)
                                for c in nothing.asDict()}


def test_run_without_output_stays(results):
    rows = {r.run_id: r for r in E.metrics_record(E.evaluate_results(results)).collect()}
    blank = rows["blank"]
    assert (blank.num_prompts, blank.avg_length_ollama, blank.empty_responses) == (1, 0.0, 1)
    asked = {r.run_id: r for r in E.metrics_record(E.evaluate_results(results, mode="two")).collect()}
    assert asked["blank"].avg_length_base == 0.0 and asked["blank"].avg_length_ollama is None


def test_field_that_is_null_counts_as_there(spark):
    rows = [("r", 0, "p", "base text", None, None, True), ("s", 0, "p", None, None, "x", False)]
    df = spark.createDataFrame(rows, RESULTS + ", has_two boolean")
    assert {tuple(r) for r in E.result_mode(df).collect()} == {("r", "two"), ("s", "single")}
    record = {r.run_id: r for r in E.metrics_record(E.evaluate_results(df)).collect()}["r"]
    assert (record.avg_length_base, record.avg_length_fine_tuned, record.empty_responses) == (9.0, 0.0, 1)


def test_paired_scores(spark):
    rows = [("r", 1, "base", "order"), ("r", 1, "base", "the longer answer, an order"), ("r", 1, "fine_tuned", None),
            ("r", 2, "fine_tuned", "x" * 70_000)]
    df = spark.createDataFrame(rows, "run_id string, prompt_id long, model string, output string")
    got = {(r.prompt_id, r.model): tuple(r)[3:] for r in E.paired_scores(df).collect()}
    assert got == {(1, "base"): (27, 1, "ok"), (1, "fine_tuned"): (0, 0, "empty"),
                   (2, "base"): (0, 0, "empty"), (2, "fine_tuned"): (70_000, 0, "ok")}
    wide = E.side_by_side(df)
    assert wide.where("prompt_id = 1").first().base_output == "the longer answer, an order"
    assert {tuple(r) for r in E.ab_delta(wide).collect()} == {
        tuple(r) for r in E.ab_delta_of_scores(E.paired_scores(df)).collect()}


def test_replies_without_case_or_type_are_kept(spark):
    replies = spark.createDataFrame([(7, "m", "order")], "prompt_id long, model string, output string")
    cases = spark.createDataFrame([], "case_id long, intent string")
    catalog = spark.createDataFrame([], "prompt_id long, test_type string")
    assert [(r.intent, r.num_prompts) for r in E.weak_intents(replies, cases, 3).collect()] == [(None, 1)]
    assert [(r.test_type, r.num_prompts) for r in E.metrics_by_test_type(replies, catalog).collect()] == [(None, 1)]


def test_side_by_side_and_back(spark):
    rows = [("r", 1, "base", "b1"), ("r", 1, "fine_tuned", "f1"), ("r", 2, "base", "b2"), ("s", 2, "fine_tuned", "f2")]
    wide = E.side_by_side(spark.createDataFrame(rows, "run_id string, prompt_id long, model string, output string"))
    assert {tuple(r)[:4] for r in wide.collect()} == {("r", 1, "b1", "f1"), ("r", 2, "b2", None), ("s", 2, None, "f2")}
    assert E.wide_to_long(wide).count() == 6


def test_deltas(results):
    rows = {r.prompt_id: r for r in E.ab_delta(results.where("run_id = 'two'")).collect()}
    assert tuple(rows[0])[2:] == (27, 0, 0) and tuple(rows[1])[2:] == (0, 0, 0)
    summary = E.ab_summary(E.ab_delta(results.where("run_id = 'two'"))).first()
    assert (summary.num_prompts, summary.length_delta_avg, summary.gained, summary.lost) == (2, 13.5, 0, 0)


def test_comparison_table(spark):
    rows = [("r", i, "p" * 250, "b" * 400, None, None) for i in range(20)] + [("s", 0, "q", "b", "f", None)]
    table = E.comparison_table(spark.createDataFrame(rows, RESULTS)).orderBy("run_id", "shown").collect()
    assert [(r.run_id, r.prompt_id) for r in table] == [("r", i) for i in range(15)] + [("s", 0)]
    assert (len(table[0].prompt), len(table[0].base_output), table[0].fine_tuned_output) == (200, 300, "")
    assert (table[0].total, table[-1].total) == (20, 1)


def test_stored_records_win(spark, results):
    computed = E.metrics_record(E.evaluate_results(results))
    stored = computed.where("run_id = 'two'").withColumn("num_prompts", F.lit(99).cast("long"))
    empty = computed.where("run_id = 'one'").select(
        "run_id", *(F.lit(None).cast(computed.schema[c].dataType).alias(c) for c in computed.columns[1:])
    )
    chosen = {r.run_id: (r.num_prompts, r.source) for r in E.metrics_or_recompute(stored.union(empty), computed).collect()}
    assert chosen == {"two": (99, "stored"), "one": (1, "computed"), "blank": (1, "computed")}


def test_cards(spark, results):
    records = E.metrics_record(E.evaluate_results(results))
    old = records.where("run_id = 'two'").withColumn("num_prompts", F.lit(None).cast("long")).withColumn(
        "relevance_score_base", F.lit(0.0)).withColumn("relevance_score_ollama", F.lit(0.7)).withColumn(
        "empty_responses", F.lit(None).cast("long"))
    cards = {r.card: r.value for r in E.report_cards(old, results).collect()}
    assert cards["prompts"] == 2 and cards["relevance_base"] == 0.7 and cards["empty_replies"] == 0
    assert cards["length_min"] == 0 and cards["length_max"] == 35
    single = {r.card: r.value for r in E.report_cards(records.where("run_id = 'one'")).collect()}
    assert single["avg_length_base"] == 5.0 and "avg_length_fine_tuned" not in single
    # null or 0 is 0, while 0 or null is null
    assert single["relevance_base"] == 0.0
    zero = records.where("run_id = 'two'").withColumn("relevance_score_base", F.lit(0.0))
    assert "relevance_base" not in {r.card for r in E.report_cards(zero).collect()}


def test_invalid_comparison(spark):
    modes = spark.createDataFrame([("a", "two"), ("b", "two"), ("c", "single"), ("d", "two")], "run_id string, mode string")
    configs = spark.createDataFrame([("a", False), ("b", True), ("c", False)], "run_id string, adapter_loaded boolean")
    flagged = {r.run_id: r.invalid for r in E.invalid_comparison(modes, configs).collect()}
    assert flagged == {"a": True, "b": False, "c": False, "d": False}


def test_weak_intents(spark):
    cases = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "case_id long, intent string")
    replies = spark.createDataFrame([(1, "m", "order"), (2, "m", "x"), (3, "m", "y"), (4, "m", "z" * 30)],
                                    "prompt_id long, model string, output string")
    assert [r.intent for r in E.weak_intents(replies, cases, 2).collect()] == ["b", "c"]


def test_test_types(spark):
    catalog = spark.createDataFrame([(0, "typo"), (1, "edge")], "prompt_id long, test_type string")
    replies = spark.createDataFrame([(0, "base", "order"), (1, "base", "x")], "prompt_id long, model string, output string")
    got = {(r.test_type, r.model): r.relevance_score for r in E.metrics_by_test_type(replies, catalog).collect()}
    assert got == {("typo", "base"): 1.0, ("edge", "base"): 0.0}

import json

import pytest

from dialogue_engine import constants as C
from dialogue_engine.plans.evaluate import evaluate
from dialogue_engine.plans.prepare import prepare_examples
from dialogue_engine.plans.report import report, report_tables
from dialogue_engine.plans.respond import respond
from dialogue_engine.sources.cases import prompt_catalog


@pytest.fixture
def cases(spark):
    rows = [(i, f"q {i} {{{{Order Number}}}}", f"a {i}", "ORDER", "abc"[i % 3], None) for i in range(300)]
    return spark.createDataFrame(
        rows, "case_id long, instruction string, response string, category string, intent string, flags string"
    )


@pytest.mark.parametrize("by, sizes", [(None, (285, 15)), ("intent", (285, 15))])
def test_prepare(cases, by, sizes):
    train, evaluation = prepare_examples(cases, stratify_by=by, placeholders="strip")
    assert (train.count(), evaluation.count()) == sizes
    row = train.first()
    assert row.messages[1].content == f"q {row.case_id} "


def test_prepare_subset(cases):
    train, evaluation = prepare_examples(cases, subset_rows=10)
    assert (train.count(), evaluation.count()) == (10, 15)


def test_evaluate_and_read_back(spark, tmp_path):
    def load(reply):
        return lambda: lambda conversations: [f"{reply} {c[-1]['content']}" for c in conversations]

    path = str(tmp_path / "eval")
    config = {"base_model": "m", "adapter_loaded": False}
    models = {"base": load("b"), "fine_tuned": load("")}
    evaluate(prompt_catalog(spark), models, "run1", path, partitions=2, config=config)
    evaluate(prompt_catalog(spark), {"single": load("s")}, "run2", path)
    metrics = {r.run_id: r for r in spark.read.parquet(f"{path}/metrics").collect()}
    hits = sum(any(k in p.lower() for k in C.SUPPORT_KEYWORDS) for p, _ in C.TEST_PROMPTS)
    assert metrics["run1"].num_prompts == 15
    assert metrics["run1"].relevance_score_base == round(hits / 15, 2)
    assert metrics["run1"].avg_length_base == round(metrics["run1"].avg_length_fine_tuned + 1, 1)
    assert metrics["run2"].avg_length_ollama == metrics["run1"].avg_length_base
    assert metrics["run2"].avg_length_base is None
    tables = [spark.read.parquet(f"{path}/{name}") for name in ("results", "metrics", "config")]
    setup, cards, comparison = report_tables(*tables)
    assert {r.run_id: r.invalid for r in setup.collect()} == {"run1": True, "run2": False}
    shown = {(r.run_id, r.card): r.value for r in cards.collect()}
    assert shown["run2", "avg_length_base"] == metrics["run2"].avg_length_ollama
    assert comparison.count() == 30
    results = spark.read.parquet(f"{path}/results").where("run_id = 'run1'").collect()
    assert len(results) == 15 and all(r.base_output == f"b {r.prompt}" for r in results)


def test_second_evaluation_replaces_the_first(spark, tmp_path):
    def works():
        return lambda conversations: ["an order"] * len(conversations)

    def fails():
        def run(conversations):
            raise RuntimeError("out of memory")

        return run

    path = str(tmp_path / "eval")
    evaluate(prompt_catalog(spark), {"base": works, "fine_tuned": works}, "r", path)
    evaluate(prompt_catalog(spark), {"base": works, "fine_tuned": fails}, "r", path)
    row = spark.read.parquet(f"{path}/metrics").first()
    assert (row.relevance_score_base, row.relevance_score_fine_tuned) == (1.0, 0.0)
    assert (row.num_prompts, row.empty_responses) == (15, 15)
    evaluate(prompt_catalog(spark), {"base": fails, "fine_tuned": fails}, "r", path)
    row = spark.read.parquet(f"{path}/metrics").first()
    assert (row.num_prompts, row.relevance_score_base, row.avg_length_base) == (15, 0.0, 0.0)
    errors = spark.read.parquet(f"{path}/responses").where("error is not null").count()
    assert errors == 30
    evaluate(prompt_catalog(spark).where("false"), {"base": works, "fine_tuned": works}, "r", path)
    assert spark.read.parquet(f"{path}/metrics").first().num_prompts == 0


def test_training_belongs_to_its_evaluation(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.json").write_text("[]")
    stats = {"trainable_params": 1, "total_params": 4, "duration_seconds": 2.0, "log_history": [{"loss": 2.0}]}
    (tmp_path / "stats.json").write_text(json.dumps(stats))
    run = report(spark, str(tmp_path / "e")).setup.first().run_id
    training = report(spark, str(tmp_path / "e"), str(tmp_path / "stats.json")).training.first().run_id
    of = spark.createDataFrame([(run, training)], "run_id string, training_run string")
    tables = report(spark, str(tmp_path / "e"), str(tmp_path / "stats.json"), of)
    assert [(r.run_id, r.final_loss) for r in tables.training.collect()] == [(run, 2.0)]
    assert {r.card: r.value for r in tables.cards.collect()}["prompts"] == 0


def test_report(spark, tmp_path):
    (tmp_path / "e").mkdir()
    results = [{"prompt": f"p{i}", "base_output": "order", "fine_tuned_output": "x" * i} for i in range(20)]
    (tmp_path / "e" / "new.json").write_text(json.dumps(
        {"results": results, "evaluation_config": {"adapter_loaded": False}}))
    (tmp_path / "e" / "stored.json").write_text(json.dumps(
        {"results": results, "metrics": {"num_prompts": 3, "relevance_score_base": 0.8}}))
    stats = {"trainable_params": 24_313_856, "total_params": 3_237_063_680, "duration_seconds": 4028.0,
             "log_history": [{"loss": 2.0}, {"loss": 1.4232}]}
    (tmp_path / "stats.json").write_text(json.dumps(stats))
    tables = report(spark, str(tmp_path / "e"), str(tmp_path / "stats.json"))

    cards = {(r.run_id.rsplit("/", 1)[1], r.card): r.value for r in tables.cards.collect()}
    assert cards["new.json", "prompts"] == 20 and cards["new.json", "avg_length_fine_tuned"] == 9.5
    assert cards["stored.json", "prompts"] == 3 and ("stored.json", "length_min") not in cards
    setup = {r.run_id.rsplit("/", 1)[1]: r.invalid for r in tables.setup.collect()}
    assert setup == {"new.json": True, "stored.json": False}
    assert tables.comparison.count() == 30 and tables.unreadable.count() == 0
    training = tables.training.first()
    assert (training.trainable_pct, training.cost_proxy) == (0.75, 97.94)
    assert (training.final_loss, training.min_loss) == (1.4232, 1.4232)
    assert [(r.step, r.loss) for r in tables.loss.orderBy("seq").collect()] == [(0, 2.0), (1, 1.4232)]
    assert [(r.x, r.y) for r in tables.curve.orderBy("seq").collect()] == [(0.0, 1.0), (1.0, 0.0)]


def test_respond(spark):
    def load():
        def run(conversations):
            if any("fail" in c[-1]["content"] for c in conversations):
                raise ValueError("no")
            return [f"{len(c)}:{c[-1]['content']}" for c in conversations]

        return run

    turns = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "c"), (2, 1, "assistant", "d")],
        "conv_id long, turn long, role string, text string",
    )
    requests = spark.createDataFrame(
        [(1, "next", 64), (2, " \t", 64), (3, "first", 0), (4, "fail", 0)], "conv_id long, message string, max_tokens long"
    )
    after, failed = respond(turns, requests, load)
    assert [tuple(r) for r in failed.collect()] == [(4, "fail", "ValueError: no")]
    assert {tuple(r) for r in after.subtract(turns).collect()} == {
        (1, 2, "user", "next"), (1, 3, "assistant", "4:next"), (3, 0, "user", "first"), (3, 1, "assistant", "2:first"),
    }
    assert after.count() == 8

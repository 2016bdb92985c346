"""Runs are replaced as a whole, whatever fails in between."""

import pytest
from pyspark.sql import functions as F

from dialogue_engine.plans.evaluate import evaluate
from dialogue_engine.sources import evaluations as ev
from dialogue_engine.sources import staging
from dialogue_engine.sources.cases import prompt_catalog

ROWS = "run_id string, prompt_id long, output string"


def rows_of(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(ROWS).parquet(path).select("run_id", "prompt_id", "output").collect())


def failing(spark):
    """Rows of which the last cannot be computed."""
    bad = F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.lit("new"))
    return spark.range(10).select(F.lit("a").alias("run_id"), F.col("id").alias("prompt_id"), bad.alias("output"))


def test_a_failed_write_leaves_the_old_run(spark, tmp_path):
    path = str(tmp_path / "out")
    old = [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")]
    ev.write_results(spark.createDataFrame(old, ROWS), path)
    for run_id in (None, "a"):
        with pytest.raises(Exception, match="lost"):
            ev.write_results(failing(spark), path, run_id=run_id)
        assert rows_of(spark, path) == old
    staging.drop_staged(spark, path)
    assert rows_of(spark, path) == old


def test_rows_may_come_from_the_run_they_replace(spark, tmp_path):
    path = str(tmp_path / "out")
    ev.write_results(spark.createDataFrame([("a", 0, "x"), ("b", 0, "z")], ROWS), path)
    longer = spark.read.schema(ROWS).parquet(path).withColumn("output", F.concat("output", "output"))
    ev.write_results(longer.where("run_id = 'a'"), path)
    assert rows_of(spark, path) == [("a", 0, "xx"), ("b", 0, "z")]


def test_a_run_without_rows_loses_its_old_ones(spark, tmp_path):
    path = str(tmp_path / "out")
    odd = "a/b=c d%"
    ev.write_results(spark.createDataFrame([(odd, 0, "x"), ("b", 0, "z")], ROWS), path)
    ev.write_results(spark.createDataFrame([], ROWS), path, run_id=odd)
    assert rows_of(spark, path) == [("b", 0, "z")]


@pytest.mark.parametrize("renames", [0, 1, 2, 3])
def test_a_crash_between_renames_is_made_good(spark, tmp_path, monkeypatch, renames):
    """Two tables with two runs each: the swap stops after some renames, and the next writer ends it."""
    root = str(tmp_path / "out")

    def stage(value):
        unit = staging.Staging(spark, root)
        for table in ("first", "second"):
            unit.write(spark.createDataFrame([("a", 0, value), ("b", 0, value)], ROWS), table)
        return unit

    stage("old").commit()
    unit = stage("new")
    move, made = staging._Store.move, []

    def crash(self, source, target):
        if staging.PLAN not in target:
            if len(made) == renames:
                raise KeyboardInterrupt
            made.append(target)
        move(self, source, target)

    monkeypatch.setattr(staging._Store, "move", crash)
    with pytest.raises(KeyboardInterrupt):
        unit.commit()
    monkeypatch.undo()
    staging.finish_swaps(spark, root)
    for table in ("first", "second"):
        assert rows_of(spark, f"{root}/{table}") == [("a", 0, "new"), ("b", 0, "new")]
    assert not (tmp_path / "out" / staging.STAGED).exists() or not list((tmp_path / "out" / staging.STAGED).iterdir())


def test_staged_rows_without_a_list_are_not_put_in_place(spark, tmp_path):
    root = str(tmp_path / "out")
    ev.write_results(spark.createDataFrame([("a", 0, "x")], ROWS), root)
    unit = staging.Staging(spark, root)
    unit.write(spark.createDataFrame([("a", 0, "half")], ROWS), "")
    ev.write_results(spark.createDataFrame([("b", 0, "y")], ROWS), root)
    assert rows_of(spark, root) == [("a", 0, "x"), ("b", 0, "y")]
    unit.commit()
    assert rows_of(spark, root) == [("a", 0, "half"), ("b", 0, "y")]


def counting(spark):
    """A loader of a model that says how many conversations it has seen, and fails where told."""
    asked = spark.sparkContext.accumulator(0)

    def load(fail_at=None):
        def loaded():
            def run(conversations):
                if fail_at and any(c[-1]["content"] == fail_at for c in conversations):
                    raise SystemExit("the executor is lost")
                asked.add(len(conversations))
                return [f"order {c[-1]['content']}" for c in conversations]

            return run

        return loaded

    return asked, load


def test_evaluation_goes_on_after_a_crash(spark, tmp_path):
    """The old run stays whole until the new one ends, and the second start asks what was open."""
    path = str(tmp_path / "eval")
    prompts = prompt_catalog(spark)
    evaluate(prompts, {"base": lambda: lambda c: ["old"] * len(c), "fine_tuned": lambda: lambda c: ["old"] * len(c)}, "r", path)
    tables = ("responses", "results", "metrics", "config")
    before = {t: sorted(map(str, spark.read.parquet(f"{path}/{t}").collect())) for t in tables}

    asked, load = counting(spark)
    last = prompts.collect()[-1].prompt
    with pytest.raises(Exception):
        evaluate(prompts, {"base": load(), "fine_tuned": load(last)}, "r", path, steps=15)
    first = asked.value
    assert 15 <= first < 30
    assert before == {t: sorted(map(str, spark.read.parquet(f"{path}/{t}").collect())) for t in tables}

    evaluate(prompts, {"base": load(), "fine_tuned": load()}, "r", path, steps=15)
    # what a lost step had asked is asked again, nothing else is
    assert 30 <= asked.value <= 30 + 15
    row = spark.read.parquet(f"{path}/metrics").first()
    assert (row.num_prompts, row.relevance_score_base, row.relevance_score_fine_tuned) == (15, 1.0, 1.0)
    now = asked.value
    evaluate(prompts, {"base": load(), "fine_tuned": load()}, "r", path)
    assert asked.value == now + 30, "a run that has ended is asked anew"

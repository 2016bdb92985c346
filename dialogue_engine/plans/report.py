"""The tables of an evaluation report."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine.operators.evaluate import (
    comparison_table,
    evaluate_results,
    invalid_comparison,
    metrics_or_recompute,
    metrics_record,
    report_cards,
    result_mode,
)
from dialogue_engine.operators.runs import loss_scaled, loss_series, run_cards
from dialogue_engine.schemas import OUTPUT_COLUMNS
from dialogue_engine.scratch import written
from dialogue_engine.sources.evaluations import (
    evaluation_runs,
    load_eval_config,
    load_eval_metrics,
    load_eval_results,
    read_evaluations,
    unreadable_files,
)
from dialogue_engine.sources.run_stats import load_run_stats, run_log


@dataclass
class Report:
    setup: DataFrame
    cards: DataFrame
    comparison: DataFrame
    unreadable: DataFrame
    training: DataFrame | None = None
    loss: DataFrame | None = None
    curve: DataFrame | None = None


def report_tables(
    results: DataFrame, stored: DataFrame, configs: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Setup, cards and comparison of the runs in ``configs``. Only runs without a stored record are
    scored."""
    known = stored.select("run_id").distinct()
    unscored = results.join(known, "run_id", "left_anti")
    computed = metrics_record(
        evaluate_results(unscored), configs.select("run_id").join(known, "run_id", "left_anti")
    )
    records = metrics_or_recompute(stored, computed)
    flagged = invalid_comparison(result_mode(results), configs)
    setup = configs.join(flagged.select("run_id", "mode", "invalid"), "run_id", "left")
    return (
        setup.withColumn("invalid", F.coalesce("invalid", F.lit(False))),
        report_cards(records, results),
        comparison_table(results, models=list(OUTPUT_COLUMNS)),
    )


def report(
    spark: SparkSession,
    evaluations: str,
    run_stats: str | None = None,
    trained_by: DataFrame | None = None,
) -> Report:
    """Tables for all evaluation files under a path. A missing path fails here.

    ``trained_by`` (run_id, training_run) says which file of statistics belongs to which
    evaluation; the training tables then have one row set per evaluation that has one.
    """
    # the files are parsed once; the tables read the copy
    files = written(read_evaluations(spark, evaluations))
    runs = evaluation_runs(spark, evaluations).join(
        files.where("broken").select("run_id").distinct(), "run_id", "left_anti"
    )
    setup, cards, comparison = report_tables(
        load_eval_results(files),
        load_eval_metrics(files),
        runs.join(load_eval_config(files), "run_id", "left"),
    )
    tables = Report(setup, cards, comparison, unreadable=unreadable_files(files))
    if run_stats is not None:
        runs = load_run_stats(spark, run_stats)
        log = run_log(runs)
        tables.training = run_cards(runs, log)
        if trained_by is not None:
            of = trained_by.select(F.col("run_id").alias("evaluation"), "training_run")
            tables.training = of.join(
                tables.training.withColumnRenamed("run_id", "training_run"), "training_run", "left"
            ).withColumnRenamed("evaluation", "run_id")
        tables.loss = loss_series(log)
        tables.curve = loss_scaled(log)
    return tables

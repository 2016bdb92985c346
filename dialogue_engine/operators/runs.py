"""Training runs: loss curves, parameter counts, cost.

A log is (run_id, seq, step, loss): ``seq`` gives the order inside a run, entries without a
loss belong to something else, ``step`` may be missing. A run can be long, so positions come
from ``positions`` and not from a window over the run.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogue_engine.functions.rounding import py_round
from dialogue_engine.operators.positions import positions, span_of


def has_loss(log: DataFrame) -> DataFrame:
    return log.where(F.col("loss").isNotNull())


def _positioned(log: DataFrame, totals=None) -> DataFrame:
    rounded = has_loss(log).withColumn("loss", py_round(F.col("loss"), 4))
    return positions(rounded, ["run_id"], ["seq"], span_of("seq"), totals=totals)


def loss_series(log: DataFrame) -> DataFrame:
    """Loss per step; a missing step is the position among the entries with a loss."""
    return _positioned(log).select(
        "run_id", "seq", F.coalesce("step", "position").alias("step"), "loss"
    )


def loss_scaled(log: DataFrame) -> DataFrame:
    """The curve in the unit square: position and loss scaled to 0..1 per run.

    A single point and a flat curve divide by 1. So does a largest loss of 0, which counts as 1.
    """
    totals = {
        "points": (F.lit(1), "sum"),
        "lowest": (F.col("loss"), "min"),
        "highest": (F.col("loss"), "max"),
    }
    highest = F.coalesce(F.nullif(F.col("highest"), F.lit(0.0)), F.lit(1.0))
    height = F.coalesce(F.nullif(highest - F.col("lowest"), F.lit(0.0)), F.lit(1.0))
    return _positioned(log, totals).select(
        "run_id",
        "seq",
        (F.col("position") / F.greatest(F.col("points") - 1, F.lit(1))).alias("x"),
        ((F.col("loss") - F.col("lowest")) / height).alias("y"),
    )


def loss_summary(log: DataFrame) -> DataFrame:
    """Last and smallest loss per run."""
    return (
        has_loss(log)
        .groupBy("run_id")
        .agg(
            py_round(F.max_by("loss", "seq"), 4).alias("final_loss"),
            py_round(F.min("loss"), 4).alias("min_loss"),
        )
    )


def percent(part: Column, total: Column) -> Column:
    """Two digits; 0 when there is no total."""
    share = (part * 100).cast("double") / F.nullif(total, F.lit(0).cast("long")).cast("double")
    return F.coalesce(py_round(share, 2), F.lit(0.0))


def trainable_share(
    parameters: DataFrame, by: Sequence[str] = ("model_name",)
) -> DataFrame:
    """Sum of the parameter counts, all and trainable, and the share in percent.

    ``parameters`` has one row per tensor: ``size`` and ``trainable``.
    """
    sums = parameters.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("trainable"), F.col("size").cast("long"))), F.lit(0))
        .cast("long")
        .alias("trainable_params"),
        F.sum(F.col("size").cast("long")).alias("total_params"),
    )
    return sums.withColumn(
        "trainable_pct", percent(F.col("trainable_params"), F.col("total_params"))
    )


def cost_proxy(runs: DataFrame) -> DataFrame:
    """Add ``cost_proxy``: seconds times trainable parameters / 1e9; null when either is unknown
    or nothing is trainable."""
    cost = F.col("duration_seconds") * F.col("trainable_params") / F.lit(1e9)
    return runs.withColumn(
        "cost_proxy", F.when(F.col("trainable_params") != 0, py_round(cost, 2))
    )


def run_cards(runs: DataFrame, log: DataFrame) -> DataFrame:
    """One row per run: parameter counts, cost and losses. Runs without a log stay."""
    stated = F.coalesce(
        F.nullif(F.col("trainable_pct"), F.lit(0.0)),
        percent(F.coalesce("trainable_params", F.lit(0)), F.coalesce("total_params", F.lit(0))),
    )
    return (
        cost_proxy(runs.withColumn("trainable_pct", stated))
        .join(loss_summary(log), "run_id", "left")
        .select(
            "run_id",
            "model_name",
            "trainable_params",
            "total_params",
            "trainable_pct",
            "duration_seconds",
            "cost_proxy",
            "final_loss",
            "min_loss",
            F.to_json("config").alias("config"),
        )
    )

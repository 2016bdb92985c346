"""Prompts through models, answers stored, scores stored."""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from hashlib import md5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.operators.evaluate import evaluate_results, metrics_record, side_by_side
from dialogue_engine.operators.generate import (
    STEPS,
    BatchFunction,
    fan_out,
    prompt_messages,
    resume_generate,
)
from dialogue_engine.schemas import EVALUATION_CONFIG, OUTPUT_COLUMNS
from dialogue_engine.scratch import delete_folder
from dialogue_engine.sources.staging import Staging


def evaluate(
    prompts: DataFrame,
    load: Mapping[str, Callable[[], BatchFunction]],
    run_id: str,
    path: str,
    partitions: int | None = None,
    keywords: Sequence[str] = C.SUPPORT_KEYWORDS,
    config: Mapping[str, object] | None = None,
    steps: int = STEPS,
    resume: bool = True,
) -> None:
    """Ask every prompt of every model in ``load`` ("base" and "fine_tuned", or "single").

    Writes ``responses``, ``results``, ``metrics`` and ``config`` under ``path``. All four replace those
    of an earlier run of this name together, at the end; until then the earlier run is there whole.

    Answers are stored under ``path/answers`` as they come. A start after a crash takes them from
    there and asks only what is open; with ``resume=False`` it asks all again, as it must when a
    model has changed under its name. A run that has ended leaves no answers there.
    """
    spark = prompts.sparkSession
    answers = f"{path}/answers/{md5(run_id.encode()).hexdigest()}"
    if not resume:
        delete_folder(spark, answers)
    staging = Staging(spark, path)
    described = spark.createDataFrame(
        [tuple((config or {}).get(f.name) for f in EVALUATION_CONFIG.fields)], EVALUATION_CONFIG
    )
    staging.write(described.withColumn("run_id", F.lit(run_id)), "config", runs=[run_id])

    models = list(load)
    # model by model, so that no task has to hold two of them
    answered = reduce(
        DataFrame.unionByName,
        (
            resume_generate(
                prompt_messages(fan_out(prompts, [m])),
                {m: load[m]},
                f"{answers}/{md5(m.encode()).hexdigest()}",
                partitions,
                steps=steps,
            )
            for m in models
        ),
    ).select(F.lit(run_id).alias("run_id"), "prompt_id", "prompt", "model", "output", "error")
    staging.write(answered, "responses", runs=[run_id])

    def of_this_run(table: str, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(staging.path(table))

    stored = of_this_run("responses", answered.schema)
    wide = side_by_side(stored, ("run_id", "prompt_id", "prompt"), models)
    missing = [c for c in OUTPUT_COLUMNS.values() if c not in wide.columns]
    wide = wide.withColumns({c: F.lit(None).cast("string") for c in missing})
    staging.write(wide, "results", runs=[run_id])

    results = of_this_run("results", wide.schema)
    # the mode is that of the models asked, and the run has a record even without any prompt
    mode = "single" if models == ["single"] else "two"
    this_run = described.select(F.lit(run_id).alias("run_id"))
    record = metrics_record(evaluate_results(results, keywords, mode), this_run)
    staging.write(record, "metrics", runs=[run_id])
    staging.commit()
    delete_folder(spark, answers)

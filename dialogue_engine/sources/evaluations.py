"""Evaluation files and tables."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine import schemas
from dialogue_engine.sources.staging import Staging


def read_evaluations(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation JSON of any number of runs, one file per run, in one scan.

    Both shapes are read: an object with results, metrics and configuration, and a bare list of
    results. A file that cannot be read is a row with ``broken``. ``run_id`` is the path of the
    file. The functions below take the result apart.
    """
    return (
        spark.read.schema(schemas.EVALUATION_FILE)
        .option("multiLine", True)
        .json(path)
        .select(
            F.col("_metadata.file_path").alias("run_id"),
            F.monotonically_increasing_id().alias("row"),
            "*",
            schemas.is_broken("results").alias("broken"),
        )
        .drop("_corrupt_record")
    )


def evaluation_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run of every file, also of one that holds no row at all. Contents are not read."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select(F.col("_metadata.file_path").alias("run_id"))


def _readable(files: DataFrame) -> DataFrame:
    return files.where(~F.col("broken"))


_RESULT_NAMES = [name for name, _ in schemas.RESULT_FIELDS]


def _list_entries(files: DataFrame) -> DataFrame:
    """The rows of files that are a bare list: those with a field of a result."""
    whole = ("results", "metrics", "evaluation_config")
    is_object = reduce(or_, (F.col(name).isNotNull() for name in whole))
    return files.where(~is_object & F.coalesce(*_RESULT_NAMES).isNotNull())


def unreadable_files(files: DataFrame) -> DataFrame:
    """Broken files, and how many results could be read before the fault."""
    return files.where("broken").select("run_id", F.coalesce(F.size("results"), F.lit(0)).alias("entries_read"))


def load_eval_results(files: DataFrame) -> DataFrame:
    """Result rows of every file: (run_id, prompt_id, prompt, the outputs, commentary, has_two).

    ``prompt_id`` is the position in the file. ``has_two`` says whether the entry has the field of
    the fine-tuned output, be it null. Entries without a field of a result are no results. Rows
    of a bare list are numbered from the first of their file, whose smallest row number is one
    row per task and file; no text is moved for it.
    """
    readable = _readable(files)
    objects = readable.select("run_id", F.posexplode("results").alias("prompt_id", "entry")).select(
        "run_id",
        F.col("prompt_id").cast("long").alias("prompt_id"),
        *(F.col("entry")[name].alias(name) for name in _RESULT_NAMES),
        F.map_contains_key("entry", "fine_tuned_output").alias("has_two"),
        F.arrays_overlap(F.map_keys("entry"), F.array(*map(F.lit, _RESULT_NAMES))).alias("is_result"),
    )
    entries = _list_entries(readable)
    first = entries.groupBy("run_id").agg(F.min("row").alias("first_row"))
    rows = entries.join(first, "run_id").select(
        "run_id",
        (F.col("row") - F.col("first_row")).alias("prompt_id"),
        *_RESULT_NAMES,
        F.col("fine_tuned_output").isNotNull().alias("has_two"),
        F.lit(True).alias("is_result"),
    )
    return objects.unionByName(rows).where("is_result").drop("is_result")


def load_eval_metrics(files: DataFrame) -> DataFrame:
    """Stored metrics, one row per run that has them."""
    return _readable(files).where(F.col("metrics").isNotNull()).select("run_id", "metrics.*")


def load_eval_config(files: DataFrame) -> DataFrame:
    """Configuration of each run; nulls for a run without one."""
    config = F.max("evaluation_config").alias("config")
    return _readable(files).groupBy("run_id").agg(config).select("run_id", "config.*")


def write_results(
    df: DataFrame, path: str, fmt: str = "parquet", run_id: str | None = None
) -> None:
    """Write rows under one folder per run, replacing only the runs that are in ``df``, and the run
    ``run_id``, which then loses its old rows even if it has no new ones.

    The old rows stay until all new ones are written; if that fails, nothing has changed.
    """
    staging = Staging(df.sparkSession, path)
    try:
        staging.write(df, "", fmt, [] if run_id is None else [run_id])
    except BaseException:
        staging.discard()
        raise
    staging.commit()

"""Statistics of training runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine import schemas


def load_run_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row per statistics file. Join it from the left: a run may have none."""
    return (
        spark.read.schema(schemas.RUN_STATS_FILE)
        .option("multiLine", True)
        .json(path)
        .select(F.col("_metadata.file_path").alias("run_id"), "*")
        .where(~schemas.is_broken("log_history"))
        .drop("_corrupt_record")
    )


def unreadable_run_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files that ``load_run_stats`` leaves out because they cannot be read."""
    files = spark.read.schema(schemas.RUN_STATS_FILE).option("multiLine", True).json(path)
    broken = files.select(
        F.col("_metadata.file_path").alias("run_id"), schemas.is_broken("log_history").alias("broken")
    )
    return broken.where("broken").select("run_id")


def run_log(runs: DataFrame) -> DataFrame:
    """The log entries of each run in order."""
    return runs.select("run_id", F.posexplode("log_history").alias("seq", "entry")).select(
        "run_id", F.col("seq").cast("long").alias("seq"), "entry.step", "entry.loss"
    )


def write_run_stats(
    runs: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """Write run statistics, log included as a nested list."""
    runs.write.mode(mode).format(fmt).save(path)

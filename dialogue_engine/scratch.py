"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="dialogue-engine-")


def scratch_dir(spark: SparkSession) -> str:
    """The folder the session names. Without one, a temporary folder, where driver and executor are
    one process; anywhere else the setting is required."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


def _tables(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/tables/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession) -> str:
    """Name of a folder that no one else uses, deleted together with the intermediate tables."""
    return f"{_tables(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write an intermediate result once and read it back.

    It survives lost executors, is not computed again by each branch that uses it, and Spark
    now knows its size on disk: below ``spark.sql.autoBroadcastJoinThreshold`` a join with it
    becomes a broadcast join, above it stays a shuffle join. No broadcast is forced.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_written(spark: SparkSession) -> None:
    """Delete what this application has written. Frames made from it can no longer be read."""
    delete_folder(spark, _tables(spark))

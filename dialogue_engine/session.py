"""A local session for tests and the benchmark. On a cluster the session is given."""

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    partitions = cpus if isinstance(cpus, int) else 8
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dialogue_engine")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="dialogue-engine-"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )

"""The table of support cases and the catalogue of test prompts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine import schemas


def load_cases(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read cases from Parquet or CSV.

    A table without ``case_id`` gets one from the file and the position in it, so it does not
    change with the number of tasks or their sizes. Formats other than Parquet and CSV need one.
    """
    if fmt == "csv":
        reader = spark.read.schema(schemas.CASES).option("header", True)
        # quoted texts hold line breaks and doubled quotes
        cases = reader.option("multiLine", True).option("escape", '"').csv(path)
    else:
        cases = spark.read.format(fmt).load(path)
    if "case_id" in cases.columns:
        return cases.select("case_id", *schemas.CASE_COLUMNS)
    if fmt == "parquet":
        at = F.col("_metadata.row_index")
    elif fmt == "csv":
        # A file with quoted line breaks is read by one task, which numbers its rows in order. The
        # smallest number of a file is one row per task and file; no text is moved to find it.
        cases = cases.withColumn("__file", F.col("_metadata.file_path")).withColumn(
            "__row", F.monotonically_increasing_id()
        )
        first = cases.groupBy("__file").agg(F.min("__row").alias("__first"))
        cases = cases.join(first, "__file")
        at = F.col("__row") - F.col("__first")
    else:
        raise ValueError(f"cases in {fmt} need a case_id")
    file = F.col("__file") if fmt == "csv" else F.col("_metadata.file_path")
    return cases.select(F.concat_ws(":", file, at).alias("case_id"), *schemas.CASE_COLUMNS)


def write_cases(cases: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write cases so that ``load_cases`` reads the same texts, in CSV too with their line breaks,
    quotes and outer blanks. CSV has no empty text: it is read as a missing one."""
    writer = cases.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.format(fmt).save(path)


def prompt_catalog(spark: SparkSession) -> DataFrame:
    """The test prompts with the kind of test each makes."""
    rows = [(i, prompt, kind) for i, (prompt, kind) in enumerate(C.TEST_PROMPTS)]
    return spark.createDataFrame(rows, schemas.PROMPTS)

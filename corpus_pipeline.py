"""Training sequences from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on what the stage before it kept, written as
Parquet in between. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession

from dialogue_engine.llm.decontaminate import drop_contaminated
from dialogue_engine.llm.line_chunks import drop_repeated_lines
from dialogue_engine.llm.ngram_join import keep_one_per_group
from dialogue_engine.llm.queries import pack_documents
from dialogue_engine.llm.toxicity import drop_toxic
from dialogue_engine.scratch import written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of lines that an earlier document has."""
    return drop_repeated_lines(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

# The tokenizer and the trained model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

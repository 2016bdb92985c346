"""One query per operator, over the whole of its table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine.llm import (
    decontaminate,
    html_cut,
    line_chunks,
    line_rules,
    ngram_join,
    packing,
    resample,
    secret_scan,
    sparse_suffixes,
    spelling,
    toxicity,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op2_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminations(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


@query
def op3_quality_resampling(spark, sf_dir):
    return resample.importance_sample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


@query
def op4_ngram_jaccard_join(spark, sf_dir):
    found = ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op5_line_dedup(spark, sf_dir):
    return line_chunks.drop_repeated_lines(_table(spark, sf_dir, "documents"), counts=True)


@query
def op6_secret_scan(spark, sf_dir):
    return secret_scan.secrets(_table(spark, sf_dir, "documents"))


def pack_documents(documents: DataFrame) -> DataFrame:
    return packing.pack(
        documents,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op7_packing(spark, sf_dir):
    return pack_documents(_table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark, sf_dir):
    return line_rules.quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


@query
def op9_html_extraction(spark, sf_dir):
    return html_cut.extract(_table(spark, sf_dir, "pages"))


@query
def op10_suffix_dedup(spark, sf_dir):
    found = sparse_suffixes.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.drop("text_hash")


@query
def op11_warc(spark, sf_dir):
    return warc.page_records(_table(spark, sf_dir, "pages"))


@query
def op12_embedding_whitening(spark, sf_dir):
    found = whitening.whitened_embeddings(_table(spark, sf_dir, "embeddings"))
    # exact at any size as decimal(38, 0); beyond a long it is null here
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))

"""The test tables in the roles of the operators' inputs.

The tables hold invented prose without support words, so the queries use keywords that do occur.
Each view has its SQL twin in ``oracles``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYWORDS = ("ung", "que", "elle", "ich", "ción", "ando")
TEST_TYPES = ("standard", "typo", "structure", "edge", "paraphrase")
# Texts with known, unknown, repeated, adjacent and unclosed tokens, stray braces, or none.
TEMPLATES = (
    "Order {{Order Number}} of {{Customer}} is {{Status}}, {{Website URL}} {{Order Number}} {{Open",
    "{{Customer}}{{Customer}}{{Status}}",
    "Nothing to fill in",
    "{{Unclosed {{Status}} and }} closed twice}} { {one} {{Delivery City}} {{}}",
    "{{status}} is not {{Status}}; {{ Status }} neither. {{Order Number}",
    "{{Invoice Number}}: {{Order Number}}\n{{Customer Support Hours}}, {{Customer}}",
    "",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as support cases."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("case_id"),
        F.concat_ws(" ", "lang", "source", "n_chars").alias("instruction"),
        F.col("text").alias("response"),
        F.col("lang").alias("category"),
        F.col("source").alias("intent"),
    )


def flagged_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with flags where the document has a label, null elsewhere."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("case_id"), F.concat_ws("-", "quality", "toxic").alias("flags")
    )
    return cases(spark, sf_dir).join(labels, "case_id", "left")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as replies: of four neighbouring turns, the first pair answers for the
    base model, the second for the fine-tuned one."""
    return (
        table(spark, sf_dir, "conversations")
        .where("role = 'assistant'")
        .select(
            (F.col("conv_id") % 4).alias("run_id"),
            F.concat_ws(":", "conv_id", F.expr("turn div 4")).alias("prompt_id"),
            F.when(F.col("turn") % 4 < 2, "base").otherwise("fine_tuned").alias("model"),
            F.col("text").alias("output"),
        )
    )


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies as result rows with one output each; every prompt is a run."""
    return responses(spark, sf_dir).select(
        F.col("prompt_id").alias("run_id"),
        *(
            F.when(F.col("model") == m, F.col("output")).alias(f"{m}_output")
            for m in ("base", "fine_tuned", "ollama")
        ),
    )


def document_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as replies, one per case."""
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("run_id"),
        F.col("doc_id").alias("prompt_id"),
        F.when(F.col("doc_id") % 2 == 0, "base").otherwise("fine_tuned").alias("model"),
        F.col("text").alias("output"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations' prompts with a kind of test."""
    kind = F.element_at(
        F.array(*(F.lit(t) for t in TEST_TYPES)), (F.col("conv_id") % 5 + 1).cast("int")
    )
    return (
        table(spark, sf_dir, "conversations")
        .where("role = 'user'")
        .select(
            F.concat_ws(":", "conv_id", F.expr("turn div 4")).alias("prompt_id"),
            kind.alias("test_type"),
        )
        .distinct()
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a training log: views carry a loss, every third entry lacks its step."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("step"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("loss"),
    )


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text per order: which one depends on the order, and so do the tokens that follow, one with a
    name of its own, another zero to three times, and for some a last one without an end."""
    which = (F.col("o_orderkey") % len(TEMPLATES)).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        "o_orderkey",
        "o_orderstatus",
        F.concat(
            F.get(F.array(*map(F.lit, TEMPLATES)), which),
            F.lit(" "),
            F.col("o_orderpriority"),
            F.lit(" {{Field "),
            (F.col("o_custkey") % 5).cast("string"),
            F.lit("}}"),
            F.repeat(F.lit(" {{Status}}"), (F.col("o_custkey") % 4).cast("int")),
            F.when(F.col("o_custkey") % 3 == 0, F.lit(" {{Order Number")).otherwise(F.lit("")),
        ).alias("text"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as requests; a third of them has the token limit 0."""
    return (
        table(spark, sf_dir, "conversations")
        .where("role = 'user'")
        .select(
            "conv_id",
            "turn",
            F.col("text").alias("message"),
            ((F.col("conv_id") % 3) * 64).alias("max_tokens"),
        )
    )

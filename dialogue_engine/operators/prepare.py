"""Support cases into chat examples."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.functions import chat
from dialogue_engine.operators.positions import null_safe_join, positions, span_of, top_per_key
from dialogue_engine.operators.split import order_hash


def keep_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def to_messages(
    cases: DataFrame, system_prompt: str = C.SYSTEM_PROMPT, keys: Sequence[str] = ("case_id",)
) -> DataFrame:
    """Each case becomes one message array; the source columns go, the key columns stay."""
    entries = chat.messages(F.col("instruction"), F.col("response"), system_prompt)
    return keep_only(cases.withColumn("messages", entries), [*keys, "messages"])


def explode_messages(examples: DataFrame) -> DataFrame:
    """One row per message, with its position in the example."""
    others = [c for c in examples.columns if c != "messages"]
    return examples.select(*others, F.posexplode("messages").alias("position", "m")).select(
        *others, "position", "m.role", "m.content"
    )


def length_band(cases: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Drop very short and very long cases; both limits are inside the band."""
    return cases.where(F.length(column).between(low, high))


def in_scope(cases: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """Keep chosen categories or intents. The list is a filter the scan can use."""
    return cases.where(F.col(column).isin(*wanted))


def in_scope_of(cases: DataFrame, selection: DataFrame, column: str) -> DataFrame:
    """Keep the cases whose category or intent is in a selection table with a column of that name.

    A semi join, so repeated selections do not multiply cases and a missing value is in no
    selection. Where the cases are stored by that column and the selection is filtered and small
    enough to broadcast, Spark reads only the chosen folders.
    """
    return cases.join(selection.select(column), column, "left_semi")


def add_fallback_examples(cases: DataFrame, extra: DataFrame) -> DataFrame:
    """Add out-of-scope examples with an answer that leads back to the topic."""
    labelled = extra.withColumn("intent", F.lit(C.FALLBACK_INTENT))
    if "response" not in labelled.columns:
        labelled = labelled.withColumn("response", F.lit(C.FALLBACK_REPLY))
    return cases.unionByName(labelled, allowMissingColumns=True)


def dedupe(cases: DataFrame, keys: Sequence[str | Column], id_col: str = "case_id") -> DataFrame:
    """One case per key, the one with the smallest id.

    Spark applies the row limit in each task before the shuffle, so a key that holds a third of
    all rows sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(id_col)
    return cases.withColumn("__rank", F.row_number().over(first)).where("__rank = 1").drop("__rank")


def cap_per_template(
    cases: DataFrame, k: int, template: str = "response", id_col: str = "case_id", seed: int = C.SEED
) -> DataFrame:
    """At most k cases for each identical response, the first ones in seeded order.

    A missing response is a template like any other. Templates are compared by md5.
    """
    order = [order_hash(id_col, seed), F.col(id_col)]
    keyed = cases.withColumn("__template", F.md5(template))
    return top_per_key(keyed, ["__template"], order, k, id_col).drop("__template", "__rank")


def number_turns(turns: DataFrame) -> DataFrame:
    """Give turns the positions 0, 1, 2, ... in their conversation, closing gaps.

    The operators on turns expect positions, as in a list.
    """
    numbered = positions(turns, ["conv_id"], ["turn"], span_of("turn"), name="__turn")
    return numbered.withColumn("turn", F.col("__turn")).drop("__turn").select(*turns.columns)


def pair_turns(turns: DataFrame) -> DataFrame:
    """User turns with the next turn of the conversation, when that is the assistant's. Turn
    numbers may have gaps.

    A join on (conversation, position) rather than a window over the conversation: the key is
    unique, so a very long conversation is spread evenly, and each row is on one side only.
    """
    at = positions(turns, ["conv_id"], ["turn"], span_of("turn"), name="__at")
    asked = at.where(F.col("role") == "user").select(
        "conv_id", "__at", "turn", F.col("text").alias("instruction")
    )
    answered = at.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("__at") - 1).alias("__at"), F.col("text").alias("response")
    )
    return null_safe_join(asked, answered, ["conv_id", "__at"], "inner").drop("__at")

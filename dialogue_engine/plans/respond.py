"""The chat step for many conversations at once: gate, context, answer, append."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.operators.context import append_reply, request_context, request_gate
from dialogue_engine.operators.generate import BatchFunction, batch_generate
from dialogue_engine.scratch import written


def respond(
    turns: DataFrame,
    requests: DataFrame,
    load: Callable[[], BatchFunction],
    system_prompt: str = C.SYSTEM_PROMPT,
    last_k: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The turns after answering ``requests`` (conv_id, message, max_tokens), and the requests that
    failed, with their error. Blank messages change nothing; failed answers add nothing."""
    gated = request_gate(requests)
    ready = request_context(turns, gated, system_prompt, last_k).withColumn(
        "model", F.lit("single")
    )
    # stored before use: otherwise a second reader would ask the model again
    answered = written(
        batch_generate(ready, {"single": load}).select(
            "conv_id", "message", F.col("output").alias("reply"), "error"
        )
    )
    replies = answered.where("error is null").select("conv_id", "message", "reply")
    failed = answered.where("error is not null").select("conv_id", "message", "error")
    return append_reply(turns, replies), failed

"""Chat context per user turn, requests, and the growing history."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine import schemas
from dialogue_engine.functions import chat
from dialogue_engine.functions.text import strip_unicode, text_or_empty
from dialogue_engine.operators.positions import (
    KEY,
    null_safe_join,
    positions,
    span_of,
    top_per_key,
)
from dialogue_engine.scratch import written

# Turns per block. Few conversations are longer, so few need what the next function does.
BLOCK_TURNS = 256


def _last(entries: Column, count: int | None) -> Column:
    if count is None:
        return entries
    size = F.size(entries)
    return F.slice(entries, F.greatest(size - count + 1, F.lit(1)), count)


def _recent(long: DataFrame, span: int, last_k: int) -> DataFrame:
    """The ``last_k`` messages before the first turn of each block.

    The messages are numbered and cut into runs of equal length, whatever gaps their turns have.
    The last messages of a run also go to the next one, which then needs nothing else: a
    window never spans more than one run, and only the counts per block meet by conversation.
    """
    width = max(span, last_k)
    numbered = positions(long, ["conv_id"], ["turn"], span_of("turn", span), name="__pos")
    own = numbered.withColumn("__run", F.expr(f"__pos div {width}")).withColumn("__own", F.lit(True))
    handed_on = (
        own.where(F.col("__pos") % width >= width - last_k)
        .withColumn("__run", F.col("__run") + 1)
        .withColumn("__own", F.lit(False))
    )
    rows = own.unionByName(handed_on).withColumn("__of", F.struct("conv_id", "__run"))
    order = Window.partitionBy("__of").orderBy("__pos")
    starts = F.coalesce(F.lag("block").over(order) != F.col("block"), F.lit(True))
    return (
        rows.withColumn("__starts", starts & F.col("__own"))
        .withColumn("inherited", F.collect_list("message").over(order.rowsBetween(-last_k, -1)))
        .where("__starts")
        .select("conv_id", "block", "inherited")
        .where(F.size("inherited") > 0)
    )


def _carried(history: DataFrame, span: int, last_k: int | None) -> DataFrame:
    """Messages a block of a long conversation inherits from the blocks before it.

    Only conversations with a turn outside block 0 take part. The scan can skip files and row
    groups by the turn number, so for ordinary data their list is found at no cost, is empty,
    and ends this branch. The rows are partitioned by block right after the join with that
    list, which leaves Spark free to split a conversation that makes the join uneven.
    """
    outside = (F.col("turn") >= span) | (F.col("turn") < 0)
    long_ids = written(history.where(outside).select("conv_id").distinct())
    long = null_safe_join(history.drop(KEY), long_ids, ["conv_id"], "left_semi")
    if last_k is not None:
        return _recent(long, span, last_k)
    # whole histories: every block holds all before it, so they must meet
    blocks = (
        long.repartition("conv_id", "block")
        .groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "message"))).alias("entries"))
        .withColumn("messages", F.col("entries")["message"])
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inherited = F.flatten(F.collect_list("messages").over(earlier))
    return blocks.select("conv_id", "block", inherited.alias("inherited")).where(F.size("inherited") > 0)


def chat_context(
    turns: DataFrame,
    system_prompt: str = C.SYSTEM_PROMPT,
    last_k: int | None = None,
    span: int = BLOCK_TURNS,
) -> DataFrame:
    """For each user turn: system message, the earlier turns, and the message itself.

    The whole history grows with the square of the conversation; ``last_k`` keeps the last k
    earlier turns. A conversation is worked on in blocks of ``span`` turns: a task holds one
    block and what the block inherits, never all contexts of a long conversation.
    """
    history = turns.where(F.col("role").isin("user", "assistant")).select(
        "conv_id",
        "turn",
        "role",
        span_of("turn", span).alias("block"),
        chat.message(F.col("role"), F.col("text")).alias("message"),
    ).withColumn(KEY, F.struct("conv_id", "block"))
    nothing = F.array().cast(schemas.MESSAGES)
    if last_k == 0:
        rows = history.where(F.col("role") == "user").withColumn("earlier", nothing)
    else:
        start = Window.unboundedPreceding if last_k is None else -last_k
        # window and join are partitioned by the same column: the rows are shuffled once
        before = Window.partitionBy(KEY).orderBy("turn").rowsBetween(start, -1)
        near = history.withColumn("near", F.collect_list("message").over(before)).where(
            F.col("role") == "user"
        )
        carried = _carried(history, span, last_k)
        rows = null_safe_join(near, carried, ["conv_id", "block"], "left").withColumn(
            "earlier",
            _last(F.concat(F.coalesce("inherited", nothing), F.col("near")), last_k),
        )
    system = F.array(chat.message("system", F.lit(system_prompt)))
    return rows.select(
        "conv_id",
        "turn",
        F.concat(system, F.col("earlier"), F.array("message"))
        .cast(schemas.MESSAGES)
        .alias("messages"),
    )


def request_context(
    turns: DataFrame,
    requests: DataFrame,
    system_prompt: str = C.SYSTEM_PROMPT,
    last_k: int | None = None,
) -> DataFrame:
    """Add to ``requests`` (conv_id, message, ..) the messages to send: system message, the turns
    of the conversation so far, and the new message.

    Without ``last_k`` a request holds its whole conversation, as the row must. With it, a task
    passes on no more than the last k turns it has of a conversation.
    """
    history = turns.where(F.col("role").isin("user", "assistant")).join(
        requests.select("conv_id"), "conv_id", "left_semi"
    )
    if last_k is not None:
        # which turns are kept is found without their texts
        turns_of = history.select("conv_id", "turn").repartition("conv_id", "turn")
        kept = top_per_key(turns_of, ["conv_id"], [F.col("turn").desc()], last_k, "turn")
        history = history.join(kept.select("conv_id", "turn"), ["conv_id", "turn"], "left_semi")
    entry = F.struct("turn", chat.message(F.col("role"), F.col("text")).alias("message"))
    earlier = history.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("earlier"))
    messages = F.concat(
        F.array(chat.message("system", F.lit(system_prompt))),
        F.coalesce(F.col("earlier")["message"], F.array().cast(schemas.MESSAGES)),
        F.array(chat.message("user", F.col("message"))),
    )
    return (
        requests.join(earlier, "conv_id", "left")
        .withColumn("messages", messages.cast(schemas.MESSAGES))
        .drop("earlier")
    )


def append_reply(
    turns: DataFrame, replies: DataFrame, order_by: Sequence[str] = ("message", "reply")
) -> DataFrame:
    """History plus user message plus reply, as rows.

    ``replies`` has (conv_id, message, reply) and, where a conversation has several, ``order_by``,
    the columns that say which came first. The new turns follow the last turn of the
    conversation, or start one.
    """
    own = turns.join(replies.select("conv_id").distinct(), "conv_id", "left_semi")
    last = own.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    among = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order_by)) - 1
    numbered = replies.withColumn("__exchange", among)
    following = F.coalesce(F.col("last_turn") + 1, F.lit(0)).cast("long") + 2 * F.col("__exchange")
    exchange = F.array(
        F.struct(following.cast("long").alias("turn"), F.lit("user").alias("role"), F.col("message").alias("text")),
        F.struct(
            (following + 1).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.col("reply").alias("text")
        ),
    )
    added = numbered.join(last, "conv_id", "left").select("conv_id", F.inline(exchange))
    return turns.select("conv_id", "turn", "role", "text").unionByName(added)


def request_gate(requests: DataFrame) -> DataFrame:
    """Drop blank messages; a missing or zero token limit becomes the default."""
    limit = F.coalesce(F.nullif(F.col("max_tokens"), F.lit(0)), F.lit(C.DEFAULT_MAX_TOKENS))
    return requests.where(F.length(strip_unicode(text_or_empty(F.col("message")))) > 0).withColumn(
        "max_tokens", limit.cast("long")
    )


def build_requests(contexts: DataFrame, model: str) -> DataFrame:
    """Add ``request``, the JSON body. Without a ``max_tokens`` column there is no limit."""
    limit = F.col("max_tokens") if "max_tokens" in contexts.columns else F.lit(None).cast("long")
    return contexts.withColumn(
        "request", chat.request_json(F.lit(model), F.col("messages"), limit)
    )

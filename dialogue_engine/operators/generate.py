"""Prompts through models. The only place where Python code sees rows."""

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialogue_engine import constants as C
from dialogue_engine import schemas
from dialogue_engine.functions import chat
from dialogue_engine.functions.text import text_or_empty
from dialogue_engine.scratch import folder_exists, written

# Conversations per call of a model.
BATCH_SIZE = 64
# Parts that requests are answered in, each stored before the next is asked.
STEPS = 8

# list of conversations -> list of replies; a conversation is a list of {role, content}
BatchFunction = Callable[[list[list[dict]]], list[str]]


def fan_out(prompts: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every prompt through every model. The models are a short list known when the query is
    written, so the rows are multiplied in place and nothing is joined."""
    return prompts.withColumn("model", F.explode(F.array(*(F.lit(m) for m in models))))


def prompt_messages(prompts: DataFrame, system_prompt: str = C.SYSTEM_PROMPT) -> DataFrame:
    """Add the two messages that ask a prompt without history."""
    entries = F.array(
        chat.message("system", F.lit(system_prompt)), chat.message("user", F.col("prompt"))
    )
    return prompts.withColumn("messages", entries.cast(schemas.MESSAGES))


def batch_generate(
    requests: DataFrame,
    load: Mapping[str, Callable[[], BatchFunction]],
    partitions: int | None = None,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Add ``output`` and ``error`` to rows that have ``model`` and ``messages``.

    ``load`` has a function per model that loads it; each task loads a model once, when the
    first row for it arrives, and then sends batches of at most ``batch_size`` conversations. Few
    rows with slow models need ``partitions`` to spread. Write the result before using it twice,
    or the models run twice.

    If a batch fails it is sent again row by row, so that an error stays with its row. Python
    sees ``model`` and ``messages`` alone; all other columns pass through unread.
    """
    if partitions is not None:
        requests = requests.repartition(partitions)
    loaders = dict(load)
    fields = [*requests.schema.fields]
    fields += [T.StructField(name, T.StringType(), True) for name in ("output", "error")]

    # Nested, so that Spark ships it whole and executors need not have this package.
    def ask(model: BatchFunction, conversations: list[list[dict]]) -> list[tuple]:
        try:
            replies = model(conversations)
            if len(replies) != len(conversations):
                raise ValueError(f"{len(replies)} replies for {len(conversations)} requests")
            return [(reply, None) for reply in replies]
        except Exception as error:
            if len(conversations) == 1:
                return [(None, f"{type(error).__name__}: {error}")]
            return [ask(model, [one])[0] for one in conversations]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, BatchFunction] = {}
        for batch in batches:
            done: list[tuple] = [(None, None)] * batch.num_rows
            rows_of: dict[str, list[int]] = {}
            for row, model in enumerate(batch.column("model").to_pylist()):
                rows_of.setdefault(model, []).append(row)
            messages = batch.column("messages")
            for model, rows in rows_of.items():
                if model not in ready:
                    ready[model] = loaders[model]()
                for first in range(0, len(rows), batch_size):
                    some = rows[first : first + batch_size]
                    conversations = messages.take(pa.array(some)).to_pylist()
                    for row, result in zip(some, ask(ready[model], conversations)):
                        done[row] = result
            added = [pa.array([d[i] for d in done], pa.string()) for i in (0, 1)]
            names = [*batch.schema.names, "output", "error"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return requests.mapInArrow(run, T.StructType(fields))


def _request_key() -> Column:
    """What an answer belongs to. A prompt whose messages have changed is another request."""
    return F.struct("prompt_id", "model", F.xxhash64("messages").alias("asked"))


def _stored(requests: DataFrame, store: str) -> DataFrame | None:
    """(key, output, error) of all stored answers; a failed one only where no other came later."""
    spark = requests.sparkSession
    if not folder_exists(spark, store):
        return None
    fields = [T.StructField("__key", requests.select(_request_key().alias("k")).schema["k"].dataType)]
    fields += [T.StructField(name, T.StringType()) for name in ("output", "error")]
    rows = spark.read.schema(T.StructType(fields)).parquet(store)
    good, bad = rows.where("error is null"), rows.where("error is not null")
    failed = bad.join(good.select("__key"), "__key", "left_anti")
    return good.unionByName(failed.groupBy("__key").agg(
        F.lit(None).cast("string").alias("output"), F.max("error").alias("error")
    ))


def resume_generate(
    requests: DataFrame,
    load: Mapping[str, Callable[[], BatchFunction]],
    store: str,
    partitions: int | None = None,
    batch_size: int = BATCH_SIZE,
    steps: int = STEPS,
    retry_errors: bool = True,
) -> DataFrame:
    """``batch_generate`` that keeps what has been answered.

    ``requests`` has ``prompt_id``, ``model`` and ``messages``. Answers are stored under ``store``, a
    shared folder, in ``steps`` parts; a request whose answer is there is not asked again, so a start
    after a crash asks what was open and the part that was being asked. Within a part Spark
    keeps the answers of finished tasks when an executor is lost, as nothing is shuffled after
    the models. Equal requests are asked once. With ``retry_errors`` a start asks failed requests
    again.
    """
    spark = requests.sparkSession
    keyed = requests.withColumn("__key", _request_key())
    # one row per request that is not answered yet, found by keys alone
    keys = keyed.select("__key").distinct()
    done = _stored(requests, store)
    if done is not None:
        finished = done.where("error is null") if retry_errors else done
        keys = keys.join(finished.select("__key"), "__key", "left_anti")
    # fixed now: what a step answers must not change which requests the next one takes
    keys = written(keys)
    for step in range(steps):
        of_step = F.pmod(F.xxhash64("__key"), F.lit(steps)) == step
        open_now = (
            keyed.select("__key", "model", "messages")
            .where(of_step)
            .join(keys.where(of_step), "__key", "left_semi")
            .dropDuplicates(["__key"])
        )
        answers = batch_generate(open_now, load, partitions, batch_size)
        answers.select("__key", "output", "error").write.mode("append").parquet(store)
    answered = _stored(requests, store)
    return keyed.join(answered, "__key", "left").drop("__key")


def token_count(fn: Callable[[list[str]], list[int]]) -> Callable:
    """A column function from a Python length function, e.g. of a real tokenizer.

    Without one, ``functions.text.word_count`` is the native estimate.
    """

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(fn(texts.fillna("").tolist()), dtype="int64")

    return lambda col: count(text_or_empty(col))


def map_rows(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """Map Arrow batches with a Python function; columns outside ``schema`` are removed.

    For anything that column expressions can say, use ``df.transform`` or ``select``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (fn(batch) for batch in batches)

    return df.mapInPandas(run, schema)

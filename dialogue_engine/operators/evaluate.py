"""Scoring replies.

Long form is (run_id, prompt_id, model, output); wide form, the stored one, has one column per
model, named as in ``schemas.OUTPUT_COLUMNS``. Scores are one grouped aggregate over the long
form: the text is reduced to numbers before the shuffle, so a run that holds a third of all
replies costs each task one row.
"""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine import schemas
from dialogue_engine.functions.rounding import py_round
from dialogue_engine.functions.text import (
    char_length,
    excerpt,
    keyword_count,
    length_commentary,
    reply_class,
)
from dialogue_engine.operators.positions import null_safe_join, top_per_key


def side_by_side(
    responses: DataFrame,
    keys: Sequence[str] = ("run_id", "prompt_id"),
    models: Sequence[str] = ("base", "fine_tuned"),
) -> DataFrame:
    """One row per prompt with the output of each model; a missing one is null.

    Of several answers of a model to a prompt the longest counts, as in ``paired_scores``; of
    equally long ones the last in the alphabet. This is the one operator that moves the texts.
    """
    answer = F.struct(char_length(F.col("output")).alias("chars"), "output")
    outputs = [
        F.max(F.when(F.col("model") == m, answer))["output"].alias(schemas.OUTPUT_COLUMNS[m])
        for m in models
    ]
    wide = responses.groupBy(*keys).agg(*outputs)
    if {"base", "fine_tuned"} <= set(models):
        wide = wide.withColumn(
            "commentary", length_commentary(F.col("base_output"), F.col("fine_tuned_output"))
        )
    return wide


_CLASSES = ("empty", "short", "ok")


def paired_scores(
    responses: DataFrame,
    keys: Sequence[str] = ("run_id", "prompt_id"),
    models: Sequence[str] = ("base", "fine_tuned"),
    keywords: Sequence[str] = C.SUPPORT_KEYWORDS,
) -> DataFrame:
    """Scores per prompt and model as ``score_replies`` has them; a missing answer is an empty one.

    The text becomes numbers before the shuffle: length, keywords and class of an answer are put
    into one number, so that the longest answer of a model is a plain maximum.
    """
    scored = score_replies(responses, keywords)
    kind = F.array_position(F.array(*map(F.lit, _CLASSES)), F.col("reply_class")) - 1
    one = F.col("chars") * (1 << 24) + F.col("keywords") * 4 + kind
    best = [F.coalesce(F.max(F.when(F.col("model") == m, one)), F.lit(0)).alias(m) for m in models]
    entries = F.array(*(F.struct(F.lit(m).alias("model"), F.col(m).alias("one")) for m in models))
    long = scored.groupBy(*keys).agg(*best).select(*keys, F.inline(entries))
    return long.select(
        *keys,
        "model",
        F.shiftright("one", 24).alias("chars"),
        F.shiftright(F.col("one").bitwiseAND(F.lit((1 << 24) - 1)), 2).alias("keywords"),
        F.element_at(
            F.array(*map(F.lit, _CLASSES)), (F.col("one").bitwiseAND(F.lit(3)) + 1).cast("int")
        ).alias("reply_class"),
    )


def metrics_of_scores(scores: DataFrame, by: Sequence[str] = ("run_id", "model")) -> DataFrame:
    """``evaluation_metrics`` of replies that are scored already."""
    return scores.groupBy(*by).agg(*metric_columns())


def wide_to_long(
    results: DataFrame,
    keys: Sequence[str] = ("run_id", "prompt_id"),
    models: Sequence[str] = ("base", "fine_tuned"),
) -> DataFrame:
    """One row per prompt and model; a null output stays a row and so in the denominator."""
    entries = F.array(
        *(
            F.struct(F.lit(m).alias("model"), F.col(schemas.OUTPUT_COLUMNS[m]).alias("output"))
            for m in models
        )
    )
    return results.select(*keys, F.inline(entries))


def result_mode(results: DataFrame) -> DataFrame:
    """Whether the results of a run are of ``two`` models or of a ``single`` one.

    It is two when the result of any prompt has the field of the fine-tuned output, filled or
    null. Where the source can tell, that is in ``has_two``; else a filled output says so. A run
    without any output is single.
    """
    return results.groupBy("run_id").agg(
        F.when(F.bool_or(_of_two(results)), "two").otherwise("single").alias("mode")
    )


def _of_two(results: DataFrame) -> Column:
    filled = F.col("fine_tuned_output").isNotNull()
    return filled | F.coalesce("has_two", F.lit(False)) if "has_two" in results.columns else filled


def score_replies(
    responses: DataFrame, keywords: Sequence[str] = C.SUPPORT_KEYWORDS
) -> DataFrame:
    """Replace ``output`` by its length, keyword count and class."""
    others = [c for c in responses.columns if c != "output"]
    return responses.select(
        *others,
        char_length(F.col("output")).alias("chars"),
        keyword_count(F.col("output"), keywords).alias("keywords"),
        reply_class(F.col("output")).alias("reply_class"),
    )


def length_stats(chars: Column) -> list[Column]:
    """min, max, mean and sample deviation; zeros where Spark would say null."""
    zero = F.lit(0.0)
    return [
        F.coalesce(F.min(chars), F.lit(0)).cast("long").alias("length_min"),
        F.coalesce(F.max(chars), F.lit(0)).cast("long").alias("length_max"),
        F.coalesce(py_round(F.avg(chars), 1), zero).alias("length_avg"),
        F.coalesce(py_round(F.stddev_samp(chars), 1), zero).alias("length_std"),
    ]


def metric_columns() -> list[Column]:
    """The aggregates over scored replies."""
    return [
        F.count(F.lit(1)).alias("num_prompts"),
        *length_stats(F.col("chars")),
        py_round(F.avg((F.col("keywords") > 0).cast("int")), 2).alias("relevance_score"),
        py_round(F.avg("keywords"), 1).alias("keyword_count_avg"),
        F.count_if(F.col("reply_class") == "empty").alias("empty_responses"),
        F.count_if(F.col("reply_class") == "short").alias("short_responses"),
    ]


def evaluation_metrics(
    responses: DataFrame,
    by: Sequence[str] = ("run_id", "model"),
    keywords: Sequence[str] = C.SUPPORT_KEYWORDS,
) -> DataFrame:
    """All scores per group. ``length_avg`` is the average length."""
    return score_replies(responses, keywords).groupBy(*by).agg(*metric_columns())


def evaluate_results(
    results: DataFrame, keywords: Sequence[str] = C.SUPPORT_KEYWORDS, mode: str | None = None
) -> DataFrame:
    """``evaluation_metrics`` of stored results in which the runs differ in mode.

    All three outputs are scored in the one pass over the text. Which of them count is decided
    afterwards, on the three rows per run that are left: those of ``mode`` if it is given, else
    those of the run's ``result_mode``. Null outputs are empty replies, so no run is lost.
    """
    flagged = results.withColumn("__two", F.lit(mode == "two") if mode else _of_two(results))
    long = wide_to_long(flagged, ("run_id", "prompt_id", "__two"), list(schemas.OUTPUT_COLUMNS))
    metrics = (
        score_replies(long, keywords)
        .groupBy("run_id", "model")
        .agg(*metric_columns(), F.bool_or("__two").alias("__two"))
    )
    return metrics.where(F.col("__two") == (F.col("model") != "single")).drop("__two")


def metrics_record(metrics: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row per run in the layout of the stored record.

    Values of the other mode are null. Empty and short replies and the keyword average are
    those of the primary model, the fine-tuned one or else the single one. ``runs`` lists runs
    that must appear even without any result; these have ``num_prompts`` 0 and nothing else.
    """

    def value(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(column)))

    def primary(column: str) -> Column:
        return F.coalesce(value("fine_tuned", column), value("single", column))

    def stats(model: str) -> Column:
        parts = [value(model, f"length_{p}").alias(p) for p in ("min", "max", "avg", "std")]
        return F.when(value(model, "num_prompts").isNotNull(), F.struct(*parts))

    stored = {"base": "base", "fine_tuned": "fine_tuned", "single": "ollama"}
    record = metrics.groupBy("run_id").agg(
        F.max("num_prompts").alias("num_prompts"),
        *(value(m, "length_avg").alias(f"avg_length_{s}") for m, s in stored.items()),
        *(value(m, "relevance_score").alias(f"relevance_score_{s}") for m, s in stored.items()),
        *(stats(m).alias(f"length_stats_{s}") for m, s in stored.items()),
        primary("empty_responses").alias("empty_responses"),
        primary("short_responses").alias("short_responses"),
        primary("keyword_count_avg").alias("keyword_count_avg"),
        value("base", "keyword_count_avg").alias("keyword_count_avg_base"),
    )
    if runs is None:
        return record
    return null_safe_join(runs.select("run_id").distinct(), record, ["run_id"], "left").withColumn(
        "num_prompts", F.coalesce("num_prompts", F.lit(0)).cast("long")
    )


def metrics_or_recompute(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """Stored records as they are; the computed one only for a run that has none.

    Both have one row per run. ``source`` says which one it is, because a stored record may be
    older than today's metrics and lack some.
    """
    columns = [c for c in computed.columns if c != "run_id"]
    # A record without any value is as good as none.
    filled = reduce(or_, (F.col(c).isNotNull() for c in columns))
    kept = stored.where(filled).select("run_id", F.struct(*columns).alias("old"))
    fresh = computed.select("run_id", F.struct(*columns).alias("new"))
    both = kept.join(fresh, "run_id", "full")
    chosen = F.coalesce("old", "new")
    return both.select(
        "run_id",
        *(chosen[c].alias(c) for c in columns),
        F.when(F.col("old").isNotNull(), "stored").otherwise("computed").alias("source"),
    )


def _or_else(first: Column, second: Column) -> Column:
    """Zero counts as missing, as with Python's ``or``."""
    return F.coalesce(F.nullif(first, F.lit(0.0)), second)


def report_cards(records: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Headline values per run as rows (run_id, card, value); a card without value is left out.

    ``results`` gives the number of prompts for records that do not state it.
    """
    if results is not None:
        counted = results.groupBy("run_id").agg(F.count(F.lit(1)).alias("__rows"))
        records = null_safe_join(records, counted, ["run_id"], "left")
        prompts = F.coalesce("num_prompts", F.coalesce("__rows", F.lit(0)))
    else:
        prompts = F.col("num_prompts")
    stats = F.coalesce("length_stats_fine_tuned", "length_stats_ollama")
    cards = {
        "relevance_base": _or_else(F.col("relevance_score_base"), F.col("relevance_score_ollama")),
        "relevance_fine_tuned": F.col("relevance_score_fine_tuned"),
        "avg_length_base": _or_else(F.col("avg_length_base"), F.col("avg_length_ollama")),
        "avg_length_fine_tuned": F.col("avg_length_fine_tuned"),
        "prompts": prompts,
        "length_min": F.when(stats.isNotNull(), F.coalesce(stats["min"], F.lit(0))),
        "length_max": F.when(stats.isNotNull(), F.coalesce(stats["max"], F.lit(0))),
        "length_std": F.when(stats.isNotNull(), F.coalesce(stats["std"], F.lit(0.0))),
        "keyword_density": F.col("keyword_count_avg"),
        "empty_replies": F.coalesce("empty_responses", F.lit(0)),
        "short_replies": F.coalesce("short_responses", F.lit(0)),
    }
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("card"), value.cast("double").alias("value"))
            for name, value in cards.items()
        )
    )
    return records.select("run_id", F.inline(rows)).where("value is not null")


def invalid_comparison(modes: DataFrame, configs: DataFrame) -> DataFrame:
    """Runs whose two columns came from the base model, since no adapter was loaded. An unknown
    state is not flagged."""
    not_loaded = (F.col("mode") == "two") & (~F.col("adapter_loaded"))
    return null_safe_join(modes, configs.select("run_id", "adapter_loaded"), ["run_id"], "left").select(
        "run_id", "mode", "adapter_loaded", F.coalesce(not_loaded, F.lit(False)).alias("invalid")
    )


def metrics_by_test_type(
    responses: DataFrame, catalog: DataFrame, keywords: Sequence[str] = C.SUPPORT_KEYWORDS
) -> DataFrame:
    """The scores per kind of test prompt. Scores first: the join carries numbers, not text.
    Replies to prompts that the catalog lacks are the kind null."""
    scored = score_replies(responses, keywords).join(
        catalog.select("prompt_id", "test_type"), "prompt_id", "left"
    )
    return scored.groupBy("test_type", "model").agg(*metric_columns())


def weak_intents(
    responses: DataFrame,
    cases: DataFrame,
    k: int,
    keywords: Sequence[str] = C.SUPPORT_KEYWORDS,
) -> DataFrame:
    """The k intents with the lowest relevance, then the most short replies.

    ``responses.prompt_id`` is the ``case_id`` of the case that was asked. Replies without a case
    are the intent null.
    """
    scored = score_replies(responses, keywords).join(
        cases.select(F.col("case_id").alias("prompt_id"), "intent"), "prompt_id", "left"
    )
    return scored.groupBy("intent").agg(*metric_columns()).transform(weakest, k)


def weakest(metrics: DataFrame, k: int, name: str = "intent") -> DataFrame:
    short_rate = F.col("short_responses") / F.col("num_prompts")
    return metrics.orderBy(F.col("relevance_score"), short_rate.desc(), F.col(name)).limit(k)


def ab_delta(
    results: DataFrame,
    keys: Sequence[str] = ("run_id", "prompt_id"),
    keywords: Sequence[str] = C.SUPPORT_KEYWORDS,
) -> DataFrame:
    """Per prompt: fine-tuned minus base in length, keywords and relevance (0 or 1)."""
    base, tuned = F.col("base_output"), F.col("fine_tuned_output")
    scored = results.select(
        *keys,
        (char_length(tuned) - char_length(base)).alias("length_delta"),
        keyword_count(base, keywords).alias("__base"),
        keyword_count(tuned, keywords).alias("__tuned"),
    )
    relevant = [(F.col(c) > 0).cast("long") for c in ("__tuned", "__base")]
    return scored.select(
        *keys,
        "length_delta",
        (F.col("__tuned") - F.col("__base")).alias("keyword_delta"),
        (relevant[0] - relevant[1]).alias("relevance_delta"),
    )


def ab_delta_of_scores(scores: DataFrame, keys: Sequence[str] = ("run_id", "prompt_id")) -> DataFrame:
    """``ab_delta`` of ``paired_scores``."""

    def difference(value: Column) -> Column:
        return F.sum(F.when(F.col("model") == "fine_tuned", value).otherwise(-value))

    return scores.groupBy(*keys).agg(
        difference(F.col("chars")).alias("length_delta"),
        difference(F.col("keywords")).alias("keyword_delta"),
        difference((F.col("keywords") > 0).cast("long")).alias("relevance_delta"),
    )


def ab_summary(deltas: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Mean differences per run, and on how many prompts the fine-tuned reply gained keywords."""
    return deltas.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_prompts"),
        py_round(F.avg("length_delta"), 1).alias("length_delta_avg"),
        py_round(F.avg("keyword_delta"), 1).alias("keyword_delta_avg"),
        py_round(F.avg("relevance_delta"), 2).alias("relevance_delta_avg"),
        F.count_if(F.col("keyword_delta") > 0).alias("gained"),
        F.count_if(F.col("keyword_delta") < 0).alias("lost"),
    )


def comparison_table(
    results: DataFrame,
    rows: int = C.COMPARISON_ROWS,
    models: Sequence[str] = ("base", "fine_tuned"),
) -> DataFrame:
    """The first prompts of each run with shortened cells, and ``total``, the number of prompts.

    Cells are shortened before anything is moved, and the limit holds in each task at any number
    of rows.
    """
    totals = results.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"))
    cells = [
        excerpt(F.col(schemas.OUTPUT_COLUMNS[m]), C.OUTPUT_CELL_CHARS).alias(
            schemas.OUTPUT_COLUMNS[m]
        )
        for m in models
    ]
    if "prompt" in results.columns:
        cells.insert(0, excerpt(F.col("prompt"), C.PROMPT_CELL_CHARS).alias("prompt"))
    short = results.select("run_id", "prompt_id", *cells)
    first = top_per_key(short, ["run_id"], [F.col("prompt_id")], rows, "prompt_id", "shown")
    return null_safe_join(first, totals, ["run_id"], "inner").withColumn(
        "shown", F.col("shown").cast("long")
    ).select("run_id", "shown", "prompt_id", *(c for c in short.columns[2:]), "total")

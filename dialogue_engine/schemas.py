"""Explicit schemas: nothing is inferred, so a column that is null everywhere keeps its type."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


CASE_COLUMNS = ("instruction", "response", "category", "intent", "flags")
CASES = _struct(*((name, _S) for name in CASE_COLUMNS))

MESSAGE = _struct(("role", _S), ("content", _S))
MESSAGES = T.ArrayType(MESSAGE)

PROMPTS = _struct(("prompt_id", _L), ("prompt", _S), ("test_type", _S))

RESULT_FIELDS = (
    ("prompt", _S),
    ("base_output", _S),
    ("fine_tuned_output", _S),
    ("ollama_output", _S),
    ("commentary", _S),
)
RESULT = _struct(*RESULT_FIELDS)

LENGTH_STATS = _struct(("min", _L), ("max", _L), ("avg", _D), ("std", _D))

METRICS = _struct(
    ("num_prompts", _L),
    ("avg_length_base", _D),
    ("avg_length_fine_tuned", _D),
    ("avg_length_ollama", _D),
    ("relevance_score_base", _D),
    ("relevance_score_fine_tuned", _D),
    ("relevance_score_ollama", _D),
    ("length_stats_base", LENGTH_STATS),
    ("length_stats_fine_tuned", LENGTH_STATS),
    ("length_stats_ollama", LENGTH_STATS),
    ("empty_responses", _L),
    ("short_responses", _L),
    ("keyword_count_avg", _D),
    ("keyword_count_avg_base", _D),
)

EVALUATION_CONFIG = _struct(
    ("base_model", _S), ("adapter_path", _S), ("adapter_loaded", _B)
)

# One schema reads both file shapes: an object file fills the first three fields, a file that
# is a bare list of results fills the fields of a result, a broken file the last one.
EVALUATION_FILE = _struct(
    # maps, because a null value then keeps its key
    ("results", T.ArrayType(T.MapType(_S, _S))),
    ("metrics", METRICS),
    ("evaluation_config", EVALUATION_CONFIG),
    *RESULT_FIELDS,
    ("_corrupt_record", _S),
)

RUN_STATS_FILE = _struct(
    ("model_name", _S),
    ("trainable_params", _L),
    ("total_params", _L),
    ("trainable_pct", _D),
    ("config", T.MapType(_S, _S)),
    ("duration_seconds", _D),
    ("log_history", T.ArrayType(_struct(("step", _L), ("loss", _D)))),
    ("_corrupt_record", _S),
)

REPLY_BODY = _struct(("message", MESSAGE), ("_corrupt_record", _S))

# Columns of each model in an evaluation record, and the name the model has in long form.
OUTPUT_COLUMNS = {
    "base": "base_output",
    "fine_tuned": "fine_tuned_output",
    "single": "ollama_output",
}


def is_broken(list_column: str) -> Column:
    """Whether the record could not be read. Spark refuses to read nothing but the corrupt text,
    so the condition names a second column, which does not change it."""
    entries = F.col(list_column)
    return F.col("_corrupt_record").isNotNull() & (entries.isNull() | (F.size(entries) >= 0))

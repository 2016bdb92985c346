"""Cases to training and eval examples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.functions.placeholders import handle_placeholders
from dialogue_engine.operators.prepare import to_messages
from dialogue_engine.operators.split import random_split, split_parts, stratified_split, subset


def prepare_examples(
    cases: DataFrame,
    subset_rows: int | None = None,
    seed: int = C.SEED,
    test_size: float = C.TEST_SIZE,
    stratify_by: str | None = None,
    placeholders: str = "keep",
) -> tuple[DataFrame, DataFrame]:
    """Training and eval part as message arrays. Rows are chosen first and mapped last."""
    if stratify_by:
        flagged = stratified_split(cases, [stratify_by], test_size, seed)
    else:
        flagged = random_split(cases, test_size, seed)
    parts = split_parts(flagged)
    if subset_rows is not None:
        parts = subset(*parts, subset_rows, seed)

    def mapped(part: DataFrame) -> DataFrame:
        texts = {c: handle_placeholders(F.col(c), placeholders) for c in ("instruction", "response")}
        return to_messages(part.withColumns(texts))

    return mapped(parts[0]), mapped(parts[1])

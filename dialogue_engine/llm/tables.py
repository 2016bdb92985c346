"""Document keys and column names."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def document_key() -> Column:
    """What a document is known by: its doc_id and the xxhash64 of its text. A struct, so that a
    null doc_id meets a null doc_id in a join. Rows that agree in both are one document."""
    return F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))


def like(df: DataFrame, columns: DataFrame) -> DataFrame:
    """The columns of another table, in their order."""
    return df.select(*(df[f"`{c}`"] for c in columns.columns))


def dealt(df: DataFrame) -> DataFrame:
    """The smaller side of a join whose sides are both dealt out by the key. It may grow with the
    corpus, so the plan is the same at every size and nothing is broadcast."""
    return df.hint("merge")

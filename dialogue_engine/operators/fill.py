"""Values from entity tables into text."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_engine.functions.placeholders import fill_tokens, placeholder_names


def fill_placeholders(
    texts: DataFrame,
    values: DataFrame,
    key: str,
    names: Mapping[str, str],
    column: str = "text",
) -> DataFrame:
    """Replace ``{{Name}}`` by the value of the entity the row belongs to.

    ``values`` has one row per ``key``; ``names`` maps placeholder names to its columns. Rows
    whose entity is unknown keep their tokens. One entity may own any share of the texts: the
    other side has one row for it, so Spark can split the skewed partition.
    """
    needed = values.select(key, *(F.col(c).alias(f"__{c}") for c in dict.fromkeys(names.values())))
    lookup = {name: F.col(f"__{c}") for name, c in names.items()}
    filled = texts.join(needed, key, "left").withColumn(column, fill_tokens(F.col(column), lookup))
    return filled.select(*texts.columns)


def placeholder_inventory(texts: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of each placeholder, and the number of texts that have it.

    Repeats are counted inside the row, so no distinct count over texts is needed.
    """
    names = placeholder_names(F.col(column))
    counted = F.transform(
        F.array_distinct("names"),
        lambda name: F.struct(
            name.alias("placeholder"),
            F.size(F.filter("names", lambda other: other == name)).cast("long").alias("times"),
        ),
    )
    return (
        texts.select(names.alias("names"))
        .select(F.inline(counted))
        .groupBy("placeholder")
        .agg(F.sum("times").alias("occurrences"), F.count(F.lit(1)).alias("texts"))
    )

"""Rounding with the result Python's ``round`` gives."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_round(value: Column, digits: int) -> Column:
    """Round the binary value of a double, ties to even.

    Spark's ``round`` and ``bround`` look at the shortest decimal spelling, so 0.065 becomes 0.06
    with ``bround`` and 0.07 in Python. Number formatting looks at the binary value.
    """
    x = value.cast("double")
    text = F.call_function("format_number", x, F.lit("0." + "0" * digits))
    # infinity has no number text and stays what it is
    return F.coalesce(text.try_cast("double"), x)

"""Positions inside a group that may be too large for one task.

A window over the group puts all its rows into one task. Here the order column is cut into
buckets, so a group is spread over many tasks: rows are numbered inside (group, bucket), and
the number of rows in the earlier buckets is added from a table with one row per bucket.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 65_536
KEY = "__key"
# Parts that a group's rows are dealt out to before the best of each are compared.
PARTS = 64


def span_of(col: Column | str, span: int = SPAN) -> Column:
    """Bucket of a whole-number order column."""
    col = F.col(col) if isinstance(col, str) else col
    return F.floor(col.cast("decimal(20,0)") / F.lit(span)).cast("long")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which a null key meets a null key; key columns are kept once.

    The keys are compared as one struct, which is never null itself. Unlike ``<=>`` this keeps a
    plain column as join key, so a side that is already partitioned by it is not shuffled again.
    """
    keyed = left if KEY in left.columns else left.withColumn(KEY, F.struct(*keys))
    others = [c for c in right.columns if c not in keys]
    found = right.select(F.struct(*keys).alias(KEY), *others)
    return keyed.join(found, KEY, how).drop(KEY)


def top_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    k: int,
    spread_by: str,
    name: str = "__rank",
) -> DataFrame:
    """The first k rows of each group, with their rank in ``name``.

    In two steps, so that a group that holds a third of all rows is spread over ``PARTS`` tasks and
    only the first k rows of each part meet in one, whatever k is.
    """
    part = F.pmod(F.xxhash64(spread_by), F.lit(PARTS))
    first = Window.partitionBy(*keys, "__part").orderBy(*order)
    spread = df.withColumn("__part", part).withColumn(name, F.row_number().over(first))
    left = spread.where(F.col(name) <= k).drop("__part")
    last = Window.partitionBy(*keys).orderBy(*order)
    return left.withColumn(name, F.row_number().over(last)).where(F.col(name) <= k)


def _rows_before(counted: DataFrame, keys: Sequence[str], bucket: str, levels: int) -> DataFrame:
    """Add ``__before``: rows of the group in earlier buckets. Buckets are gathered by ``SPAN`` of
    them, so that sparse buckets, of which a group has very many, are spread as well."""
    if not levels:
        earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        return counted.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    outer = f"{bucket}_"
    spread = counted.withColumn(outer, span_of(bucket))
    inside = (
        Window.partitionBy(*keys, outer).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    )
    spread = spread.withColumn("__near", F.coalesce(F.sum("__rows").over(inside), F.lit(0)))
    sums = spread.groupBy(*keys, outer).agg(F.sum("__rows").alias("__rows"))
    far = _rows_before(sums, keys, outer, levels - 1).select(
        *keys, outer, F.col("__before").alias("__far")
    )
    return (
        null_safe_join(spread, far, [*keys, outer], "inner")
        .withColumn("__before", F.col("__near") + F.col("__far"))
        .drop(outer, "__near", "__far")
    )


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    name: str = "position",
    totals: Mapping[str, tuple[Column, str]] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group.

    ``bucket`` must not decrease along ``order``. ``totals`` adds group-wide values that can
    be merged from buckets: name -> (column, "sum" | "min" | "max").
    """
    totals = totals or {}
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    keyed = df.withColumn("__bucket", bucket)

    per_bucket = keyed.groupBy(*keys, "__bucket").agg(
        F.count(F.lit(1)).alias("__rows"),
        *(merge[how](col).alias(out) for out, (col, how) in totals.items()),
    )
    offsets = _rows_before(per_bucket, keys, "__bucket", levels=1)
    offsets = offsets.select(*keys, "__bucket", "__before")
    if totals:
        whole = keyed.groupBy(*keys).agg(
            *(merge[how](col).alias(out) for out, (col, how) in totals.items())
        )
        offsets = null_safe_join(offsets, whole, list(keys), "inner")

    # window and join are partitioned by the same column: the rows are shuffled once
    inside = Window.partitionBy(KEY).orderBy(*order)
    numbered = keyed.withColumn(KEY, F.struct(*keys, "__bucket")).withColumn(
        "__inside", F.row_number().over(inside) - 1
    )
    return (
        null_safe_join(numbered, offsets, [*keys, "__bucket"], "inner")
        .withColumn(name, (F.col("__before") + F.col("__inside")).cast("long"))
        .drop("__bucket", "__inside", "__before")
    )

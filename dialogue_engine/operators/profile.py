"""Looking at a table: rows, columns, distributions, lengths."""

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.functions.rounding import py_round
from dialogue_engine.functions.text import char_length, word_count

# Keys that cut a range in two or more, per pass; rows before a position that may be gathered.
PREVIEW_BOUNDS = 8
PREVIEW_ROWS = 10_000
# Size of a distinct-count sketch as a power of two, and of a quantile sketch.
DISTINCT_LG_K = 14
QUANTILE_K = 400
_COUNTED = {"instructions": "instruction", "templates": "response", "flags": "flags"}


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows of the table, rows with a value."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)),
    )
    described = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("rows"),
            F.col(f"c{i}").alias("filled"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*described)))


def _rows_from(df: DataFrame, order_by: Sequence[str], first: int, rows: int) -> DataFrame:
    """The rows at the positions from ``first`` on, read from the range of keys that has them.

    Keys of a few rows drawn at random cut the range; one pass counts the rows equal to each of
    them and between two of them, and the part with position ``first`` becomes the next range. A
    pass reads the key columns of its range alone, and the driver sees keys and counts. It ends
    when the part is one key, of whose rows any will do, or begins shortly before ``first``.
    """
    key = F.struct(*order_by)
    leading = F.col(order_by[0])

    def value(bound: Row) -> Column:
        types = (df.schema[c].dataType for c in order_by)
        return F.struct(*(F.lit(v).cast(t).alias(c) for c, v, t in zip(order_by, bound, types)))

    def above(found: DataFrame, bound: Row, itself: bool) -> DataFrame:
        found = found.where(key >= value(bound) if itself else key > value(bound))
        # what the scan can skip by; nulls come first
        return found if bound[0] is None else found.where(leading >= F.lit(bound[0]))

    def under(found: DataFrame, bound: Row) -> DataFrame:
        found = found.where(key < value(bound))
        return found.where(leading.isNull() | (leading <= F.lit(bound[0])))

    # ``part`` has position ``first``; ``open_part`` goes on to the end of the wanted rows
    part = open_part = df
    below, ceiling = 0, None
    for step in itertools.count():
        keys = part.select(*order_by)
        drawn = keys.orderBy(F.rand(step)).limit(PREVIEW_BOUNDS).distinct().orderBy(*order_by).collect()
        # 0 below the first bound, 1 at it, 2 between it and the next, and so on
        place = sum(
            ((key > value(b)).cast("int") + (key >= value(b)).cast("int") for b in drawn), F.lit(0)
        )
        counts = {r["place"]: r["count"] for r in keys.groupBy(place.alias("place")).count().collect()}
        starts = list(itertools.accumulate((counts.get(p, 0) for p in range(2 * len(drawn) + 1)), initial=below))
        if starts[-1] <= first:
            return df.limit(0)
        at = max(p for p in range(2 * len(drawn) + 1) if starts[p] <= first < starts[p + 1])
        ceiling = next((drawn[p // 2] for p in range(at + 1 + at % 2, 2 * len(drawn), 2) if starts[p] >= first + rows), ceiling)
        below = starts[at]
        if at % 2:
            bound = drawn[at // 2]
            wanted = min(rows, starts[at + 1] - first)
            equal = above(open_part, bound, True).where(key == value(bound)).limit(wanted)
            rest = above(open_part, bound, False)
            rest = rest if ceiling is None else under(rest, ceiling)
            return equal.unionByName(rest).orderBy(*order_by).limit(rows)
        if at:
            part = above(part, drawn[at // 2 - 1], False)
            open_part = above(open_part, drawn[at // 2 - 1], False)
        if first - below <= PREVIEW_ROWS:
            found = open_part if ceiling is None else under(open_part, ceiling)
            return found.orderBy(*order_by).offset(first - below).limit(rows)
        if at < 2 * len(drawn):
            part = under(part, drawn[at // 2])


def preview(
    df: DataFrame, rows: int, order_by: Sequence[str | Column], offset: int = 0
) -> DataFrame:
    """Rows by position in a stated order.

    The first rows are found in each task and merged. Far from the start that would gather all the
    rows before; there, for plain ascending columns, the range of keys that has the positions is
    found first, and no more than it is read.
    """
    if offset > PREVIEW_ROWS and all(isinstance(c, str) for c in order_by):
        return _rows_from(df, list(order_by), offset, rows)
    ordered = df.orderBy(*order_by)
    return (ordered.offset(offset) if offset else ordered).limit(rows)


def distribution(
    cases: DataFrame,
    by: Sequence[str] = ("category", "intent"),
    approx: bool = False,
    totals: bool = False,
) -> DataFrame:
    """Cases, share of all cases, and distinct instructions, responses and flags per group.

    Distinct texts are counted by their md5, so that the shuffle moves 32 characters per text;
    it is keyed by the text as well as the group, so a large group is spread. ``approx`` counts
    them by sketches of a fixed size, which leaves one row per group and task to move; the counts
    are then off by 1 % or so.

    ``totals`` adds a row for every prefix of ``by``, the whole table included, with null in the
    columns that are summed up. ``level``, the number of columns that are not, tells them
    from groups whose value is missing.
    """
    if approx:
        return estimated_distribution(distribution_sketches(cases, by), by, totals)
    if totals:
        return _distribution_totals(cases, by)
    narrow = cases.select(
        *by,
        F.md5("instruction").alias("instruction"),
        F.md5("response").alias("response"),
        "flags",
    )
    groups = narrow.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_distinct("instruction").alias("instructions"),
        F.count_distinct("response").alias("templates"),
        F.count_distinct("flags").alias("flags"),
    )
    # the groups are few, and their counts add up to the total
    total = F.sum("cases").over(Window.partitionBy())
    return groups.withColumn("share", py_round(F.col("cases") / total, 4))


def _rolled_up(by: Sequence[str]) -> list[Column]:
    """The row of a group and of every total it adds to, as structs of ``level`` and ``by``."""
    return [
        F.struct(
            F.lit(level).alias("level"),
            *((F.col(c) if i < level else F.lit(None).cast("string")).alias(c) for i, c in enumerate(by)),
        )
        for level in range(len(by), -1, -1)
    ]


def _distribution_totals(cases: DataFrame, by: Sequence[str]) -> DataFrame:
    narrow = cases.select(
        *(F.col(c).cast("string").alias(c) for c in by),
        F.md5("instruction").alias("instruction"),
        F.md5("response").alias("response"),
        "flags",
    )
    level = F.lit(len(by)) - sum((F.grouping(c).cast("int") for c in by), F.lit(0))
    groups = narrow.rollup(*by).agg(
        level.alias("level"),
        F.count(F.lit(1)).alias("cases"),
        *(F.count_distinct(column).alias(name) for name, column in _COUNTED.items()),
    )
    return _with_share(groups, by)


def _with_share(groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of all cases; the groups are few."""
    total = F.sum(F.when(F.col("level") == len(by), F.col("cases"))).over(Window.partitionBy())
    return groups.select(
        "level", *by, "cases", *_COUNTED, py_round(F.col("cases") / total, 4).alias("share")
    )


def distribution_sketches(
    cases: DataFrame, by: Sequence[str] = ("category", "intent"), lg_k: int = DISTINCT_LG_K
) -> DataFrame:
    """Per group the number of cases and a sketch of each distinct count, to be stored per load.

    Sketches of several loads add up: union the rows and give them to ``estimated_distribution``.
    """
    return cases.groupBy(*(F.col(c).cast("string").alias(c) for c in by)).agg(
        F.count(F.lit(1)).alias("cases"),
        *(F.hll_sketch_agg(F.col(column), lg_k).alias(name) for name, column in _COUNTED.items()),
    )


def estimated_distribution(
    sketches: DataFrame, by: Sequence[str] = ("category", "intent"), totals: bool = False
) -> DataFrame:
    """The distribution that the sketches of any number of loads add up to."""
    levels = _rolled_up(by) if totals else _rolled_up(by)[:1]
    groups = (
        sketches.select(F.explode(F.array(*levels)).alias("__group"), "cases", *_COUNTED)
        .groupBy("__group")
        .agg(
            F.sum("cases").alias("cases"),
            *(F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in _COUNTED),
        )
        .select("__group.*", "cases", *_COUNTED)
    )
    found = _with_share(groups, by)
    return found if totals else found.drop("level")


def _lengths(cases: DataFrame, columns: Sequence[str]) -> DataFrame:
    lengths = F.array(
        *(F.struct(F.lit(c).alias("column"), char_length(F.col(c)).alias("chars")) for c in columns)
    )
    return cases.select(F.inline(lengths))


def length_sketches(
    cases: DataFrame, columns: Sequence[str] = ("instruction", "response"), k: int = QUANTILE_K
) -> DataFrame:
    """Per text column smallest and largest length and a quantile sketch, to be stored per load.

    Sketches of several loads add up: union the rows and give them to ``estimated_lengths``.
    """
    return _lengths(cases, columns).groupBy("column").agg(
        F.min("chars").alias("length_min"),
        F.max("chars").alias("length_max"),
        F.kll_sketch_agg_bigint("chars", k).alias("sketch"),
    )


def estimated_lengths(
    sketches: DataFrame, percentiles: Sequence[float] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """The length profile that the sketches of any number of loads add up to."""
    merged = sketches.groupBy("column").agg(
        F.min("length_min").alias("length_min"),
        F.max("length_max").alias("length_max"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )
    return merged.select(
        "column",
        "length_min",
        "length_max",
        *(
            F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).cast("double").alias(f"p{round(p * 100)}")
            for p in percentiles
        ),
    )


def length_profile(
    cases: DataFrame,
    columns: Sequence[str] = ("instruction", "response"),
    percentiles: Sequence[float] = (0.5, 0.95, 0.99),
    approx: bool = False,
) -> DataFrame:
    """Smallest, largest and percentile lengths (one digit) per text column.

    Percentiles are exact: cases are first counted per length, which leaves one row per
    different length. With ``approx`` they are lengths of the data whose rank is off by less than
    1 %, from sketches of a fixed size.
    """
    if approx:
        return estimated_lengths(length_sketches(cases, columns), percentiles)
    histogram = _lengths(cases, columns).groupBy("column", "chars").count()
    return histogram.groupBy("column").agg(
        F.min("chars").alias("length_min"),
        F.max("chars").alias("length_max"),
        *(
            py_round(F.percentile("chars", F.lit(p), F.col("count")), 1).alias(f"p{round(p * 100)}")
            for p in percentiles
        ),
    )


def truncation_monitor(
    cases: DataFrame,
    text: Column,
    max_tokens: int = C.MAX_SEQ_LENGTH,
    by: Sequence[str] = ("intent",),
    tokens=word_count,
) -> DataFrame:
    """Cases per group that are longer than the sequence limit. ``tokens`` is a length function
    on a column; words are only an estimate of what a tokenizer counts."""
    return (
        cases.select(*by, tokens(text).alias("tokens"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("cases"),
            F.max("tokens").alias("tokens_max"),
            F.count_if(F.col("tokens") > max_tokens).alias("truncated"),
            py_round(F.avg((F.col("tokens") > max_tokens).cast("int")), 4).alias("truncated_share"),
        )
    )


def longest_cases(
    cases: DataFrame, k: int, column: str = "response", id_col: str = "case_id"
) -> DataFrame:
    return (
        cases.withColumn("chars", char_length(F.col(column)))
        .orderBy(F.col("chars").desc(), id_col)
        .limit(k)
    )

"""Seeded splits.

The order of the rows is that of ``md5("seed:id")``, with the id as tie-break. It does not
depend on the partitioning. A split is a cut in this order, found without sorting the table:
counts per hash prefix say which prefix holds the cut, and only the rows of that prefix
(1/65,536 of the group) are ranked. The table itself is filtered by comparing with the cut.
"""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.operators.positions import null_safe_join
from dialogue_engine.scratch import written

# Characters of the hash that are counted: 65,536 prefixes, so 10^11 rows leave 1.5 million to rank.
PREFIX_CHARS = 4


def order_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def part_size(total: Column, share: float) -> Column:
    """ceil(share * total) in exact decimals."""
    exact = F.lit(Decimal(str(share))).cast("decimal(9,6)")
    return F.ceil(exact * total.cast("decimal(20,0)")).cast("long")


def _cuts(df: DataFrame, id_col: str, seed: int, by: Sequence[str], size) -> DataFrame:
    """One row per group: hash and id of the last row that belongs to the first part.

    ``size`` maps the number of rows of a group to the size of its first part.
    """
    ordered = df.select(
        *by, order_hash(id_col, seed).alias("cut_hash"), F.col(id_col).alias("cut_id")
    ).withColumn("prefix", F.substring("cut_hash", 1, PREFIX_CHARS))

    group = Window.partitionBy(*by)
    counted = (
        ordered.groupBy(*by, "prefix")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(group.orderBy("prefix")))
        .withColumn("wanted", size(F.sum("rows").over(group)))
    )
    edge = counted.where("upto >= wanted and upto - rows < wanted").select(
        *by, "prefix", (F.col("wanted") - F.col("upto") + F.col("rows")).alias("nth")
    )
    rank = F.row_number().over(
        Window.partitionBy(*by, "prefix").orderBy("cut_hash", "cut_id")
    )
    return (
        null_safe_join(ordered, written(edge), [*by, "prefix"], "inner")
        .withColumn("rank", rank)
        .where("rank = nth")
        .select(*by, "cut_hash", "cut_id")
    )


def _up_to_cut(id_col: str, seed: int, cut_hash: Column, cut_id: Column) -> Column:
    row_hash = order_hash(id_col, seed)
    inside = (row_hash < cut_hash) | ((row_hash == cut_hash) & (F.col(id_col) <= cut_id))
    return F.coalesce(inside, F.lit(False))


def _flag_first(df: DataFrame, id_col: str, seed: int, size, flag: str) -> DataFrame:
    cut = written(_cuts(df, id_col, seed, [], size))
    cut_hash, cut_id = cut.select("cut_hash").scalar(), cut.select("cut_id").scalar()
    return df.withColumn(flag, _up_to_cut(id_col, seed, cut_hash, cut_id))


def random_split(
    df: DataFrame,
    test_size: float = C.TEST_SIZE,
    seed: int = C.SEED,
    id_col: str = "case_id",
    approx: bool = False,
) -> DataFrame:
    """Add ``is_eval``: exactly ceil(test_size * n) rows, the rest is the training part.

    With ``approx`` the hash alone decides: no pass over the ids, and a size that is only
    close to the wanted one. ``id_col`` must be unique.
    """
    if approx:
        share = F.conv(F.substring(order_hash(id_col, seed), 1, 8), 16, 10).cast("long")
        return df.withColumn("is_eval", share < int(test_size * 2**32))
    return _flag_first(df, id_col, seed, lambda total: part_size(total, test_size), "is_eval")


def stratified_split(
    df: DataFrame,
    by: Sequence[str],
    test_size: float = C.TEST_SIZE,
    seed: int = C.SEED,
    id_col: str = "case_id",
) -> DataFrame:
    """``random_split`` inside each stratum, so that every stratum is in the eval part."""
    cuts = written(_cuts(df, id_col, seed, by, lambda total: part_size(total, test_size)))
    flag = _up_to_cut(id_col, seed, F.col("cut_hash"), F.col("cut_id"))
    return (
        null_safe_join(df, cuts, list(by), "left")
        .withColumn("is_eval", flag)
        .drop("cut_hash", "cut_id")
    )


def split_parts(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The training and the eval part of a flagged table. Training is what eval leaves."""
    rows = flagged.drop("is_eval")
    return rows.where(~flagged["is_eval"]), rows.where(flagged["is_eval"])


def first_rows(df: DataFrame, rows: int, seed: int = C.SEED, id_col: str = "case_id") -> DataFrame:
    """The first min(rows, n) rows in seeded order, filtered in place at every size."""

    def size(total):
        return F.least(total, F.lit(rows).cast("long"))

    flagged = _flag_first(df, id_col, seed, size, "__first")
    return flagged.where("__first").drop("__first")


def subset(
    train: DataFrame,
    evaluation: DataFrame,
    rows: int,
    seed: int = C.SEED,
    id_col: str = "case_id",
    eval_rows: int = C.EVAL_SUBSET_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """A small training and eval part for a quick run. Map the rows after this, not before."""
    return (
        first_rows(train, rows, seed, id_col),
        first_rows(evaluation, eval_rows, seed, id_col),
    )


def review_sample(
    df: DataFrame, rows: int = 30, seed: int = C.SEED, id_col: str = "case_id"
) -> DataFrame:
    """Rows for reading by hand."""
    return first_rows(df, rows, seed, id_col)


def eval_coverage(train: DataFrame, evaluation: DataFrame, column: str = "intent") -> DataFrame:
    """Values of the training part that have no eval example."""
    wanted = train.select(column).distinct()
    covered = evaluation.select(F.col(column).alias("__covered")).distinct()
    same = wanted[column].eqNullSafe(covered["__covered"])
    return wanted.join(covered, same, "left_anti")

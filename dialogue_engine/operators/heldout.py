"""Test prompts must not come from the training data."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.functions.rounding import py_round
from dialogue_engine.functions.text import normalised, strip_unicode, text_or_empty

NGRAM = 8
# Size of the pre-filter of asked n-grams, the same whatever their number: half a megabyte in a task.
BLOOM_BITS = 1 << 22
# Prompts of more text than this would set so many bits that the filter keeps most of the data.
BLOOM_TEXT = BLOOM_BITS
# Bytes of text whose n-grams meet in one task, so that it sorts them in memory.
TASK_TEXT = 1 << 23


def held_out(
    prompts: DataFrame, cases: DataFrame, prompt: str = "prompt", instruction: str = "instruction"
) -> DataFrame:
    """Prompts whose text, apart from case and blanks, is no instruction of the data.

    Only hashes of the data's texts are moved, each once per task: an instruction that makes up
    a third of the data is one row from every task. Each text is normalised once.
    """
    known = cases.select(F.md5(normalised(F.col(instruction))).alias("__key")).distinct()
    keyed = prompts.withColumn("__key", F.md5(normalised(F.col(prompt))))
    return keyed.join(known, "__key", "left_anti").drop("__key")


def _with_grams(df: DataFrame, text: str, n: int, *keep: str) -> DataFrame:
    """(keep, __grams): hashes of the different runs of n words; of the whole text, if it has fewer;
    none without words.

    Each word is hashed once. Hashes of runs of 2, 4, 8, .. words are made from those of half as
    many, and a run of n from the powers of two in n, so a run costs a few hashes of two numbers and
    no string. The words are those of ``normalised``, without building that text.
    """
    # ranges, which the pattern compiler makes a table of where it can
    codes = [ord(c) for c in C.BLANK_CHARS]
    firsts = [c for c in codes if c - 1 not in codes]
    lasts = [c for c in codes if c + 1 not in codes]
    blanks = "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(firsts, lasts)) + "]+"
    stripped = strip_unicode(F.lower(text_or_empty(F.col(text))))
    words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, blanks))
    hashed = df.select(*keep, words.alias("__w")).select(
        *keep, F.transform("__w", lambda w: F.xxhash64(w)).alias("__run1")
    )

    def joined(first: str, second: str, apart: int) -> Column:
        """Runs of the first kind, each with the run of the second kind that many words on."""
        count = F.greatest(F.size(second) - apart, F.lit(0))
        ahead = F.slice(second, F.lit(apart + 1), count)
        return F.zip_with(F.slice(first, F.lit(1), count), ahead, lambda a, b: F.xxhash64(a, b))

    # every step is a projection of its own, so that nothing is computed twice
    power = 1
    while power * 2 <= n:
        hashed = hashed.withColumn(
            f"__run{power * 2}", joined(f"__run{power}", f"__run{power}", power)
        )
        power *= 2
    done, name = power, f"__run{power}"
    while done < n:
        power //= 2
        if n - done >= power:
            hashed = hashed.withColumn("__runs", joined(name, f"__run{power}", done))
            done, name = done + power, "__runs"
    size = F.size("__run1")
    grams = F.when(size == 0, F.array().cast("array<bigint>"))
    grams = grams.when(size < n, F.array(F.xxhash64("__run1")))
    return hashed.select(*keep, grams.otherwise(F.array_distinct(name)).alias("__grams"))


def _each(df: DataFrame, *keep: str) -> DataFrame:
    """A row per n-gram, and one with null for a text without any. Spark would test an inner explode
    for empty arrays before it makes them, and work out every step of theirs again for that."""
    return df.select(*keep, F.explode_outer("__grams").alias("__gram"))


def _slot(gram: Column) -> Column:
    """The bit of an n-gram in the pre-filter."""
    return F.pmod(gram, F.lit(BLOOM_BITS))


def _set_bits(grams: DataFrame) -> Column:
    """An array of 64-bit numbers in which every n-gram has set its bit, as a scalar subquery."""
    spark = grams.sparkSession
    parts = (
        grams.where(F.col("__gram").isNotNull())
        .select(_slot(F.col("__gram")).alias("slot"))
        .selectExpr("slot div 64 as id", "shiftleft(1L, cast(slot % 64 as int)) as bit")
        .groupBy("id")
        .agg(F.bit_or("bit").alias("bits"))
    )
    every = spark.range(BLOOM_BITS // 64).join(parts, "id", "left")
    part = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return every.agg(F.sort_array(F.collect_list(part))["bits"].alias("bits")).scalar()


def _text_size(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def _tasks(text: int, spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-text // TASK_TEXT))


def held_out_overlap(
    prompts: DataFrame,
    cases: DataFrame,
    n: int = NGRAM,
    prompt: str = "prompt",
    instruction: str = "instruction",
    id_col: str = "prompt_id",
) -> DataFrame:
    """Per prompt how many of its different word n-grams the data has: (id, ngrams, found, share).

    ``id_col`` must be unique. A prompt without words has no n-grams and the share 0. N-grams are
    compared by 64-bit hashes, which is all that moves.

    Unless the prompts are large themselves (``BLOOM_TEXT``), a bit array of their n-grams, of a
    fixed size, is looked into where the data is, and little more than what was asked for moves
    at all, each once per task. The hashes of large prompts and of their data are dealt out over as
    many tasks as their text asks for (``TASK_TEXT``), where they are made distinct and sorted in
    memory; made distinct before, those of a task's whole input would go to disk. The result does
    not depend on either.
    """
    asked = _each(_with_grams(prompts, prompt, n, id_col), id_col)
    known = _each(_with_grams(cases, instruction, n)).where(F.col("__gram").isNotNull())
    text = _text_size(prompts, prompt)
    if text > BLOOM_TEXT:
        tasks = _tasks(max(text, _text_size(cases, instruction)), prompts.sparkSession)
        asked, known = (side.repartition(tasks, "__gram") for side in (asked, known))
    else:
        slot = _slot(F.col("__gram"))
        part = F.get(_set_bits(asked), F.floor(slot / 64).cast("int"))
        known = known.where(F.getbit(part, (slot % 64).cast("int")) == 1)
    ngrams, found = F.count("__gram"), F.count("__known")
    share = F.coalesce(found / F.nullif(ngrams, F.lit(0).cast("long")), F.lit(0.0))
    return (
        asked.join(known.distinct().withColumn("__known", F.lit(True)), "__gram", "left")
        .groupBy(id_col)
        .agg(ngrams.alias("ngrams"), found.alias("found"), py_round(share, 4).alias("share"))
    )

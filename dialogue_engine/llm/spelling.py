"""Groups of spelling variants by an index of variable-length grams.

Two words are near when one inserted, deleted or replaced code point turns one into the other.

* **Dictionary.** Grams of two to five code points of the words between ``^`` and ``$``. A gram that
  is frequent is pruned: longer ones take its place. The frequent grams are few by construction:
  a gram counts as frequent above a share of all postings, so at most ``MOST_FREQUENT`` are.
* **Decomposition.** At each position a word has one gram, the shortest that is not frequent (at
  most five long, or to the word's end). Where a gram ends depends on its own letters alone,
  so an edit changes a gram only if it lies within it.
* **Bound.** An edit touches the grams that span its place, and all others stand in every near
  word, at the same position or one moved by the edit. Of a set of grams of a word it can take
  as many as span one place: that is the bound of the set, and a near word has the rest.
* **Lists.** The list of a gram and position has the words with it. For each word the sets whose
  bound is smaller than the set are compared by the length of their lists, and those of the
  cheapest are merged; the others need not be read. Intervals without a common point have two
  that are disjoint, so the cheapest set is a pair of grams that do not overlap, with bound one.
  The first and the last gram of a word of five letters do not, so no word is without a pair.
* **Check.** What the lists give is compared letter by letter.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_engine.scratch import written

LEAST_LENGTH = 5
LEAST_COUNT = 3
# Every so many-th occurrence, by a hash, is read with a letter missing.
MISSPELT = 97
# A form is at least so many times as frequent as its variant.
TIMES = 2
SHORTEST, LONGEST = 2, 5
# Bound on the frequent grams, which every task holds; and a list shorter than this is not frequent.
MOST_FREQUENT = 200_000
LEAST_LIST = 32
# Different words a task counts before it hands them on.
HELD_WORDS = 300_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def runs_of(text: str | None) -> list[str]:
    """The runs of letters of a text; only A-Z become lower case."""
    return _RUN.findall((text or "").encode().lower().decode())


def read_as(doc: str, run: str) -> str:
    """A run as the document ``doc`` has it: now and then without one of its letters."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % MISSPELT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(documents: DataFrame, id_col: str = "doc_id", column: str = "text") -> DataFrame:
    """(word, n): words of at least five letters found at least three times in all texts.

    A null text has no words; a null id counts as an empty one. Repeated rows count each. A task
    counts words before they are shuffled, so a frequent word is a row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def table() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                names=["word", "n"],
            )
            total.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seed = zlib.crc32(f"{doc}:".encode())
                for word, n in Counter(runs_of(text.as_py())).items():
                    if zlib.crc32(word.encode(), seed) % MISSPELT == 0:
                        word = read_as(doc, word)
                    if len(word) >= LEAST_LENGTH:
                        total[word] += n
                if len(total) >= HELD_WORDS:
                    yield table()
        if total:
            yield table()

    ids = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return (
        documents.select(ids.alias("doc"), F.col(f"`{column}`").alias("text"))
        .mapInArrow(run, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


def frequent_grams(words: DataFrame, least: int = LEAST_LIST, most: int = MOST_FREQUENT) -> set[str]:
    """The grams with more postings than a share of all that lets no more than ``most`` through."""
    framed = F.concat(F.lit("^"), F.col("word"), F.lit("$"))

    def of_size(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("t") - size + 1)
        return F.transform(starts, lambda p: F.substring("t", p, size))

    grams = F.flatten(F.array(*map(of_size, range(SHORTEST, LONGEST))))
    lists = words.select(framed.alias("t")).select(F.explode(grams).alias("gram")).groupBy("gram").count()
    postings = words.agg(F.sum((F.length("word") + 2) * (LONGEST - SHORTEST))).first()[0] or 0
    above = max(least, postings // most)
    return {r["gram"] for r in lists.where(F.col("count") > above).select("gram").collect()}


def decompose(word: str, frequent: set[str]) -> list[str]:
    """The gram at each position of ``^word$``."""
    framed = f"^{word}$"
    size = len(framed)
    grams = []
    for p in range(size - SHORTEST + 1):
        end = p + SHORTEST
        while end < min(size, p + LONGEST) and framed[p:end] in frequent:
            end += 1
        grams.append(framed[p:end])
    return grams


def cheapest(sizes: list[int], lengths: list[int]) -> tuple[int, int]:
    """The two positions whose grams, of the given sizes, do not overlap and whose lists are the
    shortest together."""
    by_end = sorted(range(len(sizes)), key=lambda p: p + sizes[p])
    best, ended, total, pair = -1, 0, float("inf"), (-1, -1)
    for p, length in enumerate(lengths):
        while ended < len(by_end) and by_end[ended] + sizes[by_end[ended]] <= p:
            before = by_end[ended]
            if best < 0 or lengths[before] < lengths[best]:
                best = before
            ended += 1
        if best >= 0 and lengths[best] + length < total:
            total, pair = lengths[best] + length, (best, p)
    return pair


def _places(words: DataFrame, frequent: set[str]) -> DataFrame:
    """(word, n, p, gram): a row per gram of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [decompose(w, frequent) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(grams, pa.list_(pa.string()))],
                names=[*batch.schema.names, "grams"],
            )

    split = words.mapInArrow(run, "word string, n long, grams array<string>")
    return split.select("word", "n", F.posexplode("grams").alias("p", "gram"))


def _place(gram: Column | str, p: Column) -> Column:
    """A gram at a position, as a hash. Two with one hash would share a list, and what they have in
    common is checked like all else."""
    return F.xxhash64(gram, p)


def merged_lists(places: DataFrame) -> DataFrame:
    """(word, n, place, next_place) of the two lists to merge for each word; ``next_place`` is the
    gram's place one position on."""
    here = _place("gram", F.col("p")).alias("place")
    lists = places.groupBy(here).agg(F.count(F.lit(1)).alias("length"))
    entry = F.struct("p", F.length("gram").alias("size"), "length", "place", "next_place")
    gathered = (
        places.select(
            "word", "n", "p", "gram", here, _place("gram", F.col("p") + 1).alias("next_place")
        )
        .join(lists, "place")
        .groupBy("word", "n")
        .agg(F.array_sort(F.collect_list(entry)).alias("all"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.column("all")
            starts, rows = entries.offsets.to_numpy(), entries.values
            sizes, lengths = (rows.field(n).to_pylist() for n in ("size", "length"))
            chosen = []
            for low, high in zip(starts[:-1], starts[1:]):
                chosen += [int(low) + p for p in cheapest(sizes[low:high], lengths[low:high])]
            owner = pa.array([i for i in range(batch.num_rows) for _ in (0, 1)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word").take(owner),
                    batch.column("n").take(owner),
                    *(rows.field(n).take(pa.array(chosen, pa.int64())) for n in ("place", "next_place")),
                ],
                names=["word", "n", "place", "next_place"],
            )

    return gathered.mapInArrow(run, "word string, n long, place long, next_place long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all near words, each pair in both directions.

    ``words`` has (word, n), each word once and with at least five letters.
    """
    places = written(_places(words, frequent_grams(words)))
    merged = merged_lists(places)

    def listed(place: str, longer: int) -> Column:
        """The list of the words with a gram at a place and of one length, and what such a word has
        to compare with: 16 bits each for as many letters at its start and at its end as one
        edit cannot touch both."""
        size = F.length("word") + longer
        letters = F.floor((size - 1) / 2).cast("int")
        ends = [F.hash(end("word", letters)).bitwiseAND(0xFFFF) for end in (F.left, F.right)]
        return F.struct(
            F.xxhash64(place, size).alias("list"), F.shiftleft(ends[0], 16).bitwiseOR(ends[1]).alias("ends")
        )

    # where a near word that is as long, or one longer, has the gram
    asked = merged.select(
        "word",
        "n",
        F.inline(F.array(listed("place", 0), listed("place", 1), listed("next_place", 1))),
    )
    index = (
        places.withColumn("place", _place("gram", F.col("p")))
        .select(F.col("word").alias("other"), F.col("n").alias("other_n"), listed("place", 0).alias("in"))
        .select("other", "other_n", "in.list", F.col("in.ends").alias("other_ends"))
    )
    unlike = F.col("ends").bitwiseXOR(F.col("other_ends"))
    found = (
        asked.join(index, "list")
        .where((unlike.bitwiseAND(0xFFFF) == 0) | (F.shiftrightunsigned(unlike, 16) == 0))
        .where((F.length("other") > F.length("word")) | (F.col("word") < F.col("other")))
        .where(F.levenshtein("word", "other", 1) == 1)
        .select("word", "n", "other", "other_n")
        .distinct()
    )
    pairs = written(found)
    return pairs.unionByName(
        pairs.select(
            F.col("other").alias("word"),
            F.col("other_n").alias("n"),
            F.col("word").alias("other"),
            F.col("n").alias("other_n"),
        )
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each (word, form): the last word reached by following forms.

    A form is at least twice as frequent as its word, so no path is a circle or longer than the
    logarithm of the largest count, and each round doubles the steps made.
    """
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(step, "root", "left")
        after = written(
            joined.select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            )
        )
        now = after.drop("moved")
        if after.where("moved").isEmpty():
            return now


def spelling_variants(
    documents: DataFrame, id_col: str = "doc_id", column: str = "text"
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    ``form`` is the near word with the largest n, the first in code-point order of several, if its n
    is at least twice that of the word; else null. ``root`` is what following forms leads to, the
    word itself without a form. Empty tables and texts without words give no rows.
    """
    words = written(word_counts(documents, id_col, column))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = (
        near_pairs(words)
        .groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form", "n")
    )
    frequent_enough = F.col("form_n") >= TIMES * F.col("n")
    near = written(
        near.select(
            "word",
            "n_near",
            F.when(frequent_enough, F.col("form")).alias("form"),
            F.when(frequent_enough, F.col("form_n")).alias("form_n"),
        )
    )
    ends = roots(near.where("form is not null"))
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )

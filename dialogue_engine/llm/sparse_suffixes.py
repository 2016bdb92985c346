"""Passages of 50 words or more that occur again, by sparse suffix arrays.

Only suffixes at content-selected positions are kept: of every 26 neighbouring runs of 25 words,
the start of the run with the smallest hash (a minimiser). A passage of 50 words has 26 such runs,
so each of its copies keeps a suffix at the same place inside it, with the same run. All
windows of 50 words around that suffix reach at most 25 words to its left and 50 to its right:
these 75 words are its context, and with them every match of the suffix can be found.

1. Each text gives its suffixes (run, hash of the context, place), about one row per 13 words.
   Suffixes with one context are one entry from then on: a passage that a third of all documents
   have is a row per task before anything moves. Runs at one place only go no further.
2. For a run with different contexts the entries are sorted by the words to the right, neighbours
   are compared for their common length, and so are they when sorted by the words to the left.
   Entries that share l words to the left lie in one interval of the second order, those that
   share 50 - l to the right in one of the first, and two entries in both intervals match over 50
   words. So a longer one-sided match with another text hides nothing.
3. The matches go back to the suffixes with that context, are put in order per document and
   merged into passages.

Entries of one run meet in one task, which sees one run after the other. Runs with very many
contexts (``MOST_ENTRIES``) would not fit there; the 26 windows around their entries are compared
by hash instead, in a grouping that Spark spreads, with the same result. Words are compared by
64-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogue_engine.llm.tables import dealt, document_key
from dialogue_engine.llm.words import as_bytes, blocks, mix, signed, windows, word_hashes
from dialogue_engine.scratch import written

PASSAGE = 50
RUN = 25
CHOICE = PASSAGE - RUN + 1
# Words of a context to the left of the suffix, and to the right of its run.
SIDE = PASSAGE - RUN
# Entries of one run that one task compares.
MOST_ENTRIES = 20_000
# Rows handed on at once.
ROWS = 4096
# A bit for each number of words, 0 to 25, that a window reaches to the left of the suffix.
ALL = (1 << CHOICE) - 1

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_PLACE = "doc_id bigint, text_hash bigint, at int"


def _smallest(runs: np.ndarray) -> np.ndarray:
    """For every ``CHOICE`` neighbouring hashes the position of the smallest; of equals the first."""
    if len(runs) < CHOICE:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(runs, CHOICE).argmin(1)
    return least + np.arange(len(least))


def minimisers(runs: np.ndarray) -> np.ndarray:
    """Positions of the smallest of every ``CHOICE`` neighbouring hashes, each once."""
    places = _smallest(runs)
    if not len(places):
        return places
    return places[np.append(True, places[1:] != places[:-1])]


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(max(count, 1), base % 2**64, _U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def range_hashes(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of ``sizes[i]`` neighbouring words from ``starts[i]`` on, any ranges, from prefix sums."""
    sums = np.zeros(len(hashes) + 1, _U64)
    np.cumsum(hashes * _powers(_BASE, len(hashes))[: len(hashes)], out=sums[1:])
    back = _powers(pow(_BASE, -1, 2**64), len(hashes) + 1)
    ranges = (sums[starts + sizes] - sums[starts]) * back[starts]
    return mix(ranges + sizes.astype(_U64) * _U64(_BASE))


def suffixes(documents: DataFrame) -> DataFrame:
    """(run, context, place, n_left, n_right): the kept suffixes of every text, with the number of
    words of their context that the text has on either side of the suffix's first word."""
    names = ["run", "context", "doc_id", "text_hash", "at", "n_left", "n_right"]

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            ids, text_hashes = batch.column("key").flatten()
            for first, last in blocks(texts):
                hashes, bounds = word_hashes(texts[first:last])
                runs = windows(hashes, RUN)
                places = [
                    low + minimisers(runs[low : max(low, high - RUN + 1)])
                    for low, high in zip(bounds[:-1], bounds[1:])
                ]
                counts = [len(p) for p in places]
                if not sum(counts):
                    continue
                at = np.concatenate(places)
                low, high = np.repeat(bounds[:-1], counts), np.repeat(bounds[1:], counts)
                left, right = np.minimum(at - low, SIDE), np.minimum(high - at, PASSAGE)
                # contexts at the ends of a text are shorter, and those of other lengths are others
                context = range_hashes(hashes, at - left, left + right)
                context = mix(context ^ mix(left.astype(_U64) << _U64(8)))
                owner = pa.array(np.repeat(np.arange(first, last), counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(runs[at])),
                        pa.array(signed(context)),
                        ids.take(owner),
                        text_hashes.take(owner),
                        pa.array((at - low).astype(np.int32)),
                        pa.array(left.astype(np.int8)),
                        pa.array(right.astype(np.int8)),
                    ],
                    names=names,
                )

    return documents.select(document_key().alias("key"), "text").mapInArrow(
        kept, f"run bigint, context bigint, {_PLACE}, n_left tinyint, n_right tinyint"
    )


def entries(found: DataFrame) -> DataFrame:
    """(run, context, place, many, contexts): every context of the runs that occur at two places or
    more, with its first place, whether it has another, and how many contexts its run has."""
    place = F.struct("doc_id", "text_hash", "at")
    each = found.groupBy("run", "context").agg(
        F.min(place).alias("place"), F.max(place).alias("last")
    )
    runs = (
        each.groupBy("run")
        .agg(F.min("place").alias("lo"), F.max("last").alias("hi"), F.count(F.lit(1)).alias("contexts"))
        .where("lo < hi")
        .select("run", "contexts")
    )
    return each.join(dealt(runs), "run").select(
        "run", "context", "place", (F.col("place") < F.col("last")).alias("many"), "contexts"
    )


_ENTRY = f"run bigint, context bigint, many boolean, {_PLACE}, n_left int, n_right int, words binary"


def _with_words(documents: DataFrame, listed: DataFrame) -> DataFrame:
    """The entries with the hashes of their words: 25 to the left, nearest first, and 25 from the end
    of the run on. Only texts that are the first place of an entry are read again."""
    wanted = listed.groupBy(F.struct("place.doc_id", "place.text_hash").alias("key")).agg(
        F.collect_list(F.struct("place.at", "run", "context", "many")).alias("listed")
    )
    names = [part.split()[0] for part in _ENTRY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = np.concatenate([-1 - np.arange(SIDE), RUN + np.arange(SIDE)])
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            ids, text_hashes = batch.column("key").flatten()
            lists = batch.column("listed")
            for first, last in blocks(texts):
                hashes, bounds = word_hashes(texts[first:last])
                for i, low, high in zip(range(first, last), bounds[:-1], bounds[1:]):
                    own = lists[i].values
                    places = own.field("at").to_numpy()
                    for k in range(0, len(places), ROWS):
                        at = places[k : k + ROWS]
                        left = np.minimum(at, SIDE)
                        right = np.minimum(high - low - at, PASSAGE)
                        where = low + at[:, None] + reach
                        there = (where >= low) & (where < high)
                        words = np.where(there, hashes[np.clip(where, 0, len(hashes) - 1)], _U64(0))
                        owner = pa.array(np.full(len(at), i))
                        part = own.slice(k, len(at))
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.field("run"),
                                part.field("context"),
                                part.field("many"),
                                ids.take(owner),
                                text_hashes.take(owner),
                                pa.array(at),
                                pa.array(left.astype(np.int32)),
                                pa.array(right.astype(np.int32)),
                                pa.array([row.tobytes() for row in words], pa.binary()),
                            ],
                            names=names,
                        )

    keyed = documents.select(document_key().alias("key"), "text").join(dealt(wanted), "key")
    # rows that agree in doc_id and text are one document
    return keyed.dropDuplicates(["key"]).mapInArrow(run, _ENTRY)


def _common(run: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of entries by run and words, and of each in that order the number of words that it
    has in common with the one before; -1 for the first entry of a run."""
    order = np.lexsort((*words.T[::-1], run))
    same = words[order][1:] == words[order][:-1]
    common = np.logical_and.accumulate(same, axis=1).sum(1)
    common[run[order][1:] != run[order][:-1]] = -1
    return order, np.append(-1, common)


def matches(
    run: np.ndarray, words: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, rank: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Per entry the bits of the windows that another entry has, and of those that one of a smaller
    ``rank`` has. ``words`` are 25 to the left, nearest first, and 25 to the right of the run."""
    size = len(run)
    by_left, in_common_left = _common(run, words[:, :SIDE])
    by_right, in_common_right = _common(run, words[:, SIDE:])
    repeated, later = np.zeros(size, np.int32), np.zeros(size, np.int32)

    def interval(order: np.ndarray, in_common: np.ndarray, least: int) -> np.ndarray:
        """Number of the interval of entries with ``least`` words in common."""
        numbers = np.empty(size, np.int64)
        numbers[order] = np.cumsum(in_common < least)
        return numbers

    for left in range(CHOICE):
        # the run is part of what is to the right
        right = PASSAGE - left
        has = np.flatnonzero((n_left >= left) & (n_right >= right))
        both = interval(by_left, in_common_left, left) * (size + 1) + interval(
            by_right, in_common_right, right - RUN
        )
        both = both[has]
        order = np.lexsort((rank[has], both))
        again = both[order][1:] == both[order][:-1]
        after = has[order[1:][again]]
        later[after] |= 1 << left
        repeated[after] |= 1 << left
        repeated[has[order[:-1][again]]] |= 1 << left
    return repeated, later


_MATCH = "run bigint, context bigint, repeated int, later int"


def compare(listed: DataFrame) -> DataFrame:
    """(run, context, repeated, later) of entries with words, run after run."""
    names = [part.split()[0] for part in _MATCH.split(", ")]

    def result(rows: pa.Table) -> pa.RecordBatch:
        column = {n: rows.column(n).combine_chunks() for n in rows.column_names}
        words = np.frombuffer(b"".join(column["words"].to_pylist()), _U64).reshape(-1, 2 * SIDE)
        ids = column["doc_id"]
        rank = np.empty(len(words), np.int64)
        rank[
            np.lexsort(
                (
                    column["at"].to_numpy(),
                    column["text_hash"].to_numpy(),
                    ids.fill_null(0).to_numpy(),
                    ids.is_valid().to_numpy(zero_copy_only=False),
                )
            )
        ] = np.arange(len(words))
        repeated, later = matches(
            column["run"].to_numpy(),
            words,
            column["n_left"].to_numpy(),
            column["n_right"].to_numpy(),
            rank,
        )
        repeated[column["many"].to_numpy(zero_copy_only=False)] = ALL
        return pa.RecordBatch.from_arrays(
            [column["run"], column["context"], pa.array(repeated), pa.array(later)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            runs = rows.column("run").to_numpy()
            # the last run may go on in the next batch
            whole = int(np.searchsorted(runs, runs[-1])) if len(runs) else 0
            held = rows.slice(whole)
            if whole:
                yield result(rows.slice(0, whole))
        if held is not None and held.num_rows:
            yield result(held)

    together = listed.repartition("run").sortWithinPartitions("run")
    return together.mapInArrow(run, _MATCH)


def compare_by_window(listed: DataFrame) -> DataFrame:
    """The same for runs with any number of entries: the windows around an entry are rows, grouped by
    their words' hash."""
    names = ["run", "context", "doc_id", "text_hash", "at", "many", "bit", "window"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS // CHOICE):
                rows = batch.slice(k, ROWS // CHOICE)
                words = np.frombuffer(b"".join(rows.column("words").to_pylist()), _U64)
                words = words.reshape(-1, 2 * SIDE)
                # in reading order without the run, which all of them share
                line = np.concatenate([words[:, :SIDE][:, ::-1], words[:, SIDE:]], axis=1)
                left, right = (rows.column(n).to_numpy() for n in ("n_left", "n_right"))
                lefts = np.arange(CHOICE)
                owner, bit = np.nonzero((left[:, None] >= lefts) & (right[:, None] >= PASSAGE - lefts))
                starts = owner * 2 * SIDE + SIDE - bit
                window = range_hashes(line.ravel(), starts, np.full(len(starts), SIDE))
                takes = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(n).take(takes) for n in names[:6]),
                        pa.array(bit.astype(np.int32)),
                        pa.array(signed(window)),
                    ],
                    names=names,
                )

    place = F.struct("doc_id", "text_hash", "at")
    each = listed.mapInArrow(
        run, f"run bigint, context bigint, {_PLACE}, many boolean, bit int, window bigint"
    )
    shared = (
        each.groupBy("run", "bit", "window")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first < last")
        .select("run", "bit", "window", "first")
    )
    mark = F.expr("shiftleft(1, bit)")
    found = (
        each.join(dealt(shared), ["run", "bit", "window"])
        .groupBy("run", "context")
        .agg(
            F.bit_or(mark).alias("repeated"),
            F.bit_or(F.when(place > F.col("first"), mark).otherwise(0)).alias("later"),
        )
    )
    every = listed.select("run", "context", "many")
    return every.join(found, ["run", "context"], "left").select(
        "run",
        "context",
        F.when(F.col("many"), ALL).otherwise(F.coalesce("repeated", F.lit(0))).cast("int").alias("repeated"),
        F.coalesce("later", F.lit(0)).cast("int").alias("later"),
    )


def matched_entries(documents: DataFrame, found: DataFrame, most: int = MOST_ENTRIES) -> DataFrame:
    """(run, context, place, repeated, later) of the entries that have a match."""
    listed = written(entries(found))
    # one context at several places: all of it is repeated, and the first place comes first
    alone = listed.where("contexts = 1").select(
        "run", "context", "place", F.lit(ALL).alias("repeated"), F.lit(0).alias("later")
    )
    several = listed.where("contexts > 1")
    few = several.where(F.col("contexts") <= most)
    results = compare(_with_words(documents, few))
    many = several.where(F.col("contexts") > most)
    if not many.isEmpty():
        results = results.unionByName(compare_by_window(written(_with_words(documents, many))))
    compared = several.select("run", "context", "place").join(
        results.where("repeated <> 0"), ["run", "context"]
    )
    return alone.unionByName(compared)


def _span(n_left: Column, n_right: Column) -> Column:
    """The bits of the windows that lie in the text."""
    least = F.greatest(F.lit(PASSAGE) - n_right, F.lit(0))
    bits = F.call_function("shiftleft", F.lit(1), n_left + 1) - F.call_function("shiftleft", F.lit(1), least)
    return F.when(least <= n_left, bits).otherwise(0)


_PASSAGES = "doc_id bigint, text_hash bigint, start_word int, n_words int, later_words int"


def _passages(marked: DataFrame) -> DataFrame:
    """Windows of one document put in order and merged where they touch."""
    names = [part.split()[0] for part in _PASSAGES.split(", ")]

    def covered(starts: np.ndarray) -> np.ndarray:
        """Words that each window adds to those before it."""
        return np.minimum(np.diff(starts, prepend=starts[0] - PASSAGE), PASSAGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(CHOICE)
        for batch in batches:
            rows = []
            ids, text_hashes = (c.to_pylist() for c in batch.column("key").flatten())
            for doc, text, marks in zip(ids, text_hashes, batch.column("marks")):
                at, repeated, later = (
                    marks.values.field(n).to_numpy() for n in ("at", "repeated", "later")
                )
                own, bit = np.nonzero(repeated[:, None] >> bits & 1)
                starts = np.unique(at[own] - bit)
                own, bit = np.nonzero(later[:, None] >> bits & 1)
                again = np.unique(at[own] - bit)
                cuts = np.append(0, np.flatnonzero(np.diff(starts) > PASSAGE) + 1)
                added = covered(again) if len(again) else again
                within = np.searchsorted(starts[cuts], again, side="right") - 1
                words = np.bincount(within, added, len(cuts)).astype(int)
                ends = np.append(starts[cuts[1:] - 1], starts[-1]) + PASSAGE
                for start, end, n in zip(starts[cuts].tolist(), ends.tolist(), words.tolist()):
                    rows.append((doc, text, start, end - start, n))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    return marked.mapInArrow(run, _PASSAGES)


def repeated_passages(documents: DataFrame, most: int = MOST_ENTRIES) -> DataFrame:
    """(doc_id, text_hash, start_word, n_words, later_words) per repeated passage of a text.

    A passage is what windows of 50 words that occur at another place make up together.
    ``later_words`` is how much of it lies in windows that an earlier place has, by (doc_id, hash of
    the text, position); removing these words leaves the first copy of everything. Places may
    overlap: of a word that stands 20,000 times in a row all but the first are in a window that
    an earlier place has. Words are those between white space, as they are written. A text of fewer
    than 50 words, an empty or null one has no passages. Rows that agree in doc_id and text are one
    document and do not repeat each other; null ids are ids like others, and come first. A passage
    repeated inside one document counts.
    """
    found = written(suffixes(documents))
    matched = matched_entries(documents, found, most).withColumnRenamed("place", "first")
    here = F.struct("doc_id", "text_hash", "at")
    span = _span(F.col("n_left"), F.col("n_right"))
    marks = (
        found.join(dealt(written(matched)), ["run", "context"])
        .withColumn("repeated", F.col("repeated").bitwiseAND(span))
        .where("repeated <> 0")
        .withColumn(
            "later",
            F.col("repeated").bitwiseAND(
                F.when(here.eqNullSafe(F.col("first")), F.col("later")).otherwise(ALL)
            ),
        )
        .groupBy(F.struct("doc_id", "text_hash").alias("key"))
        .agg(F.collect_set(F.struct("at", "repeated", "later")).alias("marks"))
    )
    return _passages(marks)

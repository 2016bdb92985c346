"""Documents that contain items of a benchmark.

Documents are cut into windows of about the size of an item, and items and windows are
compared by SimHash. A multi-index over the fingerprint's blocks finds every window within the
Hamming radius, and an index of shingles finds what SimHash misses because an item is cut or
edited. Each place found is compared with its item by weighted shingles.

* An item of m words belongs to the largest window size w <= 3m/4 of a fixed list. Windows of w
  words start every ``w // 3 + 1`` words of a document. Of the item, the windows at its first
  ``w // 3 + 1`` words are fingerprinted. Wherever the item stands, one of the document's
  windows lies in it and starts at one of these words, so an unchanged item is at distance 0.
  Items of fewer than 12 words are a window themselves, at every word.
* A fingerprint has 64 bits in three blocks. Two fingerprints within radius 8 differ by at most
  two bits in one of the blocks. The index holds, per block, all values within two bits of an
  item's, so one lookup per block misses none of them.
* The exact comparison is the weighted share of the item's five-word shingles (of the whole
  item, if it has fewer words) found where the item would have to stand. It must be 0.75 or
  more. A shingle weighs less the more items of the whole benchmark have it.
* Of each item of five words or more, the heaviest shingles that together weigh more than 0.25 are
  indexed. A place with a share of 0.75 has one of them, so none is missed, wherever the item
  is cut or changed. Such a shingle says where the item would have to begin; if the share is too
  small there, the item may still be moved apart, and every piece that begins with one of its
  shingles is compared.

Letters A-Z are lower-cased; words end at white space.

The items are the query set and the documents pass by. Items are taken in slices of a bounded
number of fingerprints, so the index a task holds has a fixed size; with more items than one
slice has, the documents pass by once for each slice.
"""

from collections.abc import Iterator
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogue_engine.llm.tables import dealt, document_key, unused
from dialogue_engine.llm.words import (
    as_bytes,
    blocks,
    distinct,
    shingles,
    signed,
    windows,
    word_hashes,
)
from dialogue_engine.scratch import written

WORDS = 5
SIMILARITY = 0.75
# What the sum of an item's weights may be off by.
ROUNDING = 1e-9
SIZES = (9, 12, 16, 21, 28, 38, 50, 64)
SHORT_ITEM = 12
BLOCK_BITS = (22, 21, 21)
BLOCK_RADIUS = 2
RADIUS = 3 * BLOCK_RADIUS + 2
# About 50 MB of index.
SLICE_FINGERPRINTS = 8192
# Places of shingles looked at together.
PLACES = 1 << 20
HIT = "struct<item_id: bigint, start_word: int, similarity: double>"

_U64 = np.uint64
_ONES = _U64(0x0101010101010101)
_HIGH = _U64(0x8080808080808080)
# The eight bits of a byte, each in a byte of its own.
_SPREAD = np.array([sum(((v >> b) & 1) << (8 * b) for b in range(8)) for v in range(256)], _U64)


def window_size(words: int) -> int:
    """Size of the windows for an item of so many words."""
    if words < SHORT_ITEM:
        return words
    return max(size for size in SIZES if 4 * size <= 3 * words)


def stride(size: int) -> int:
    return size // 3 + 1 if size in SIZES else 1


class Sums:
    """Running sums of the 64 bits of words, eight bits in one number.

    A window has at most 64 words, so a bit's sum over it fits in a byte, and the difference of two
    running sums is right whatever has overflowed before.
    """

    def __init__(self, hashes: np.ndarray):
        self.running = np.zeros((len(hashes) + 1, 8), _U64)
        np.cumsum(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], axis=0, out=self.running[1:])

    def fingerprints(self, starts: np.ndarray, size: int) -> np.ndarray:
        """SimHash of the windows: a bit is set where at least half of the words have it."""
        sums = self.running[starts + size] - self.running[starts]
        sums += _U64(128 - (size + 1) // 2) * _ONES
        sums &= _HIGH
        sums >>= _U64(7)
        sums *= _U64(0x0102040810204080)
        sums >>= _U64(56)
        return sums.astype(np.uint8).view(_U64)[:, 0]


def _near_values(bits: int) -> np.ndarray:
    """What a value of so many bits is xored with to get all values within the block radius."""
    flips = [0]
    for count in range(1, BLOCK_RADIUS + 1):
        flips += [sum(1 << b for b in some) for some in combinations(range(bits), count)]
    return np.array(flips, np.int64)


def _block_values(prints: np.ndarray) -> list[np.ndarray]:
    values, shift = [], 0
    for bits in BLOCK_BITS:
        values.append(((prints >> _U64(shift)) & _U64((1 << bits) - 1)).astype(np.int64))
        shift += bits
    return values


class SizeIndex:
    """Multi-index of the fingerprints of one window size."""

    def __init__(self, size: int, prints: list[int], items: list[int], offsets: list[int]):
        self.size = size
        self.prints = np.array(prints, _U64)
        self.items = np.array(items, np.int64)
        self.offsets = np.array(offsets, np.int64)
        self.blocks = []
        for bits, values in zip(BLOCK_BITS, _block_values(self.prints)):
            near = (values[:, None] ^ _near_values(bits)[None, :]).ravel()
            order = np.argsort(near, kind="stable")
            owner = np.repeat(np.arange(len(values)), len(near) // len(values))
            self.blocks.append((near[order].astype(np.int32), owner[order].astype(np.int32)))

    def open(self) -> None:
        """Add a table that says which block values occur at all."""
        self.occurs = []
        for bits, (near, _) in zip(BLOCK_BITS, self.blocks):
            table = np.zeros(1 << bits, bool)
            table[near] = True
            self.occurs.append(table)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, fingerprint of an item) within the radius; a pair may appear twice."""
        found = []
        for values, table, (near, owner) in zip(_block_values(prints), self.occurs, self.blocks):
            which = np.flatnonzero(table[values])
            if not len(which):
                continue
            low = np.searchsorted(near, values[which], side="left")
            count = np.searchsorted(near, values[which], side="right") - low
            window = np.repeat(which, count)
            place = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
            mine = owner[place + np.repeat(low, count)]
            close = np.bitwise_count(prints[window] ^ self.prints[mine]) <= RADIUS
            found.append((window[close], mine[close]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class ShingleIndex:
    """The shingles of which a place must have one, with the items and where they stand in them."""

    def __init__(self, entries: list[tuple[int, int, int]]):
        found = sorted(entries)
        self.shingles = np.array([e[0] for e in found], _U64)
        self.items = np.array([e[1] for e in found], np.int64)
        self.offsets = np.array([e[2] for e in found], np.int64)

    def open(self) -> None:
        """Add a table that says which first 20 bits occur at all."""
        self.occurs = np.zeros(1 << 20, bool)
        self.occurs[self.shingles >> _U64(44)] = True

    def places(self, every: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position of the shingle, item, word at which the item would begin), in parts."""
        which = np.flatnonzero(self.occurs[every >> _U64(44)])
        low = np.searchsorted(self.shingles, every[which], side="left")
        count = np.searchsorted(self.shingles, every[which], side="right") - low
        which, low, count = which[count > 0], low[count > 0], count[count > 0]
        part = np.cumsum(count) // PLACES
        for cut in np.split(np.arange(len(which)), np.flatnonzero(np.diff(part)) + 1):
            n = count[cut]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            mine = place + np.repeat(low[cut], n)
            at = np.repeat(which[cut], n)
            yield at, self.items[mine], at - self.offsets[mine]


# Number, lower-cased text, and how many items have those shingles that others have too.
Item = tuple[int, bytes, dict[int, int]]


class ItemIndex:
    """A slice of the items: fingerprints by window size, shingles and their weights."""

    def __init__(self, items: list[Item], total: int):
        """``total`` is the number of items in all slices."""
        self.ids = [item_id for item_id, _, _ in items]
        by_size: dict[int, tuple[list, list, list]] = {}
        self.lengths, sets, listed = [], [], []
        for no, (_, text, _) in enumerate(items):
            hashes, _ = word_hashes([text])
            self.lengths.append(len(hashes))
            listed.append(shingles(hashes, WORDS).tolist())
            sets.append(distinct(shingles(hashes, WORDS)))
            size = window_size(len(hashes))
            starts = np.arange(min(stride(size), len(hashes) - size + 1))
            entry = by_size.setdefault(size, ([], [], []))
            entry[0].extend(Sums(hashes).fingerprints(starts, size).tolist())
            entry[1].extend([no] * len(starts))
            entry[2].extend(starts.tolist())
        self.sizes = [SizeIndex(size, *entry) for size, entry in sorted(by_size.items())]
        self.weights: list[dict[int, float]] = []
        for own, (_, _, shared) in zip(sets, items):
            held_by = np.array([shared.get(shingle, 1) for shingle in signed(own).tolist()])
            weight = np.log1p(total / held_by)
            self.weights.append(dict(zip(own.tolist(), (weight / weight.sum()).tolist())))
        entries = []
        for no, weights in enumerate(self.weights):
            if self.lengths[no] < WORDS:
                continue
            needed, total = set(), 0.0
            for shingle, weight in sorted(weights.items(), key=lambda w: (-w[1], w[0])):
                if total > 1 - SIMILARITY + ROUNDING:
                    break
                needed.add(shingle)
                total += weight
            entries += [(x, no, at) for at, x in enumerate(listed[no]) if x in needed]
        self.heaviest = ShingleIndex(entries)

    def open(self) -> None:
        for size in self.sizes:
            size.open()
        self.heaviest.open()

    def hits(self, texts: list[bytes]) -> list[list[dict]]:
        """Per text the items in it, in order of their number, each with its best place."""
        out: list[list[dict]] = []
        for first, last in blocks(texts):
            hashes, bounds = word_hashes(texts[first:last])
            out.extend(self._block_hits(hashes, bounds))
        return out

    def _block_hits(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[list[dict]]:
        docs = len(bounds) - 1
        best: dict[tuple[int, int], tuple[float, float, int]] = {}
        if len(hashes):
            sums = Sums(hashes)
            every = windows(hashes, WORDS)
            ranges = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            for index in self.sizes:
                size, step = index.size, stride(index.size)
                starts = np.concatenate(
                    [np.arange(low, max(low, high - size + 1), step) for low, high in ranges]
                )
                window, mine = index.near(sums.fingerprints(starts, index.size))
                at = starts[window]
                owner = np.searchsorted(bounds, at, side="right") - 1
                found = (owner, index.items[mine], at - index.offsets[mine])
                places = set(zip(*(part.tolist() for part in found)))
                for doc, item, place in places:
                    self._compare(best, hashes, every, doc, item, place, ranges[doc])
            places = set()
            for at, items, place in self.heaviest.places(every):
                owner = np.searchsorted(bounds, at, side="right") - 1
                inside = at + WORDS <= bounds[owner + 1]
                found = (owner[inside], items[inside], place[inside])
                places.update(zip(*(part.tolist() for part in found)))
            for doc, item, place in places:
                self._compare(best, hashes, every, doc, item, place, ranges[doc])
            for doc, item in {(doc, item) for doc, item, _ in places} - best.keys():
                for place in self._apart(every, item, *ranges[doc]):
                    self._compare(best, hashes, every, doc, item, place, ranges[doc])
        listed: list[list[dict]] = [[] for _ in range(docs)]
        for (doc, item), (share, _, place) in sorted(best.items()):
            listed[doc].append(
                {"item_id": self.ids[item], "start_word": -place, "similarity": round(share, 6)}
            )
        yield from listed

    def _compare(self, best, hashes, every, doc: int, item: int, place: int, bounds) -> None:
        """Keep the place if the item is there and no better place is known."""
        low, high = bounds
        place, slack = max(low, place), self.lengths[item] // 8
        share = self._share(hashes, every, item, place, low, high, slack)
        if share >= SIMILARITY - ROUNDING:
            # of places with the same share, where the item fits without slack
            exact = self._share(hashes, every, item, place, low, high, 0)
            here = (share, exact, low - place)
            best[doc, item] = max(best.get((doc, item), here), here)

    def _apart(self, every, item: int, low: int, high: int) -> list[int]:
        """Where the piece and the slack before it begin with a shingle of the item. A piece with the
        largest share is among them. None if the whole text has too few of the shingles."""
        weights = self.weights[item]
        own = every[low : high - WORDS + 1]
        at = np.flatnonzero(np.isin(own, np.array(list(weights), _U64)))
        if sum(weights[shingle] for shingle in set(own[at].tolist())) < SIMILARITY - ROUNDING:
            return []
        return np.minimum(low + at + self.lengths[item] // 8, high - 1).tolist()

    def _share(
        self, hashes, every, item: int, place: int, low: int, high: int, slack: int
    ) -> float:
        """Weighted share of the item's shingles in the item-sized piece at ``place`` and so many
        words around it, which make up for words put in or left out."""
        length = self.lengths[item]
        first, last = max(low, place - slack), min(high, place + length + slack)
        if length >= WORDS:
            there = every[first : max(first, last - WORDS + 1)]
        else:
            there = windows(hashes[first:last], length)
        weights = self.weights[item]
        return sum(weights[shingle] for shingle in weights.keys() & there.tolist())


def _shingles() -> Column:
    @F.arrow_udf("array<bigint>")
    def own(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [
                signed(distinct(shingles(word_hashes([text.lower()])[0], WORDS)))
                for text in as_bytes(batch)
            ]
            yield pa.array(found, pa.list_(pa.int64()))

    return own(F.col("text"))


def _counted(benchmark: DataFrame) -> DataFrame:
    """(no, item_id, text, shared): the items, and of their shingles those that several items have,
    with their number over the whole benchmark. Items without words or without an id are left
    out: nothing contains them."""
    items = written(
        benchmark.select(
            F.monotonically_increasing_id().alias("no"),
            F.col("item_id").cast("long").alias("item_id"),
            "text",
            _shingles().alias("shingles"),
        ).where(F.col("item_id").isNotNull() & (F.size("shingles") > 0))
    )
    each = items.select("no", F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = (
        each.join(dealt(held), "shingle")
        .groupBy("no")
        .agg(F.collect_list(F.struct("shingle", "held")).alias("shared"))
    )
    return written(items.drop("shingles").join(dealt(shared), "no", "left"))


def _slices(items: DataFrame) -> Iterator[list[Item]]:
    """The items, in slices of a bounded number of fingerprints."""
    held, prints = [], 0
    for row in items.orderBy("no").toLocalIterator():
        text = row["text"].encode().lower()
        held.append((row["item_id"], text, dict(row["shared"] or ())))
        prints += stride(window_size(len(text.split())))
        if prints >= SLICE_FINGERPRINTS:
            yield held
            held, prints = [], 0
    if held:
        yield held


def _hits(index: Broadcast) -> Column:
    @F.arrow_udf(f"array<{HIT}>")
    def hits(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = index.value
        found.open()
        kind = pa.list_(
            pa.struct(
                [("item_id", pa.int64()), ("start_word", pa.int32()), ("similarity", pa.float64())]
            )
        )
        for batch in texts:
            yield pa.array(found.hits([t.lower() for t in as_bytes(batch)]), kind)

    return hits(F.col("text"))


def with_hits(documents: DataFrame, benchmark: DataFrame, name: str = "hits") -> DataFrame:
    """Add the items each document contains: item_id, first word, similarity; empty if none.

    A null or empty text contains nothing. Null ids and repeated rows are kept as they are. Of
    equal places of an item the first one is given; items with the same id are reported each. Of
    ``benchmark`` only ``item_id`` and ``text`` are read.

    With one slice of items the documents pass by once, row by row. With more, one slice after the
    other is sent out, looked up in a pass of its own whose hits are written, and given back, so
    no worker holds two; the hits then meet the documents by doc_id and hash of the text.
    """
    spark = documents.sparkSession
    items = _counted(benchmark)
    total = items.count()
    slices = _slices(items)
    first = next(slices, None)
    if first is None:
        return documents.withColumn(name, F.array().cast(f"array<{HIT}>"))
    following = next(slices, None)
    if following is None:
        sent = spark.sparkContext.broadcast(ItemIndex(first, total))
        return documents.withColumn(name, _hits(sent))
    key = unused(documents, "__key")
    passes = []
    for number, part in enumerate(chain([first, following], slices)):
        sent = spark.sparkContext.broadcast(ItemIndex(part, total))
        found = documents.select(document_key().alias(key), "text").withColumn(name, _hits(sent))
        # rows that agree in doc_id and text have the same hits
        hits = found.where(F.size(name) > 0).select(key, F.lit(number).alias("slice"), name)
        passes.append(written(hits.dropDuplicates([key])))
        sent.unpersist()
    every = F.array_sort(F.collect_list(F.struct("slice", name)))
    listed = reduce(DataFrame.unionByName, passes).groupBy(key).agg(
        F.flatten(F.transform(every, lambda s: s[name])).alias(name)
    )
    joined = documents.withColumn(key, document_key()).join(dealt(written(listed)), key, "left")
    none = F.array().cast(f"array<{HIT}>")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return joined.select(*columns, F.coalesce(name, none).alias(name))


def contaminations(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, similarity): a row per document and item it contains."""
    return with_hits(documents.select("doc_id", "text"), benchmark).select(
        "doc_id", F.inline("hits")
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    name = unused(documents, "__hits")
    flagged = with_hits(documents, benchmark, name)
    return flagged.where(F.size(name) == 0).select(*(f"`{c}`" for c in documents.columns))

"""Similarity join on word shingles with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of five-word shingles is at least
3/4. A shingle set is put into one global order, rare shingles first, and only a prefix of it
is looked up. With the first ``n - ceil(3n/4) + l`` shingles of a set as its prefix, a similar
document shares at least ``l`` of them, so a document may choose its own ``l``: a longer prefix
costs more lookups and asks for more matches before a pair is compared. Each document takes
the ``l`` with the lowest estimated cost. Every pair that could be similar is compared exactly.

Sets are 64-bit hashes of shingles, and equal sets are one node known by 128 bits. A document of
n shingles meets a wrong match in another one with a probability of about n * n / 2**64.

How the work is laid out:

1. One pass over the texts gives size and 128-bit signature of each set, and per task a count of
   shingles in 2**20 cells. Summed over all tasks the counts are the estimate of how common a
   shingle is: a fixed 8 MB whatever the size of the corpus. They only decide the order.
2. A second pass emits the prefixes, once per different set and task. They are dealt out by
   shingle, common shingles also by a salt, and shingles that only one set has are dropped.
3. Every set is compared with one set of each lookup list, the one of which most is shared
   (linear in the lists, never all pairs). This joins large groups of near copies at once.
4. Pairs inside lists are only formed between sets that are not connected yet, of similar size,
   and only where both have enough shingles left that such sets share. Each row carries a
   bitmap of its set's remaining shingles, which bounds what two sets can share before a pair is
   given out. In long lists it also carries a sketch of the whole set, the parity of the shingles
   in 2**11 cells: in as many cells as two sketches differ, at least, the sets differ, so edited
   copies of one text that are too far apart are not given out pair by pair. This makes the result
   exact and leaves nothing to do inside the large groups. The lists of common shingles are worked
   on in pieces, pair of pieces by pair of pieces.
5. Before that, each set of a long list is paired only with the one whose sketch is nearest, one row
   per set and list. What that joins, step 4 need not give out pair by pair.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_engine.llm.graph import components
from dialogue_engine.llm.tables import dealt, document_key, unused
from dialogue_engine.llm.words import as_bytes, mix, shingle_sets, signed
from dialogue_engine.scratch import written

WORDS = 5
# Similarity as a fraction: 3/4.
SAME, OF = 3, 4
LONGEST = 4
CELL_BITS = 20
CELLS_PER_ROW = 4096
# Sets per piece of a lookup list.
PIECE = 2048
# What comparing two sets costs, in lookups.
COMPARE_COST = 16
# Bits of the sketch of a set, and the longest list whose rows go without.
SKETCH_BITS = 2048
SHORT_LIST = 8

_U64 = np.uint64
_NO_SKETCH = bytes(SKETCH_BITS // 8)
_ID_SALTS = (_U64(0x5851F42D4C957F2D), _U64(0x14057B7EF767814F))


def least_common(size: np.ndarray) -> np.ndarray:
    """Shingles that a set of this size shares with any similar set, at least."""
    return (SAME * size + OF - 1) // OF


def most_apart(sizes: np.ndarray) -> np.ndarray:
    """Shingles that only one of two similar sets has, at most, given the sum of their sizes: they
    share at least 3/7 of that sum."""
    return sizes - 2 * (-(-SAME * sizes // (SAME + OF)))


def prefix_size(size: np.ndarray, matches: np.ndarray) -> np.ndarray:
    return size - least_common(size) + matches


def set_id(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    parts = (mix(shingles ^ salt).sum(dtype=_U64) for salt in _ID_SALTS)
    return tuple(int(part) for part in parts)


def sketch_of(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles in each of ``SKETCH_BITS`` cells. A shingle that only
    one of two sets has flips one bit, so two sketches differ in no more bits than that."""
    cells = np.bincount((shingles % _U64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def signatures(documents: DataFrame) -> DataFrame:
    """Per document: size, signature and sketch of its set. Then, per task, its shingle counts.

    Rows of the first kind have ``doc_id``, ``text_hash``, ``n_shingles``, ``na``, ``nb``,
    ``sketch``; rows of the second have ``cells``, a piece of the counts, and its number ``row``.
    """
    schema = (
        "doc_id bigint, text_hash bigint, n_shingles bigint, na bigint, nb bigint, sketch binary, "
        "row int, cells array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            texts = [text.lower() for text in as_bytes(batch.column("text"))]
            sizes, ids, sketches, held, pending = [], [], [], [], 0
            for found in shingle_sets(texts, WORDS):
                sizes.append(len(found))
                ids.append(set_id(found))
                sketches.append(sketch_of(found))
                held.append(found)
                pending += len(found)
                if pending > 1 << CELL_BITS:
                    counts += _cell_counts(held)
                    held, pending = [], 0
            counts += _cell_counts(held)
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    *_id_columns(ids),
                    pa.array(sketches, pa.binary()),
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.list_(pa.int32())),
                ],
                names=names,
            )
        if counts.any():
            pieces = np.minimum(counts, 2**31 - 1).astype(np.int32).reshape(-1, CELLS_PER_ROW)
            none = pa.nulls(len(pieces), pa.int64())
            bounds = pa.array(np.arange(len(pieces) + 1, dtype=np.int32) * CELLS_PER_ROW)
            cells = pa.ListArray.from_arrays(bounds, pa.array(pieces.ravel()))
            number = pa.array(np.arange(len(pieces), dtype=np.int32))
            empty = [*[none] * 5, pa.nulls(len(pieces), pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, number, cells], names=names)

    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, schema
    )


def _id_columns(ids: list[tuple[int, int]]) -> list[pa.Array]:
    return [pa.array(signed(np.array([x[i] for x in ids], _U64))) for i in (0, 1)]


def _cell_counts(sets: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate(sets) if sets else np.zeros(0, _U64)
    return np.bincount(cell_of(every), minlength=1 << CELL_BITS)


def cell_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> _U64(64 - CELL_BITS)).astype(np.int64)


def shingle_counts(signed_rows: DataFrame) -> np.ndarray:
    """The counts of all tasks added up, 2**20 numbers. Sums of vectors, so the tasks' counts
    are merged one by one and never gathered."""
    summed = (
        signed_rows.where("row is not null")
        .select("row", array_to_vector(F.col("cells").cast("array<double>")).alias("v"))
        .groupBy("row")
        .agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("v"))
    )
    counts = np.zeros((1 << CELL_BITS) // CELLS_PER_ROW * CELLS_PER_ROW)
    for row in summed.collect():
        counts[row["row"] * CELLS_PER_ROW : (row["row"] + 1) * CELLS_PER_ROW] = row["v"]
    return counts


def choose_matches(size: int, above: np.ndarray) -> int:
    """The cheapest number of matches to ask for.

    ``above``: for the shingles of a set in order, how many sets are expected to share each. A
    prefix costs a lookup per shingle; the pairs it leads to are at most the sum of what its
    shingles bring, divided by the matches each pair needs.
    """
    most = min(LONGEST, int(least_common(np.int64(size))))
    options = np.arange(1, most + 1)
    lengths = prefix_size(np.int64(size), options)
    expected = np.concatenate(([0.0], np.cumsum(above[: int(lengths[-1])])))[lengths]
    return int(options[np.argmin(lengths + COMPARE_COST * expected / options)])


def prefixes(documents: DataFrame, counts: np.ndarray) -> DataFrame:
    """(token, salt, salts, na, nb, n, p): the prefix of every different set; p is its length."""
    usual = float(np.median(counts))
    sent = documents.sparkSession.sparkContext.broadcast(counts.astype(np.float32))
    schema = "token bigint, salt int, salts int, na bigint, nb bigint, n int, p int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        done: set[tuple[int, int]] = set()
        for batch in batches:
            texts = [text.lower() for text in as_bytes(batch.column("text"))]
            tokens, salts, nodes, held = [], [], [], 0
            for found in shingle_sets(texts, WORDS):
                if not len(found):
                    continue
                node = set_id(found)
                if node in done:
                    continue
                done.add(node)
                seen = counts[cell_of(found)]
                order = np.argsort(seen, kind="stable")
                found, above = found[order], np.maximum(seen[order] - usual, 0.0)
                matches = choose_matches(len(found), above)
                p = int(prefix_size(np.int64(len(found)), np.int64(matches)))
                tokens.append(found[:p])
                salts.append(1 + (above[:p] // PIECE).astype(np.int32))
                nodes.append((*node, len(found), p))
                held += p
                if held > 200_000:
                    yield _prefix_batch(tokens, salts, nodes)
                    tokens, salts, nodes, held = [], [], [], 0
            if nodes:
                yield _prefix_batch(tokens, salts, nodes)

    return documents.select("text").mapInArrow(run, schema)


def _prefix_batch(tokens, salts, nodes) -> pa.RecordBatch:
    sizes = [len(t) for t in tokens]
    na, nb = (np.repeat(np.array([x[i] for x in nodes], _U64), sizes) for i in (0, 1))
    n, p = (np.repeat(np.array([x[i] for x in nodes], np.int32), sizes) for i in (2, 3))
    pieces = np.concatenate(salts)
    salt = (mix(na) % pieces.astype(_U64)).astype(np.int32)
    columns = [signed(np.concatenate(tokens)), salt, pieces, signed(na), signed(nb), n, p]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], names=["token", "salt", "salts", "na", "nb", "n", "p"]
    )


def shared_prefixes(rows: DataFrame) -> DataFrame:
    """The rows of lists with at least two sets, or of shingles with several lists; each once.

    The rows arrive sorted, so a task holds one Arrow batch and one row more.
    """
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            col = {n: batch.column(n).to_numpy() for n in names}
            if held is not None:
                col = {n: np.concatenate([held[n], col[n]]) for n in names}
            key = np.stack([col["token"], col["salt"]])
            node = np.stack([col["na"], col["nb"]])
            same_list = np.zeros(len(col["n"]), bool)
            same_list[1:] = (key[:, 1:] == key[:, :-1]).all(0)
            repeat = same_list.copy()
            repeat[1:] &= (node[:, 1:] == node[:, :-1]).all(0)
            col = {n: v[~repeat] for n, v in col.items()}
            same_list = same_list[~repeat]
            # the held row has been given out already if its list had two rows by then
            given = held is not None and bool(held["given"][0])
            wanted = same_list | (col["salts"] > 1)
            wanted[:-1] |= same_list[1:]
            last = {n: v[-1:] for n, v in col.items()}
            held = last | {"given": wanted[-1:] if len(wanted) > 1 else np.array([given])}
            if given:
                wanted[0] = False
            if wanted.any():
                yield _arrow({n: v[wanted] for n, v in col.items()})

    lists = rows.repartition("token", "salt").sortWithinPartitions("token", "salt", "na", "nb")
    return lists.mapInArrow(run, rows.schema)


def _arrow(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _could_be_similar(matches: Column, n: Column, p: Column, m: Column, q: Column) -> Column:
    """Whether this many matches in prefixes of p and q shingles allow sets of n and m shingles
    to be similar.

    Similar sets share at least 3 (n + m) / 7. Shared shingles not matched lie behind the prefix
    that ends first, so they are no more than the longer of the two rests.
    """
    rest = F.greatest(n - p, m - q)
    return (matches + rest) * (SAME + OF) >= SAME * (n + m)


def _similar_size(n: Column, m: Column) -> Column:
    return (n * OF >= m * SAME) & (m * OF >= n * SAME)


def with_shared(rows: DataFrame) -> DataFrame:
    """Add ``s``: how many rows a set has here. A window over one set's own prefix."""
    own = Window.partitionBy("na", "nb")
    return rows.withColumn("s", F.count(F.lit(1)).over(own).cast("int"))


def _head_pairs(shared: DataFrame) -> DataFrame:
    """Each set with the set that leads one of its lists, where half of the matches needed are
    there already. The leader of a list is the set of which the largest share is shared: a text
    that others are copies of, rather than one of the copies."""
    leader = F.struct(
        (F.col("s") / F.col("p")).alias("share"), F.col("na").alias("ha"), F.col("nb").alias("hb"),
        F.col("n").alias("hn"), F.col("p").alias("hp"),
    )
    heads = shared.groupBy("token").agg(F.max(leader).alias("h")).select("token", "h.*")
    pairs = (
        shared.join(dealt(heads), "token")
        .where("(na <> ha or nb <> hb)")
        .where(_similar_size(F.col("n"), F.col("hn")))
        .groupBy("na", "nb", "ha", "hb", "n", "p", "hn", "hp")
        .agg(F.count(F.lit(1)).alias("matches"))
    )
    twice = 2 * F.col("matches")
    return pairs.where(
        _could_be_similar(twice, F.col("n"), F.col("p"), F.col("hn"), F.col("hp"))
    ).select("na", "nb", "ha", "hb")


def _open_pairs(
    shared: DataFrame, labels: DataFrame, sketches: DataFrame, nearest: bool = False
) -> DataFrame:
    """Pairs of sets from different components so far that share enough of their prefixes.

    Only shingles with sets from two components are looked at, the rarest first. Their lists are
    cut into pieces of a bounded expected size, and every pair of pieces is a group of its own.
    A pair that needs N matches is looked at where its shingle is among the first ``s - N + 1`` of
    both sets, which holds for the first shingle they share; so none is missed.

    With ``nearest`` only lists longer than ``SHORT_LIST`` are looked at, and of the pairs of a set
    in a list with sets of later components the one with the nearest sketches.
    """
    node = F.struct("na", "nb")
    labelled = (
        shared.drop("s")
        .withColumn("node", node)
        .join(dealt(labels), "node", "left")
        .withColumn("label", F.coalesce("component", "node"))
        .select("token", "salt", "salts", "na", "nb", "n", "p", F.xxhash64("label").alias("label"))
    )
    mixed = (
        labelled.groupBy("token")
        .agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("freq")
        )
        .where("low <> high")
        .where(F.col("freq") > (SHORT_LIST if nearest else 0))
        .select("token", "freq")
    )
    pieces = F.transform(
        F.sequence(F.lit(0), F.col("salts") - 1),
        lambda other: F.struct(
            F.least("salt", other).alias("u"), F.greatest("salt", other).alias("v")
        ),
    )
    # windows over the rows of one set, which are no more than its prefix
    own = Window.partitionBy("na", "nb")
    remaining = {
        "s": F.count(F.lit(1)).over(own).cast("int"),
        "r": F.row_number().over(own.orderBy("freq", "token")) - 1,
        **{b: F.bit_or(bit).over(own) for b, bit in zip(_BITS, _bitmap(F.col("token")))},
    }
    # the sketches are enough to find the nearest: any shingle may be shared, and be the first
    unknown = {"s": F.col("n"), "r": F.lit(0), **{b: F.lit(0).cast("long") for b in _BITS}}
    units = (
        labelled.join(dealt(mixed), "token")
        .withColumns(unknown if nearest else remaining)
        .join(dealt(sketches), ["na", "nb"])
        .withColumn("sketch", F.when(F.col("freq") > SHORT_LIST, F.col("sketch")))
        .select("*", F.explode(pieces).alias("unit"))
        .select(
            "token", "unit.u", "unit.v", "salt", "na", "nb", "n", "p", "s", "r", "label", *_BITS, "sketch"
        )
    )
    schema = "na bigint, nb bigint, ha bigint, hb bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(n).to_numpy() for n in batch.schema.names if n != "sketch"}
            col["sketch"] = _sketch_rows(batch.column("sketch"))
            key = np.stack([col["token"], col["u"], col["v"]])
            edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            # the last group may go on in the next batch, the others are complete
            cut = int(edge[-1]) if len(edge) else 0
            if held and not cut and any(held[-1][n][-1] != col[n][0] for n in ("token", "u", "v")):
                yield from _pairs_of(held, nearest)
                held = []
            if cut:
                yield from _pairs_of([*held, {n: v[:cut] for n, v in col.items()}], nearest)
                held = []
            held.append({n: v[cut:] for n, v in col.items()})
        if held:
            yield from _pairs_of(held, nearest)

    ordered = units.repartition("token", "u", "v").sortWithinPartitions("token", "u", "v", "label")
    return ordered.mapInArrow(run, schema).distinct()


_BITS = [f"b{i}" for i in range(8)]


def _bitmap(token: Column) -> list[Column]:
    """The bit of a shingle in a map of 512 bits, as eight numbers."""
    bit = F.expr("shiftleft(1L, cast(pmod(token, 64) as int))")
    word = F.pmod(F.floor(token / 64), F.lit(8))
    return [F.when(word == i, bit).otherwise(F.lit(0).cast("long")) for i in range(8)]


def _sketch_rows(column: pa.Array) -> np.ndarray:
    """A row of 64-bit numbers per sketch; of zeros, which differ nowhere, where there is none."""
    joined = b"".join(sketch or _NO_SKETCH for sketch in column.to_pylist())
    return np.frombuffer(joined, _U64).reshape(-1, SKETCH_BITS // 64)


def _pairs_of(held: list[dict[str, np.ndarray]], nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs inside complete groups: different labels, similar sizes, from the two pieces of the
    group, and able to share enough. Groups are ordered by label, so the rows of a large component
    are never held against each other. With ``nearest``, at most one pair per row."""
    col = {n: np.concatenate([part[n] for part in held]) for n in held[0]}
    n, rows = col["n"].astype(np.int64), len(col["n"])
    new_group = np.ones(rows, bool)
    key = np.stack([col["token"], col["u"], col["v"]])
    new_group[1:] = (key[:, 1:] != key[:, :-1]).any(0)
    new_label = new_group.copy()
    new_label[1:] |= col["label"][1:] != col["label"][:-1]
    group_end, label_end = (
        np.append(np.flatnonzero(new)[1:], rows)[np.cumsum(new) - 1] for new in (new_group, new_label)
    )
    count = group_end - label_end
    bits = np.stack([col[b] for b in _BITS], 1).view(_U64)
    # shingles that fell on a bit of another one
    lost = col["s"] - np.bitwise_count(bits).sum(1, dtype=np.int64)
    upto = np.cumsum(count)
    first = 0
    while first < rows:
        before = int(upto[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + 500_000, side="right")))
        some = count[first:last]
        left = np.repeat(np.arange(first, last), some)
        right = label_end[left] + np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
        small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
        rest = np.maximum(n[left] - col["p"][left], n[right] - col["p"][right])
        # similar sets share at least 3 (n + m) / 7, and all but ``rest`` of it in their prefixes
        need = np.maximum(1, -(-SAME * (small + large) // (SAME + OF)) - rest)
        keep = small * OF >= large * SAME
        for side in (left, right):
            keep &= col["r"][side] + need <= col["s"][side]
        across = col["u"][left] != col["v"][left]
        keep &= ~across | (col["salt"][left] != col["salt"][right])
        left, right, need = left[keep], right[keep], need[keep]
        found = []
        for at in range(0, len(left), 100_000):
            a, b = left[at : at + 100_000], right[at : at + 100_000]
            common = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64)
            able = common + np.minimum(lost[a], lost[b]) >= need[at : at + 100_000]
            a, b = a[able], b[able]
            apart = np.bitwise_count(col["sketch"][a] ^ col["sketch"][b]).sum(1, dtype=np.int64)
            able = apart <= most_apart(n[a] + n[b])
            a, b, apart = a[able], b[able], apart[able]
            if nearest:
                found.append((a, b, apart / (n[a] + n[b])))
            elif len(a):
                yield _pair_batch(col, a, b)
        if found:
            # all pairs of a left row are in one round of the loop
            a, b, apart = (np.concatenate(part) for part in zip(*found))
            order = np.lexsort((apart, a))
            a, b = a[order], b[order]
            best = np.diff(a, prepend=-1) > 0
            if len(a):
                yield _pair_batch(col, a[best], b[best])
        first = last


def _pair_batch(col, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    # the same two sets in the same order whichever shingle they meet in
    later = (col["na"][left] > col["na"][right]) | (
        (col["na"][left] == col["na"][right]) & (col["nb"][left] > col["nb"][right])
    )
    a, b = np.where(later, right, left), np.where(later, left, right)
    return _arrow({"na": col["na"][a], "nb": col["nb"][a], "ha": col["na"][b], "hb": col["nb"][b]})


def _similar(pairs: DataFrame, documents: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs of nodes (a, b) whose sets are similar, found by comparing the whole sets.

    One document stands for each node that is in a pair; only those texts are read as sets.
    """
    left = pairs.select("na", "nb")
    nodes = left.unionByName(pairs.select(F.col("ha").alias("na"), F.col("hb").alias("nb")))
    wanted = written(
        rows.join(dealt(nodes.distinct()), ["na", "nb"], "left_semi")
        .groupBy("na", "nb")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("key"))
        .select("key")
    )
    keyed = documents.select(document_key().alias("key"), "text")
    texts = keyed.join(dealt(wanted), "key", "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.lower() for text in as_bytes(batch.column("text"))]
            found = list(shingle_sets(texts, WORDS))
            for at in range(0, len(found), 500):
                some = found[at : at + 500]
                members = pa.array([s.tobytes() for s in some], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*_id_columns([set_id(s) for s in some]), members],
                    names=["na", "nb", "members"],
                )

    members = (
        texts.mapInArrow(sets, "na bigint, nb bigint, members binary")
        .groupBy("na", "nb")
        .agg(F.first("members").alias("members"))
    )
    stored = written(members)
    heads = stored.select(
        F.col("na").alias("ha"), F.col("nb").alias("hb"), F.col("members").alias("head_members")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for mine, theirs in zip(
                batch.column("members").to_pylist(), batch.column("head_members").to_pylist()
            ):
                x, y = np.frombuffer(mine, _U64), np.frombuffer(theirs, _U64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(both * OF >= SAME * (len(x) + len(y) - both))
            yield batch.select(["na", "nb", "ha", "hb"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(dealt(stored), ["na", "nb"]).join(dealt(heads), ["ha", "hb"]).select(
        "na", "nb", "ha", "hb", "members", "head_members"
    )
    return joined.mapInArrow(compare, "na bigint, nb bigint, ha bigint, hb bigint").select(
        F.struct("na", "nb").alias("a"),
        F.struct(F.col("ha").alias("na"), F.col("hb").alias("nb")).alias("b"),
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, is_kept) per row of ``documents``.

    ``component_id`` is the smallest doc_id reachable by links, its own included. ``is_kept``
    marks one document of each component, the one with the smallest (doc_id, text_hash).

    A document is known by doc_id and the xxhash64 of its text; rows that agree in both are the
    same document, repeated. A null doc_id sorts first and is never a component's id while
    another is there. A text without words, or null, has no shingles, is linked with nothing
    and has its own doc_id as component. Only ``doc_id`` and ``text`` are read.
    """
    rows = written(signatures(documents))
    docs = rows.where("row is null").select("doc_id", "text_hash", "n_shingles", "na", "nb")
    filled = docs.where("n_shingles > 0")
    shared = written(with_shared(shared_prefixes(prefixes(documents, shingle_counts(rows)))))

    first = written(_similar(written(_head_pairs(shared)), documents, filled))
    stars = written(components(first)) if not first.isEmpty() else None
    labels = stars if stars is not None else first.select(
        F.col("a").alias("node"), F.col("b").alias("component")
    )
    sketches = (
        rows.where("n_shingles > 0").groupBy("na", "nb").agg(F.first("sketch").alias("sketch"))
    )
    for nearest in (True, False):
        rest = written(_open_pairs(shared, labels, sketches, nearest))
        if not rest.isEmpty():
            second = _similar(rest, documents, filled)
            links = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = written(components(links.unionByName(second)))

    node = F.struct("na", "nb")
    labelled = (
        filled.withColumn("node", node)
        .join(dealt(labels), "node", "left")
        .withColumn("label", F.coalesce("component", "node"))
        .select("doc_id", "text_hash", "n_shingles", "label")
    )
    groups = labelled.groupBy("label").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct("doc_id", "text_hash")).alias("first"),
    )
    found = labelled.join(dealt(groups), "label").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        "component_id",
        F.struct("doc_id", "text_hash").eqNullSafe(F.col("first")).alias("is_kept"),
    )
    empty = docs.where("n_shingles = 0").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.col("doc_id").alias("component_id"),
        F.lit(True).alias("is_kept"),
    )
    return found.unionByName(empty)


def keep_one_per_group(documents: DataFrame) -> DataFrame:
    """The documents without near copies: one row of each component stays, with all its columns.
    Documents without words all stay. Of rows that agree in doc_id and text that one stays whose
    other columns come first, in their order; maps, which have no order, do not count."""
    key, size, tie, rank = (unused(documents, n) for n in ("__key", "__shingles", "__tie", "__rank"))
    wanted = (
        near_duplicates(documents)
        .where("is_kept")
        .groupBy(F.struct("doc_id", "text_hash").alias(key))
        .agg(F.max("n_shingles").alias(size))
    )
    alone = F.when(F.col(size) == 0, F.monotonically_increasing_id()).otherwise(F.lit(0))
    others = [
        F.col(f"`{f.name}`")
        for f in documents.schema.fields
        if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()
    ]
    first = Window.partitionBy(key, tie).orderBy(*(others or [F.lit(0)]))
    return (
        documents.withColumn(key, document_key())
        .join(dealt(wanted), key)
        .withColumn(tie, alone)
        .withColumn(rank, F.row_number().over(first))
        .where(F.col(rank) == 1)
        .select(*(f"`{c}`" for c in documents.columns))
    )

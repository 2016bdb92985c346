"""Choosing training text by importance resampling.

Two generative models of hashed words and word pairs, one of the target text and one of the raw
corpus, say how much likelier a text is among the target than among the rest. Texts are then
sampled without replacement with these odds: each gets its log ratio plus Gumbel noise from
the hash of its id, and the largest are chosen.

The raw model counts all words of all documents and the target model all of the target's; a task
sends one row per bucket of the hash, so the models have a fixed size and what is shuffled grows
with the number of tasks. The ratio is the mean over a text's words and pairs, so that a long
text is not chosen or refused for its length, times ``SHARPNESS``.

The sample is cut without sorting the corpus: counts per step of the keys say in which step the
last chosen document lies, and only that step is ranked.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogue_engine.llm.tables import dealt, unused
from dialogue_engine.llm.words import as_bytes, blocks, windows, word_hashes
from dialogue_engine.scratch import written

BUCKETS = 1 << 16
# Buckets of words get this much of one of each added.
SMOOTH = 1.0
SHARPNESS = 40.0
SEED = "resample"
# Steps that a range of keys is counted in at once, and rows that are put in order in the end.
STEPS = 1024
EDGE_ROWS = 10_000


def _buckets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and pairs of some texts, and the bounds of each text's."""
    pairs = windows(hashes, 2)
    parts, sizes = [], [0]
    for low, high in zip(bounds[:-1], bounds[1:]):
        own, two = hashes[low:high], pairs[low : max(low, high - 1)]
        parts += [own, two]
        sizes.append(len(own) + len(two))
    every = np.concatenate(parts) if parts else hashes
    return (every % np.uint64(BUCKETS)).astype(np.int64), np.cumsum(sizes)


def _features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lowered = [text.lower() for text in texts]
    for first, last in blocks(lowered):
        yield _buckets(*word_hashes(lowered[first:last]))


def bucket_counts(flagged: DataFrame) -> DataFrame:
    """(bucket, raw, target) counts over all rows of (text, is_target). Every task counts its own
    rows first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            targets = batch.column("is_target").to_numpy(zero_copy_only=False)
            texts = as_bytes(batch.column("text"))
            first = 0
            for found, bounds in _features(texts):
                last = first + len(bounds) - 1
                counts[0] += np.bincount(found, minlength=BUCKETS)
                wanted = np.repeat(targets[first:last].astype(bool), np.diff(bounds))
                counts[1] += np.bincount(found[wanted], minlength=BUCKETS)
                first = last
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])],
            names=["bucket", "raw", "target"],
        )

    return (
        flagged.select("text", "is_target")
        .mapInArrow(count, "bucket bigint, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log of target against raw probability of each bucket, from the summed counts."""
    raw, target = np.full(BUCKETS, SMOOTH), np.full(BUCKETS, SMOOTH)
    for row in counts.collect():
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def with_log_ratio(documents: DataFrame, ratios: np.ndarray, name: str) -> DataFrame:
    """Add the mean log ratio of each text's words and pairs; 0 for a text without words."""
    sent = documents.sparkSession.sparkContext.broadcast(ratios.astype(np.float32))

    @F.arrow_udf("double")
    def ratio(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = sent.value
        for batch in batches:
            out = []
            for found, bounds in _features(as_bytes(batch)):
                sums = np.concatenate(([0.0], np.cumsum(table[found], dtype=np.float64)))
                total = sums[bounds[1:]] - sums[bounds[:-1]]
                out.append(total / np.maximum(1, np.diff(bounds)))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return documents.withColumn(name, ratio(F.col("text")))


def gumbel(seed: str = SEED) -> Column:
    """Gumbel noise that depends on doc_id and text alone."""
    draw = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text"))
    even = (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(even))


def _edge(keyed: DataFrame, key: str, wanted: int) -> tuple[DataFrame, int]:
    """The rows among which the ``wanted``-th largest key is, and how many of them belong to the
    ``wanted`` first. Of a range of keys one pass counts the rows in each of ``STEPS`` steps, and the
    step with the cut is the next range, until few rows are left or all have one key."""
    part, left = keyed, wanted
    while True:
        seen = part.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        n, low, high = seen.first()
        if n <= EDGE_ROWS or low == high:
            return part, left
        # the smallest and the largest key are in different steps
        step = F.least(F.floor((F.col(key) - low) / (high - low) * STEPS), F.lit(STEPS - 1))
        counts = {r["step"]: r["count"] for r in part.groupBy(step.alias("step")).count().collect()}
        for at in sorted(counts, reverse=True):
            if counts[at] >= left:
                break
            left -= counts[at]
        part = part.where(step == at)


def first_by_key(keyed: DataFrame, key: str, tie: list[str], share: float) -> DataFrame:
    """Add ``chosen``: whether a row is among the ceil(share * n) with the largest key.

    Of equal keys those come first that come first in the order of ``tie``. Rows equal in all
    are chosen together or not at all, and then count as far as they fit.
    """
    every = keyed.count()
    wanted = math.ceil(share * every)
    if not wanted:
        return keyed.withColumn("chosen", F.lit(False))
    edge, left = _edge(keyed, key, wanted)
    # rows equal in all are one row here, so a third of the table may be alike
    order = [F.col(key).desc(), *(F.col(t) for t in tie)]
    groups = edge.groupBy(key, *tie).agg(F.count(F.lit(1)).alias("rows"))
    for last in groups.orderBy(*order).toLocalIterator():
        left -= last["rows"]
        if left <= 0:
            break
    before = F.col(key) > last[key]
    same = F.col(key) == last[key]
    for name in tie:
        value = F.lit(last[name])
        # nulls come first, as in the order above
        smaller = F.col(name).isNull() & value.isNotNull() if last[name] is not None else F.lit(False)
        smaller |= F.coalesce(F.col(name) < value, F.lit(False))
        before |= same & smaller
        same &= F.col(name).eqNullSafe(value)
    return keyed.withColumn("chosen", before | same)


def importance_sample(
    documents: DataFrame, labels: DataFrame, share: float | None = None
) -> DataFrame:
    """(doc_id, log_ratio, sample_key, chosen) per row of ``documents``.

    ``share`` of the rows are chosen; by default as many as the labels call good among those that
    have one, and all without labels. The target is what the labels call good. A document labelled twice is good if all its labels
    say so; without a good document both models are alike, every ratio is 0, and the noise
    decides. Rows that agree in doc_id and text share their fate. A null or empty text has the
    ratio 0. Only ``doc_id`` and ``text`` are read.
    """
    labelled = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .dropna()
        .groupBy("doc_id")
        .agg((F.min("quality") > 0).alias("is_target"))
    )
    if share is None:
        share = labelled.agg(F.avg(F.col("is_target").cast("int"))).first()[0]
        share = 1.0 if share is None else share
    good = labelled.where("is_target")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    flagged = docs.join(dealt(good), "doc_id", "left").select(
        "text", F.coalesce("is_target", F.lit(False)).alias("is_target")
    )
    ratios = log_ratios(bucket_counts(flagged))
    if not ratios.any():
        ratios = np.zeros(BUCKETS)
    scored = with_log_ratio(docs, ratios, "log_ratio").select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "log_ratio",
        (F.col("log_ratio") * SHARPNESS + gumbel()).alias("sample_key"),
    )
    return first_by_key(written(scored), "sample_key", ["doc_id", "text_hash"], share).drop(
        "text_hash"
    )


def keep_sample(documents: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """The chosen documents, with all their columns."""
    key, flag = unused(documents, "__key"), unused(documents, "__chosen")
    sample = importance_sample(documents, labels, share).where("chosen")
    ids = sample.select(F.struct("doc_id").alias(key)).distinct().withColumn(flag, F.lit(True))
    return (
        documents.withColumn(key, F.struct(F.col("doc_id").cast("long").alias("doc_id")))
        .join(dealt(ids), key)
        .select(*(f"`{c}`" for c in documents.columns))
    )

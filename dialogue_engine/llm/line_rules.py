"""Quality rules with lines labelled by a conditional random field.

Every line with a word is content or boilerplate. Features of the line speak for either, and so
does the label of the line before it: a linear chain over the lines, decoded whole by Viterbi.
A document is kept when content lines have at least ``CONTENT_SHARE`` of its words and the base
rules let it pass.

The field is trained by likelihood. At most about ``SAMPLE_ROWS`` labelled documents, chosen by a
hash of the id, give at most ``SAMPLE_PIECES`` pieces of a few lines each, chosen by a hash all over
the text; their lines carry the document's quality label. Pieces of both labels are joined to
sequences in which the label changes from piece to piece as often as not: the field learns what
a line of either kind looks like and how long kinds last, and not that a document has one kind
alone. A document with lines of both kinds then has a share between 0 and 1. Scoring reads every
line of every text.
"""

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_engine.llm.tables import unused
from dialogue_engine.llm.words import as_bytes, blocks, windows, word_hashes

SAMPLE_ROWS = 3_000
# Pieces of a sampled document that are trained on, and lines of a piece.
SAMPLE_PIECES = 8
PIECE = 4
CONTENT_SHARE = 0.5
# Base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
# Pieces of a training sequence.
JOINED = 6
ROUNDS = 300
STEP = 0.2
SHRINK = 1e-4
FEATURES = (
    "bias", "words", "few words", "symbols", "capitals", "digits", "ends a sentence", "stops",
    "different words", "same word again", "exclaims", "seen before", "word length", "links",
)

_WORD = re.compile(r"[^ \t\n\v\f\r]+")
_LINK = re.compile(r"https?://|www\.|@\w+\.\w")


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and words of each line that has a word. All features are between 0 and 1."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            continue
        count, chars = len(words), len(line)
        letters = sum(map(len, words))
        upper = sum(map(str.isupper, words))
        digits = sum(map(str.isdigit, words))
        again = sum(map(str.__eq__, words, words[1:]))
        rows.append(
            (
                1.0,
                min(1.0, count / 50),
                float(count < 4),
                min(1.0, 4 * sum(map(line.count, SYMBOLS)) / letters),
                upper / count,
                digits / count,
                float(words[-1][-1] in ".!?…\"'”»"),
                min(1.0, (line.count(".") + line.count(",")) / count * 4),
                len(set(words)) / count,
                again / count,
                min(1.0, 2 * line.count("!") / count),
                float(line in seen),
                min(1.0, letters / count / 12),
                float(_LINK.search(line) is not None),
            )
        )
        sizes.append(count)
        seen.add(line)
    return np.array(rows).reshape(-1, len(FEATURES)), np.array(sizes, np.int64)


@dataclass
class LineField:
    """Weights of the content label against boilerplate, and of each pair of labels."""

    weights: np.ndarray
    moves: np.ndarray

    def labels(self, features: np.ndarray) -> np.ndarray:
        """The most likely labels of a document's lines: 1 is content. Of equals, content."""
        count = len(features)
        if not count:
            return np.zeros(0, np.int8)
        lines = (features @ self.weights).tolist()
        (stay0, to1), (to0, stay1) = self.moves.tolist()
        zero, one, came = 0.0, lines[0], []
        for speaks in lines[1:]:
            from_zero, from_one = zero + to1 > one + stay1, one + to0 >= zero + stay0
            came.append((from_one, not from_zero))
            zero, one = (
                one + to0 if from_one else zero + stay0,
                (zero + to1 if from_zero else one + stay1) + speaks,
            )
        out = np.empty(count, np.int8)
        label = int(one >= zero)
        out[-1] = label
        for i in range(count - 2, -1, -1):
            label = int(came[i][label])
            out[i] = label
        return out

    def content_share(self, text: str) -> float:
        """Share of the words that stand in content lines; 0 without words."""
        features, sizes = line_features(text)
        if not len(sizes):
            return 0.0
        return float(sizes[self.labels(features) == 1].sum() / sizes.sum())


def pieces_of(text: str) -> list[bytes]:
    """The features of at most ``SAMPLE_PIECES`` pieces of a text, chosen by a hash of the text and
    their number, each as 32-bit floats."""
    features, _ = line_features(text)
    cut = [features[at : at + PIECE] for at in range(0, len(features), PIECE)]
    seed = zlib.crc32(text.encode())
    chosen = sorted(range(len(cut)), key=lambda i: zlib.crc32(f"{seed}:{i}".encode()))
    return [cut[i].astype(np.float32).tobytes() for i in chosen[:SAMPLE_PIECES]]


def joined(pieces: list[tuple[np.ndarray, int]], seed: int = 17) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sequences of pieces, (features, labels) line by line. Each next piece is of either label as
    the toss of a coin says, so both have as many; the pieces of each are used in turn."""
    random = np.random.Generator(np.random.PCG64(seed))
    turns = []
    for label in (0, 1):
        own = [features for features, has in pieces if has == label]
        turns.append(itertools.cycle([own[i] for i in random.permutation(len(own))]))
    out = []
    for _ in range(-(-len(pieces) // JOINED)):
        kinds = random.integers(0, 2, JOINED)
        parts = [next(turns[kind]) for kind in kinds]
        labels = np.repeat(kinds, [len(part) for part in parts])
        out.append((np.concatenate(parts), labels))
    return out


def fit(sequences: list[tuple[np.ndarray, np.ndarray]]) -> LineField:
    """Maximum likelihood by gradient steps over sequences of features and labels of lines."""
    steps = max(len(f) for f, _ in sequences)
    x = np.zeros((len(sequences), steps, len(FEATURES)))
    there, label = np.zeros((2, len(sequences), steps))
    for i, (features, labels) in enumerate(sequences):
        x[i, : len(features)], there[i, : len(features)] = features, 1
        label[i, : len(features)] = labels
    lines = there.sum()
    seen = np.zeros((2, 2))
    for a, b in itertools.product((0, 1), repeat=2):
        seen[a, b] = (there[:, 1:] * (label[:, :-1] == a) * (label[:, 1:] == b)).sum() / lines
    weights, moves = np.zeros(len(FEATURES)), np.zeros((2, 2))
    pace = [np.zeros_like(weights), np.zeros_like(moves)]
    for round_ in range(ROUNDS):
        pull = STEP * (1 - round_ / ROUNDS)
        speaks = x @ weights
        score = np.stack([np.zeros_like(speaks), speaks], -1)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, steps):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves[None], axis=1) + score[:, t]
            ahead[:, t] = np.where(there[:, t, None] > 0, step, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            step = np.logaddexp.reduce(
                moves[None] + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2
            )
            behind[:, t] = np.where(there[:, t + 1, None] > 0, step, 0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        one = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]) * there
        grad = np.einsum("it,itf->f", (label - one) * there, x) / lines
        pairs = np.exp(
            ahead[:, :-1, :, None]
            + moves[None, None]
            + (score + behind)[:, 1:, None, :]
            - total[:, None, None, None]
        ) * there[:, 1:, None, None]
        expected = pairs.sum((0, 1)) / lines
        for k, (value, g) in enumerate(((weights, grad), (moves, seen - expected))):
            g = g - SHRINK * value
            pace[k] = 0.9 * pace[k] + 0.1 * g * g
            value += pull * g / (np.sqrt(pace[k]) + 1e-6)
    return LineField(weights, moves)


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> LineField:
    """Fit the field on a sample of labelled documents. Without lines of both labels in the sample
    every line is content. What the driver receives is bounded by ``rows``, ``SAMPLE_PIECES`` and
    ``PIECE``."""
    usable = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    # half of the sample for each label, as far as there are documents
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    share = F.lit(0)
    for label, count in counts.items():
        part = min(1 << 20, (rows // 2) * (1 << 20) // count)
        share = F.when(F.col("quality") == label, F.lit(part)).otherwise(share)
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)

    @F.arrow_udf("array<binary>")
    def features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([pieces_of(text.as_py() or "") for text in batch], pa.list_(pa.binary()))

    # at most a little over ``rows`` ids, so the texts need not move; repeated rows are one
    chosen = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(sample), "doc_id")
        .select("quality", F.explode(features("text")).alias("piece"))
        .distinct()
        .collect()
    )
    pieces = [
        (np.frombuffer(r["piece"], np.float32).reshape(-1, len(FEATURES)), int(r["quality"] > 0))
        for r in sorted(chosen, key=lambda r: (r["quality"], bytes(r["piece"])))
    ]
    if len({label for _, label in pieces}) < 2:
        weights = np.zeros(len(FEATURES))
        weights[0] = 1
        return LineField(weights, np.zeros((2, 2)))
    return fit(joined(pieces))


def base_counts(texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    encoded = [text.encode() for text in texts]
    out = []
    for first, last in blocks(encoded):
        hashes, bounds = word_hashes(encoded[first:last])
        for text, low, high in zip(texts[first:last], bounds[:-1], bounds[1:]):
            lines = [line for line in text.split("\n") if line.strip(BLANKS)]
            out.append(
                (
                    int(high - low),
                    len(text) - sum(map(text.count, BLANKS)),
                    sum(map(text.count, SYMBOLS)),
                    len(lines) - len(set(lines)),
                    _repeated(hashes[low:high]),
                )
            )
    return out


def _repeated(words: np.ndarray) -> int:
    """Words in runs of three that occur twice or more."""
    runs = windows(words, 3)
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(runs)] |= twice
    return int(covered.sum())


def with_rules(documents: DataFrame, field: LineField, name: str = "rules") -> DataFrame:
    """Add the counts and the content share as one struct. A null text is an empty one. Row by
    row; other columns are not read, and repeated rows are judged alike."""
    kinds = [(n, pa.int64()) for n in _COUNTS] + [("content_share", pa.float64())]
    kind = pa.struct(kinds)

    @F.arrow_udf("struct<" + ", ".join(f"{n}: bigint" for n in _COUNTS) + ", content_share: double>")
    def rules(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [text or "" for text in batch.to_pylist()]
            rows = [
                dict(zip(_COUNTS, counts)) | {"content_share": field.content_share(text)}
                for text, counts in zip(texts, base_counts(texts))
            ]
            yield pa.array(rows, kind)

    return documents.withColumn(name, rules(F.col("text")))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the counts, content_share, base_failed, kept) per row of ``documents``."""
    judged = with_rules(documents.select("doc_id", "text"), train(documents, labels))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return judged.select("doc_id", "rules.*").select(
        "*",
        failed.alias("base_failed"),
        (~failed & (F.col("content_share") >= CONTENT_SHARE)).alias("kept"),
    )

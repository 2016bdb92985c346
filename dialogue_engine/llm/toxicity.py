"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its different words (runs of letters, lower case) and the first four and five
letters of longer words, which hold across endings that no training text had. Terms are known
by a 32-bit hash. Besides a weight per term the machine has a vector per term, and adds the
product of the vectors of every two terms of a text: two words that are harmless alone can be
toxic together, which no sum of weights can say.

Training takes at most about ``SAMPLE_ROWS`` labelled documents, chosen by a hash of the id, the
``TERMS`` terms that tell the classes apart best, and Spark's own ``FMClassifier``. These bounds
are parameters and hold at every size; scoring reads all texts whole.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogue_engine.llm.tables import unused
from dialogue_engine.llm.terms import Machine, listed_terms
from dialogue_engine.scratch import written

THRESHOLD = 0.7
SAMPLE_ROWS = 20_000
TERMS = 4096
# A term must be as telling as this chi-square: four documents of a class of one tenth pass.
LEAST_CHI = 30.0
FACTORS = 4
ITERATIONS = 100
STEP = 0.2
SHRINK = 0.0001


def training_rows(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, toxic) of about ``rows`` labelled documents, none of them held out.

    A document is held out when the crc32 of its id as text leaves 1 when divided by 3. The
    sample is cut by a hash, so it is the same whatever the partitioning. A document labelled
    twice counts as toxic if one label says so; rows without id or label are left out.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .dropna()
        .where(~is_held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    count = usable.count()
    if count <= rows:
        return usable
    return usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rows * (1 << 20) // count)


def is_held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine:
    """Fit the machine. Only texts and labels are inputs. Without both classes in the sample, or
    without a term that is frequent enough, every text has the share of toxic documents as its
    score (0 without labels)."""

    @F.arrow_udf("array<bigint>")
    def hashes(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield listed_terms(batch)

    # at most a little over ``rows`` ids, so the other side need not move; the terms of the sample
    # are used several times and are made once
    sample = F.broadcast(training_rows(labels, rows))
    terms = written(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(sample, "doc_id")
        .select("toxic", hashes("text").alias("terms"))
    )
    sizes = {r["toxic"]: r["count"] for r in terms.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    share = toxic / max(1, clean + toxic)
    prior = math.log((share or 1e-9) / (1 - share or 1e-9))
    nothing = Machine({}, prior, np.zeros(0), np.zeros((0, FACTORS)))
    if not clean or not toxic:
        return nothing

    # chi-square of term and label; a term that all documents have tells nothing
    n1, n0, n = F.col("n1"), F.col("n0"), clean + toxic
    apart = (n1 * clean - n0 * toxic).cast("double")
    chi = apart**2 * n / (F.lit(float(clean) * toxic) * (n1 + n0) * F.greatest(n - n1 - n0, F.lit(1)))
    chosen = (
        terms.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
        .withColumn("chi", chi)
        .where(F.col("chi") >= LEAST_CHI)
        .orderBy(F.col("chi").desc(), "term")
        .limit(TERMS)
    )
    numbers = {row["term"]: i for i, row in enumerate(chosen.select("term").collect())}
    if not numbers:
        return nothing

    # the vectors are made in the JVM, from the terms as text
    vectorizer = CountVectorizerModel.from_vocabulary(
        [str(term) for term in numbers], "names", "features"
    ).setBinary(True)
    examples = vectorizer.transform(
        terms.select(
            F.col("toxic").cast("double").alias("label"),
            F.col("terms").cast("array<string>").alias("names"),
        )
    ).select("label", "features")
    model = FMClassifier(
        factorSize=FACTORS, maxIter=ITERATIONS, stepSize=STEP, regParam=SHRINK, seed=7, tol=1e-6
    ).fit(examples)
    return Machine(numbers, model.intercept, model.linear.toArray(), model.factors.toArray())


def with_score(documents: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """Add the probability, from 0 to 1, that a text is toxic. A null text is an empty one, which
    scores what the machine says of no terms. Row by row; other columns are not read."""

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield machine.scores(batch)

    return documents.withColumn(name, score(F.col("text")))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): every document scored by a machine that has seen
    labels of documents that are not held out alone. A null id counts as not held out."""
    scored = with_score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select(
        "doc_id",
        F.coalesce(is_held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not found toxic, with all their columns."""
    name = unused(documents, "__score")
    scored = with_score(documents, train(documents, labels), name)
    return scored.where(F.col(name) < THRESHOLD).select(*(f"`{c}`" for c in documents.columns))

import math
import random
from collections import Counter

import numpy as np
import pytest
from edges import COLUMNS, documents, edge_documents, no_documents
from pyspark.sql import functions as F

from dialogue_engine.llm import resample as R


def corpus(spark, n=300):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        stock = "river stone walks quietly under old light" if good else "buy cheap now click here win"
        texts.append(" ".join(rng.choices(stock.split(), k=rng.randrange(20, 60))))
        if i % 2:
            labels.append((i, int(good)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int"), texts


def test_counts_against_python(spark):
    docs, _, texts = corpus(spark)
    flagged = docs.withColumn("is_target", F.col("doc_id") % 3 == 0)
    got = {r.bucket: (r.raw, r.target) for r in R.bucket_counts(flagged).collect()}
    assert sum(v[0] for v in got.values()) == sum(2 * len(t.split()) - 1 for t in texts)
    assert sum(v[1] for v in got.values()) == sum(2 * len(t.split()) - 1 for t in texts[::3])
    # as many buckets as different words and pairs, unless two share one
    kinds = set()
    for t in texts:
        w = t.split()
        kinds |= set(w) | set(zip(w, w[1:]))
    assert len(kinds) - 3 <= len(got) <= len(kinds)


def test_ratio_is_the_mean(spark):
    docs, labels, texts = corpus(spark)
    flagged = docs.join(labels.where("quality > 0"), "doc_id", "left").select(
        "text", F.col("quality").isNotNull().alias("is_target")
    )
    ratios = R.log_ratios(R.bucket_counts(flagged))
    rows = R.with_log_ratio(docs, ratios, "r").collect()
    for r in rows[:40]:
        (found, bounds), = R._features([r.text.encode()])
        assert r.r == pytest.approx(float(np.mean(ratios[found])), abs=1e-5)


def test_good_texts_are_chosen(spark):
    docs, labels, _ = corpus(spark)
    rows = R.importance_sample(docs, labels).collect()
    # half of the labelled rows are of each residue 1 and 3, all of them good
    chosen = Counter(r.doc_id % 4 > 0 for r in rows if r.chosen)
    assert sum(chosen.values()) == len(rows)
    rows = R.importance_sample(docs, labels, 0.75).collect()
    assert sum(r.chosen for r in rows) == math.ceil(0.75 * len(rows))
    assert all(r.doc_id % 4 > 0 for r in rows if r.chosen)


@pytest.mark.parametrize("share", [0.0, 0.01, 0.33, 0.5, 1.0])
def test_cut_against_sorting(spark, share):
    rng = random.Random(2)
    rows = [(i, rng.choice([rng.random() * 9 - 4, 1.5, 1.5]), rng.choice([None, i])) for i in range(200)]
    keyed = spark.createDataFrame(rows, "doc_id long, k double, tie long")
    got = {r.doc_id for r in R.first_by_key(keyed, "k", ["tie", "doc_id"], share).collect() if r.chosen}
    order = sorted(rows, key=lambda r: (-r[1], r[2] is not None, r[2] or 0, r[0]))
    assert got == {r[0] for r in order[: math.ceil(share * 200)]}


@pytest.mark.parametrize("share", [0.0, 0.004, 0.3, 0.77, 1.0])
def test_cut_in_many_small_steps(spark, monkeypatch, share):
    """Close, far and equal keys; few rows are put in order, and a third of all are one row."""
    monkeypatch.setattr(R, "STEPS", 4)
    monkeypatch.setattr(R, "EDGE_ROWS", 3)
    rng = random.Random(5)
    rows = [(i, rng.choice([rng.random(), rng.random() * 1e-9, rng.random() * 1e9, -7.0]), i % 5) for i in range(400)]
    rows += [(-1, 0.25, 0)] * 200
    keyed = spark.createDataFrame(rows, "doc_id long, k double, tie long").repartition(5)
    got = sorted(r.doc_id for r in R.first_by_key(keyed, "k", ["tie", "doc_id"], share).collect() if r.chosen)
    order = sorted(rows, key=lambda r: (-r[1], r[2], r[0]))
    wanted = [r[0] for r in order[: math.ceil(share * 600)]]
    if wanted and wanted[-1] == -1:
        wanted += [-1] * (200 - wanted.count(-1))
    assert got == sorted(wanted)


def test_noise_is_gumbel(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    mean, dev = docs.select(R.gumbel().alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert mean == pytest.approx(0.5772, abs=0.05) and dev == pytest.approx(1.2825, abs=0.05)


@pytest.mark.parametrize("rows", [[], [(5, 1)], [(5, 0)], [(None, 1), (5, None)], [(5, 1), (5, 0)]])
def test_edges(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = R.importance_sample(edge_documents(spark), labels, 0.5).collect()
    assert len(got) == 10
    assert sum(r.chosen for r in got) in (4, 5, 6)
    kept = R.keep_sample(edge_documents(spark), labels, 1.0)
    assert kept.columns == COLUMNS and kept.count() == 10
    assert R.importance_sample(no_documents(spark), labels).collect() == []

import random

import numpy as np
import pytest
from edges import COLUMNS, documents, edge_documents, no_documents

from dialogue_engine.llm import toxicity as T
from dialogue_engine.llm.terms import term_hashes


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def trained(spark):
    """A toxic text has both an insult and the name of a group; either alone is clean."""
    rng = random.Random(3)
    filler = [f"word{i:03d}" for i in range(200)]
    texts, labels = [], []
    for i in range(900):
        words = rng.choices(filler, k=20)
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["zinsult"] * insult + ["qgroup"] * group
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append((i, int(insult and group)))
    return texts, labels, T.train(documents(spark, texts), labelled(spark, labels))


def held_out(spark):
    rows = spark.range(900).withColumnRenamed("id", "doc_id").where(T.is_held_out()).collect()
    return {r.doc_id for r in rows}


def test_pairs_of_terms_decide(spark, trained):
    texts, labels, machine = trained
    test = held_out(spark)
    right = [(machine.score(texts[i]) >= 0.5) == bool(t) for i, t in labels if i in test]
    assert len(right) > 200 and np.mean(right) > 0.95
    both, one = machine.score("zinsult qgroup"), machine.score("zinsult and more")
    assert both > 0.7 > one


def test_score_is_the_sum_over_all_pairs(trained):
    """Against the definition, pair by pair."""
    texts, _, machine = trained
    for text in texts[:30]:
        at = sorted({machine.numbers[h] for h in term_hashes(text) if h in machine.numbers})
        total = machine.bias + sum(machine.weights[i] for i in at)
        for n, i in enumerate(at):
            for j in at[:n]:
                total += machine.vectors[i] @ machine.vectors[j]
        assert machine.score(text) == pytest.approx(1 / (1 + np.exp(-total)))


def test_held_out_labels_are_not_used(spark, trained):
    texts, labels, machine = trained
    test = held_out(spark)
    turned = [(i, 1 - t if i in test else t) for i, t in labels]
    again = T.train(documents(spark, texts), labelled(spark, turned))
    assert again.numbers == machine.numbers
    assert np.allclose(again.weights, machine.weights)


def test_stems_reach_unseen_endings():
    assert set(term_hashes("loweiung")) & set(term_hashes("loweischaft"))
    assert not set(term_hashes("lowest")) & set(term_hashes("slowest"))


def test_sample_is_bounded(spark):
    labels = labelled(spark, [(i, i % 2) for i in range(3000)])
    few = T.training_rows(labels, 300).collect()
    assert 200 < len(few) < 400
    assert {r.doc_id for r in few} <= {r.doc_id for r in T.training_rows(labels, 10**6).collect()}


@pytest.mark.parametrize(
    "rows", [[], [(5, 1)], [(5, 0), (6, 0)], [(None, 1), (5, None)], [(5, 1), (5, 0), (6, 0), (7, 0)]]
)
def test_edges(spark, rows):
    docs, labels = edge_documents(spark), labelled(spark, rows)
    scored = T.toxicity(docs, labels).collect()
    assert len(scored) == 10
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in scored)
    assert all(r.predicted == int(r.score >= 0.7) for r in scored)
    assert len({r.score for r in scored if r.doc_id in (1, 2, 3)}) == 1
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == COLUMNS
    assert T.toxicity(no_documents(spark), labels).collect() == []

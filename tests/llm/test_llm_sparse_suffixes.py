import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edges import documents, edge_documents, no_documents

from dialogue_engine.llm import sparse_suffixes as S


def covered(texts):
    """Words in runs of 50 that occur twice, by looking at all runs."""
    words = [(t or "").split() for t in texts]
    seen = Counter(tuple(w[i : i + 50]) for w in words for i in range(len(w) - 49))
    out = {}
    for d, w in enumerate(words):
        marks = set()
        for i in range(len(w) - 49):
            if seen[tuple(w[i : i + 50])] > 1:
                marks |= set(range(i, i + 50))
        if marks:
            out[d] = marks
    return out


def found(spark, texts, **how):
    marks, later = defaultdict(set), 0
    for r in S.repeated_passages(documents(spark, texts), **how).collect():
        marks[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
        later += r.later_words
    return dict(marks), later


def corpus(seed):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    passages = [fresh(n) for n in (30, 49, 50, 51, 60, 90, 200)]
    texts = []
    for _ in range(60):
        words = fresh(rng.randrange(80))
        for _ in range(rng.randrange(3)):
            words += passages[rng.randrange(len(passages))] + fresh(rng.randrange(1, 60))
        texts.append(" ".join(words))
    return texts + [texts[0], "", None, " ".join(passages[3]), " ".join(fresh(3000))]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_runs(spark, seed):
    texts = corpus(seed)
    assert found(spark, texts)[0] == covered(texts)


def test_runs_with_many_contexts(spark):
    """Whatever a task compares itself and what is grouped by window, the passages are the same."""
    texts = corpus(3) + [" ".join(w) for w in one_sided(random.Random(1), "h")]
    rows = [sorted(S.repeated_passages(documents(spark, texts), most=m).collect()) for m in (0, 3, 20_000)]
    assert rows[0] == rows[1] == rows[2]
    assert found(spark, texts, most=0)[0] == covered(texts)


def test_rows_handed_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS", 60)
    texts = corpus(3)
    assert found(spark, texts)[0] == found(spark, texts, most=0)[0] == covered(texts)


def later_of(texts):
    """Words in windows that an earlier place has, by comparing all windows."""
    seen, count = set(), 0
    for text in texts:
        words, marks = (text or "").split(), set()
        for i in range(len(words) - 49):
            window = tuple(words[i : i + 50])
            if window in seen:
                marks |= set(range(i, i + 50))
            seen.add(window)
        count += len(marks)
    return count


@pytest.mark.parametrize("most", [0, 20_000])
def test_later_words(spark, most):
    texts = [t for t in corpus(5) if t] + ["b " * 130, "c d " * 60]
    marks, later = found(spark, texts, most=most)
    assert marks == covered(texts)
    assert later == later_of(texts)


def test_range_hashes():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**64, 3, dtype=np.uint64)[rng.integers(0, 3, 400)]
    starts, sizes = rng.integers(0, 300, 3000), rng.integers(0, 9, 3000)
    hashes = S.range_hashes(words, starts, sizes)
    of = defaultdict(set)
    for s, n, h in zip(starts, sizes, hashes):
        of[tuple(words[s : s + n])].add(int(h))
    assert all(len(h) == 1 for h in of.values()) and len({h for v in of.values() for h in v}) == len(of)


def test_later_words_leave_one_copy(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(70))
    texts = [f"a{i} b{i} {passage} c{i}" for i in range(5)]
    marks, later = found(spark, texts)
    assert set(marks) == set(range(5)) and all(len(m) == 70 for m in marks.values())
    assert later == 4 * 70


def test_every_window_has_its_smallest():
    rng = np.random.default_rng(5)
    runs = rng.integers(0, 50, 300, dtype=np.uint64)
    places = set(S.minimisers(runs).tolist())
    for i in range(len(runs) - S.CHOICE + 1):
        part = runs[i : i + S.CHOICE]
        assert i + int(part.argmin()) in places
    assert len(S.minimisers(runs[: S.CHOICE - 1])) == 0


def test_edges(spark):
    assert S.repeated_passages(edge_documents(spark)).collect() == []
    assert S.repeated_passages(no_documents(spark)).collect() == []
    twice = " ".join(f"w{i}" for i in range(60))
    rows = [(None, twice), (1, twice), (1, twice), (2, f"{twice} x {twice}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.start_word, r.n_words) for r in S.repeated_passages(docs).collect())
    assert got == [(0, 0, 60), (1, 0, 60), (2, 0, 60), (2, 61, 60)]


def one_sided(rng, name):
    """A text and four others: two share its middle words with 25 more on one side or less than 25
    on the other. Only the first of each pair reaches 50 words with it, and others match a side longer."""
    fresh = lambda n: [f"{name}{rng.randrange(10**6)}" for _ in range(n)]
    left, run, right = fresh(25), fresh(25), fresh(25)
    part = lambda before, after: [
        *fresh(30), *left[25 - before :], *run, *right[:after], *fresh(30)
    ]
    sides = [(25, 0), (24, 0), (23, 0), (0, 25), (0, 24), (0, 23)]
    return [part(12, 13), part(12, 13), *(part(max(0, b - 1), max(0, a - 1)) for b, a in sides)]


def test_matches_behind_longer_one_sided_ones(spark):
    """Runs of few members: others match one side longer, but not 50 words together."""
    rng = random.Random(6)
    texts = [" ".join(w) for i in range(40) for w in one_sided(rng, f"g{i}x")]
    wanted = covered(texts)
    assert len(wanted) >= 80
    assert found(spark, texts)[0] == wanted


def test_matches_with_different_texts_add_up(spark):
    """One text has the first 50 of 75 words and another the last 50: all 75 are marked, also where
    a single suffix is kept in them."""
    rng = random.Random(8)
    fresh = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(250):
        words = fresh(75)
        for part in (words, words[:50], words[25:]):
            texts.append(" ".join([*fresh(30), *part, *fresh(30)]))
    got, later = found(spark, texts)
    assert got == covered(texts)
    assert all(got[i] == set(range(30, 105)) for i in range(0, len(texts), 3))
    assert later == 250 * 100


def test_one_text_that_repeats_a_word(spark):
    """A few contexts at 20,000 places. Every word but the first is in a window that another place,
    which overlaps it, has before."""
    docs = documents(spark, ["a " * 20_000])
    entries = S.entries(S.suffixes(docs)).collect()
    assert len({e.run for e in entries}) == 1 and len(entries) <= 60
    got = [(r.start_word, r.n_words, r.later_words) for r in S.repeated_passages(docs).collect()]
    assert got == [(0, 20_000, 19_999)]


def test_hot_passage_moves_as_few_rows(spark):
    """A passage in all of 300 texts: what is compared grows with the texts' edges alone."""
    passage = " ".join(f"p{i}" for i in range(400))
    texts = [f"a{i} b{i} {passage} c{i}" for i in range(300)]
    suffixes = S.suffixes(documents(spark, texts))
    rows, kept = S.entries(suffixes).count(), suffixes.count()
    assert kept > 300 * 20 and rows < 300 * 8
    assert found(spark, texts) == ({i: set(range(2, 402)) for i in range(300)}, 299 * 400)

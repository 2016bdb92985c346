import math
import random

import numpy as np
import pytest
from edges import COLUMNS, documents, edge_documents, no_documents

from dialogue_engine.llm import decontaminate as D

RNG = random.Random(11)


def text(n):
    return [f"t{RNG.randrange(3000)}" for _ in range(n)]


ITEMS = [text(n) for n in (3, 6, 11, 12, 15, 20, 30, 45, 70, 150)]


def benchmark(spark, items=ITEMS):
    rows = [(i, " ".join(words)) for i, words in enumerate(items)]
    return spark.createDataFrame(rows, "item_id long, text string")


def hits(spark, texts, items=ITEMS):
    rows = D.contaminations(documents(spark, texts), benchmark(spark, items)).collect()
    return {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in rows}


def test_unchanged_items_are_found_wherever_they_stand(spark):
    texts, wanted = [], {}
    for shift in range(23):
        for number, item in enumerate(ITEMS):
            wanted[len(texts), number] = shift
            texts.append(" ".join([*text(shift), *item, *text(9)]).upper())
    got = hits(spark, texts)
    assert {k: v[0] for k, v in got.items()} == wanted
    assert all(v[1] == 1.0 for v in got.values())


def test_changed_items_are_judged_by_their_shingles(spark):
    """One word changed near the end leaves enough, changing every sixth does not."""
    item = ITEMS[7]
    slight = [*item[:43], "other", item[44]]
    heavy = [w if i % 6 else "other" for i, w in enumerate(item)]
    texts = [" ".join([*text(30), *words, *text(30)]) for words in (item, slight, heavy, text(90))]
    got = hits(spark, texts)
    assert set(got) == {(0, 7), (1, 7)}
    assert D.SIMILARITY <= got[1, 7][1] < 1


def test_brute_force(spark):
    """Against the share of shingles at every place of every text."""
    texts = []
    for _ in range(60):
        words = text(RNG.randrange(0, 100))
        for _ in range(2):
            item = list(ITEMS[RNG.randrange(len(ITEMS))])
            if RNG.random() < 0.3 and len(item) > 20:
                item[RNG.randrange(len(item))] = "other"
            words += [*item, *text(RNG.randrange(0, 100))]
        texts.append(" ".join(words))
    wanted = set()
    for d, t in enumerate(texts):
        words = t.split()
        have = {tuple(words[i : i + 5]) for i in range(len(words))}
        for n, item in enumerate(ITEMS):
            if len(item) < 5:
                if any(words[i : i + len(item)] == item for i in range(len(words))):
                    wanted.add((d, n))
                continue
            own = {tuple(item[i : i + 5]) for i in range(len(item) - 4)}
            if len(own & have) >= 0.8 * len(own):
                wanted.add((d, n))
    got = set(hits(spark, texts))
    clear = {(d, n) for d, n in got if (d, n) not in wanted}
    assert wanted <= got
    # only places between 0.75 and 0.8, which the count above leaves out
    assert len(clear) <= 3


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2**64, 50, dtype=np.uint64)
    index = D.SizeIndex(9, prints.tolist(), [0] * 50, [0] * 50)
    index.open()
    asked = prints.copy()
    for i in range(50):
        for bit in rng.choice(64, D.RADIUS, replace=False):
            asked[i] ^= np.uint64(1 << int(bit))
    window, mine = index.near(asked)
    assert {(i, i) for i in range(50)} <= set(zip(window.tolist(), mine.tolist()))


def test_fingerprint_is_the_majority_of_bits():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**64, 80, dtype=np.uint64)
    for size in (5, 9, 64):
        got = D.Sums(hashes).fingerprints(np.array([0, 7]), size)
        for start, value in zip((0, 7), got.tolist()):
            part = hashes[start : start + size].tolist()
            bits = [sum(h >> b & 1 for h in part) for b in range(64)]
            assert value == sum(1 << b for b in range(64) if bits[b] >= (size + 1) // 2)


def test_slices_add_up(spark, monkeypatch):
    texts = [" ".join([*text(5), *item, *text(5)]) for item in ITEMS]
    whole = hits(spark, texts)
    monkeypatch.setattr(D, "SLICE_FINGERPRINTS", 5)
    assert hits(spark, texts) == whole


def test_slices_with_nulls_repeats_and_odd_columns(spark, monkeypatch):
    """In many slices, each with a pass of its own, rows and columns stay as they are."""
    monkeypatch.setattr(D, "SLICE_FINGERPRINTS", 5)
    item = " ".join(ITEMS[0])
    rows = [(1, item, "x"), (1, item, "y"), (None, item, "z"), (2, None, "x"), (3, "", "x"), (4, "nothing of it", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    held = D.with_hits(docs, benchmark(spark, ITEMS)).collect()
    assert sorted((str(r.doc_id), r["a.b"], len(r.hits)) for r in held) == [
        ("1", "x", 1), ("1", "y", 1), ("2", "x", 0), ("3", "x", 0), ("4", "x", 0), ("None", "z", 1)
    ]
    kept = D.drop_contaminated(docs, benchmark(spark, ITEMS))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


@pytest.mark.parametrize("items", [[], [[]], ITEMS])
def test_edges(spark, items):
    docs = edge_documents(spark)
    kept = D.drop_contaminated(docs, benchmark(spark, items))
    assert kept.columns == COLUMNS
    assert kept.count() == 10
    assert D.contaminations(no_documents(spark), benchmark(spark, items)).collect() == []


def test_null_items_are_left_out(spark):
    items = spark.createDataFrame([(1, None), (None, "a b c d e f")], "item_id long, text string")
    assert D.contaminations(documents(spark, ["a b c d e f"]), items).collect() == []


def test_contaminated_rows_go(spark):
    docs = documents(spark, [" ".join(ITEMS[5]), "clean text", None])
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, benchmark(spark)).collect()) == [1, 2]


def edited(rng, item):
    """Cut at the front, in the middle or at the end, words changed all over, or a word put in."""
    n = len(item)
    kind = rng.randrange(5)
    if kind < 3:
        cut = rng.randrange(1, n // 4 + 1)
        low = (0, rng.randrange(n - cut), n - cut)[kind]
        return item[:low] + item[low + cut :]
    words = list(item)
    for _ in range(max(1, n // 20)):
        at = rng.randrange(n)
        words[at : at + (kind == 3)] = [f"new{rng.randrange(10**6)}"]
    return words


def every_place(texts, items):
    """(text, item) where a piece with the slack around it has 0.75 of the item's shingles."""
    held = {}
    sets = [{tuple(item[i : i + 5]) for i in range(len(item) - 4)} for item in items]
    for own in sets:
        for shingle in own:
            held[shingle] = held.get(shingle, 0) + 1
    out = set()
    for n, (item, own) in enumerate(zip(items, sets)):
        weight = {s: math.log1p(len(items) / held[s]) for s in own}
        slack = len(item) // 8
        for d, words in enumerate(texts):
            runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
            if sum(weight[s] for s in own & set(runs)) < 0.7 * sum(weight.values()):
                continue
            for place in range(len(words)):
                first, last = max(0, place - slack), min(len(words), place + len(item) + slack)
                share = sum(weight[s] for s in own & set(runs[first : max(first, last - 4)]))
                if share / sum(weight.values()) >= 0.75 - 1e-9:
                    out.add((d, n))
    return out


def test_cut_and_edited_items_against_every_place(spark):
    rng = random.Random(12)
    items = [text(n) for n in (20, 40, 50, 59, 100, 200) for _ in range(2)]
    texts = []
    for _ in range(40):
        for item in items:
            texts.append([*text(rng.randrange(40)), *edited(rng, item), *text(rng.randrange(40))])
    wanted = every_place(texts, items)
    assert len(wanted) > 200
    assert set(hits(spark, [" ".join(words) for words in texts], items)) == wanted


def test_weights_are_those_of_the_whole_benchmark(spark, monkeypatch):
    """Items that share shingles, cut so that the share is near 0.75, in one slice and in many."""
    common = text(30)
    items = [[*common, *text(30)] for _ in range(8)]
    texts = [" ".join([*text(4), *item[cut:], *text(4)]) for item in items for cut in (12, 24, 30)]
    whole = hits(spark, texts, items)
    assert 0 < len(whole) < len(texts)
    monkeypatch.setattr(D, "SLICE_FINGERPRINTS", 5)
    assert hits(spark, texts, items) == whole

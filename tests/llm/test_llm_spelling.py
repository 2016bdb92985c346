"""Spelling variants against the contract word by word, and the bound of the gram index."""

import random
import re
import zlib
from collections import Counter

from edges import LONG, edge_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from dialogue_engine.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def groups(counts):
    """(word, form, root, n, n_near, form_n) by comparing all pairs."""
    form = {}
    rows = {}
    for word, n in counts.items():
        around = [(-counts[o], o) for o in counts if near(word, o)]
        best = min(around, default=None)
        if best and -best[0] >= 2 * n:
            form[word] = best[1]
        rows[word] = (form.get(word), n, len(around), -best[0] if word in form else None)
    out = []
    for word, (f, n, n_near, form_n) in rows.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, f, root, n, n_near, form_n))
    return sorted(out)


def words_of(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_against_all_pairs(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choices("abÀé×z", k=rng.randint(3, 9))) for _ in range(60)]

    def variant(w):
        at = rng.randrange(len(w))
        return rng.choice([w, w.upper(), w[:at] + w[at + 1 :], w[:at] + rng.choice("abé") + w[at:]])

    rows = [(i, " ".join(variant(w) for w in rng.choices(stems, k=80))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = groups(words_of(rows))
    assert result(spelling.spelling_variants(df)) == wanted
    assert any(r[2] != r[1] and r[1] for r in wanted), "no path of two steps"


def test_pairs_with_any_dictionary(spark):
    """However the lists are cut, no pair is lost: everything frequent, nothing frequent."""
    rng = random.Random(9)
    words = {"".join(rng.choices("ab", k=rng.randint(5, 9))) for _ in range(150)} | {"a" * 40, "a" * 41, "ab" * 20}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    wanted = sorted((a, b) for a in words for b in words if near(a, b))
    keep = spelling.frequent_grams
    try:
        for least in (0, 3, 10**6):
            spelling.frequent_grams = lambda found, least=least: keep(found, least)
            assert sorted((r.word, r.other) for r in spelling.near_pairs(df).collect()) == wanted
    finally:
        spelling.frequent_grams = keep


def test_frequent_grams_are_bounded(spark):
    words = [("".join(p), 3) for p in __import__("itertools").product("abc", repeat=5)]
    df = spark.createDataFrame(words, "word string, n long")
    assert "^a" in spelling.frequent_grams(df, least=10)
    for most in (1, 5, 50):
        assert len(spelling.frequent_grams(df, least=0, most=most)) <= most


letters = st.text("abcé", min_size=5, max_size=12)


@settings(max_examples=300, deadline=None)
@given(letters, st.sets(st.text("^abcé$", min_size=2, max_size=4), max_size=60), st.data())
def test_one_edit_leaves_one_of_the_merged_lists(word, frequent, data):
    at = data.draw(st.integers(0, len(word)))
    letter = data.draw(st.sampled_from("abcé"))
    how = data.draw(st.sampled_from(["in", "out", "other"]))
    if how == "in":
        edited = word[:at] + letter + word[at:]
    else:
        at = min(at, len(word) - 1)
        edited = word[:at] + (letter if how == "other" else "") + word[at + 1 :]
    grams = spelling.decompose(word, frequent)
    there = spelling.decompose(edited, frequent)
    moved = len(edited) - len(word)
    lost = {
        p
        for p, g in enumerate(grams)
        if not (p < len(there) and there[p] == g) and not (0 <= p + moved < len(there) and there[p + moved] == g)
    }
    spans = [set(range(p, p + len(g))) for p, g in enumerate(grams)]
    # what is lost spans one place
    assert not lost or set.intersection(*(spans[p] for p in lost))
    lengths = data.draw(st.lists(st.integers(1, 50), min_size=len(grams), max_size=len(grams)))
    a, b = spelling.cheapest([len(g) for g in grams], lengths)
    assert not spans[a] & spans[b] and not {a, b} <= lost
    assert lengths[a] + lengths[b] == min(
        lengths[i] + lengths[j] for i in range(len(grams)) for j in range(i) if not spans[i] & spans[j]
    )


def test_edges(spark):
    rows = [tuple(r)[:2] for r in edge_documents(spark).collect()]
    assert result(spelling.spelling_variants(edge_documents(spark))) == groups(words_of(rows))
    assert result(spelling.spelling_variants(no_documents(spark))) == []


def test_very_long_words_and_ties(spark):
    long = "q" * 20_000
    rows = [(i, f"{long} {long}r water WATER wafer wager {LONG[:50]}") for i in range(4)]
    rows += [(None, "wafer wager"), (None, "Çedille Çedille Çedille çedille"), (None, "a" * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(spelling.spelling_variants(df)) == groups(words_of(rows))

import hashlib
import random
import re
import time

from edges import COLUMNS, documents, edge_documents, no_documents
from helpers import plan
from pyspark.sql import functions as F

from dialogue_engine.llm import line_chunks as L


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def chunks_of(text):
    lines = (text or "").split("\n")
    return [
        (i, f"{a}\n{b}")
        for i, (a, b) in enumerate(zip(lines, lines[1:]))
        if digest(digest(a) + digest(b))[0] < L.CUT_BELOW and words(f"{a}\n{b}") >= L.LEAST_WORDS
    ]


def cleaned(texts):
    """Chunk by chunk in the order of the documents; a set of what has been seen."""
    seen, out = set(), []
    for text in texts:
        gone = set()
        for i, chunk in chunks_of(text):
            if chunk in seen:
                gone |= {i, i + 1}
            seen.add(chunk)
        lines = (text or "").split("\n")
        out.append(text if text is None else "\n".join(l for i, l in enumerate(lines) if i not in gone))
    return out


def corpus(seed):
    rng = random.Random(seed)
    line = lambda: " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 16)))
    hot = [line() for _ in range(12)]
    texts = []
    for _ in range(40):
        lines = [line() for _ in range(rng.randrange(1, 30))]
        if rng.random() < 0.7:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = hot
        if rng.random() < 0.2:
            lines += lines
        texts.append("\n".join(lines))
    return texts + ["", None, "\n\n\n\n", "x", "\n".join(["same"] * 200), texts[0], texts[1]]


def test_against_a_set_of_seen_chunks(spark):
    texts = corpus(7)
    got = {r.doc_id: r.text for r in L.drop_repeated_lines(documents(spark, texts)).collect()}
    assert got == dict(enumerate(cleaned(texts)))


def test_chunks(spark):
    texts = corpus(8)
    rows = documents(spark, texts).select("doc_id", L._chunks(F.col("text")).alias("c")).collect()
    for r in rows:
        found = chunks_of(texts[r.doc_id])
        assert [c["at"] for c in r.c] == [at for at, _ in found]
        assert len({c["hash"] for c in r.c}) == len({chunk for _, chunk in found})


def test_chunks_are_the_same_wherever_they_stand():
    rng = random.Random(9)
    lines = [f"line {rng.random()} with some more words to count for it" for _ in range(200)]
    chunks = {c for _, c in chunks_of("\n".join(lines))}
    moved = {c for _, c in chunks_of("\n".join([lines[-1], "new one", *lines[:90], "in between", *lines[90:]]))}
    assert len(chunks - moved) <= 1 and len(chunks) > 150


def repeats(texts, least=50):
    """Runs of two lines or more, of so many words or more, that stand at an earlier place in that
    order, as (text, numbers of lines), by comparing all neighbouring lines."""
    seen, out = set(), []
    for n, text in enumerate(texts):
        lines = (text or "").split("\n")
        pairs = list(zip(lines, lines[1:]))
        marks = [i for i, pair in enumerate(pairs) if pair in seen]
        seen.update(pairs)
        run = []
        for i in [*marks, None]:
            if run and (i is None or i > run[-1] + 1):
                at = [*run, run[-1] + 1]
                if words("\n".join(lines[j] for j in at)) >= least:
                    out.append((n, at))
                run = []
            if i is not None:
                run.append(i)
    return out


def test_recall_of_repeated_passages(spark):
    """Passages of two to six lines in other surroundings: of their lines nine in ten go, and no line
    that does not repeat does."""
    rng = random.Random(21)
    line = lambda: " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(8, 50)))
    passages = [[line() for _ in range(rng.choice([2, 2, 2, 3, 3, 4, 6]))] for _ in range(60)]
    texts = []
    for _ in range(300):
        lines = [line() for _ in range(rng.randrange(6))]
        for _ in range(rng.randrange(3)):
            lines += [*rng.choice(passages), *(line() for _ in range(rng.randrange(1, 5)))]
        texts.append("\n".join(lines))
    left = {r.doc_id: r.text.split("\n") for r in L.drop_repeated_lines(documents(spark, texts)).collect()}
    found = repeats(texts)
    assert len(found) > 150
    wanted = [(n, i) for n, at in found for i in at]
    gone = sum(texts[n].split("\n")[i] not in left[n] for n, i in wanted)
    assert gone / len(wanted) >= 0.9
    assert sum(any(texts[n].split("\n")[i] not in left[n] for i in at) for n, at in found) / len(found) >= 0.9
    repeated = {(n, i) for n, at in repeats(texts, 0) for i in at}
    fresh = [(n, line) for n, t in enumerate(texts) for i, line in enumerate(t.split("\n")) if (n, i) not in repeated]
    assert len(fresh) > 1000 and all(line in left[n] for n, line in fresh)


def test_many_lines(spark):
    """Half of 60,000 lines go in a text; neither cutting nor removal grows faster than the text."""
    lines = [f"line {i} of a long text with words enough in it" for i in range(60_000)]
    texts = ["\n".join(lines[::2][i] + "\n" + lines[1::2][i] for i in range(30_000)), "\n".join(lines[:30_000])]
    start = time.time()
    rows = {r.doc_id: r.text for r in L.drop_repeated_lines(documents(spark, texts)).collect()}
    assert time.time() - start < 60
    assert rows == dict(enumerate(cleaned(texts))) and len(rows[1]) < 0.1 * len(texts[1])


def test_no_python_in_the_plan(spark):
    text = plan(L.drop_repeated_lines(documents(spark, corpus(1)), counts=True))
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "BroadcastHash"))


def test_edges(spark):
    docs = edge_documents(spark)
    got = L.drop_repeated_lines(docs)
    assert got.columns == COLUMNS
    rows = got.collect()
    assert len(rows) == 10
    by = {(r.doc_id, r.text): r.n_chars for r in rows}
    assert by[1, None] is None and (2, "") in by
    # the repeated row is the same document, the other document comes after it
    same = [r.text for r in rows if r.doc_id == 5]
    assert len(same) == 2 and same[0] == same[1] == "same words here\nand there\nand over there"
    assert all(n == len(t) for (_, t), n in by.items() if t is not None)
    assert L.drop_repeated_lines(no_documents(spark)).collect() == []

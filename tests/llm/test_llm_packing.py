import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from edges import documents, edge_documents, no_documents
from tokenizers import Tokenizer

from dialogue_engine.llm import packing as P

FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)
ODD = [
    "", " ", "  ", "\n", "a  b", "a \nb", "\n \nx", " lead", "trail ", "trail  ", "<|endoftext|>",
    "x <|endoftext|> y", "a  <|endoftext|>  b", "don't I'll  we've", "é b c", "tab\t x\t\ty",
    "　 x", "日本 語 text", "\U0001F600 hi \U0001F600", "123 456 7.8",
    "x\x1c y \x85z", "ŉ ǅ ʰ ª º ² ¼ ½ × ÷", "a\x00b c", "​ x ᠎ y",
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(FILES[0])


def ids(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids + [0]


def test_words_give_the_ids_of_the_whole_text(whole):
    rng = random.Random(1)
    letters = " \n\ta.é日1'<|>$ \x85sdtl"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(3000)]
    mine = P.WordTokenizer(*FILES).encode(texts)
    for text, data in zip(texts, mine):
        assert np.frombuffer(data, "<u4").tolist() == ids(whole, text)[:-1], text


def test_old_words_are_forgotten_without_harm(whole, monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 5)
    tokenizer = P.WordTokenizer(*FILES)
    for _ in range(3):
        for text in ODD:
            (data,) = tokenizer.encode([text])
            assert np.frombuffer(data, "<u4").tolist() == ids(whole, text)[:-1]


def check(whole, rows, texts):
    """Every id in exactly one piece, sequences gapless and full."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, own in pieces.items():
        wanted, at = ids(whole, texts[doc_id]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(wanted)
            part = np.array(wanted[at : at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(wanted)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0


def test_round_trip(spark, whole):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(int(rng.paretovariate(0.6)) % 3000)) for _ in range(150)]
    texts += ODD + [None]
    rows = P.pack(documents(spark, texts), *FILES).collect()
    check(whole, rows, dict(enumerate(texts)))


def test_groups(spark, whole, monkeypatch):
    monkeypatch.setattr(P, "GROUP_SEQUENCES", 2)
    texts = ["some words " * n for n in range(0, 700, 23)]
    rows = P.pack(documents(spark, texts).coalesce(1), *FILES).collect()
    check(whole, rows, dict(enumerate(texts)))


def test_costs_are_balanced():
    rng = random.Random(3)
    lengths = [rng.randrange(1, 900) for _ in range(300)]
    spent = defaultdict(int)
    used = defaultdict(int)
    for pieces in P.assign(lengths):
        for length, sequence, _ in pieces:
            spent[sequence] += P.cost(length)
            used[sequence] += length
    full = [spent[s] for s, n in used.items() if n == 1024]
    by_arrival = []
    room = 0
    for length in lengths:
        while length:
            if not room:
                by_arrival.append(0)
                room = 1024
            part = min(room, length)
            by_arrival[-1] += P.cost(part)
            room, length = room - part, length - part
    assert np.std(full) < np.std(by_arrival[:-1])


def test_capacities():
    for tokens in (1, 5, 1023, 1024, 1025, 5000):
        sizes = P.capacities(tokens)
        assert sum(sizes) == tokens and all(s & (s - 1) == 0 for s in sizes)


def test_edges(spark, whole):
    rows = P.pack(edge_documents(spark).where("doc_id is null or doc_id not in (5)"), *FILES).collect()
    assert sum(r.start == 0 for r in rows) == 8
    twice = P.pack(edge_documents(spark).where("doc_id = 5"), *FILES).collect()
    assert sum(r.start == 0 for r in twice) == 2
    assert P.pack(no_documents(spark), *FILES).collect() == []

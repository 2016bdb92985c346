"""Packing documents into training sequences of nearly equal cost.

Attention stays inside a document, so a piece of n tokens costs ``LINEAR * n + n * n``. The
tokens of a group of documents are cut into whole sequences' worth, pieces are taken in
descending order, and each goes to the sequence with the lowest cost so far that still has room
for it. A piece that fits nowhere whole is cut along the room that is left, lowest cost first. A
document longer than a sequence fills whole sequences first; its rest is packed like a short one.

A sequence whose length is a power of two needs no padding. The last sequences of a group
therefore have powers of two as capacity, together exactly what is left over, and every sequence
ends up full: there is no padding at all.

A group is what one task reads until it has ``GROUP_SEQUENCES`` sequences, so a task holds that
many tokens and the longest single document. Nothing is shuffled, and sequences never cross
tasks. ``sequence_id`` is made from the partition and a count, so a task that runs again gives
the same sequences as long as it reads its rows in the same order.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from dialogue_engine.llm.caches import process_cache

CAPACITY = 1024
GROUP_SEQUENCES = 256
# Tokens of linear cost per token, against one per pair of tokens.
LINEAR = 1024
SEPARATOR = 0
# Words whose tokens a Python worker remembers, in two generations of this many each.
REMEMBERED = 250_000
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]

# Where a text can be cut without changing its tokens: before a space that is followed by another
# character. The byte-level patterns take a space only as the first character of a word, and
# white space before the last space of a run is a word of its own.
_CUTS = re.compile(r"(?= \S)")
_TWO_BLANKS = re.compile(r"\s\s")
# Words that both libraries are known to split alike.
_PLAIN = re.compile(r"[!-;=-~À-ɏ]+(?:\n[!-;=-~À-ɏ]+)*")


def _words(text: str) -> list[str]:
    """A text as words that each stand for a space and themselves. The first word has no space
    before it and is marked by one."""
    if _TWO_BLANKS.search(text):
        first, *rest = _CUTS.split(text)
        words = [first, *(word[1:] for word in rest)]
    else:
        words = text.split(" ")
    if words[0]:
        words[0] = " " + words[0]
    else:
        del words[0]
    return words


def _written(word: str) -> str:
    return word[1:] if word[:1] == " " else " " + word


class WordTokenizer:
    """Token ids of texts, with the ids of frequent words remembered.

    The ids are those of the tokenizer file. Words of common characters are encoded by the
    faster library with the same vocabulary, all others by the file's own.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            "words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.opens_word = np.zeros(max(ranks.values()) + 2, bool)
        self.opens_word[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        words = [_words(text) for text in texts]
        known = self.young.get
        parts = [list(map(known, own)) for own in words]
        holes = [[i for i, ids in enumerate(own) if ids is None] for own in parts]
        missing = {own[i] for own, at in zip(words, holes) for i in at}
        fresh = []
        for word in missing:
            ids = self.old.get(word)
            if ids is None:
                fresh.append(word)
            else:
                self.young[word] = ids
        self._learn(fresh)
        for own, ids, at in zip(words, parts, holes):
            for i in at:
                ids[i] = known(own[i])
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        return [b"".join(ids) for ids in parts]

    def _learn(self, words: list[str]) -> None:
        plain, others = [], []
        for word in words:
            (plain if _PLAIN.fullmatch(word) else others).append(word)
        for first in range(0, len(plain), 20_000):
            some = plain[first : first + 20_000]
            ids = np.array(self.plain.encode_ordinary(" " + " ".join(some)), "<u4")
            # every word starts with a space, and no token has one further inside
            cuts = np.flatnonzero(self.opens_word[ids]) * 4
            data = ids.tobytes()
            ends = [*cuts[1:].tolist(), len(data)]
            self.young.update(zip(some, (data[a:b] for a, b in zip(cuts.tolist(), ends))))
        found = self.whole.encode_batch_fast(
            [_written(word) for word in others], add_special_tokens=False
        )
        for word, encoding in zip(others, found):
            self.young[word] = np.array(encoding.ids, "<u4").tobytes()


def cost(length: int) -> int:
    return LINEAR * length + length * length


def capacities(tokens: int) -> list[int]:
    """Sequences that hold exactly so many tokens: full ones, then powers of two."""
    full, rest = divmod(tokens, CAPACITY)
    return [CAPACITY] * full + [1 << bit for bit in reversed(range(10)) if rest >> bit & 1]


def assign(lengths: list[int]) -> list[list[tuple[int, int, int]]]:
    """Per document the pieces (length, sequence, offset) it is cut into, in its order.

    Documents are numbered as given; sequences are numbered from 0 and all full.
    """
    placed: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    whole = 0
    rests = []
    for doc, length in enumerate(lengths):
        full, rest = divmod(length, CAPACITY)
        placed[doc] = [(CAPACITY, whole + i, 0) for i in range(full)]
        whole += full
        if rest:
            rests.append((rest, doc))
    room = np.array(capacities(sum(rest for rest, _ in rests)), np.int64)
    used, spent = np.zeros(len(room), np.int64), np.zeros(len(room), np.int64)
    never = np.iinfo(np.int64).max
    # the largest first; of equal ones the first document
    for rest, doc in sorted(rests, key=lambda r: (-r[0], r[1])):
        while rest:
            fits = room - used >= rest
            open_ = fits if fits.any() else room > used
            at = int(np.argmin(np.where(open_, spent, never)))
            piece = min(rest, int(room[at] - used[at]))
            placed[doc].append((piece, whole + at, int(used[at])))
            used[at] += piece
            spent[at] += cost(piece)
            rest -= piece
    return placed


def pack(
    documents: DataFrame, tokenizer: str, ranks: str, pattern: str
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level BPE file, ``ranks`` that of the same vocabulary
    as ranks, ``pattern`` how it splits text; the files are where the executors run. Each text
    is followed by the id 0. A null or empty text is that one id. Repeated rows are packed
    each; a null doc_id stays null. Only ``doc_id`` and ``text`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = process_cache("word_tokenizer")
        key = (tokenizer, ranks, pattern)
        if held.get("key") != key:
            held.update(key=key, encoder=WordTokenizer(*key))
        encoder = held["encoder"]
        base = TaskContext.get().partitionId() << 40
        group: list[tuple[int | None, bytes]] = []
        tokens = 0
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for first in range(0, batch.num_rows, 256):
                part = [text or "" for text in texts.slice(first, 256).to_pylist()]
                for doc_id, data in zip(ids.slice(first, 256).to_pylist(), encoder.encode(part)):
                    group.append((doc_id, data + b"\0\0\0\0"))
                    tokens += len(data) // 4 + 1
                    if tokens >= GROUP_SEQUENCES * CAPACITY:
                        sequences, rows = _rows(group, base)
                        yield rows
                        base += sequences
                        group, tokens = [], 0
        if group:
            yield _rows(group, base)[1]

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _rows(group: list[tuple[int | None, bytes]], base: int) -> tuple[int, pa.RecordBatch]:
    rows, sequences = [], 0
    for (doc_id, data), pieces in zip(group, assign([len(data) // 4 for _, data in group])):
        start = 0
        for length, sequence, offset in pieces:
            crc = zlib.crc32(data[4 * start : 4 * (start + length)])
            rows.append((doc_id, start, length, crc, len(data) // 4, base + sequence, offset))
            sequences = max(sequences, sequence + 1)
            start += length
    columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
    return sequences, pa.RecordBatch.from_arrays(columns, names=_NAMES)

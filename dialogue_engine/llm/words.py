"""Words and shingles of whole texts as 64-bit hashes, for batches of texts.

Words are the runs of bytes other than the six white-space bytes 0x20 and 0x09-0x0D. Two
different words have the same hash with a probability of about 2**-64; the operators that use
hashes say what a collision would do.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# Texts are worked on in blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 17

_U64 = np.uint64
_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _random.integers(1, 2**64, 256, dtype=_U64) | _U64(1)
_STEP = _U64(0x9E3779B97F4A7C15)
_SPREAD = _random.integers(1, 2**64, 64, dtype=_U64) | _U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = np.ones(1, _U64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over the result."""
    values = values ^ (values >> _U64(30))
    values = values * _U64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> _U64(27))
    values = values * _U64(0x94D049BB133111EB)
    return values ^ (values >> _U64(31))


def _powers_upto(count: int) -> np.ndarray:
    global _powers
    if len(_powers) < count:
        grown = np.full(max(count, 256), _STEP, _U64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and first byte after each word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each of the disjoint, ascending byte ranges, none of them empty."""
    if not len(starts):
        return np.zeros(0, _U64)
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(before, sizes)
    letters = data[within + np.repeat(starts, sizes)]
    sums = np.add.reduceat(_BYTE[letters] * _powers_upto(int(sizes.max()))[within], before)
    return mix(sums + sizes.astype(_U64))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a null counts as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def blocks(texts: Sequence[bytes], size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``size`` bytes together."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield first, i
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the bounds: words of text i are ``[bounds[i], bounds[i+1])``."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_spans(data)
    ranges = np.cumsum([0, *(len(text) + 1 for text in texts)])
    return span_hashes(data, starts, ends), np.searchsorted(starts, ranges)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring hashes, ``len - size + 1`` of them."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, _U64)
    sums = np.zeros(count, _U64)
    for i in range(size):
        sums += hashes[i : i + count] * _SPREAD[i]
    return mix(sums)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; with fewer words, of the whole sequence; of no
    words, none. Not distinct yet."""
    return windows(hashes, min(size, len(hashes))) if len(hashes) else hashes


def distinct(values: np.ndarray) -> np.ndarray:
    """Ascending, each once."""
    ordered = np.sort(values)
    fresh = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    return ordered[fresh]


def shingle_sets(texts: Sequence[bytes], size: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingles of each text."""
    for first, last in blocks(texts):
        hashes, bounds = word_hashes(texts[first:last])
        every = windows(hashes, size)
        for low, high in zip(bounds[:-1], bounds[1:]):
            if high - low >= size:
                yield distinct(every[low : high - size + 1])
            else:
                yield distinct(shingles(hashes[low:high], size))


def signed(values: np.ndarray) -> np.ndarray:
    """64 bits as Spark's bigint has them."""
    return values.astype(_U64).view(np.int64)

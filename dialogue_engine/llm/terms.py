"""Terms of a text and the scoring side of a factorization machine, without the training library.

Python workers unpickle what they run; these functions need numpy and Arrow alone.
"""

import math
import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# The first so many letters of a longer word are a term too.
STEMS = (4, 5)

_WORD = re.compile(r"[^\W\d_]+")


def term_hashes(text: str | None) -> list[int]:
    """Hashes of the different terms of a text."""
    words = set(_WORD.findall((text or "").lower()))
    terms = words.union(*({f"{w[:n]}*" for w in words if len(w) > n} for n in STEMS))
    return [zlib.crc32(term.encode()) for term in terms]


def listed_terms(texts: pa.Array) -> pa.Array:
    """The term hashes of each text. One text at a time is a Python string, and no hash stays one
    object."""
    hashes, bounds = array("q"), array("i", [0])
    for text in texts:
        hashes.extend(term_hashes(text.as_py()))
        bounds.append(len(hashes))
    return pa.ListArray.from_arrays(pa.array(np.array(bounds)), pa.array(np.array(hashes, np.int64)))


@dataclass
class Machine:
    """A trained factorization machine: number of each term, weights and vectors."""

    numbers: dict[int, int]
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, text: str | None) -> float:
        numbers = self.numbers
        found = sorted({numbers[h] for h in term_hashes(text) if h in numbers})
        total = self.bias
        if found:
            vectors = self.vectors[found]
            pairs = vectors.sum(0) ** 2 - (vectors**2).sum(0)
            total += float(self.weights[found].sum() + pairs.sum() / 2)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))

    def scores(self, texts: pa.Array) -> pa.Array:
        """Scores of a batch. One text at a time is a Python string."""
        return pa.array([self.score(text.as_py()) for text in texts], pa.float64())

"""Words of a text as numbers, for work inside a Python worker.

A word is a run of bytes other than ASCII white space. Since UTF-8 uses no ASCII byte inside a
longer character, splitting the bytes gives the same words as splitting the code points.
"""

from __future__ import annotations

import numpy as np
import xxhash

# Words a worker remembers; beyond it the memory is emptied, which costs time and changes no result.
REMEMBERED = 300_000

# Upper-case ASCII letters to lower case, as bytes.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_ODD, _STEP = np.uint64(0x9E3779B97F4A7C15), 0xC2B2AE3D27D4EB4F


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambling, so that sums of products become well spread."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordNumbers(dict):
    """Numbers words in order of first sight and keeps a 64-bit hash of each."""

    def __init__(self) -> None:
        super().__init__()
        self._hashes = np.zeros(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = len(self)
        if number == len(self._hashes):
            self._hashes = np.concatenate([self._hashes, np.zeros_like(self._hashes)])
        self._hashes[number] = xxhash.xxh3_64_intdigest(word)
        self[word] = number
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers; equal numbers in one result mean equal words."""
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """The words' 64-bit hashes, the same in every process."""
        numbers = self.numbers(words)  # may replace the array of hashes
        return self._hashes[numbers]


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` words; a shorter text is one run as a whole."""
    runs = max(1, len(hashes) - size + 1) if len(hashes) else 0
    size = min(size, len(hashes))
    total = np.zeros(runs, np.uint64)
    for k in range(size):
        total = mixed(total * _ODD + hashes[k : k + runs] + np.uint64((k + 1) * _STEP % (1 << 64)))
    return total

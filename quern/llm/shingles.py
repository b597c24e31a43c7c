"""Words and word shingles of texts as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from quern.llm.common import kept

#: Words whose hashes a worker keeps; it changes no result.
REMEMBERED = 500_000


class WordHashes(dict):
    """Maps a word's bytes to its hash."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@kept
def word_hashes() -> WordHashes:
    return WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k words, in order; a shorter sequence is one window, an empty one none."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    out = np.full(len(hashes) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - k + 1 + i])
    return out


def words_of(text: str | bytes | None, fold: bool) -> list[bytes]:
    """Words between spaces and the ASCII controls from tab to carriage return; with fold, A-Z in lower case."""
    raw = (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text) or b""
    return (raw.lower() if fold else raw).split()

"""Words of texts as 64-bit hashes in one array for all documents of a part."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words remembered by a Python worker; beyond it the memory starts anew.
REMEMBERED = 600_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()


def hashed(lists: list[list[bytes]], remember: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each document's words begin (with the end as last entry).

    Without ``remember`` the words are forgotten after the call, which leaves no memory taken in the worker.
    """
    known = _hashes if remember else _Hashes()
    if len(known) > REMEMBERED:
        known.clear()
    offsets = np.concatenate([[0], np.cumsum([len(words) for words in lists], dtype=np.int64)]).astype(np.int64)
    flat = np.empty(int(offsets[-1]), np.uint64)
    for words, a, b in zip(lists, offsets, offsets[1:]):
        flat[a:b] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return flat, offsets


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on uint64 that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(flat: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every n consecutive words of ``flat``; runs over document ends, which callers leave out."""
    count = max(0, len(flat) - n + 1)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total = total * np.uint64(base) + flat[i : i + count]
    return mixed(total)

"""Word shingles of whole texts as sorted sets of 64-bit hashes (inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multiplier that separates the words of a shingle, and the two of the final mix.
STEP, MIX_1, MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA3B195354A39B70D)
_29, _32 = np.uint64(29), np.uint64(32)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space (0x09-0x0D and 0x20), A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all ``width``-word shingles.

    With fewer words the whole sequence is the only shingle; without words the set is
    empty. Words are hashed by xxh3; two shingles share a hash with probability 2^-64.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(hashes))
    last = len(hashes) - span + 1
    mixed = hashes[:last] + np.uint64(span)
    for k in range(1, span):
        mixed ^= mixed >> _29
        mixed *= STEP
        mixed += hashes[k:last + k]
    mixed ^= mixed >> _32
    mixed *= MIX_1
    mixed ^= mixed >> _29
    mixed *= MIX_2
    mixed ^= mixed >> _32
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]

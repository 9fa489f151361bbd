"""Word shingles as 64-bit hashes, for many texts at once in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from tidemark.llm.common import words_of

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (fixed constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(
    texts: list[bytes | None], width: int, kept: dict[bytes, int]
) -> list[np.ndarray]:
    """For each text its sorted distinct hashes of ``width`` words, A-Z in lower case.

    A text of fewer words is one shingle, a text without words none. ``kept`` remembers the
    hashes of words.
    """
    if len(kept) > 400_000:
        kept.clear()
    flat: list[int] = []
    sizes: list[int] = []
    digest = xxhash.xxh3_64_intdigest
    for text in texts:
        words = words_of(text.lower() if text else text)
        for word in words:
            if word not in kept:
                kept[word] = digest(word)
        flat.extend(map(kept.__getitem__, words))
        sizes.append(len(words))
    hashes = np.array(flat, dtype=np.uint64)
    ends = np.cumsum(sizes)
    out = []
    with np.errstate(over="ignore"):
        for size, end in zip(sizes, ends, strict=True):
            own = hashes[end - size:end]
            width_here = min(width, size)
            n = size - width_here + 1
            rolled = np.zeros(n if size else 0, dtype=np.uint64)
            for k in range(width_here):
                rolled = mix(rolled * MULTIPLIER + own[k:k + n] + np.uint64(1))
            # shorter sequences are told apart from shingles by their length
            out.append(np.unique(rolled + np.uint64(width_here)))
    return out

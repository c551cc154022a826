"""Word and shingle hashes of a text, in NumPy."""

from __future__ import annotations

import numpy as np
import xxhash

from pubstrata.llm.common import WORD

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                  0xFF51AFD7ED558CCD], dtype=np.uint64)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in WORD.findall(text)), dtype=np.uint64)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MULT[5]
    return x ^ (x >> np.uint64(29))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, by position; empty if there are fewer words.

    Runs are put together by doubling, so the work grows with log(width).
    """
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out, covered, power, length = None, 0, words, 1
    rest = width
    while rest:
        if rest & 1:
            part = power[covered:covered + n]
            out = scramble(part) if out is None else scramble(out * _MULT[0] + part * _MULT[1] + np.uint64(covered))
            covered += length
        rest >>= 1
        if rest:
            power = scramble(power[:-length] * _MULT[2] + power[length:] * _MULT[3] + np.uint64(length))
            length *= 2
    return out


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle, a wordless one has none."""
    words = word_hashes(text or "")
    if len(words) == 0:
        return words
    if len(words) < width:
        return scramble(window_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(words, width))

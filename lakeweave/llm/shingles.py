"""Hashes of words and of runs of words, for many texts at once."""

from __future__ import annotations

import numpy as np

#: Odd multipliers; one number for each byte, with A-Z as a-z.
P = np.uint64(0x9E3779B97F4A7C15)
_bytes = np.arange(256)
_lower = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes)
LETTERS = (np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[_lower]
SPACE = np.isin(_bytes, [9, 10, 11, 12, 13, 32])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word and the words of each text, for texts that lie end to end in ``data``."""
    texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    inside = ~SPACE[data]
    bounds = np.zeros(len(data) + 1, bool)
    bounds[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~bounds[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~bounds[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sizes = ends - starts
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    powers = np.cumprod(np.full(int(sizes.max()), P, np.uint64))
    letters = data[inside]
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTERS[letters] * powers[place], dtype=np.uint64)])
    counts = np.bincount(np.searchsorted(offsets, starts, "right") - 1, minlength=texts)
    return mix(total[first + sizes] - total[first]), counts


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of ``words`` words of each text: (hash, text) sorted by text and hash.

    A text of fewer words has one run, the whole; one without words has none.
    """
    hashes, counts = word_hashes(data, offsets)
    firsts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - firsts[owner]
    run = np.full(len(hashes), np.uint64(words), np.uint64)
    for i in range(words):
        run[:len(run) - i] = (run[:len(run) - i] ^ hashes[i:]) * P + np.uint64(i + 1)
    full = place + words <= counts[owner]
    found, texts = [mix(run[full])], [owner[full]]
    for n in range(1, words):
        short = np.flatnonzero(counts == n)
        whole = np.full(len(short), np.uint64(n), np.uint64)
        for i in range(n):
            whole = (whole ^ hashes[firsts[short] + i]) * P + np.uint64(100 + i)
        found.append(mix(whole))
        texts.append(short)
    found, texts = np.concatenate(found), np.concatenate(texts)
    order = np.lexsort((found, texts))
    found, texts = found[order], texts[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
    return found[keep], texts[keep]

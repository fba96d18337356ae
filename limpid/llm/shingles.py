"""Character shingles of many texts at once, as 64-bit hashes, and the minima of their windows."""

from __future__ import annotations

import numpy as np

BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the offsets of the texts."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def grams(flat: np.ndarray, offsets: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all q-grams that lie inside one text, and the text of each."""
    n = len(flat) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # polynomials of doubling length; those of lengths a and b join to one of a + b
    h, length, part, step, factor = None, 0, flat, 1, int(BASE)
    while length < q:
        if q & step:
            most = len(flat) - length - step + 1
            h = part if h is None else h[:most] * np.uint64(factor) + part[length : length + most]
            length += step
        if length < q:
            part = part[:-step] * np.uint64(factor) + part[step:]
            step, factor = 2 * step, factor * factor & (1 << 64) - 1
    h = h.copy()
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    per = np.maximum(np.diff(offsets) - q + 1, 0)
    own = np.repeat(np.arange(len(per)), per)
    at = np.repeat(offsets[:-1] - np.cumsum(per) + per, per) + np.arange(per.sum())
    return h[at], own


def window_minima(h: np.ndarray, own: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimum, text, first, count): the smallest of every w neighbouring hashes of a text, for each run of windows
    with equal minima once, with the first window of the run and how many there are.

    A text of fewer than w hashes has no window. Equal stretches of w hashes give the same minimum in any two texts.
    """
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    low, wide = h, 1
    while 2 * wide <= w:  # minima of doubling width
        low, wide = np.minimum(low[:-wide], low[wide:]), 2 * wide
    low = np.minimum(low[:n], low[w - wide :][:n])
    first = np.flatnonzero(own[:n] == own[w - 1 :])  # windows inside one text
    low, whose = low[first], own[first]
    new = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (whose[1:] != whose[:-1])]) if len(low) else np.empty(0, np.int64)
    return low[new], whose[new], first[new], np.diff(np.r_[new, len(low)])


def places(h: np.ndarray, first: np.ndarray, count: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, place): where the minima of the windows of each run stand, every place once."""
    run = np.repeat(np.arange(len(first)), count)
    at = first[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    for lo in range(0, len(at), 100_000):
        part = at[lo : lo + 100_000]
        at[lo : lo + 100_000] = part + h[part[:, None] + np.arange(w)].argmin(axis=1)
    new = np.r_[True, (run[1:] != run[:-1]) | (at[1:] != at[:-1])] if len(run) else np.empty(0, bool)
    return run[new], at[new]

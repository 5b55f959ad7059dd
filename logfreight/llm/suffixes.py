"""Longest previous factors over many short byte strings, by a suffix array.

Suffixes are ordered by their first ``length`` bytes through ranks of doubling width (4, 8, 16,
32 bytes, then the whole). In that order the previous and the next suffix of a smaller owner are
where a suffix has its longest match with an earlier owner; the lesser of the common prefixes
on the way tells its length, which reaches ``length`` where both lie in one run of equal ranks.
"""

from __future__ import annotations

import numpy as np


def previous_smaller(values: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Index of the nearest earlier smaller value within the same run, or -1.

    Links to the index before are shortened all at once until they point at smaller values.
    """
    at = np.arange(len(values)) - 1
    if len(at):
        at[1:][runs[1:] != runs[:-1]] = -1
    open_ = np.flatnonzero(at >= 0)
    while len(open_):
        open_ = open_[values[at[open_]] >= values[open_]]
        at[open_] = at[at[open_]]
        open_ = open_[at[open_] >= 0]
    return at


def next_smaller(values: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Index of the nearest later smaller value within the same run, or -1."""
    back = previous_smaller(values[::-1], runs[::-1])[::-1]
    return np.where(back >= 0, len(values) - 1 - back, -1)


def _ranks(keys: np.ndarray, below: int) -> np.ndarray:
    """Dense ranks of integers ``below`` a bound; key and place are sorted as one integer if they fit."""
    bits = len(keys).bit_length()
    if below << bits > 1 << 64:
        return np.unique(keys, return_inverse=True)[1].astype(np.uint64)
    packed = (keys << np.uint64(bits)) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    packed >>= np.uint64(bits)
    rank = np.zeros(len(keys), np.uint64)
    rank[order[1:]] = np.cumsum(packed[1:] != packed[:-1])
    return rank


def suffix_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` (32 to 64) bytes at each start; equal strings, equal ranks."""
    pad = np.concatenate([data, np.zeros(64, np.uint8)]).astype(np.uint64)
    word, width = pad, 1
    while width < 4:
        word = (word[:-width] << np.uint64(8 * width)) | word[width:]
        width *= 2
    rank = _ranks(word, 1 << 32)
    pair = lambda first, second: _ranks(first * np.uint64(len(rank) + 1) + second, (len(rank) + 1) ** 2)
    for width in (4, 8, 16):
        rank = pair(rank[:-width], rank[width:])
    return pair(rank[starts], rank[starts + length - 32])


def repeats_of_earlier(data: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int) -> np.ndarray:
    """Whether the longest previous factor at each start, in smaller owners, reaches ``length``."""
    if not len(starts):
        return np.zeros(0, bool)
    rank = suffix_ranks(data, starts, length)
    order = np.argsort(rank, kind="stable")  # the suffix array, to that depth
    runs, values = rank[order], owners[order]
    found = (previous_smaller(values, runs) >= 0) | (next_smaller(values, runs) >= 0)
    out = np.zeros(len(starts), bool)
    out[order] = found
    return out

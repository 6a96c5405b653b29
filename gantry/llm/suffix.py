"""Suffix arrays of integer sequences in numpy, by prefix doubling."""

from __future__ import annotations

import numpy as np


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for each k = 1, 2, 4, ... the ranks by the first k symbols.

    Suffixes that agree on k symbols share a rank (the first place of their group).
    The sequence must end in a symbol that occurs once, so that all suffixes differ.
    """
    order, levels = _doubled(symbols, 1, keep=True)
    return order, levels


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffix array alone; the doubling starts from several symbols packed into one key."""
    names = np.unique(symbols, return_inverse=True)[1] + 1
    bits = int(names.max()).bit_length()
    together = 1
    while together * 2 * bits <= 62:
        names = (names << (together * bits)) + np.r_[names[together:], np.zeros(together, np.int64)][: len(names)]
        together *= 2
    return _doubled(names, together, keep=False)[0]


def _doubled(symbols: np.ndarray, k: int, keep: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """Prefix doubling from keys that stand for ``k`` symbols each."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.r_[starts, n])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, sizes)
    levels = [rank.astype(np.int32)] if keep else []
    open_slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(open_slots):
        members = order[open_slots]
        key = rank[members] * (n + 1) + rank[members + k]
        by_key = np.argsort(key, kind="stable")
        members, key = members[by_key], key[by_key]
        order[open_slots] = members
        first = np.r_[True, key[1:] != key[:-1]]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.r_[starts, len(key)])
        rank[members] = np.repeat(open_slots[starts], sizes)
        if keep:
            levels.append(rank.astype(np.int32))
        open_slots = open_slots[np.repeat(sizes > 1, sizes)]
        k *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in order (first: 0).

    Goes down the ranks of the doubling: if the first k symbols agree, skip them.
    """
    n = len(order)
    lcp = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        inside = np.maximum(left, right) < n
        same = inside & (rank[np.minimum(left, n - 1)] == rank[np.minimum(right, n - 1)])
        step = same.astype(np.int64) << level
        lcp[1:] += step
        left += step
        right += step
    return lcp


def longest_repeat_at(symbols: np.ndarray) -> np.ndarray:
    """For each position, the longest string that starts there and somewhere else too.

    Of the intervals of the suffix array whose suffixes share a prefix, the deepest
    one around a suffix is bounded by its two neighbours.
    """
    order, levels = suffix_ranks(symbols)
    lcp = common_prefixes(order, levels)
    longest = np.empty(len(symbols), np.int64)
    longest[order] = np.maximum(lcp, np.r_[lcp[1:], 0])
    return longest


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in at least one of the ranges."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change[:n]) > 0

"""The suffix array of a sequence of numbers by the difference cover of 3, in whole-array steps."""

from __future__ import annotations

import numpy as np


def _names(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """The order of tuples, the name (rank from 1, equal for equal tuples) of each, and the number of names."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        held = column[order]
        new[1:] |= held[1:] != held[:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    return order, names, int(new.sum())


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a sequence of positive integers, in order.

    Triples that start at places not divisible by 3 are sorted and named; unless all names differ, the
    sequence of names is sorted the same way. The suffixes at places divisible by 3 then follow from
    their first number and the rank behind it, and both kinds are merged by comparing at most two numbers and
    a rank.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.concatenate((text.astype(np.int64), np.zeros(3, np.int64)))
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sampled = np.concatenate((ones, twos))
    order, names, kinds = _names([s[sampled], s[sampled + 1], s[sampled + 2]])
    if kinds < len(sampled):
        order = suffix_array(names)
        names = np.empty(len(order), np.int64)
        names[order] = np.arange(1, len(order) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = names
    rank[n:] = 0
    rest = np.arange(0, n, 3)
    rest = rest[np.lexsort((rank[rest + 1], s[rest]))]
    held = sampled[order]
    held = held[held < n]
    # how many suffixes of the other kind come before each: by (number, rank) after places of the first
    # kind, by (number, number, rank) after those of the second
    wide = np.int64(int(rank.max()) + 1)
    scale = np.int64(int(s.max()) + 1)
    first = held % 3 == 1
    one, two = held[first], held[~first]
    before = np.searchsorted(s[one] * wide + rank[one + 1], s[rest] * wide + rank[rest + 1])
    if int(scale) ** 2 * int(wide) < 1 << 62:
        pairs = lambda at: (s[at] * scale + s[at + 1]) * wide + rank[at + 2]
        before += np.searchsorted(pairs(two), pairs(rest))
    else:
        both = np.concatenate((two, rest))
        _, named, _ = _names([s[both], s[both + 1], rank[both + 2]])
        before += np.searchsorted(named[: len(two)], named[len(two) :])
    out = np.empty(n, np.int64)
    place = before + np.arange(len(rest))
    out[place] = rest
    free = np.ones(n, bool)
    free[place] = False
    out[free] = held
    return out


def equal_prefixes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A number for each of `starts`, equal where the next `length` numbers are equal: neighbours in the suffix
    array are compared. Every start must have `length` numbers after it."""
    wanted = np.full(len(text), -1, np.int64)
    wanted[starts] = np.arange(len(starts))
    found = suffix_array(text)
    rows = wanted[found]
    rows = rows[rows >= 0]
    at = starts[rows]
    new = np.ones(len(at), bool)
    for low in range(0, len(at) - 1, 1 << 14):
        high = min(low + (1 << 14), len(at) - 1)
        same = np.ones(high - low, bool)
        live = np.arange(low, high)
        for k in range(length):
            live = live[text[at[live] + k] == text[at[live + 1] + k]]
        same[:] = False
        same[live - low] = True
        new[low + 1 : high + 1] = ~same
    out = np.empty(len(starts), np.int64)
    out[rows] = np.cumsum(new) - 1
    return out

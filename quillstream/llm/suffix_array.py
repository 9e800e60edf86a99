"""Suffix order by the difference cover {1, 2} modulo 3, in array operations."""

from __future__ import annotations

import numpy as np


def names_of(first: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, name from 1 on in order: equal rows have equal names) of rows given by their columns."""
    key = first
    for column in rest:
        width = int(column.max(initial=0)) + 1
        if int(key.max(initial=0)) >= 2**62 // width:
            key = names_of(key)[1]
        key = key * width + column
    order = np.argsort(key)
    ordered = key[order]
    names = np.empty(len(key), np.int64)
    names[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]]) if len(key) else 0
    return order, names


def suffix_array(s: np.ndarray, prefix: int) -> np.ndarray:
    """Starts of the suffixes of `s` (positive integers) in the order of their first `prefix` symbols at least.

    The suffixes at positions that aren't multiples of 3 are sorted by their triples; if triples repeat, their names
    form a shorter string whose suffixes are sorted in the same way. Names that stand for `prefix` symbols are final:
    ties beyond them don't matter. The other suffixes follow from one symbol and the next suffix's place, and the two
    orders are merged.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: list(s[i:])), np.int64)
    t = np.r_[s.astype(np.int64), 0, 0, 0]
    ones = np.arange(1, n + (n % 3 == 1), 3)  # with the empty suffix, if nothing else ends the first half
    twos = np.arange(2, n, 3)
    cover = np.r_[ones, twos]
    order, names = names_of(t[cover], t[cover + 1], t[cover + 2])
    if prefix > 3 and names[order[-1]] < len(cover):
        order = suffix_array(names, -(-prefix // 3))
        ranks = np.empty(len(cover), np.int64)  # ties that don't matter are in some order as well
        ranks[order] = np.arange(1, len(cover) + 1)
    else:
        ranks = names
    rank = np.zeros(n + 3, np.int64)
    rank[cover] = ranks
    sorted12 = cover[order]
    sorted12 = sorted12[sorted12 < n]
    zeros = np.arange(0, n, 3)
    most = len(cover) + 2
    symbols = int(t.max()) + 1
    key0 = t[zeros] * most + rank[zeros + 1]
    at0 = np.argsort(key0)
    zeros, key0 = zeros[at0], key0[at0]
    is_one = sorted12 % 3 == 1
    one, two = sorted12[is_one], sorted12[~is_one]
    before = np.searchsorted(np.maximum.accumulate(t[one] * most + rank[one + 1]) if len(one) else np.zeros(0, np.int64), key0)
    pair2, pair0 = t[two] * symbols + t[two + 1], t[zeros] * symbols + t[zeros + 1]
    if symbols * symbols >= 2**62 // most:  # names instead of the pairs themselves
        both = names_of(np.r_[pair2, pair0])[1]
        pair2, pair0 = both[: len(two)], both[len(two) :]
    before += np.searchsorted(np.maximum.accumulate(pair2 * most + rank[two + 2]) if len(two) else np.zeros(0, np.int64), pair0 * most + rank[zeros + 2])
    before = np.maximum.accumulate(before)
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    place = before + np.arange(len(zeros))
    out[place] = zeros
    taken[place] = True
    out[~taken] = sorted12
    return out


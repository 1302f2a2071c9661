"""Suffix sorting by difference cover, vectorised: the part of the suffix-array
deduplication that a task does on its bounded share of the text.

Positions not divisible by three are the sample: their triples are sorted and
named, names that tie are resolved by recursion on the string of names, the
remaining suffixes are sorted by their first symbol and the rank of the sampled
suffix behind it, and both orders are merged.  Sorting stops at DEPTH symbols:
a name at the r-th level of the recursion covers 3**r symbols, and suffixes that
agree as far as that keep the order of their places.
"""

from __future__ import annotations

import numpy as np

DEPTH = 100


def _names(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of the triple at each place among all distinct ones (from 1), and how many there are."""
    top = int(s.max(initial=0)) + 1
    a, b, c = s[at], s[at + 1], s[at + 2]
    if top ** 3 < 1 << 62:
        _, names = np.unique((a * top + b) * top + c, return_inverse=True)
    else:
        _, pair = np.unique(a * top + b, return_inverse=True)
        _, names = np.unique(pair * top + c, return_inverse=True)
    return names.astype(np.int64) + 1, int(names.max(initial=-1)) + 1


def suffix_order(text: np.ndarray, depth: int = DEPTH, covered: int = 1) -> np.ndarray:
    """Places of ``text`` (integers above 0) in the order of their suffixes' first ``depth`` symbols of width 1."""
    n = len(text)
    if n < 3:
        s = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
        return np.array(sorted(range(n), key=lambda i: s[i:i + 3].tolist()), np.int64)
    s = np.concatenate([text.astype(np.int64), np.zeros(4, np.int64)])
    # an extra sampled place behind the end keeps the two halves of the sample apart
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    names, distinct = _names(s, sample)
    if distinct < len(sample) and covered * 3 < depth:
        order = suffix_order(names, depth, covered * 3)
    else:
        order = np.argsort(names, kind="stable")
    sample = sample[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    sample = sample[sample < n]
    rest = np.arange(0, n, 3)
    wide = len(rank) + 1
    key = s[rest] * wide + rank[rest + 1]
    by = np.argsort(key, kind="stable")
    rest, key = rest[by], key[by]
    # how many sampled suffixes of each kind come before each of the rest
    first, second = sample[sample % 3 == 1], sample[sample % 3 == 2]
    before = np.searchsorted(s[first] * wide + rank[first + 1], key, "left")
    # two symbols as one name, the same for both kinds, so that with a rank they fit one number
    both = np.concatenate([second, rest])
    top = int(s.max(initial=0)) + 1
    _, pair = np.unique(s[both] * top + s[both + 1], return_inverse=True)
    deep = pair * wide + rank[both + 2]
    before = before + np.searchsorted(np.maximum.accumulate(deep[:len(second)]), deep[len(second):], "left")
    out = np.empty(n, np.int64)
    place = np.arange(len(rest)) + np.maximum.accumulate(before)
    out[place] = rest
    free = np.ones(n, bool)
    free[place] = False
    out[free] = sample
    return out


def equal_prefixes(data: np.ndarray, places: np.ndarray, width: int, step: int = 1 << 15) -> np.ndarray:
    """For each two neighbours of ``places``: do the ``width`` bytes there agree?"""
    view = np.lib.stride_tricks.sliding_window_view(data, width)
    out = np.zeros(max(0, len(places) - 1), bool)
    for i in range(0, len(out), step):
        a, b = places[i:i + step], places[i + 1:i + step + 1]
        a = a[:len(b)]
        out[i:i + len(b)] = (view[a] == view[b]).all(axis=1)
    return out

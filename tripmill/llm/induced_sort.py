"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller (S) or larger (L) than the next one. Sorting those at
leftmost-smaller (LMS) places induces the order of all: every bucket of a first character is
filled by its neighbours in linear time. A bucket is filled in waves of whole arrays; it needs as
many waves as its longest run of the character.

LMS substrings are sorted by inducing too and named; equal names are told apart by the names that
follow, ranks of pairs at doubling distance, which takes the place of the recursion's own inducing
(names are too many for buckets of arrays).
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last character is the least of all."""
    step = np.sign(np.diff(t.astype("i4"), append=np.int32(-1)))
    # equal neighbours share the type of the next place that differs
    places = np.where(step != 0, np.arange(len(t)), len(t) - 1)
    following = np.minimum.accumulate(places[::-1])[::-1]
    smaller = step[following] > 0
    smaller[-1] = True
    return smaller


def _put(sa: np.ndarray, front: np.ndarray, suffixes: np.ndarray, chars: np.ndarray, way: int) -> None:
    """Append suffixes to their characters' buckets, in order, from the front (1) or the end (-1)."""
    order = np.argsort(chars, kind="stable")
    sorted_chars = chars[order]
    counts = np.bincount(chars, minlength=len(front))
    first = np.cumsum(counts) - counts
    rank = np.arange(len(chars)) - first[sorted_chars]
    sa[front[sorted_chars] + way * rank] = suffixes[order]
    front += way * counts


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array from LMS suffixes in the order given (sorted within each first character)."""
    n = len(t)
    sa = np.empty(n, "i4")
    count = np.bincount(t, minlength=sigma)
    begin = np.cumsum(count) - count
    large = np.bincount(t[~smaller], minlength=sigma)
    present = np.flatnonzero(count)
    lms_chars = t[lms]
    at = np.searchsorted(lms_chars, np.arange(sigma + 1))

    def before(suffixes: np.ndarray, want_smaller: bool) -> tuple[np.ndarray, np.ndarray]:
        prev = suffixes[suffixes > 0] - 1
        prev = prev[smaller[prev] == want_smaller]
        return prev, t[prev]

    front = begin.copy()
    for c in present.tolist():
        done = begin[c]
        while done < front[c]:
            wave = sa[done : front[c]].copy()
            done = front[c]
            _put(sa, front, *before(wave, False), 1)
        _put(sa, front, *before(lms[at[c] : at[c + 1]], False), 1)
    back = begin + count - 1
    for c in present[::-1].tolist():
        done = begin[c] + count[c] - 1
        if c == t[-1]:
            # the end of the text is the first suffix of all
            sa[begin[c]] = n - 1
            back[c] -= 1
            done = begin[c]
            _put(sa, back, *before(sa[done : done + 1], True), -1)
            continue
        while done > back[c]:
            wave = sa[back[c] + 1 : done + 1][::-1].copy()
            done = back[c]
            _put(sa, back, *before(wave, True), -1)
        _put(sa, back, *before(sa[begin[c] : begin[c] + large[c]][::-1].copy(), True), -1)
    return sa


def _rank_lms(names: np.ndarray) -> np.ndarray:
    """Order of the reduced string's suffixes."""
    rank, far, m = names.astype("i8"), 1, len(names)
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_rank = rank[order]
        tied = np.zeros(m, bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        if not tied.any():
            return order
        # only places that are not told apart yet are sorted again
        slots = np.flatnonzero(tied)
        who = order[slots]
        follow = np.where(who + far < m, rank[np.minimum(who + far, m - 1)] + 1, 0)
        again = np.lexsort((follow, rank[who]))
        who, follow = who[again], follow[again]
        order[slots] = who
        group = rank[who]
        new = np.r_[True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])]
        # ranks are places in the order, so those settled earlier stay as they are
        rank[who] = slots[np.maximum.accumulate(np.where(new, np.arange(len(who)), 0))]
        if far == 1:
            settled = np.flatnonzero(~tied)
            rank[order[settled]] = settled
        far *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of small non-negative integers whose last one is 0 and occurs there alone."""
    n = len(t)
    if n < 2:
        return np.arange(n, dtype="i4")
    sigma = int(t.max()) + 1
    smaller = _types(t)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    lms = np.flatnonzero(is_lms).astype("i4")
    if len(lms) > 1:
        first = _induce(t, smaller, lms[np.argsort(t[lms], kind="stable")], sigma)
        ordered = first[is_lms[first]]
        # substrings reach to the next LMS place; equal ones have equal lengths and characters
        next_lms = np.empty(n, "i4")
        next_lms[lms] = np.r_[lms[1:], n - 1]
        length = next_lms[ordered] - ordered + 1
        new = np.r_[True, length[1:] != length[:-1]]
        same = np.flatnonzero(~new)
        for k in range(int(length.max()) if len(same) else 0):
            same = same[length[same] > k]
            if not len(same):
                break
            differ = t[ordered[same] + k] != t[ordered[same - 1] + k]
            new[same[differ]] = True
            same = same[~differ]
        names = np.empty(n, "i4")
        names[ordered] = np.cumsum(new) - 1
        lms = lms[_rank_lms(names[lms])]
    return _induce(t, smaller, lms, sigma)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, phi): what each suffix shares with the one before it in the array, and which that is.

    Values above ``most`` are cut to it. If the characters before a suffix and before its
    predecessor are equal, its value is one less than its left neighbour's; only the others are
    compared, eight characters at a time.
    """
    n = len(t)
    phi = np.empty(n, "i4")
    phi[sa[1:]] = sa[:-1]
    phi[sa[0]] = -1
    at = np.arange(n)
    follows = np.zeros(n, bool)
    follows[1:] = (phi[1:] > 0) & (t[phi[1:] - 1] == t[:-1])
    heads = np.flatnonzero(~follows & (phi >= 0))
    padded = np.concatenate([t.astype("u2"), np.arange(60_000, 60_008, dtype="u2")])
    plcp = np.zeros(n, "i4")
    # heads may be carried on by as many places as follow them, so they are compared further
    reach = np.diff(np.r_[np.flatnonzero(~follows), n])[np.searchsorted(np.flatnonzero(~follows), heads)]
    limit = np.minimum(most + reach, n)
    a, b, live = heads.copy(), phi[heads].astype("i8"), np.arange(len(heads))
    shared = np.zeros(len(heads), "i8")
    wide = np.lib.stride_tricks.sliding_window_view(padded, 8)
    while len(live):
        x, y = a[live] + shared[live], b[live] + shared[live]
        inside = (x < n) & (y < n) & (shared[live] < limit[live])
        live, x, y = live[inside], x[inside], y[inside]
        if not len(live):
            break
        equal = wide[x] == wide[y]
        run = np.where(equal.all(1), 8, equal.argmin(1))
        shared[live] += run
        live = live[run == 8]
    value = np.zeros(n, "i8")
    value[heads] = shared
    start = np.maximum.accumulate(np.where(~follows, at, 0))
    plcp = np.minimum(np.maximum(value[start] - (at - start), 0), most).astype("i4")
    plcp[phi < 0] = 0
    return plcp, phi

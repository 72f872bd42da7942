"""Suffix arrays by induced sorting, and their permuted common prefixes, on numpy arrays.

A suffix is of type S if it is less than the next one, else of type L. Where an S
follows an L a leftmost S suffix starts; a substring from one to the next is a
leftmost-smaller substring. Those are sorted by one induction and named, the string
of names is sorted in the same way, and its order induces that of all suffixes:
L suffixes from the left, S suffixes from the right, each placed by the one after it.

An induction takes many suffixes at once: as many neighbouring buckets as induce
nothing among themselves, so that all of them are known, or else one bucket, where
those that fall into the bucket itself make the next round. Their order is that of
a scan suffix by suffix.
"""

from __future__ import annotations

import numpy as np

#: A string whose symbols stand there less often, on average, is sorted by refining ties.
REPEATS = 16

def classify(s: np.ndarray) -> np.ndarray:
    """Which suffixes are of type S. The last symbol is the least and stands there only."""
    n = len(s)
    kind = np.ones(n, dtype=bool)
    change = np.flatnonzero(s[1:] != s[:-1])
    rises = s[change + 1] > s[change]
    # A symbol that repeats has the type of the last of its run.
    kind[: n - 1] = np.repeat(rises, np.diff(np.concatenate([[-1], change])))
    return kind


def _deal(sa: np.ndarray, found: np.ndarray, symbols: np.ndarray, edge: np.ndarray, sign: int) -> None:
    """Put suffixes, in order, at the edges of their buckets, which move up or down."""
    if not len(found):
        return
    order = np.argsort(symbols, kind="stable")
    of = symbols[order]
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    counts = np.diff(np.concatenate([first, [len(of)]]))
    within = np.arange(len(of)) - np.repeat(first, counts)
    sa[edge[of] + within if sign > 0 else edge[of] - 1 - within] = found[order]
    edge[of[first]] += sign * counts


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes, induced from leftmost S suffixes in the given order."""
    sizes = np.bincount(s, minlength=symbols)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    larger = np.bincount(s[~is_s], minlength=symbols)
    sa = np.full(len(s), -1, dtype=np.int32)
    small = ends.copy()
    _deal(sa, lms[::-1], s[lms[::-1]], small, -1)

    def before(suffixes: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray]:
        found = suffixes[suffixes > 0] - 1
        found = found[is_s[found] == kind]
        return found, s[found]

    # Buckets that share few suffixes are taken side by side; the guess follows what went well.
    guess = max(1, int(symbols / len(s) ** 0.5))
    edge, c, reach = starts.copy(), 0, guess
    while c < symbols:
        to = min(c + reach, symbols)
        if to > c + 1:
            found, into = before(sa[starts[c] : ends[to - 1]], False)
            inside = into[into < to]
            if len(inside):
                to = int(inside.min())
                reach = max(1, 2 * (to - c))
                if to > c:
                    found, into = before(sa[starts[c] : starts[to]], False)
            else:
                reach *= 2
            if to > c:
                _deal(sa, found, into, edge, 1)
                c = to
                continue
        done = starts[c]
        while done < edge[c]:
            part, done = sa[done : edge[c]], edge[c]
            _deal(sa, *before(part, False), edge, 1)
        _deal(sa, *before(sa[small[c] : ends[c]], False), edge, 1)
        reach, c = max(reach, guess), c + 1

    edge, c, reach = ends.copy(), symbols - 1, guess
    sa[0] = len(s) - 1
    while c >= 0:
        to = max(c - reach, -1)
        if to < c - 1:
            found, into = before(sa[starts[to + 1] : ends[c]][::-1], True)
            inside = into[into > to]
            if len(inside):
                to = int(inside.max())
                reach = max(1, 2 * (c - to))
                if to < c:
                    found, into = before(sa[ends[to] : ends[c]][::-1], True)
            else:
                reach *= 2
            if to < c:
                _deal(sa, found, into, edge, -1)
                c = to
                continue
        done = ends[c]
        while done > edge[c]:
            part, done = sa[edge[c] : done][::-1], edge[c]
            _deal(sa, *before(part, True), edge, -1)
        _deal(sa, *before(sa[starts[c] : starts[c] + larger[c]][::-1], True), edge, -1)
        reach, c = max(reach, guess), c - 1
    return sa


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The rank, from 0, of each key among the distinct ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return out


def _names(s: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """Ranks from 0 of the leftmost-smaller substrings, in the order of the text; equal ones share one.

    A substring that ends where another goes on is the greater: at its end it has
    an S suffix, the other an L suffix with the same symbol. So the end counts as a
    symbol above all. Symbols are compared some at a time, as digits of one number.
    """
    sizes = np.diff(np.concatenate([lms, [len(s)]])) + 1
    sizes[-1] = 1
    base = symbols + 1
    digits = max(1, int(62 * np.log(2) / np.log(base)))

    def number(which: np.ndarray, at: int) -> np.ndarray:
        key = np.zeros(len(which), dtype=np.int64)
        for k in range(at, at + digits):
            inside = sizes[which] > k
            key = key * base + np.where(inside, s[np.where(inside, lms[which] + k, 0)], symbols)
        return key

    names = _ranks(number(np.arange(len(lms)), 0))
    at = digits
    while True:
        # Of the substrings that share a name and go on, the next symbols decide.
        shared = np.bincount(names)[names] > 1
        live = np.flatnonzero(shared & (sizes > at))
        if not len(live):
            return names
        more = _ranks(number(live, at))
        finer = np.zeros(len(names), dtype=np.int64)
        finer[live] = more
        # Those that have ended are equal to their like, and greater than those that go on.
        finer[shared & (sizes <= at)] = more.max() + 1
        names = _ranks(names * (int(finer.max()) + 1) + finer)
        at += digits


def _refined(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string in which few symbols repeat: ties are told apart by what follows."""
    rank, step = _ranks(names), 1
    while True:
        order = np.argsort(rank)
        tied = np.bincount(rank)[rank] > 1
        live = np.flatnonzero(tied)
        if not len(live):
            return order
        # The last suffix is alone, so that one that ties has another ``step`` further on.
        key = rank[live] * len(names) + rank[live + step]
        by = np.argsort(key)
        ordered, places = key[by], np.flatnonzero(tied[order])
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        rank[order] = np.arange(len(order))
        rank[live[by]] = places[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        step *= 2


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes in order. The last symbol must be the least, and stand there only."""
    if len(s) == 1:
        return np.zeros(1, dtype=np.int32)
    is_s = classify(s)
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    names = _names(s, lms, symbols)
    found = int(names.max()) + 1
    if found == len(names):
        order = np.argsort(names)
    elif found * REPEATS > len(names):
        order = _refined(names)
    else:
        order = suffix_array(names, found)
    return _induce(s, is_s, lms[order], symbols)


def repeated_windows(s: np.ndarray, sa: np.ndarray, starts: np.ndarray, windows: np.ndarray, least: int) -> np.ndarray:
    """Which positions share their first ``least`` symbols with another suffix.

    Only positions ``starts[k]`` to ``starts[k] + windows[k] - 1`` are looked at. The common prefix
    of a suffix with the one before it in order is at most one shorter than that of
    the suffix one position earlier, so it is carried along each range, all ranges
    side by side, and compared no further than ``least``.
    """
    before = np.empty(len(s), dtype=np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    found = np.zeros(len(s), dtype=bool)
    ranges = np.argsort(-windows, kind="stable")
    starts, windows = starts[ranges], windows[ranges]
    prefix = np.zeros(len(starts), dtype=np.int64)
    for step in range(int(windows[0]) if len(windows) else 0):
        n = int(np.searchsorted(-windows, -step, side="left"))
        here = starts[:n] + step
        there = before[here].astype(np.int64)
        common = np.maximum(prefix[:n] - 1, 0)
        common[there < 0] = 0
        live = np.flatnonzero((common < least) & (there >= 0))
        while len(live):
            live = live[s[here[live] + common[live]] == s[there[live] + common[live]]]
            common[live] += 1
            live = live[common[live] < least]
        prefix[:n] = common
        full = common >= least
        found[here[full]] = True
        found[there[full]] = True
    return found

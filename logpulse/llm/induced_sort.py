"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

One shard's segments at a time. A suffix is induced by the one after it, which stands before
it (or, going back, behind it) in the order, so the places filled without a gap from where
the scan stands are final: all suffixes that they induce are dealt out in one step. Few
buckets fill in long stretches, and of many small ones a stretch spans about the square root, so
the work is linear in array operations for any alphabet, that of the names of the
recursion too.
"""

from __future__ import annotations

import numpy as np

def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last is."""
    n = len(t)
    diff = np.diff(t.astype(np.int64))
    at = np.where(diff != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]  # the next place where neighbours differ
    small = np.ones(n, dtype=bool)
    ends = following < n
    small[:-1] = np.where(ends, diff[np.minimum(following, n - 2)] > 0, False) if n > 1 else True
    return small


def _sweep(line: np.ndarray, t: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> None:
    """Scan ``line`` from its start and append, for each suffix met, the one before it in ``t``, if
    ``wanted`` (the last one never is), to its bucket (``at`` has the next free place of each). Free places
    are negative."""
    done, reach, n = 0, 256, len(line)
    steps = np.arange(n)
    while done < n:
        window = line[done:done + reach]
        free = window < 0
        k = int(free.argmax())
        stop = k if free[k] else len(window)
        j = window[:stop] - 1  # before the first suffix stands the last one
        j = j[wanted[j]]
        m = len(j)
        if m:
            d = t[j]
            order = d.argsort(kind="stable")
            d = d[order]
            new = (d[1:] != d[:-1]).nonzero()[0]
            first = np.empty(len(new) + 1, dtype=np.int64)
            first[0] = 0
            first[1:] = new
            first[1:] += 1
            count = np.empty_like(first)
            count[:-1] = first[1:]
            count[-1] = m
            count -= first
            heads = d[first]
            place = at[heads]
            line[np.repeat(place - first, count) + steps[:m]] = j[order]
            at[heads] = place + count
        done += stop
        reach = max(256, 2 * stop)


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix order from the order of the leftmost-smaller suffixes ``lms``."""
    n, size = len(t), int(t.max()) + 1
    n_large, n_small = (np.bincount(t[kind], minlength=size) for kind in (~small, small))
    # forward: of each bucket the places of its larger suffixes, then its seeds
    seeds = lms[np.argsort(t[lms], kind="stable")]
    of = t[seeds]
    n_seed = np.bincount(of, minlength=size)
    block = n_large + n_seed
    first = np.cumsum(block) - block
    line = np.full(int(block.sum()), -1, dtype=np.int64)
    line[(first + n_large)[of] + np.arange(len(seeds)) - (np.cumsum(n_seed) - n_seed)[of]] = seeds
    large, behind = ~small, small.copy()
    large[-1] = behind[-1] = False
    _sweep(line, t, large, first.copy())
    larger = line[~small[line]]
    # back: each bucket's smaller suffixes from its end, behind its larger ones
    sa = np.full(n, -1, dtype=np.int64)
    ends = np.cumsum(n_large + n_small)
    of = t[larger]
    sa[(ends - n_large - n_small)[of] + np.arange(len(larger)) - (np.cumsum(n_large) - n_large)[of]] = larger
    sa[0] = n - 1  # the terminator is not induced; it is alone in its bucket
    _sweep(sa[::-1], t, behind, n - ends)
    return sa


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``t``: small non-negative integers, the last unique and smallest."""
    n = len(t)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    if t.max() < 1 << 16:
        t = t.astype(np.uint16)  # stable sorts of short integers are by digits
    small = _types(t)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sa = _induce(t, small, starts)
    is_start = np.zeros(n, dtype=bool)
    is_start[starts] = True
    lms = sa[is_start[sa]]
    # equal neighbours among the sorted leftmost-smaller substrings get one name
    length = np.zeros(n, dtype=np.int64)
    length[starts] = np.diff(np.r_[starts, n - 1]) + 1
    a, b = lms[:-1], lms[1:]
    same = length[a] == length[b]
    pending, o = np.flatnonzero(same), 0
    while len(pending):
        equal = t[a[pending] + o] == t[b[pending] + o]
        same[pending[~equal]] = False
        pending, o = pending[equal], o + 1
        pending = pending[length[a[pending]] > o]
    name = np.empty(n, dtype=np.int64)
    name[lms] = np.cumsum(np.r_[0, ~same])
    reduced = name[starts]
    if int(reduced.max(initial=0)) + 1 < len(reduced):
        lms = starts[suffix_array(reduced)]
    return _induce(t, small, lms)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, first: np.ndarray, length: np.ndarray,
                      cap: int, barrier: int) -> np.ndarray:
    """For each place of the segments, the common prefix with the suffix before it in
    the order, up to ``cap`` and never over a value of ``barrier`` or less.

    Going one place on within a segment loses one at most, so all segments
    move on together and only compare what is new.
    """
    phi = np.zeros(len(t), dtype=np.int64)
    phi[sa[1:]] = sa[:-1]
    out = np.zeros(len(t), dtype=np.int16)
    carry = np.zeros(len(first), dtype=np.int64)
    live = np.arange(len(first))
    padded = np.r_[t, np.zeros(cap + 1, dtype=t.dtype)]
    o = 0
    while len(live):
        live = live[length[live] > o]
        p = first[live] + o
        q = phi[p]
        got = np.maximum(carry[live] - 1, 0)
        grow = np.arange(len(live))
        while len(grow):
            x = padded[p[grow] + got[grow]]
            grow = grow[(x == padded[q[grow] + got[grow]]) & (x > barrier) & (got[grow] < cap)]
            got[grow] += 1
        carry[live] = got
        out[p] = got
        o += 1
    return out

"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-array steps.

``suffix_array``: suffixes are classed as larger (L) or smaller (S) than their right neighbour; the leftmost S of each
run (LMS) begins a substring. Induction sorts these substrings, they get names, and the string of names is sorted in
turn; then the order of LMS suffixes induces that of all. Induction goes bucket by bucket: what a bucket receives from
others is in place before it is read, so all that it passes on is one numpy step, and only runs of one symbol take a
step each. A string of names has about as many symbols as places; where these are over ``BUCKETS``, each name is spelt
in two digits, which leaves the order of suffixes as it is, and that string, shorter than the one before since a name
covers two symbols at least, is sorted by the same induction. So every level is induced.
"""

from __future__ import annotations

import numpy as np

#: Names from which on they are spelt in digits.
BUCKETS = 1024


def _types(t: np.ndarray) -> np.ndarray:
    """True for S. The last symbol is a sentinel below all others."""
    n = len(t)
    step = np.sign(t[1:].astype(np.int32) - t[:-1])
    at = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n))
    at = np.minimum.accumulate(at[::-1])[::-1]
    s = np.ones(n, bool)
    s[:-1] = step[np.minimum(at, n - 2)] > 0
    return s


def _push(sa: np.ndarray, t: np.ndarray, at: np.ndarray, ptr: np.ndarray, way: int, count: np.ndarray) -> None:
    """Put suffixes into the buckets of their first symbols, in order, from ptr on in direction way. count: 0, 1, ..."""
    if not len(at):
        return
    c = t[at]
    order = np.argsort(c, kind="stable")  # of 16-bit symbols: a radix sort
    c = c[order]
    size = np.bincount(c, minlength=len(ptr))
    before = np.cumsum(size) - size
    if way > 0:
        sa[(ptr - before)[c] + count[: len(c)]] = at[order]
        ptr += size
    else:
        sa[(ptr + before)[c] - count[: len(c)]] = at[order]
        ptr -= size


def _induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array that an order of the LMS suffixes induces."""
    n = len(t)
    sa, count = np.zeros(n, np.int32), np.arange(n, dtype=np.int32)
    size = np.bincount(t, minlength=sigma)
    larger = np.bincount(t[~s], minlength=sigma)
    start = np.cumsum(size) - size
    stop = start + size
    used = np.flatnonzero(size)
    head = start.copy()
    by = lms[np.argsort(t[lms], kind="stable")]
    cut = np.searchsorted(t[by], np.arange(sigma + 1))
    for c in used:
        at, end = start[c], head[c]
        while at < end:  # a run of one symbol induces itself
            cur = sa[at:end] - 1
            cur = cur[cur >= 0]
            cur = cur[t[cur] == c]
            at = end
            sa[end : end + len(cur)] = cur
            end += len(cur)
        head[c] = end
        src = np.concatenate((sa[start[c] : end], by[cut[c] : cut[c + 1]])) - 1
        src = src[src >= 0]
        _push(sa, t, src[t[src] > c], head, 1, count)
    tail = stop - 1
    for c in used[::-1]:
        at, end = stop[c] - 1, tail[c]
        while at > end:
            cur = sa[end + 1 : at + 1][::-1] - 1
            cur = cur[cur >= 0]
            cur = cur[(t[cur] == c) & s[cur]]
            at = end
            sa[end - len(cur) + 1 : end + 1] = cur[::-1]
            end -= len(cur)
        tail[c] = end
        src = np.concatenate((sa[end + 1 : stop[c]][::-1], sa[start[c] : start[c] + larger[c]][::-1])) - 1
        src = src[src >= 0]
        _push(sa, t, src[t[src] < c], tail, -1, count)
    sa[0] = n - 1  # the sentinel
    return sa


def _spell(names: np.ndarray, count: int) -> tuple[np.ndarray, int, int]:
    """names under count, the last one 0 and below all others, in two digits each, from 1 on, and one 0 at the end. Returns (string, its number of symbols, digits of a name)."""
    if count <= BUCKETS:
        return names, count, 1
    base = int(np.ceil(np.sqrt(count)))
    out = np.zeros(2 * len(names) - 1, np.int32)
    out[:-1:2], out[1::2] = names[:-1] // base + 1, names[:-1] % base + 1
    return out, base + 1, 2


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """t: symbols under sigma (at most 65,536), the last one 0 and below all others."""
    n, t = len(t), t.astype(np.uint16)
    if n < 2:
        return np.zeros(n, np.int32)
    s = _types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]).astype(np.int32) + np.int32(1)
    sa = _induce(t, s, lms, sigma)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ranked = sa[is_lms[sa]]
    # Names: equal to the one before if length and symbols are.
    end = np.append(lms[1:], np.int32(n - 1))
    length = np.zeros(n, np.int32)
    length[lms] = end - lms + 1
    a, b = ranked[:-1], ranked[1:]
    same = length[a] == length[b]
    at = np.flatnonzero(same)
    if len(at):
        size = length[a[at]]
        begin = (np.cumsum(size) - size).astype(np.int32)
        off = np.arange(size.sum(), dtype=np.int32) - np.repeat(begin, size)
        equal = t[np.minimum(np.repeat(a[at], size) + off, n - 1)] == t[np.minimum(np.repeat(b[at], size) + off, n - 1)]
        del off
        same[at] = np.logical_and.reduceat(equal, begin)
    names = np.concatenate(([0], np.cumsum(~same))).astype(np.int32)
    if names[-1] < len(lms) - 1:
        name = np.zeros(n, np.int32)
        name[ranked] = names
        spelt, symbols, digits = _spell(name[lms], int(names[-1]) + 1)
        del sa, is_lms, end, length, same, names, name
        order = suffix_array(spelt, symbols)
        ranked = lms[order[order % digits == 0] // digits]
    return _induce(t, s, ranked, sigma)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, starts: np.ndarray, cap: int) -> np.ndarray:
    """For each suffix the length, at most cap, that it shares with the one before it in sa.

    A suffix whose left symbol is that of its predecessor's left one shares one symbol less than its left neighbour;
    others (and starts, at which counting begins anew because of cap) are compared.
    """
    n = len(t)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    head = np.ones(n, bool)
    ok = phi[1:] > 0
    head[1:] = ~(ok & (t[:-1] == t[np.maximum(phi[1:], 1) - 1]) & (phi[:-1] == phi[1:] - 1))
    head[starts] = True
    at = np.flatnonzero(head).astype(np.int32)
    shared = np.zeros(len(at), np.int32)
    live = np.flatnonzero(phi[at] >= 0)
    while len(live):
        x, y = at[live] + shared[live], phi[at[live]] + shared[live]
        good = (x < n) & (y < n) & (shared[live] < cap)
        good[good] = t[x[good]] == t[y[good]]
        live = live[good]
        shared[live] += 1
    place = np.arange(n, dtype=np.int32)
    last = np.maximum.accumulate(np.where(head, place, np.int32(0)))
    value = np.zeros(n, np.int32)
    value[at] = shared
    return np.maximum(value[last] - (place - last), 0)

"""Suffix arrays by induced sorting (Nong, Zhang and Chan, 2009), and permuted common prefixes.

Suffixes are classed as smaller (S) or larger (L) than the next one. The substrings between leftmost
S positions are sorted by an induction, named, and sorted as suffixes by recursion on the names; a
second induction then gives the whole array. On byte texts, a bucket's entries are induced from in
chunks of array operations: all that the chunk before has added. Names are of too many letters to
walk their buckets, so in the recursion a suffix takes its place by the run of symbols up to the
next suffix of the other class and that one's rank, which the induction would have carried to it.
"""

from __future__ import annotations

import numpy as np


def classify(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is S; the last is a sentinel, less than all else."""
    n = len(s)
    differs = np.append(s[:-1] != s[1:], True)
    at = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n - 1))
    at = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal symbols ends
    return np.append(s, 0)[at] < np.append(s[1:], [s[-1], s[-1]])[at] if n > 1 else np.ones(n, bool)


def spread(sa: np.ndarray, at: np.ndarray, found: np.ndarray, keys: np.ndarray, step: int) -> None:
    """Put ``found`` behind what their buckets have, in order; ``at`` are the buckets' next places."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[new, len(k)])
    sa[at[k] + step * (np.arange(len(k)) - np.repeat(new, size))] = found[order]
    at[k[new]] += step * size


def induce(s: np.ndarray, is_s: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes sorted, as far as the given order of the leftmost S ones tells."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    key = s[first]
    back = ends - 1
    spread(sa, back, first[::-1], key[::-1], -1)
    lms_from = back + 1
    head = starts.copy()
    letters = np.flatnonzero(ends > starts)
    for c in letters:  # L from smaller to larger
        done = starts[c]
        while done < head[c]:
            j = sa[done : head[c]] - 1
            done = head[c]
            j = j[j >= 0]
            j = j[~is_s[j]]
            if len(j):
                spread(sa, head, j, s[j], 1)
        j = sa[lms_from[c] : ends[c]] - 1
        j = j[j >= 0]
        j = j[~is_s[j]]
        if len(j):
            spread(sa, head, j, s[j], 1)
    tail = ends - 1
    for c in letters[::-1]:  # S from larger to smaller
        done = ends[c] - 1
        while done > tail[c]:
            j = sa[tail[c] + 1 : done + 1][::-1] - 1
            done = tail[c]
            j = j[j >= 0]
            j = j[is_s[j]]
            if len(j):
                spread(sa, tail, j, s[j], -1)
        j = sa[starts[c] : head[c]][::-1] - 1
        j = j[j >= 0]
        j = j[is_s[j]]
        if len(j):
            spread(sa, tail, j, s[j], -1)
    return sa


def names_of(s: np.ndarray, is_s: np.ndarray, order: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-S substrings, which ``order`` has sorted; equal ones share a rank."""
    length = np.zeros(len(s), np.int32)
    length[lms] = np.diff(np.append(lms, len(s) - 1)) + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    d = 0
    while len(live):
        x, y = a[live] + d, b[live] + d
        ok = (s[x] == s[y]) & (is_s[x] == is_s[y])
        same[live[~ok]] = False
        live = live[ok]
        d += 1
        live = live[length[a[live]] > d]
    rank = np.empty(len(s), np.int32)
    rank[order] = np.cumsum(np.append(0, ~same))
    return rank[lms].astype(np.int64)


def refine(c: np.ndarray, start: np.ndarray, stop: np.ndarray, tail: np.ndarray | None) -> np.ndarray:
    """Ranks of the sequences c[start] to c[stop], then tail[stop]; equal ones share the lowest."""
    rank = np.zeros(len(start), np.int64)
    live = np.arange(len(start))
    more = 0 if tail is None else 1
    bits = int(max(c.max(), 0 if tail is None else tail.max() + 1)).bit_length()

    def symbol(t: int) -> np.ndarray:
        p, end = start[live] + t, stop[live]
        x = np.where(p <= end, c[np.minimum(p, end)], 0)
        return x if tail is None else np.where(p == end + 1, tail[end] + 1, x)

    t = 0
    while len(live):
        x, y = symbol(t), symbol(t + 1)
        if int(rank.max()).bit_length() + 2 * bits < 63:
            order = np.argsort((rank[live] << (2 * bits)) | (x << bits) | y)
        else:
            order = np.lexsort((y, x, rank[live]))
        live, x, y = live[order], x[order], y[order]
        old = rank[live]
        group = np.r_[True, old[1:] != old[:-1]]
        run = group | np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
        place = np.arange(len(live))
        first, head = np.maximum.accumulate(np.where(group, place, 0)), np.maximum.accumulate(np.where(run, place, 0))
        rank[live] = old + head - first
        tied = ~(run & np.r_[run[1:], True])
        t += 2
        live = live[tied]
        live = live[start[live] + t <= stop[live] + more]
    return rank


def next_of(where: np.ndarray, n: int) -> np.ndarray:
    """For each position, the first marked one behind it (n - 1 if there is none)."""
    at = np.where(where, np.arange(n), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(at[1:], n - 1)


def by_ranks(s: np.ndarray) -> np.ndarray:
    """The same construction for a text over many letters that ends in its one least symbol."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    if (np.diff(s[order]) > 0).all():
        return order
    is_s = classify(s)
    is_s[-1] = True
    first = np.r_[False, is_s[1:] & ~is_s[:-1]]
    lms = np.flatnonzero(first)
    c = 2 * s + is_s + 1
    after = next_of(first, n)
    named = refine(c, lms, after[lms], None)
    _, names = np.unique(named, return_inverse=True)
    rank = np.zeros(n, np.int64)
    if names.max() + 1 == len(lms):
        rank[lms] = names
    else:
        rank[lms[by_ranks(names)]] = np.arange(len(lms))
    larger = np.flatnonzero(~is_s)
    rank[larger] = refine(c, larger, after[larger], rank)
    smaller = np.flatnonzero(is_s)
    rank[smaller] = refine(c, smaller, next_of(~is_s, n)[smaller], np.where(is_s, 0, rank))
    return np.lexsort((rank, c))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a byte text in order."""
    s = np.append(text.astype(np.int16) + 1, np.int16(0))
    n = len(s)
    if n < 3:
        return np.array(sorted(range(len(text)), key=lambda i: text[i:].tobytes()), np.int64)
    is_s = classify(s)
    is_s[-1] = True
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    size = np.bincount(s, minlength=257)
    ends = np.cumsum(size)
    starts = ends - size
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sa = induce(s, is_s, lms, starts, ends)
    names = names_of(s, is_s, sa[is_lms[sa]], lms)
    letters = int(names.max()) + 1
    if letters == len(lms):
        order = np.empty(len(lms), np.int64)
        order[names] = np.arange(len(lms))
    else:
        order = by_ranks(names)
    return induce(s, is_s, lms[order], starts, ends)[1:]


def permuted_prefixes(text: np.ndarray, sa: np.ndarray, most: int, where: np.ndarray | None = None) -> np.ndarray:
    """For each position, the common prefix with the suffix before it in the array, ``most`` at most;
    0 for positions that ``where``, if given, leaves out.

    In text order, by way of each position's predecessor; eight bytes are compared at once.
    """
    n = len(text)
    before = np.full(n, n, np.int32)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[:, ::-1]
    word = np.zeros(n + most + 8, np.uint64)
    for i in range(8):
        word |= eight[: len(word), 7 - i].astype(np.uint64) << np.uint64(8 * i)
    out = np.zeros(n, np.int32)
    live = np.flatnonzero(before < n if where is None else where & (before < n)).astype(np.int32)
    room = n - np.maximum(np.arange(n, dtype=np.int32), before)  # to the end of the text
    d = 0
    while len(live) and d < most:
        x = word[live + d] ^ word[before[live] + d]
        equal = x == 0
        off = live[~equal]
        low = x[~equal]
        low &= ~low + np.uint64(1)
        out[off] = d + (np.log2(low.astype(np.float64)).astype(np.int32) >> 3)
        live = live[equal]
        d += 8
        out[live] = d
        live = live[d < room[live]]
    return np.minimum(np.minimum(out, room), most)

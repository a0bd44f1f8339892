"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The scan that induces suffixes from sorted leftmost-smaller (LMS) ones goes through the
first-symbol buckets in order and handles all suffixes of a bucket that are known so far
at once, so the work is linear with a few array operations per bucket.  Strings with few
suffixes to a bucket, as reduced strings are, are scanned suffix by suffix instead; the
order is the same.  Reduced strings are sorted by the same recursion whatever their
alphabet.  Positions are 32-bit: a shard is far below 2**31 symbols.
"""

from __future__ import annotations

from array import array

import numpy as np

from .common import ranges

#: mean suffixes to a bucket from which array operations for each bucket pay off
FULL_BUCKETS = 64


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next (S type); the last suffix counts as S."""
    n = len(s)
    step = np.empty(n, np.int8)
    step[-1] = 1
    step[:-1] = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    nxt = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n - 1))
    return step[np.minimum.accumulate(nxt[::-1])[::-1]] > 0


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix array order induced from LMS positions given in order (per first symbol)."""
    n, k = len(s), len(sizes)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    sa = np.full(n, -1, np.int32)
    small = s.astype(np.uint16) if k <= 65536 else s
    by = np.zeros(k + 1, np.int64)
    np.cumsum(np.bincount(s[lms], minlength=k), out=by[1:])
    lms = lms[np.argsort(small[lms], kind="stable")]

    def place(src: np.ndarray, want_s: bool, at: np.ndarray, sign: int) -> None:
        pred = src[src > 0] - 1
        pred = pred[is_s[pred] == want_s]
        if not len(pred):
            return
        c = small[pred]
        order = np.argsort(c, kind="stable")
        c = c[order].astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        count = np.diff(np.append(start, len(c)))
        rank = np.arange(len(c)) - np.repeat(start, count)
        if sign > 0:
            sa[at[c] + rank] = pred[order]
        else:
            sa[at[c] - 1 - rank] = pred[order]
        at[c[start]] += sign * count

    used = np.flatnonzero(sizes)
    head = heads.copy()
    for c in used:                        # L suffixes, smallest symbol first
        at = heads[c]
        while at < head[c]:
            upto = head[c]
            place(sa[at:upto], False, head, 1)
            at = upto
        place(lms[by[c]: by[c + 1]], False, head, 1)
    tail = ends.copy()
    for c in used[::-1]:                  # S suffixes, largest symbol first
        at = ends[c]
        while at > tail[c]:
            downto = tail[c]
            place(sa[downto:at][::-1], True, tail, -1)
            at = downto
        place(sa[heads[c]: head[c]][::-1], True, tail, -1)
    sa[0] = n - 1                         # the sentinel's suffix
    return sa


def _induce_each(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of ``_induce`` found one suffix at a time: for strings with few suffixes to a bucket."""
    ends = np.cumsum(sizes)
    by = s[lms].astype(np.int64)
    order = np.argsort(by, kind="stable")
    count = np.bincount(by, minlength=len(sizes))
    first = np.full(len(s), -1, np.int32)
    first[ranges(ends - count, count)] = lms[order]             # at the ends of their buckets
    sa = array("i", first.tobytes())
    # bucket of the suffix that starts one symbol earlier, by its type; the entry after the last serves empty places
    before = np.append(np.concatenate(([-1], s[:-1])), -1).astype(np.int32)
    is_l = np.concatenate(([False], ~is_s[:-1], [False]))
    into, at = array("i", np.where(is_l, before, -1).tobytes()), array("q", (ends - sizes).tobytes())
    for p in sa:                                                # L suffixes; the loop reads what it places
        c = into[p]
        if c >= 0:
            k = at[c]
            sa[k] = p - 1
            at[c] = k + 1
    into, at = array("i", np.where(is_l, -1, before).tobytes()), array("q", ends.tobytes())
    for i in range(len(sa) - 1, -1, -1):                        # S suffixes take the places of the LMS ones
        p = sa[i]
        c = into[p]
        if c >= 0:
            k = at[c] - 1
            sa[k] = p - 1
            at[c] = k
    sa[0] = len(sa) - 1
    return np.frombuffer(sa, np.int32)


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """Start positions of the sorted suffixes of ``s``; its last symbol is a unique 0."""
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    is_s = _types(s)
    mark = is_s.copy()
    mark[0] = False
    mark[1:] &= ~is_s[:-1]
    lms = np.flatnonzero(mark).astype(np.int32)
    sizes = np.bincount(s, minlength=alphabet)
    induce = _induce if n > FULL_BUCKETS * np.count_nonzero(sizes) else _induce_each
    if len(lms) > 1:
        sa = induce(s, is_s, lms, sizes)
        ordered = sa[mark[sa]]
        # name equal LMS substrings alike
        end = np.full(n, n, np.int32)
        end[lms[:-1]] = lms[1:]
        end[lms[-1]] = lms[-1]
        length = end[ordered] - ordered + 1
        same = length[1:] == length[:-1]
        live = np.flatnonzero(same)
        k = 0
        while len(live):
            a, b = ordered[live], ordered[live + 1]
            differ = s[a + k] != s[b + k]
            same[live[differ]] = False
            k += 1
            live = live[~differ & (length[live] > k)]
        names = np.concatenate(([0], np.cumsum(~same)))
        if names[-1] + 1 == len(lms):
            lms = ordered
        else:
            reduced = np.empty(n, np.int64)
            reduced[ordered] = names
            reduced = reduced[lms]
            kinds = int(names[-1]) + 1
            lms = lms[suffix_array(reduced, kinds)]
    return induce(s, is_s, lms, sizes)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Permuted longest common prefixes: of each suffix with the one before it in the suffix array.

    Only irreducible values (where the symbols before the two suffixes differ) are
    compared; each following position loses one.
    """
    n = len(s)
    phi = np.empty(n, np.int32)
    phi[sa[0]] = -1
    phi[sa[1:]] = sa[:-1]
    reducible = np.zeros(n, bool)
    reducible[1:] = (phi[1:] > 0) & (phi[:-1] >= 0) & (phi[1:] == phi[:-1] + 1)
    reducible[1:] &= s[phi[1:] - 1] == s[:-1]
    base = np.flatnonzero(~reducible).astype(np.int32)
    value = np.zeros(n, np.int32)
    live = base[phi[base] >= 0]
    other, k = phi[live], 0
    while len(live):
        room = np.maximum(live, other) + k < n
        live, other = live[room], other[room]
        equal = s[live + k] == s[other + k]
        live, other = live[equal], other[equal]
        k += 1
        value[live] = k
    pos = np.arange(n, dtype=np.int32)
    last = np.maximum.accumulate(np.where(reducible, np.int32(0), pos))
    return np.maximum(0, value[last] - (pos - last))

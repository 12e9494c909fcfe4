"""Suffix arrays of one shard by induced sorting, and their permuted common prefixes, in numpy.

A suffix is of type S if it is smaller than the one that follows it, else of type L; a leftmost S suffix
(LMS) follows an L.  The LMS substrings are sorted and named, the string of names is sorted by the same
procedure (it is at most half as long), and the order of all suffixes is induced from that of the LMS
suffixes.  Over a byte alphabet the induction is the linear one: buckets are filled from left to right for
L, from right to left for S, each bucket in a few vector steps.  In the recursion, where nearly every
symbol has a bucket of its own, suffixes are refined symbol by symbol up to their next LMS suffix, whose
rank settles the rest; both give the same order.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are induced bucket by bucket.
BUCKETS = 300


def types(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """S types, and the LMS positions; ``t`` ends in a unique smallest symbol."""
    step = np.sign(np.diff(t.astype(np.int64)))
    n = len(t)
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    small = np.ones(n, dtype=bool)
    small[:-1] = step[following] > 0
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    return small, lms


def _refine(t: np.ndarray, small: np.ndarray, starts: np.ndarray, ends: np.ndarray, rank: np.ndarray | None):
    """Order of ``starts`` by their symbols and types up to the next LMS position, and group numbers.

    ``ends`` marks LMS positions.  With ``rank`` (of LMS positions) ties there are settled by it, so the order
    is that of the suffixes; without it equal substrings share a number.  Suffixes with equal symbols and types
    reach their LMS position together, so one step treats a whole group alike.
    """
    symbol = 2 * t.astype(np.int64) + small
    value = symbol
    if rank is not None:
        value = symbol * (int(ends.sum()) + 1) + np.where(ends, rank + 1, 0)
        if (int(value.max()) + 1) * len(t) >= 2**62:
            value = np.unique(value, return_inverse=True)[1]
    high = int(value.max()) + 1
    order = np.argsort(symbol[starts], kind="stable")
    keys = symbol[starts][order]
    group = np.zeros(len(starts), dtype=np.int64)  # by slot: the first slot of its group
    slots = np.arange(len(starts))
    k = 0
    while len(slots):
        first = np.ones(len(slots), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        head = np.flatnonzero(first)
        size = np.diff(np.append(head, len(slots)))
        group[slots] = np.repeat(slots[head], size)
        more = np.repeat(size > 1, size)
        if k:
            more &= ~ends[starts[order[slots]] + k]
        slots = slots[more]
        if not len(slots):
            break
        k += 1
        at = starts[order[slots]] + k
        keys = group[slots] * high + value[at]
        by = np.argsort(keys, kind="stable")
        order[slots] = order[slots][by]
        keys = keys[by]
    return order, group


def _sort(t: np.ndarray) -> np.ndarray:
    n = len(t)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    small, lms = types(t)
    ends = np.zeros(n, dtype=bool)
    ends[lms] = True
    order, group = _refine(t, small, lms, ends, None)
    names = np.empty(len(lms), dtype=np.int64)
    dense = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
    names[order] = dense
    if dense[-1] + 1 < len(lms):
        order = _sort(names)
    lms_sorted = lms[order]
    if int(t.max()) < BUCKETS:
        return _induce(t, small, lms_sorted)
    rank = np.zeros(n, dtype=np.int64)
    rank[lms_sorted] = np.arange(len(lms))
    everywhere = np.arange(n)
    return everywhere[_refine(t, small, everywhere, ends, rank)[0]]


def _induce(t: np.ndarray, small: np.ndarray, lms_sorted: np.ndarray) -> np.ndarray:
    n, letters = len(t), t.astype(np.uint16)
    size = int(letters.max()) + 1
    count = np.bincount(letters, minlength=size)
    end = np.cumsum(count)
    start = end - count
    sa = np.full(n, -1, dtype=np.int64)
    sa[0] = n - 1
    marks = np.searchsorted(letters[lms_sorted], np.arange(size + 1))

    def spread(sources: np.ndarray, wanted: bool):
        """Predecessors of the wanted type, by letter; their letters, and their numbers within the letter."""
        before = sources[sources > 0] - 1
        before = before[small[before] == wanted]
        if not len(before):
            return before, None, None
        by = np.argsort(letters[before], kind="stable")
        before = before[by]
        letter = letters[before]
        head = np.flatnonzero(np.append(True, letter[1:] != letter[:-1]))
        runs = np.diff(np.append(head, len(letter)))
        return before, (letter[head], runs), np.arange(len(letter)) - np.repeat(head, runs)

    def put_large(sources):
        before, runs, number = spread(sources, False)
        if runs is not None:
            sa[np.repeat(head[runs[0]], runs[1]) + number] = before
            head[runs[0]] += runs[1]

    def put_small(sources):
        before, runs, number = spread(sources, True)
        if runs is not None:
            sa[np.repeat(tail[runs[0]], runs[1]) - 1 - number] = before
            tail[runs[0]] -= runs[1]

    head = start.copy()
    for c in range(size):
        done = start[c]
        while done < head[c]:
            upto = head[c]
            put_large(sa[done:upto].copy())
            done = upto
        put_large(lms_sorted[marks[c] : marks[c + 1]])
    tail = end.copy()
    for c in range(size - 1, 0, -1):
        done = end[c]
        while tail[c] < done:
            upto = tail[c]
            put_small(sa[upto:done][::-1].copy())
            done = upto
        put_small(sa[start[c] : head[c]][::-1].copy())
    return sa


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; a suffix that ends is smaller than one that goes on.

    ``symbols`` are non-negative integers; an empty input gives an empty array.
    """
    if not len(symbols):
        return np.zeros(0, dtype=np.int64)
    t = np.zeros(len(symbols) + 1, dtype=np.int64)
    t[:-1] = np.asarray(symbols, dtype=np.int64) + 1
    return _sort(t)[1:]


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each position, as one integer (zeros beyond the end)."""
    padded = np.zeros(len(data) + 15, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 8, dtype="<u8", buffer=padded, strides=(1,)).astype(np.uint64)


def permuted_lcp(data: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position the length of the common prefix with the suffix before it in the array.

    In text order a value falls by at most one, and by exactly one wherever the letters before the two
    suffixes agree.  So only the other positions (irreducible ones) are compared, eight bytes at a time.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    phi = np.full(n, -1, dtype=np.int64)
    phi[sa[1:]] = sa[:-1]
    at = np.arange(n)
    fresh = np.ones(n, dtype=bool)
    inner = (at > 0) & (phi > 0)
    fresh[inner] = data[at[inner] - 1] != data[phi[inner] - 1]
    fresh[1:] |= phi[:-1] < 0
    eight = words_at(data)
    value = np.zeros(n, dtype=np.int64)
    left, right = at[fresh & (phi >= 0)], None
    right = phi[left]
    length = np.zeros(len(left), dtype=np.int64)
    todo = np.arange(len(left))
    while len(todo):
        a, b = left[todo] + length[todo], right[todo] + length[todo]
        rest = n - np.maximum(a, b)
        diff = eight[np.minimum(a, n)] ^ eight[np.minimum(b, n)]
        low = (diff & (~diff + np.uint64(1))).astype(np.float64)
        same = np.where(diff == 0, 8, (np.log2(np.maximum(low, 1)).astype(np.int64)) // 8)
        same = np.minimum(same, np.maximum(rest, 0))
        length[todo] += same
        todo = todo[(same == 8) & (rest > 8)]
    value[left] = length
    known = np.where(fresh, at, 0)
    base = np.maximum.accumulate(known)
    return np.maximum(value[base] - (at - base), 0)

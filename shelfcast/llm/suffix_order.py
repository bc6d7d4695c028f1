"""Blockwise suffix sorting with a difference cover, over one byte array in memory.

Suffixes are sorted one bucket (range of leading bytes) at a time.  Inside a bucket they are
ordered by their first V bytes; longer ties are resolved by the precomputed ranks of the
cover sample: for any two places there is a shift below V that takes both into the sample.
Only one bucket's keys are in memory at a time, besides the text and the sample's ranks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

V = 32
WORDS = V // 8
PAD = 8 * (WORDS + 1)  # zero bytes to follow the text


@lru_cache(maxsize=1)
def cover() -> tuple[np.ndarray, np.ndarray]:
    """A difference cover of V (found greedily) and, for two residues, the shift that takes
    both into it."""
    def differences(c: int, others: list[int]) -> set[int]:
        return {(c - d) % V for d in others} | {(d - c) % V for d in others}

    chosen, missing = [0], set(range(1, V))
    while missing:
        c = max(range(V), key=lambda x: (len(differences(x, chosen) & missing), -x))
        missing -= differences(c, chosen)
        chosen.append(c)
    inside = np.zeros(V, bool)
    inside[chosen] = True
    shift = np.zeros((V, V), np.int64)
    for i in range(V):
        for j in range(V):
            shift[i, j] = next(k for k in range(V) if inside[(i + k) % V] and inside[(j + k) % V])
    return np.array(sorted(chosen)), shift


def leading_words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, big-endian; ``text`` ends with PAD zero bytes."""
    n = len(text) - 7
    w = np.zeros(n, np.uint64)
    for k in range(8):
        w <<= np.uint64(8)
        w |= text[k:k + n]
    return w


def refine(order: np.ndarray, group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort places within equal groups (ascending, contiguous) by ``key`` (one per place, in the
    same sequence); returns the places and their new groups."""
    by = np.lexsort((key, group))
    order, group, key = order[by], group[by], key[by]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
    return order, np.cumsum(new) - 1


class CoverSample:
    """Ranks of the suffixes at the cover's places, by their first ``depth`` bytes or more."""

    def __init__(self, words: np.ndarray, n: int, depth: int):
        d, self.shift = cover()
        place = (np.arange(0, n + V, V)[:, None] + d).ravel()
        place = place[place < n]
        self.index = np.full(V, -1, np.int64)
        self.index[d] = np.arange(len(d))
        self.width = len(d)
        self.n = n
        order, group = place, np.zeros(len(place), np.int64)
        for k in range(WORDS):
            order, group = refine(order, group, words[np.minimum(order + 8 * k, len(words) - 1)])
        self.rank = np.zeros(len(place) + 1, np.int64)  # the last: past the end
        at = V
        while True:
            self.rank[self.number(order)] = group + 1
            if at >= depth or not len(group) or group[-1] == len(group) - 1:
                break
            order, group = refine(order, group, self.of(order + at))
            at *= 2

    def number(self, place: np.ndarray) -> np.ndarray:
        return place // V * self.width + self.index[place % V]

    def of(self, place: np.ndarray) -> np.ndarray:
        """Ranks of cover places; past the end the smallest."""
        inside = place < self.n
        return np.where(inside, self.rank[np.where(inside, self.number(place), 0)], 0)

    def greater(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i follows suffix j, for pairs with V equal leading bytes."""
        s = self.shift[i % V, j % V]
        return self.of(i + s) > self.of(j + s)


def resolve(order: np.ndarray, group: np.ndarray, sample: CoverSample) -> np.ndarray:
    """Sort every group of ties by the sample, all groups at once: a merge-exchange network
    whose comparisons look up the ranks at the pair's shift."""
    order = order.copy()
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(first, len(group)))
    local = np.arange(len(group)) - np.repeat(first, size)
    size = np.repeat(size, size)
    steps = np.maximum(size - 1, 0)
    level = np.zeros(len(group), np.int64)
    while steps.any():
        level += steps > 0
        steps >>= 1
    for t in np.unique(level[size > 1]).tolist():
        at = np.flatnonzero((level == t) & (size > 1))
        idx, m = local[at], size[at]
        p = 1 << (t - 1)
        while p:
            q, r, d = 1 << (t - 1), 0, p
            while True:
                left = at[((idx & p) == r) & (idx + d < m)]
                i, j = order[left], order[left + d]
                swap = sample.greater(i, j)
                order[left[swap]], order[left[swap] + d] = j[swap], i[swap]
                if q == p:
                    break
                d, q, r = q - p, q >> 1, p
            p >>= 1
    return order


def sorted_blocks(text: np.ndarray, places: np.ndarray, depth: int, bucket: int = 1 << 19):
    """Yield the given suffixes of ``text`` (which ends with PAD zero bytes) in lexicographic
    order up to ``depth`` bytes, block by block: no two blocks share a leading word."""
    if not len(places):
        return
    words = leading_words(text)
    sample = CoverSample(words, len(text) - PAD, depth)
    lead = words[places]
    # splitters: leading words of a spread of places; one bucket is one range between them
    pick = np.sort(lead[:: max(1, bucket // 64)])
    splitters = np.unique(pick[63::64]) if len(places) > bucket else pick[:0]
    where = np.searchsorted(splitters, lead, "right")
    for b in range(len(splitters) + 1):
        order = places[where == b] if len(splitters) else places
        if not len(order):
            continue
        group = np.zeros(len(order), np.int64)
        for k in range(WORDS):
            tied = np.ones(len(order), bool)
            if k:
                same = group[1:] == group[:-1]
                tied = np.concatenate([[False], same]) | np.concatenate([same, [False]])
                if not tied.any():
                    break
            sub, new = refine(order[tied], group[tied], words[order[tied] + 8 * k])
            order[tied] = sub
            start = np.ones(len(order), bool)
            start[1:] = group[1:] != group[:-1]
            at = np.flatnonzero(tied)
            inner = np.concatenate([[False], (new[1:] != new[:-1])])
            start[at[inner]] = True
            group = np.cumsum(start) - 1
        yield resolve(order, group, sample)

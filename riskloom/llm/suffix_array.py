"""Suffix arrays by induced sorting, whole buckets at a time, and permuted common prefixes.

Suffixes are classified as smaller or larger than their right neighbour. Sorted leftmost-smaller
suffixes induce the larger ones in one pass over the buckets from the left and the smaller ones
in one pass from the right. A pass handles what a bucket holds as one array: everything it
induces goes to its own or to later buckets, so a bucket is finished after as many steps as its
character repeats in a row. Order among leftmost-smaller suffixes comes from the same passes
over their substrings and, where substrings repeat, from the suffixes of the string of their
names, sorted recursively.
"""

from __future__ import annotations

import numpy as np

# Beyond this many characters, more than bytes need, passes over single buckets no longer pay.
LARGEST_ALPHABET = 300
_STEP = 32


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array by rank doubling, for alphabets too large for bucket passes.

    A rank is the first place of its group; each round sorts the members of larger groups only.
    The first round sorts by as many characters as one number holds.
    """
    n, h = len(s), 1
    keys, bits = s.astype(np.int64), max(1, int(s.max(initial=0)).bit_length())
    while 2 * h * bits < 64 and h < n:
        keys <<= h * bits  # the last character is unique, so nothing needs to stand behind it
        keys[:-h] |= keys[h:] >> h * bits
        h *= 2
    order = np.argsort(keys)
    keys, places, rank = keys[order], np.arange(n), np.empty(n, np.int64)
    while True:
        new = np.ones(len(places), bool)
        new[1:] = keys[1:] != keys[:-1]
        rank[order[places]] = np.maximum.accumulate(np.where(new, places, 0))
        places = places[~(new & np.append(new[1:], True))]
        if not len(places):
            return order
        items = order[places]
        after = items + h
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        keys = rank[items] * (n + 2) + second
        by = np.argsort(keys)  # equal keys stay one group, so their order is free
        keys, order[places] = keys[by], items[by]
        h *= 2


class _Passes:
    """The induction passes over one string, whose last character is its unique smallest."""

    def __init__(self, s: np.ndarray):
        n = len(s)
        self.s, self.n = s, n
        size = np.bincount(s)
        self.tails = np.cumsum(size)
        self.heads = self.tails - size
        change = np.flatnonzero(s[:-1] != s[1:])
        after = np.repeat(change, np.diff(change, prepend=-1))  # the last character is unique
        self.small = np.ones(n, bool)
        self.small[:-1] = s[after] < s[after + 1]
        self.left = np.zeros(n, bool)
        self.left[1:] = self.small[1:] & ~self.small[:-1]

    def _grouped(self, block: np.ndarray, small: bool):
        """Left neighbours of the wanted type, by character, with their place in the group."""
        at = block[block > 0] - 1
        at = at[self.small[at] == small]
        chars = self.s[at]
        order = np.argsort(chars, kind="stable")
        at, chars = at[order], chars[order]
        count = np.bincount(chars, minlength=len(self.heads))
        place = np.arange(len(at)) - (np.cumsum(count) - count)[chars]
        return at, chars, place, count

    def run(self, lefts: np.ndarray) -> np.ndarray:
        """All suffixes, induced from leftmost-smaller ones in the given order."""
        sa = np.full(self.n, -1, np.int32)
        chars = self.s[lefts]
        order = np.argsort(chars, kind="stable")
        lefts, chars = lefts[order], chars[order]
        held = np.bincount(chars, minlength=len(self.heads))
        first = self.tails - held
        sa[first[chars] + np.arange(len(lefts)) - (np.cumsum(held) - held)[chars]] = lefts
        fill = self.heads.copy()
        used = np.flatnonzero(self.tails > self.heads)
        for c in used.tolist():
            low = self.heads[c]
            while low < fill[c]:
                low, block = fill[c], sa[low : fill[c]]
                self._put(sa, fill, block, False)
            if held[c]:
                self._put(sa, fill, sa[first[c] : self.tails[c]], False)
        ends = self.tails.copy()
        sa[0], ends[self.s[-1]] = self.n - 1, 0
        for c in used[::-1].tolist():
            high = self.tails[c]
            while ends[c] < high:
                high, block = ends[c], sa[ends[c] : high][::-1]
                self._put(sa, ends, block, True)
            if fill[c] > self.heads[c]:
                self._put(sa, ends, sa[self.heads[c] : fill[c]][::-1], True)
        return sa

    def _put(self, sa: np.ndarray, fill: np.ndarray, block: np.ndarray, small: bool) -> None:
        at, chars, place, count = self._grouped(block, small)
        if small:
            sa[fill[chars] - 1 - place] = at
            fill -= count
        else:
            sa[fill[chars] + place] = at
            fill += count


def _names(s: np.ndarray, ordered: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Names of the sorted leftmost-smaller substrings; equal ones share a name."""
    a, b = ordered[:-1], ordered[1:]
    size_a, size_b = stops[a] - a, stops[b] - b
    same = size_a == size_b
    open_ = np.flatnonzero(same)
    step = 0
    while len(open_):
        open_ = open_[size_a[open_] >= step]
        equal = s[a[open_] + step] == s[b[open_] + step]
        same[open_[~equal]] = False
        open_ = open_[equal]
        step += 1
    return np.concatenate(([0], np.cumsum(~same)))


def sorted_suffixes(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s``, an array of small integers whose last is its unique smallest."""
    n = len(s)
    if n < 3 or int(s.max()) >= LARGEST_ALPHABET:
        return _doubled(s)
    passes = _Passes(s)
    lefts = np.flatnonzero(passes.left)
    stops = np.zeros(n, np.int64)
    stops[lefts] = np.append(lefts[1:], n - 1)
    sa = passes.run(lefts)
    ordered = sa[passes.left[sa]]
    names = _names(s, ordered, stops)
    if names[-1] + 1 < len(ordered):
        by_place = np.empty(n, np.int64)
        by_place[ordered] = names
        ordered = lefts[sorted_suffixes(by_place[lefts])]
    return passes.run(ordered)


def common_prefixes(s: np.ndarray, sa: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position, its predecessor in ``sa`` (or -1) and the length they share.

    ``room`` is the distance to the separator behind a position; prefixes end there. Where the
    characters in front of both agree, the length is one less than that of the position before;
    only the other positions, and those behind a separator, are compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    compare = np.ones(n, bool)
    here = np.flatnonzero((before > 0) & (np.arange(n) > 0))
    compare[here] = (s[here - 1] != s[before[here] - 1]) | (room[here - 1] == 0)
    shared = np.zeros(n, np.int32)
    rows = np.flatnonzero(compare & (before >= 0) & (room > 0))
    padded = np.concatenate((s, np.zeros(_STEP, s.dtype)))
    reach = np.arange(_STEP)
    while len(rows):
        out = []
        for part in np.array_split(rows, max(1, len(rows) // 16384)):
            x = part + shared[part]
            y = before[part] + shared[part]
            differ = padded[x[:, None] + reach] != padded[np.minimum(y, n - 1)[:, None] + reach]
            step = np.where(differ.any(1), differ.argmax(1), _STEP)
            shared[part] = np.minimum(shared[part] + step, room[part])
            out.append(part[(step == _STEP) & (shared[part] < room[part])])
        rows = np.concatenate(out)
    known = np.flatnonzero(compare)
    source = np.repeat(known, np.diff(known, append=n))
    return before, np.maximum(shared[source] - (np.arange(n) - source), 0)


def repeated_windows(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, where windows of ``length`` bytes start that occur twice in the pieces."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes + 1) - 1  # places of the separators
    s = np.empty(int(ends[-1]) + 2, np.int16)
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    s[:-1] = raw.astype(np.int16) + 2
    s[ends] = 1
    s[-1] = 0
    stop = np.append(ends, len(s) - 1)
    room = np.concatenate([np.repeat(stop, np.append(sizes + 1, 1))]) - np.arange(len(s))
    sa = sorted_suffixes(s)
    before, shared = common_prefixes(s, sa, room)
    twice = shared >= length
    again = np.flatnonzero(twice)
    twice[before[again]] = True
    starts = ends - sizes
    return [np.flatnonzero(twice[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]

"""Suffix arrays by induced sorting, and permuted common prefixes, over flat numpy arrays.

A suffix is of type S if it is smaller than its right neighbour, else of type L; leftmost S-types (LMS) are
those with an L-type to their left. LMS substrings are sorted by inducing, named, and the string of names is
sorted by the same function; from the order of the LMS suffixes two sweeps over the buckets induce all
others. A sweep handles a bucket at a time instead of a suffix at a time: what a bucket induces lies in
later buckets, or in the bucket itself for runs of one symbol, which takes one more round per symbol. So
every suffix is moved once per sweep. Where names are nearly as many as places, buckets hold next to
nothing; such a string is sorted by doubling the compared length instead.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``symbols`` (whole numbers from 0) in ascending order; a prefix comes first."""
    symbols = np.asarray(symbols)
    if len(symbols) < 2:
        return np.arange(len(symbols), dtype=np.int32)
    # A last symbol smaller than all others ends every comparison.
    text = np.zeros(len(symbols) + 1, dtype=np.int32)
    text[:-1] = symbols
    text[:-1] += 1
    return _sorted(text, int(text.max()) + 1)[1:]


def _sorted(text: np.ndarray, size: int) -> np.ndarray:
    if size * 64 > len(text) and size > 1024:
        return _by_doubling(text)
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    if len(lms) > 1:
        induced = _induce(text, small, lms, size)
        starts = np.zeros(len(text), dtype=bool)
        starts[lms] = True
        lms = _lms_order(text, lms, induced[starts[induced]])
    return _induce(text, small, lms, size)


def _types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are of type S; the last symbol is."""
    step = np.diff(text)
    # A run of one symbol has the type of what follows the run.
    next_step = np.where(step != 0, np.arange(len(step)), len(step))
    next_step = np.minimum.accumulate(next_step[::-1])[::-1]
    small = np.ones(len(text), dtype=bool)
    small[:-1] = np.append(step, 1)[next_step] > 0
    return small


def _spread(places: np.ndarray, symbols: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Append places to the buckets of their symbols, in the order given."""
    if not len(places):
        return
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    ends = [*cuts.tolist(), len(places)]
    start = 0
    for end, symbol in zip(ends, symbols[[0, *cuts]].tolist(), strict=True):
        buckets[symbol].append(places[start:end])
        start = end


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes, from LMS suffixes in the order given: L-types from the left, then S-types from the right."""
    by_symbol: list[list[np.ndarray]] = [[] for _ in range(size)]
    _spread(lms, text[lms], by_symbol)
    nothing = np.zeros(0, dtype=np.int32)
    whole = lambda blocks: np.concatenate(blocks) if len(blocks) > 1 else blocks[0] if blocks else nothing
    narrow = text.astype(np.uint16) if size <= 1 << 16 else text  # short symbols are sorted by digits

    large: list[list[np.ndarray]] = [[] for _ in range(size)]
    for symbol in range(size):
        current, found = whole(large[symbol]), []
        large[symbol] = []
        while len(current):
            large[symbol].append(current)
            before = current[current > 0] - 1
            before = before[~small[before]]
            again = narrow[before] == symbol
            found.append(before[~again])
            current = before[again]
        found.append(whole(by_symbol[symbol])[whole(by_symbol[symbol]) > 0] - 1)
        found = whole(found)
        _spread(found, narrow[found], large)

    # From here on blocks run from right to left.
    back: list[list[np.ndarray]] = [[] for _ in range(size)]
    for symbol in range(size - 1, -1, -1):
        current, found = whole(back[symbol]), []
        back[symbol] = []
        while len(current):
            back[symbol].append(current)
            before = current[current > 0] - 1
            before = before[small[before]]
            again = narrow[before] == symbol
            found.append(before[~again])
            current = before[again]
        before = whole(large[symbol])[::-1]
        before = before[before > 0] - 1
        found.append(before[small[before]])
        found = whole(found)
        _spread(found, narrow[found], back)
    last = np.array([len(text) - 1], dtype=np.int32)  # nothing induces the last symbol
    return np.concatenate([last, *(b for s in range(size) for b in (*large[s], whole(back[s])[::-1]))])


def _lms_order(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """LMS suffixes in order, from ``order``, in which only their LMS substrings are sorted."""
    length = np.zeros(len(text), dtype=np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = order[:-1], order[1:]
    differ = length[a] != length[b]
    left, k = np.flatnonzero(~differ), 0
    while len(left):
        unlike = text[a[left] + k] != text[b[left] + k]
        differ[left[unlike]] = True
        left, k = left[~unlike], k + 1
        left = left[length[a[left]] > k]
    names = np.zeros(len(text), dtype=np.int32)
    names[order[1:]] = np.cumsum(differ)
    reduced = names[lms]
    if reduced.max() + 1 == len(lms):
        return order
    return lms[_sorted(reduced, int(reduced.max()) + 1)]


def _by_doubling(text: np.ndarray) -> np.ndarray:
    """By ranks of twice the length each round, among suffixes that are still equal."""
    order = np.argsort(text, kind="stable")
    new = np.append(True, text[order][1:] != text[order][:-1])
    rank = np.empty(len(text) + 1, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))
    rank[-1] = -1
    length = 1
    while True:
        alone = new & np.append(new[1:], True)
        left = np.flatnonzero(~alone)
        if not len(left):
            return order.astype(np.int32)
        places = order[left]
        own, after = rank[places], rank[np.minimum(places + length, len(text))]
        sort = np.lexsort((after, own))
        places, own, after = places[sort], own[sort], after[sort]
        order[left] = places
        new[left] = np.append(True, (own[1:] != own[:-1]) | (after[1:] != after[:-1]))
        rank[places] = np.maximum.accumulate(np.where(new[left], left, 0))
        length *= 2


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """By place, how many symbols a suffix has in common with the one before it in ``order``, ``most`` at most.

    The place where a common prefix ends never falls from a suffix to its right neighbour. So prefixes are
    found at every 64th place first, and halfway between two known ones only symbols between their ends are
    compared.
    """
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int32)
    before = np.empty(n, dtype=np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    common = np.zeros(n, dtype=np.int32)
    # Eight bytes from every place on, where symbols are bytes.
    bytes_ = np.append(text, np.zeros(8, dtype=np.uint8)) if text.dtype == np.uint8 else None
    wide = np.ndarray(n, dtype="<u8", buffer=bytes_, strides=(1,)) if bytes_ is not None else None
    step = 64
    places = np.arange(0, n, step)
    while len(places):
        if step == 64:
            low, high = np.zeros(len(places), dtype=np.int64), np.full(len(places), most)
        else:
            low = np.maximum(common[places - step] - step, 0).astype(np.int64)
            right = places + step
            reach = common[np.minimum(right, n - 1)] + step
            # A cut prefix only says that there is more.
            open_end = (right >= n) | (common[np.minimum(right, n - 1)] == most)
            high = np.where(open_end, most, np.minimum(reach, most))
        other = before[places]
        room = np.where(other < 0, 0, np.minimum(n - places, n - np.maximum(other, 0)))
        high = np.minimum(high, room)
        found = np.minimum(low, high)
        left = np.flatnonzero(found + 8 <= high) if wide is not None else places[:0]
        while len(left):
            left = left[wide[places[left] + found[left]] == wide[other[left] + found[left]]]
            found[left] += 8
            left = left[found[left] + 8 <= high[left]]
        left = np.flatnonzero(found < high)
        while len(left):
            same = text[places[left] + found[left]] == text[other[left] + found[left]]
            left = left[same]
            found[left] += 1
            left = left[found[left] < high[left]]
        common[places] = found
        if step == 1:
            return common
        step //= 2
        places = np.arange(step, n, 2 * step)
        if not len(places):
            while step > 1 and not len(places):
                step //= 2
                places = np.arange(step, n, 2 * step)
    return common

"""Suffix arrays by grouping suffixes with equal Lyndon prefixes.

First the suffixes are sorted into groups. Groups are taken from the highest to the
lowest; each suffix of a group points to the nearest suffix before it that is in a lower
group (its previous smaller one), and what is pointed to moves to a new group right above
its own, further up the more pointers it got: its prefix has grown by that many copies of
the group's word. In the end a group holds the suffixes with one longest Lyndon prefix.
Then one pass in ascending order puts, for each suffix, those it is the next smaller one
of at the first free place of their groups. Both passes are linear; nothing is renamed and
there is no recursion.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ``text`` (numbers above 0). The end counts as lowest."""
    n = len(text) + 1
    letters = np.zeros(n, np.int64)
    letters[:-1] = text
    order = np.argsort(letters, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    first = np.searchsorted(letters[order], letters)
    return _group(order.tolist(), rank.tolist(), first.tolist(), n)


def _group(order: list[int], place: list[int], group: list[int], n: int) -> np.ndarray:
    """``order``: suffixes by group; ``place``: where each stands in it; ``group``: where the
    group of each begins."""
    size = [0] * (n + 1)
    for g in group:
        size[g] += 1
    previous = list(range(-1, n - 1))
    top = n - 1
    while top > 0:
        low = group[order[top]]
        if low == top:
            # A group of one moves a single suffix, if any.
            s = order[top]
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                g = group[p]
                size[g] -= 1
                last = g + size[g]
                if last != g:
                    at = place[p]
                    if at != last:
                        other = order[last]
                        order[at], order[last] = other, p
                        place[other], place[p] = at, last
                    group[p] = last
                    size[last] = 1
                else:
                    size[g] = 1
            top = low - 1
            continue
        pointed: dict[int, int] = {}
        many = 0
        # In order of the text: then those before in this very group know where they point.
        for s in sorted(order[low : top + 1]):
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                many += 1
                if p in pointed:
                    pointed[p] += 1
                else:
                    pointed[p] = 1
        if many == len(pointed):
            if many:
                _move(pointed, order, place, group, size)
        else:
            levels: list[list[int]] = [[] for _ in range(max(pointed.values()) + 1)]
            for p, times in pointed.items():
                levels[times].append(p)
            for level in reversed(levels):
                if level:
                    _move(level, order, place, group, size)
        top = low - 1
    return _induce(previous, group, n)


def _move(suffixes, order: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Take suffixes out of their groups into new ones, each right above the old."""
    touched: dict[int, int] = {}
    for p in suffixes:
        g = group[p]
        size[g] -= 1
        last = g + size[g]
        at = place[p]
        if at != last:
            other = order[last]
            order[at], order[last] = other, p
            place[other], place[p] = at, last
        touched[g] = touched.get(g, 0) + 1
    for g, count in touched.items():
        new = g + size[g]
        size[new] = count
        for p in order[new : new + count]:
            group[p] = new


def _induce(previous: list[int], group: list[int], n: int) -> np.ndarray:
    """Sort within groups: suffixes follow their next smaller suffix in order."""
    sorted_ = [-1] * n
    free = list(range(n))
    placed = bytearray(n)
    sorted_[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = sorted_[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            sorted_[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = previous[j]
    return np.array(sorted_[1:], np.int64)

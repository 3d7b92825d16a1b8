"""Suffix order of a text by Lyndon grouping, linear and without recursive renaming (after Baier's grouping principle).

The suffixes that share their longest Lyndon prefix form a group. Groups are taken in descending order. A group's members
point to the nearest suffix to their left that lies in a lower group; that suffix's prefix grows by the group's prefix,
once per member that points to it, so it moves to a new group right above its old one. When all groups are
settled, a walk over the suffixes in ascending order emits every group: behind each emitted suffix, the chain of pointers
from its left neighbour names the suffixes whose Lyndon prefix ends there, and each takes its group's next place.
"""

from __future__ import annotations


def groups_of(text: list[int]) -> tuple[list[int], list[int]]:
    """(first place of every suffix's group, pointer of every suffix); ``text`` ends with its only smallest symbol."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, home, size, left = [0] * n, [0] * n, [0] * n, [-1] * n
    start = 0
    for k, s in enumerate(order):
        if k and text[s] != text[order[k - 1]]:
            start = k
        place[s], home[s] = k, start
        size[start] += 1
    end = n
    while end > 0:
        low = home[order[end - 1]]
        seen: dict[int, int] = {}
        for s in sorted(order[low:end]) if end - low > 1 else (order[low],):
            p = s - 1
            while p >= 0 and home[p] >= low:
                p = left[p]
            left[s] = p
            if p >= 0:
                seen[p] = seen.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, times in seen.items():
            by_times.setdefault(times, []).append(p)
        # The counts of a group add up to its size, so there are few different ones.
        for moved in [by_times[times] for times in sorted(by_times, reverse=True)]:
            for p in moved:
                h = home[p]
                size[h] -= 1
                at, to = place[p], h + size[h]
                other = order[to]
                order[at], order[to] = other, p
                place[other], place[p] = at, to
            for p in moved:
                home[p] += size[home[p]]
            for p in moved:
                size[home[p]] += 1
        end = low
    return home, left


def suffix_order(text: list[int]) -> list[int]:
    """Suffixes in ascending order; ``text`` ends with its only smallest symbol."""
    home, left = groups_of(text)
    n = len(text)
    out, taken, free = [0] * n, [False] * n, home
    filled = [0] * n
    out[0] = n - 1
    taken[n - 1] = True
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not taken[s]:
            taken[s] = True
            h = free[s]
            out[h + filled[h]] = s
            filled[h] += 1
            s = left[s]
    return out

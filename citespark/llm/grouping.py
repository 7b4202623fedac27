"""Suffix array by linear grouping of Lyndon prefixes (after Baier's GSACA, published 2016): no recursion, no renaming."""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of `text` (integers of any range), an end below every symbol understood.

    Phase 1 groups suffixes by their longest Lyndon prefix. Groups start as the symbols and are taken in
    descending order; each suffix of the group taken is linked to the nearest suffix before it that lies in a smaller group
    (previous smaller), whose prefix it prolongs: those prolonged leave their group for a new one right above
    it, the more copies of the prefix they gained, the higher. Phase 2 goes through the array in ascending order: a suffix that is
    placed tells, along the previous-smaller pointers, which suffixes end their Lyndon prefix where it
    starts; each takes the next place of its group.
    """
    n = len(text)
    if not n:
        return []
    by: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by.setdefault(c, []).append(i)
    # a group is its id; members may hold suffixes that have left it
    members: list[list[int]] = []
    start: list[int] = []
    end: list[int] = []
    group = [0] * n
    ending = [-1] * (n + 1)  # the group that ends at a place of the array
    at = 0
    for c in sorted(by):
        own = by[c]
        g = len(members)
        members.append(own)
        start.append(at)
        at += len(own)
        end.append(at)
        ending[at] = g
        for i in own:
            group[i] = g
    before = [-1] * n
    at = n
    while at:
        g = ending[at]
        low = start[g]
        own = members[g] if end[g] - low == len(members[g]) else [i for i in members[g] if group[i] == g]
        gained: dict[int, int] = {}
        for i in own:  # ascending, so equals before i have their pointers
            j = i - 1
            while j >= 0 and start[group[j]] >= low:
                j = before[j]
            before[i] = j
            if j >= 0:
                gained[j] = gained.get(j, 0) + 1
        if gained:
            parts: dict[tuple[int, int], list[int]] = {}
            for j in gained:
                parts.setdefault((group[j], -gained[j]), []).append(j)
            for old, less in sorted(parts) if len(parts) > 1 else parts:
                moved = parts[old, less]
                top = end[old]
                if top - len(moved) == start[old]:  # all that is left of it: the group itself goes on
                    members[old] = sorted(moved)
                    continue
                new = len(members)
                moved.sort()
                members.append(moved)
                end.append(top)
                start.append(top - len(moved))
                ending[top] = new
                end[old] = top - len(moved)
                ending[end[old]] = old
                for j in moved:
                    group[j] = new
        at = low
    order = [0] * n
    free = start  # the next place of each group
    placed = bytearray(n)
    j = n - 1
    while j >= 0:  # those whose Lyndon prefix reaches the end
        g = group[j]
        order[free[g]] = j
        free[g] += 1
        placed[j] = 1
        j = before[j]
    for k in range(n):
        j = order[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]
    return order

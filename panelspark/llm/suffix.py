"""Suffix sorting by linear grouping: Lyndon-prefix groups, then one pass that emits their order."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``symbols`` (integers) in lexicographic order.

    Phase 1 groups the suffixes by their longest Lyndon prefix, in the order
    of these prefixes. It starts from groups of one symbol and takes the
    groups from the highest down. Each suffix of the group gets a pointer to
    the previous suffix of a lower group (by way of the pointers of the
    suffixes between, whose groups are done). The Lyndon prefix of that
    earlier suffix goes on with the group's prefix, once for each suffix that
    points to it; so the suffixes pointed to leave their group for new ones
    just above it, in the order of that number.

    Phase 2 goes up the suffix array. After suffix x is known, those whose
    Lyndon prefix ends just before x are x - 1 and what its pointers lead to,
    up to the first that has a place already; each takes the next free place
    of its group. Nothing is renamed and sorted again.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, dtype=np.int64)
    _, rank = np.unique(symbols, return_inverse=True)
    by_rank = np.argsort(rank, kind="stable")
    cuts = np.flatnonzero(np.diff(rank[by_rank])) + 1
    members = [m.tolist() for m in np.split(by_rank, cuts)]
    size = [len(m) for m in members]
    group = rank.tolist()
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    prev = [-1] * n
    done = bytearray(n)

    g = len(members) - 1
    while g >= 0:
        times: dict[int, int] = {}
        for i in sorted([i for i in members[g] if group[i] == g]):
            j = i - 1
            while j >= 0 and done[j]:
                j = prev[j]
            prev[i] = j
            done[i] = 1
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        by_times: dict[int, dict[int, list[int]]] = {}
        for j, t in times.items():
            by_times.setdefault(t, {}).setdefault(group[j], []).append(j)
        for t in sorted(by_times, reverse=True):
            for h, moved in by_times[t].items():
                if len(moved) == size[h]:
                    continue  # all that is left of a group: it keeps its place
                new, top = len(members), above[h]
                members.append(moved)
                size.append(len(moved))
                size[h] -= len(moved)
                below.append(h)
                above.append(top)
                above[h] = new
                below[top] = new  # top exists: the groups being split are below g
                for j in moved:
                    group[j] = new
        g = below[g]

    slot = [0] * len(members)
    g, start = 0, 0
    while g >= 0:
        slot[g] = start
        start += size[g]
        g = above[g]
    order = [0] * n
    placed = bytearray(n)
    for r in range(-1, n):
        i = (order[r] if r >= 0 else n) - 1
        while i >= 0 and not placed[i]:
            h = group[i]
            order[slot[h]] = i
            slot[h] += 1
            placed[i] = 1
            i = prev[i]
    return np.array(order, dtype=np.int64)

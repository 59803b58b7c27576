"""Suffix arrays by linear grouping construction (no recursive renaming).

Suffixes are first grouped by their Lyndon prefixes. Groups are taken in descending order; each member points to the
nearest suffix on its left that lies in a lower group (its previous smaller one), and the suffixes pointed to leave
their group for a new one right above it, the further up the more members point to them. Afterwards the order inside
the groups is emitted in one run over the array from the smallest suffix on: the suffix before a placed one, and along
the pointers those before it, take the next place of their group.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of `text` in lexicographic order (a suffix precedes those it is a prefix of)."""
    n = len(text)
    by_symbol: dict[int, set[int]] = {}
    for i, symbol in enumerate(text):
        by_symbol.setdefault(symbol, set()).add(i)
    groups = [by_symbol[s] for s in sorted(by_symbol)]
    below, above = list(range(-1, len(groups) - 1)), list(range(1, len(groups) + 1))
    if groups:
        above[-1] = -1
    group_of = [0] * n
    for g, members in enumerate(groups):
        for i in members:
            group_of[i] = g
    open_left = list(range(-1, n))  # open_left[i + 1]: i while i waits, else a place further left; shifted so -1 is a root
    smaller = [-1] * n
    lowest, current = 0, len(groups) - 1
    while current >= 0:
        members = groups[current]
        for i in members:
            open_left[i + 1] = i - 1
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while (k := open_left[j + 1]) != j:
                open_left[j + 1] = open_left[k + 1]
                j = k
            smaller[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        moves: dict[int, dict[int, list[int]]] = {}
        for j, count in pointed.items():
            moves.setdefault(group_of[j], {}).setdefault(count, []).append(j)
        for g, by_count in moves.items():
            for count in sorted(by_count, reverse=True):
                leaving = by_count[count]
                if len(leaving) == len(groups[g]):
                    continue  # all that is left of the group moves: its place is right already
                groups[g].difference_update(leaving)
                new = len(groups)
                groups.append(set(leaving))
                for j in leaving:
                    group_of[j] = new
                over = above[g]
                below.append(g)
                above.append(over)
                above[g] = new
                if over >= 0:
                    below[over] = new
        current = below[current]
    places, at = [0] * len(groups), 0
    g = lowest if groups else -1
    while g >= 0:
        places[g] = at
        at += len(groups[g])
        g = above[g]
    out, placed = [-1] * n, bytearray(n)
    for k in range(-1, n):
        j = (out[k] if k >= 0 else n) - 1
        while j >= 0 and not placed[j]:
            g = group_of[j]
            out[places[g]] = j
            places[g] += 1
            placed[j] = 1
            j = smaller[j]
    return out


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """For each entry of the suffix array, how many symbols it shares with the entry before it (0 for the first)."""
    n = len(text)
    rank, out, shared = [0] * n, [0] * n, 0
    for k, i in enumerate(order):
        rank[i] = k
    for i in range(n):
        k = rank[i]
        if k == 0:
            shared = 0
            continue
        j = order[k - 1]
        while i + shared < n and j + shared < n and text[i + shared] == text[j + shared]:
            shared += 1
        out[k] = shared
        shared = max(shared - 1, 0)
    return out
